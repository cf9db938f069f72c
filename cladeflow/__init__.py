"""Clade naming and taxonomy for genome trees, expressed as Spark DataFrame jobs."""

from cladeflow.operators.fill import fill_taxonomy
from cladeflow.operators.naming import name_clades
from cladeflow.operators.summary import summarise_clades
from cladeflow.params import DomainParams, preset

__all__ = ["DomainParams", "fill_taxonomy", "name_clades", "preset", "summarise_clades"]
