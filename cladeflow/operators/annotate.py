"""Raw tree nodes to the annotated node table naming works on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeflow.functions.labels import label_columns
from cladeflow.functions.ranks import novelty_red, per_domain
from cladeflow.operators.tree import paint_groups
from cladeflow.params import DomainParams, as_domains


def flag_reference(nodes: DataFrame, gtdb_genomes: DataFrame) -> DataFrame:
    """Add ``magset``: ``GTDB`` for genomes of the reference taxonomy, ``other`` for everything else."""
    flags = gtdb_genomes.where(F.col("genome").isNotNull()).select("genome").distinct()
    return nodes.join(flags.withColumn("magset", F.lit("GTDB")), "genome", "left").fillna("other", ["magset"])


def annotate_nodes(raw_nodes: DataFrame, gtdb_genomes: DataFrame, params: DomainParams, full_numbers: bool = False, reach: str = "root") -> DataFrame:
    """``raw_nodes`` has parent, node, branch_length and label; one tree. ``full_numbers``: see ``label_columns``; ``reach``: see
    ``paint_groups``."""
    domains = as_domains(params)
    parsed = raw_nodes.withColumns(label_columns(F.col("label"), full_numbers))
    painted = paint_groups(flag_reference(parsed, gtdb_genomes), reach=reach)
    novelty = per_domain(F.lit(domains[0].domain), {p.domain: novelty_red(F.col("RED"), p) for p in domains})
    return painted.select(
        "parent",
        "node",
        "branch_length",
        "label",
        "RED",
        "bootstrap",
        "taxa",
        "genome",
        "magset",
        "nongtdb_group",
        novelty.alias("novelty_red"),
    )
