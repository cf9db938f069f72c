"""Taxonomy strings: ``d__;p__;c__;o__;f__;g__;s__``, possibly starting at a reference node's id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cladeflow.params import GENUS, NAMED_RANKS, RANK_LETTERS


def clade_name(rank: int, genome: Column) -> Column:
    return F.concat(F.lit(RANK_LETTERS[rank] + "__"), genome)


def species_name(genus: Column, genome: Column) -> Column:
    """``s__<genus> <genome>`` for a genus name with its ``g__`` prefix."""
    return F.concat(F.lit("s"), F.substr(genus, F.lit(2)), F.lit(" "), genome)


def lineage(domain: Column, anchor: Column, anchor_rank: Column, names: list[Column], genome: Column) -> Column:
    """Taxonomy of a genome. ``names`` are the winners' ids per rank, phylum to genus.

    With an anchor the string starts at that node's id and only has the ranks below
    ``anchor_rank``; a species needs a genus name below the anchor.
    """
    above = F.coalesce(anchor_rank, F.lit(-1))
    parts = [F.when(F.lit(rank) > above, clade_name(rank, name)) for rank, name in enumerate(names)]
    assert len(parts) == len(NAMED_RANKS)
    species = species_name(parts[GENUS], genome)
    start = F.when(anchor_rank.isNotNull(), anchor.cast("string")).otherwise(domain)
    return F.concat_ws(";", start, *parts, species)


def is_complete(taxonomy: Column) -> Column:
    return taxonomy.startswith("d__")


def anchor_node(taxonomy: Column) -> Column:
    return F.split_part(taxonomy, F.lit(";"), F.lit(1)).try_cast("bigint")


def below_anchor(taxonomy: Column) -> Column:
    """Everything after the first semicolon, empty if there is none."""
    return F.when(F.contains(taxonomy, F.lit(";")), F.substr(taxonomy, F.instr(taxonomy, ";") + 1)).otherwise("")


def genus_of(taxonomy: Column) -> Column:
    """From ``g__`` to the end, null without a genus."""
    at = F.instr(taxonomy, "g__")
    return F.when(at > 0, F.substr(taxonomy, at))
