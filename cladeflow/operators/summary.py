"""New clades per data source and rank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeflow.functions.genomes import REFERENCE_SOURCES, source_of
from cladeflow.params import RANK_LETTERS

# Column names of the summary, phylum to species.
PLURALS = ("phyla", "classes", "orders", "families", "genera", "species")


def clade_sources(node_names: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Source and rank letter per new clade; clades named after reference accessions drop out."""
    tagged = node_names.select(
        *(by or []), source_of(F.col("genome_rep")).alias("magset"), F.substring("clade", 1, 1).alias("taxon_novelty")
    )
    return tagged.where(~F.col("magset").isin(*REFERENCE_SOURCES))


def counts_by_rank(tagged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per source, one column per rank. All six columns exist whatever the data holds."""
    pivoted = tagged.groupBy(*(by or []), "magset").pivot("taxon_novelty", list(RANK_LETTERS)).count().fillna(0)
    return pivoted.withColumnsRenamed(dict(zip(RANK_LETTERS, PLURALS)))


def with_total(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sources in descending order of their counts, phyla first, and a row ``all`` at the end (of each group)."""
    by = by or []
    sums = [F.sum(name).alias(name) for name in PLURALS]
    sets = [[F.col(c) for c in (*by, "magset")], [F.col(c) for c in by]]
    rolled = counts.groupingSets(sets, *by, "magset").agg(*sums, F.grouping("magset").alias("_total"))
    labelled = rolled.withColumn("magset", F.when(F.col("_total") == 1, "all").otherwise(F.col("magset")))
    return labelled.orderBy(*by, "_total", *[F.desc(name) for name in PLURALS], "magset").drop("_total")


def summarise_clades(node_names: DataFrame, by: list[str] | None = None) -> DataFrame:
    """New clades by source; with ``by`` (such as the domain) for each group, with a total row of its own."""
    return with_total(counts_by_rank(clade_sources(node_names, by), by), by)
