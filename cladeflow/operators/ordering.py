"""Genomes in order of quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeflow.functions.genomes import quality
from cladeflow.operators.tree import new_tips
from cladeflow.session import cut


def with_quality(tips: DataFrame, metadata: DataFrame) -> DataFrame:
    """New tips joined to their metadata; tips without metadata drop out (see ``issues``).

    Metadata with a ``domain`` column apply to the tips of that domain only.
    """
    by_domain = ["domain"] if "domain" in metadata.columns and "domain" in tips.columns else []
    scores = metadata.select(
        *by_domain,
        F.col("Name").alias("genome"),
        quality(F.col("Completeness").cast("double"), F.col("Contamination").cast("double")).alias("quality"),
    )
    return new_tips(tips).join(scores, ["genome", *by_domain])


def in_order(genomes: DataFrame, *leading: str) -> DataFrame:
    """Add ``ord``, increasing with the order of naming: best quality first (unknown quality before
    all), then genome id descending. The numbers have gaps; only their order counts.

    A range-partitioned sort on a unique key, so equal qualities cannot make one partition hot. The
    numbers are written out at once, as they depend on the partitioning.
    """
    ordered = genomes.orderBy(*leading, F.col("quality").desc_nulls_first(), F.col("genome").desc())
    return cut(ordered.withColumn("ord", F.monotonically_increasing_id()))


def enumerate_genomes(genomes: DataFrame) -> DataFrame:
    """Add ``genome_order``: 0, 1, 2… in the order of naming, without gaps.

    ``ord`` counts within each sorted partition, so the partitions' sizes give what is missing. There
    is one size per partition: few rows, whatever the data.
    """
    ordered = in_order(genomes).withColumn("_part", F.shiftright("ord", 33))
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"), F.min("ord").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", "_first", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn("genome_order", (F.col("ord") - F.col("_first") + F.col("_offset")).cast("bigint"))
        .drop("_part", "_first", "_offset", "ord")
    )
