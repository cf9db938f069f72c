"""Tables whose rows have an order that holds over all part files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeflow.session import cut
from cladeflow.sources import tsv


def write_in_order(frame: DataFrame, path: str, by: list[Column], folder: str | None = None, null: str = "") -> None:
    """A headered table in the order of the columns ``by``: one sort, cut into ranges of about the same size, a numbered part
    file for each range. With ``folder`` the rows go to one subfolder for each of its values, in order within each."""
    leading = [F.col(folder)] if folder else []
    ordered = frame.orderBy(*leading, *by)
    if folder:
        tsv.write_per_domain(ordered, path, null=null, column=folder)
    else:
        tsv.write_tsv(ordered, path, null=null)


def read_in_order(spark: SparkSession, path: str, columns: dict[str, str], folder: str | None = None, null: str = "") -> DataFrame:
    """The rows with ``row``, their place from 1 on (within their subfolder). Files count in the order of their numbers.

    Rows are numbered within each split of a file; the splits' sizes give what is missing, one row for each split.
    """
    wanted = {**columns, folder: "string"} if folder else columns
    read = tsv.read_headered(spark, path, wanted, null)
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("bigint")
    read = cut(
        read.select("*", part.alias("_part"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    )
    place = [folder] if folder else []
    splits = read.groupBy(*place, "_part", "_block").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*place).orderBy("_part", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(*place, "_part", "_block", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    located = read.join(starts, [*place, "_part", "_block"])
    return located.select(*wanted, (F.col("_at") - F.col("_first") + F.col("_start") + 1).alias("row"))
