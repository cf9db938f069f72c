"""Running sums and maxima over groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = 65536


def running(
    frame: DataFrame, group: list[str], position: str, sums: list[str] = (), maxima: list[str] = (), piece: int = PIECE, short: bool = False
) -> DataFrame:
    """Replace value columns by their running sums or maxima in order of ``position`` within each group.

    ``position`` counts from 0 without large gaps. A window never sees more than ``piece`` rows, or one row per piece of a
    group. ``short`` says that no position reaches ``piece``; one window is then enough.
    """
    values = {**dict.fromkeys(sums, F.sum), **dict.fromkeys(maxima, F.max)}
    kept = [name for name in frame.columns if name not in values]
    if short:
        within = Window.partitionBy(*group).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
        return frame.select(*kept, *[total(name).over(within).alias(name) for name, total in values.items()])
    cut_up = frame.select("*", F.expr(f"{position} div {piece}").alias("_piece"))
    totals = cut_up.groupBy(*group, "_piece").agg(*[total(name).alias(f"_{name}") for name, total in values.items()])
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group, "_piece", *[total(f"_{name}").over(before).alias(f"_{name}") for name, total in values.items()]
    ).where("_piece > 0")
    within = Window.partitionBy(*group, "_piece").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)

    def joined(name: str) -> Column:
        own = values[name](name).over(within)
        return F.greatest(own, f"_{name}") if name in maxima else own + F.coalesce(f"_{name}", F.lit(0))

    return cut_up.join(offsets, [*group, "_piece"], "left").select(*kept, *[joined(name).alias(name) for name in values])
