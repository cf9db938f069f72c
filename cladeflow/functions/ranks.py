"""RED values to ranks: bins, medians and the rank table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeflow.params import RANKS, DomainParams, as_domains

# How the ranks are written in novelty labels.
RANK_TITLES = ("Phylum", "Class", "Order", "Family", "Genus", "Species/Strain")


def per_domain(domain: Column, values: dict[str, Column]) -> Column:
    """CASE over the few domain literals; null for a domain without parameters."""
    (first, value), *rest = values.items()
    case = F.when(domain == first, value)
    for name, value in rest:
        case = case.when(domain == name, value)
    return case


def red_rank(red: Column, edges: tuple[float, ...]) -> Column:
    """Rank 0..5 of a RED value: bins closed on the right, null at 0 and outside (0, 1]."""
    case = F.when((red <= 0) | (red > edges[-1]), F.lit(None).cast("int"))
    for rank, edge in enumerate(edges):
        case = case.when(red <= edge, F.lit(rank))
    return case


def rank_word(novelty: Column) -> Column:
    """Rank word of a novelty label: ``Species/Strain (0.95-1]`` is ``species``."""
    return F.lower(F.substring_index(F.substring_index(novelty, " ", 1), "/", 1))


def rank_index(word: Column) -> Column:
    """0 for phylum to 5 for species, null for anything else."""
    position = F.array_position(F.array(*[F.lit(rank) for rank in RANKS]), word).cast("int")
    return F.when(position > 0, position - 1)


def median_red(rank: Column, params: DomainParams) -> Column:
    case = F.when(rank == 0, params.medians[0])
    for level, median in list(enumerate(params.medians))[1:]:
        case = case.when(rank == level, median)
    return case


def closer_to_median(red: Column, parent_red: Column, median: Column) -> Column:
    """Whether a node is strictly closer to the rank's median RED than its parent is."""
    return F.abs(red - median) < F.abs(parent_red - median)


def two_digits(value: Column) -> Column:
    """``0.95``, ``0.3``, ``1``: two digits without trailing zeros, rounded by the double's exact value.

    0.285 lies a little below 0.285 and becomes 0.28; only values that are exactly half way (0.125) go to the even digit. The
    fraction is taken apart into two numbers of 30 bits and a rest, and 200 times it is compared in whole numbers.
    """
    size, bits = F.abs(value), 2.0**30
    whole = F.floor(size)
    fraction = size - whole
    high = F.floor(fraction * bits)
    low = F.floor((fraction * bits - high) * bits)
    rest = (fraction * bits - high) * bits - low
    mask = F.lit(2**30 - 1).cast("bigint")
    below = low * 200
    above = high * 200 + F.shiftright(below, 30)
    halves = F.shiftright(above, 30)  # so many half hundredths, and something more or nothing:
    exact = (above.bitwiseAND(mask) == 0) & (below.bitwiseAND(mask) == 0) & (rest == 0)
    down = F.shiftright(halves, 1)
    up = (halves % 2 == 1) & (~exact | (down % 2 == 1))
    hundredths = whole * 100 + down + up.cast("bigint")
    unit, digits = F.floor(hundredths / 100).cast("string"), F.lpad((hundredths % 100).cast("string"), 2, "0")
    text = F.when(hundredths % 100 == 0, unit).otherwise(F.concat(unit, F.lit("."), F.rtrim(digits, F.lit("0"))))
    return F.when((value < 0) & (hundredths > 0), F.concat(F.lit("-"), text)).otherwise(text)


def rank_table(spark: SparkSession, params) -> DataFrame:
    """Per domain and rank: median RED, upper cutoff and the novelty label."""
    rows = [
        (p.domain, rank, title, float(median))
        for p in as_domains(params)
        for rank, (title, median) in enumerate(zip(RANK_TITLES, p.medians))
    ]
    medians = spark.createDataFrame(rows, "domain string, rank int, title string, median_red double")
    return with_cutoffs(medians)


def with_cutoffs(medians: DataFrame) -> DataFrame:
    """Add ``cutoff_red`` (midpoint to the next rank's median, 1 for the last) and ``label``."""
    by_rank = Window.partitionBy("domain").orderBy("rank")
    following = F.lead("median_red").over(by_rank)
    cutoffs = medians.withColumn(
        "cutoff_red", F.when(following.isNull(), F.lit(1.0)).otherwise((F.col("median_red") + following) / 2)
    )
    lower = F.coalesce(F.lag("cutoff_red").over(by_rank), F.lit(0.0))
    return cutoffs.withColumn(
        "label",
        F.concat(
            F.col("title"), F.lit(" ("), two_digits(lower), F.lit("-"), two_digits(F.col("cutoff_red")), F.lit("]")
        ),
    )


def novelty_labels(params: DomainParams) -> tuple[str, ...]:
    """The six novelty labels of a domain as plain strings."""
    edges = (0.0, *params.upper_edges)
    return tuple(
        f"{title} ({round(low, 2):g}-{round(high, 2):g}]"
        for title, low, high in zip(RANK_TITLES, edges, edges[1:])
    )


def novelty_red(red: Column, params: DomainParams) -> Column:
    """Novelty label of a RED value."""
    return F.get(F.array(*[F.lit(label) for label in novelty_labels(params)]), red_rank(red, params.upper_edges))
