"""Quality rules with cutoffs whose false rejections are bounded.

Base rules are fixed: too few words, too many repeated ones. On top of them each rule of ``RULES`` has a cutoff for each
stratum (by default the language), chosen from labelled documents:

1. On a third of the labelled rows, the cutoff of the rule's grid that best parts good from bad rows.
2. On the other rows, cutoffs are tested from the loosest to that one. A cutoff is certified if the exact binomial
   probability of seeing so few false rejections, were their rate above the rule's share of ``risk``, is at most the
   error level. Testing stops at the first failure (a fixed sequence needs no correction); levels are divided by the
   number of rules and strata (Bonferroni), so all guarantees hold together with probability 1 - ``error``. A
   stratum's rate of false rejection is at most ``risk`` by the union bound over its rules.

A rule without certified cutoff in a stratum rejects nothing there. Counts are taken over all documents; only one
histogram per stratum meets in a task.

Null texts have no words and fail the base rules, as empty ones do. A null stratum is a stratum of its own. Documents
without label are judged alike; of several labels of one id the least counts. Extra columns are returned, columns named
like results are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeflow.llm.common import text_map
from cladeflow.session import cut

RISK, ERROR = 0.04, 0.05
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_COUNTS = BASE + ("n_lines", "n_upper", "n_marks")
# Quotients of counts; a rule rejects values above its cutoff.
RULES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
}
GRID = tuple(round(1.25**-k, 4) for k in range(-12, 24))
_SYMBOLS, _MARKS = b"#*$%&|<>", b"!?"
_UPPER = bytes(range(65, 91))


def measure(text: bytes) -> tuple[int, ...]:
    """Counts of one text, in the order of _COUNTS."""
    words = text.split()
    n = len(words)
    lines = [line for line in text.split(b"\n") if line.split()]
    repeated = 0
    if n >= 4:
        known: dict[bytes, int] = {}
        ids = np.array([known.setdefault(w, len(known)) for w in words])
        pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
        _, at, count = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
        steps = np.zeros(n + 1, np.int64)
        again = np.flatnonzero(count[at] > 1)
        steps[again] += 1
        steps[again + 3] -= 1
        repeated = int((np.cumsum(steps) > 0).sum())
    return (
        n,
        len(b"".join(words).decode("utf-8", "replace")),
        sum(text.count(c) for c in _SYMBOLS),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        len(text) - len(text.translate(None, _UPPER)),
        sum(text.count(c) for c in _MARKS),
    )


def counts(documents: DataFrame, *, text: str = "text") -> DataFrame:
    """The documents with their counts and base_failed."""
    found = text_map(documents.drop(*_COUNTS), ", ".join(f"{c} bigint" for c in _COUNTS), text, measure, once=True)
    return found.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def certified(rejected: int, good: int, risk: float, level: float) -> bool:
    """Whether so few rejections of good rows are too unlikely (at most level) at a rate above the risk."""
    if not good:
        return False
    log = [
        math.lgamma(good + 1) - math.lgamma(k + 1) - math.lgamma(good - k + 1) + k * math.log(risk) + (good - k) * math.log1p(-risk)
        for k in range(rejected + 1)
    ]
    top = max(log)
    return top + math.log(sum(math.exp(x - top) for x in log)) <= math.log(level)


def choose(fit_good: np.ndarray, fit_bad: np.ndarray, test_good: np.ndarray, risk: float, level: float) -> float | None:
    """Cutoff from histograms by grid place; place p counts values above GRID[p] and not above GRID[p - 1].

    The last place counts values above no cutoff.
    """
    above = lambda h: np.cumsum(h)[:-1]
    gain = above(fit_bad) / max(fit_bad.sum(), 1) - 10 * above(fit_good) / max(fit_good.sum(), 1)
    best = int(np.argmax(gain))
    if gain[best] <= 0:
        return None
    out = None
    for place in range(best + 1):
        if not certified(int(above(test_good)[place]), int(test_good.sum()), risk, level):
            break
        out = GRID[place]
    return out


def _place(value: Column) -> Column:
    """How many cutoffs of the grid are not below the value: one short expression, as a comparison for each fills the driver with plans."""
    return F.size(F.filter(F.array(*map(F.lit, GRID)), lambda c: value <= c))


def cutoffs(measured: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", stratum: str = "lang", good: str = "quality",
            risk: float = RISK, error: float = ERROR) -> DataFrame:
    """stratum (null as empty text) and a cutoff for each rule, null where none is certified."""
    known = labels.where(F.col(good).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.min(good).alias("_good"))
    rows = measured.where("not base_failed").join(known, F.col(doc_id) == F.col("_id")).select(
        _stratum(stratum).alias("stratum"),
        (F.col("_good") > 0).alias("good"),
        (F.pmod(F.xxhash64("_id"), F.lit(3)) == 0).alias("fit"),
        F.explode(F.array(*[
            F.struct(F.lit(name).alias("rule"), F.coalesce(F.try_divide(a, b), F.lit(0.0)).alias("value")) for name, (a, b) in RULES.items()
        ])).alias("r"),
    )
    histogram = rows.groupBy("stratum", "good", "fit", "r.rule", _place(F.col("r.value")).alias("place")).agg(F.count(F.lit(1)).alias("n"))
    strata = histogram.select("stratum").distinct().count()
    level = error / (max(strata, 1) * len(RULES))

    def per_stratum(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = {"stratum": key[0]}
        for name in RULES:
            own = pdf[pdf["rule"] == name]
            h = {
                (g, f): np.bincount(part["place"], part["n"], len(GRID) + 1)
                for g in (True, False)
                for f in (True, False)
                for part in [own[(own["good"] == g) & (own["fit"] == f)]]
            }
            out[name] = choose(h[True, True], h[False, True], h[True, False], risk / len(RULES), level)
        return pd.DataFrame([out]).astype(dict.fromkeys(RULES, "float64"))

    schema = "stratum string, " + ", ".join(f"{name} double" for name in RULES)
    # written, so that documents are joined to it knowing its size
    return cut(histogram.groupBy("stratum").applyInPandas(per_stratum, schema))


def _stratum(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def judge(measured: DataFrame, limits: DataFrame, *, stratum: str = "lang") -> DataFrame:
    """Rows of counts() with kept."""
    limits = limits.select(F.col("stratum").alias("_stratum"), *[F.col(name).alias(f"_{name}") for name in RULES])
    broken = F.lit(False)
    for name, (a, b) in RULES.items():
        broken = broken | F.coalesce(F.try_divide(a, b) > F.col(f"_{name}"), F.lit(False))
    joined = measured.drop("kept").join(limits, _stratum(stratum) == F.col("_stratum"), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~broken).drop("_stratum", *[f"_{name}" for name in RULES])


def apply_rules(documents: DataFrame, labels: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents with counts, base_failed and kept; the texts are read once for the cutoffs and once for the verdict."""
    measured = counts(documents, text=text)
    stratum = options.get("stratum", "lang")
    return judge(measured, cutoffs(measured.drop(text), labels, **options), stratum=stratum)
