"""Mixing documents to target shares of tokens by soft domain membership.

A classifier fitted on labelled rows gives each document a posterior over domains. A document's rate says how often it
is to be read (0 to ``most``). Rates minimise, over all documents,

    |expected tokens by domain - target|^2 / (2 total^2)  +  ridge / 2 * mean over tokens of (rate - 1)^2

by accelerated projected gradients. A step changes a rate by a function of the document's posterior and of the domains'
current gaps alone. So no rates are stored: each pass works them out from the few gaps so far, adds up the expected
tokens by domain in its tasks, and sends one row per task, of as many numbers as there are domains, twice. The work grows with
the documents.

Targets that are not met within the steps, such as shares beyond reach of ``most``, are reported by a warning.

Rates become whole copies: the integer part, and one more with the probability of the rest, drawn by a hash of the id.

Null and empty texts have no tokens, do not count towards the targets, and get the rate of their posterior. Labels that
are null put a row in no domain. A domain without labelled rows gets (nearly) no posterior. Repeated rows are mixed
alike. Extra columns are returned, columns named like results are replaced.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeflow.llm import contrast
from cladeflow.llm.common import release, stream
from cladeflow.session import cut

# A reader's shares of tokens: what the labels call good, poor and toxic.
TARGETS = {"good": 0.95, "poor": 0.03, "toxic": 0.02}
MOST, RIDGE, STEPS, GAP = 4.0, 0.001, 60, 0.002


def rates(posteriors: np.ndarray, gaps: list[np.ndarray], most: float = MOST, ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the steps whose gaps are given, and the point where the next gap is to be measured."""
    now = point = np.ones(len(posteriors))
    pace = 1.0
    for gap in gaps:
        following = np.clip(point - (posteriors @ gap + ridge * (point - 1)) / (1 + ridge), 0, most)
        # momentum starts anew when it points uphill
        pace, before = (1 + np.sqrt(1 + 4 * pace * pace)) / 2, pace
        point = following + (before - 1) / pace * (following - now)
        now = following
    return now, point


def fit_domains(documents: DataFrame, labels: DataFrame, domain: Column, domains: list[str], *, doc_id: str = "doc_id", text: str = "text") -> contrast.Model:
    """domain: a label row's domain, or null. Of several domains of an id the first in the list counts."""
    place = F.array_position(F.array(*map(F.lit, domains)), domain) - 1
    known = labels.select(F.col(doc_id).alias("_id"), place.cast("int").alias("_class")).where("_id is not null and _class >= 0")
    known = known.groupBy("_id").agg(F.min("_class").alias("_class"))
    texts, classes, share = contrast.sample(documents, known, len(domains), doc_id=doc_id, text=text)
    return contrast.train(texts, classes, share)


def posterior(documents: DataFrame, model: contrast.Model, gaps: list[np.ndarray] | None = None, *, text: str = "text", most: float = MOST,
              ridge: float = RIDGE) -> DataFrame:
    """The documents with _tokens, _posterior and, given the gaps, _rate; only the text goes to Python."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<tokens:bigint,p:array<double>,rate:double>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = contrast.Contrasts(shared.value.table)
        for texts in batches:
            tokens, described = [], np.empty((len(texts), len(shared.value.centre)))
            for i, t in enumerate(stream(texts)):
                words = t.split()
                tokens.append(len(words))
                described[i] = contrast.describe(known, t, words)
            p = contrast.posteriors(shared.value, described)
            lists = pa.ListArray.from_arrays(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1], p.ravel())
            yield pa.StructArray.from_arrays(
                [pa.array(tokens, pa.int64()), lists, pa.array(rates(p, gaps or [], most, ridge)[0])], names=["tokens", "p", "rate"]
            )

    return documents.withColumn("_r", read(F.col(text))).select(
        *[f"`{c}`" for c in documents.columns], F.col("_r.tokens").alias("_tokens"), F.col("_r.p").alias("_posterior"), F.col("_r.rate").alias("_rate")
    )


def fit_rates(members: DataFrame, target: np.ndarray, *, most: float = MOST, ridge: float = RIDGE, steps: int = STEPS, gap: float = GAP) -> list[np.ndarray]:
    """Gaps of all steps. members: _tokens and _posterior. target: shares of all tokens, by domain."""
    rows, gaps, scale = members.select("_tokens", "_posterior"), [], None
    for _ in range(steps):
        expected, total = _expected(rows, gaps, len(target), most, ridge)
        if not total:
            return gaps
        now = expected[0] / total - target
        # twice in a row: the momentum may pass the target
        if np.abs(now).max() <= gap and gaps and np.abs(scale).max() <= gap:
            return gaps
        gaps, scale = [*gaps, expected[1] / total - target], now
    expected, total = _expected(rows, gaps, len(target), most, ridge)
    if total and np.abs(missed := expected[0] / total - target).max() > gap:
        warnings.warn(f"shares of tokens miss the targets {target.tolist()} by {missed.round(4).tolist()} after {steps} steps", stacklevel=2)
    return gaps


def _rows(posteriors: pa.Array, domains: int) -> np.ndarray:
    return posteriors.flatten().to_numpy(zero_copy_only=False).reshape(-1, domains)


def _expected(rows: DataFrame, gaps: list[np.ndarray], domains: int, most: float, ridge: float) -> tuple[np.ndarray, float]:
    """Expected tokens by domain at the rates and at the next point, and all tokens. One stage without shuffle: of the many passes,
    plans and events are what fills the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, total = np.zeros((2, domains)), 0.0
        for batch in batches:
            p, tokens = _rows(batch.column("_posterior"), domains), batch.column("_tokens").to_numpy(zero_copy_only=False)
            sums += [np.einsum("i,ij->j", tokens * r, p) for r in rates(p, gaps, most, ridge)]
            total += float(tokens.sum())
        yield pa.RecordBatch.from_pydict({"sums": [sums.ravel().tolist()], "tokens": [total]})

    found = rows.mapInArrow(run, "sums array<double>, tokens double").collect()
    return sum((np.reshape(r["sums"], (2, domains)) for r in found), np.zeros((2, domains))), sum(r["tokens"] for r in found)


def with_rates(members: DataFrame, gaps: list[np.ndarray], *, most: float = MOST, ridge: float = RIDGE) -> DataFrame:
    """Rows of posterior() with the rates that follow from the gaps."""

    @F.arrow_udf("double")
    def rate(p: pa.Array) -> pa.Array:
        return pa.array(rates(_rows(p, len(gaps[0])) if gaps else np.zeros((len(p), 0)), gaps, most, ridge)[0], pa.float64())

    return members.withColumn("_rate", rate("_posterior"))


def shown(members: DataFrame, domains: list[str], *, doc_id: str = "doc_id") -> DataFrame:
    """Rows of posterior() with n_tokens, p_<domain>, rate and copies."""
    draw = F.pmod(F.xxhash64(F.lit("copies"), doc_id), F.lit(1 << 30)) / float(1 << 30)
    parts = {f"p_{d}": F.col("_posterior")[k] for k, d in enumerate(domains)}
    return members.drop("n_tokens", "rate", "copies", *parts).withColumns(
        {"rate": F.col("_rate"), "n_tokens": F.col("_tokens"), **parts, "copies": F.floor(F.col("_rate") + draw).cast("bigint")}
    ).drop("_tokens", "_posterior", "_rate")


def label_domain(quality: str = "quality", toxic: str = "toxic") -> Column:
    return F.when(F.col(toxic) > 0, "toxic").when(F.col(quality) == 0, "poor").when(F.col(quality) > 0, "good")


def mix(documents: DataFrame, labels: DataFrame, *, targets: dict[str, float] = TARGETS, domain: Column | None = None, doc_id: str = "doc_id",
        text: str = "text") -> DataFrame:
    """The documents, text included, with n_tokens, p_<domain>, rate and copies. Texts are read once to fit and once here."""
    domains = list(targets)
    model = fit_domains(documents, labels, label_domain() if domain is None else domain, domains, doc_id=doc_id, text=text)
    release()  # the sample, before the many jobs of the rates
    members = cut(posterior(documents, model, text=text).select("_tokens", "_posterior"))
    gaps = fit_rates(members, np.array(list(targets.values())))
    return shown(posterior(documents, model, gaps, text=text), domains, doc_id=doc_id)
