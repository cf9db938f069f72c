"""Document quality by hierarchical empirical Bayes over sites.

A classifier of texts gives each document evidence: how much likelier its text makes good quality. Hosts and paths have
rates of good documents. All documents count, labelled or not: a document adds its label, or else the classifier's
probability. A host's rate is shrunk towards the global rate and a path's rate towards its host's, each as by a prior
of ``k`` documents. k is estimated from the documents themselves by moments: how much more the groups' means differ than
chance explains. A document's score takes the rate of its path without the document itself as prior odds, and its own
evidence. Sparse sites thus follow the level above them.

Only sums by group move: they are added up before the shuffle, so a host of a third of all documents is one row. The
classifier is fitted on a bounded labelled sample.

Null and empty texts have the evidence the classifier gives to no words. A null host or path is a group of its own. Null
labels are ignored, of several labels of an id the least counts. Without labels of both kinds there is no evidence and
all scores are 0.5. Extra columns are returned but the text, columns named like results are replaced.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeflow.llm import contrast
from cladeflow.llm.common import text_map
from cladeflow.session import cut

RESULT = ("evidence", "host_rate", "path_rate", "score", "kept")
_LEAST = 1e-6


def _logit(p: Column) -> Column:
    clipped = F.least(F.greatest(p, F.lit(_LEAST)), F.lit(1 - _LEAST))
    return F.log(clipped / (1 - clipped))


def strength(groups: int, documents: float, squares: float, within: float, between: float) -> float:
    """Prior documents k. within, between: sums of squares inside groups and of group means about the mean, by documents;
    squares: sum of squared group sizes."""
    if groups < 2 or documents <= groups:
        return 1e6
    spread = within / (documents - groups)
    common = documents - squares / documents
    variance = (between - (groups - 1) * spread) / common if common > 0 else 0.0
    return min(1e6, spread / variance) if variance > 0 else 1e6


def _groups(frame: DataFrame, keys: list[str]) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("_p").alias("s"), F.sum(F.col("_p") * F.col("_p")).alias("q"))


def _strength(groups: DataFrame, mean: Column) -> float:
    r = groups.agg(
        F.count(F.lit(1)).alias("g"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n").cast("double")).alias("squares"),
        F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("within"),
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - mean, 2)).alias("between"),
    ).first()
    return strength(r.g, r.n or 0, r.squares or 0.0, r.within or 0.0, r.between or 0.0)


def _known(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    return labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(
        (F.min(label) > 0).cast("int").alias("_class")
    )


def evidence(documents: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """The documents without text, with evidence: the log odds that the text adds to any prior's."""
    known = _known(labels, doc_id, label)
    texts, classes, share = contrast.sample(documents, known, 2, doc_id=doc_id, text=text)
    if min(np.bincount(classes, minlength=2)) == 0:
        return documents.drop(text).withColumn("evidence", F.lit(0.0))
    model = contrast.train(texts, classes, share)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    prior = math.log(share[1] / share[0])
    cache: list = []

    def read(said: bytes) -> tuple[float]:
        if not cache:
            cache.append(contrast.Contrasts(shared.value.table))
        p = min(max(float(contrast.posterior(shared.value, cache[0], said)[1]), _LEAST), 1 - _LEAST)
        return (math.log(p / (1 - p)) - prior,)

    return text_map(documents.drop("evidence"), "evidence double", text, read).drop(text)


def combine(read: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", host: str = "host", path: str = "path", label: str = "quality") -> DataFrame:
    """Rows of evidence(), with host_rate, path_rate, score (0 to 1) and kept (score of 0.5 or more)."""
    read, known = read.drop(*RESULT[1:]), _known(labels, doc_id, label)
    shares = {r["_class"]: r["n"] for r in known.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect()}
    odds = math.log((shares.get(1, 0) + 1) / (shares.get(0, 0) + 1))
    probability = 1 / (1 + F.exp(-(F.col("evidence") + odds)))
    # labels of rows that are not among the documents don't count for sites
    labelled = read.join(known, F.col(doc_id) == F.col("_id"), "left")
    counted = labelled.withColumn("_p", F.coalesce(F.col("_class").cast("double"), probability)).drop("_id", "_class").withColumns(
        {"_h": F.coalesce(F.col(host).cast("string"), F.lit("\0")), "_q": F.coalesce(F.col(path).cast("string"), F.lit("\0"))}
    )
    paths = cut(_groups(counted, ["_h", "_q"]))
    hosts = paths.groupBy("_h").agg(*[F.sum(c).alias(c) for c in "nsq"])
    whole = hosts.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    mean = whole.s / whole.n if whole.n else 0.5
    k_host, k_path = _strength(hosts, F.lit(mean)), 0.0
    hosts = hosts.select("_h", ((F.col("s") + k_host * mean) / (F.col("n") + k_host)).alias("host_rate"))
    sited = paths.join(hosts, "_h")
    k_path = _strength(sited, F.col("host_rate"))
    sited = sited.select("_h", "_q", F.col("n").alias("_n"), F.col("s").alias("_s"), "host_rate")
    # the document itself is taken out of its path
    rate = (F.col("_s") - F.col("_p") + k_path * F.col("host_rate")) / (F.col("_n") - 1 + k_path)
    out = counted.join(sited, ["_h", "_q"]).withColumn("path_rate", rate)
    # odds of the prior that the evidence is relative to are those of the path
    out = out.withColumn("score", 1 / (1 + F.exp(-(_logit(F.col("path_rate")) + F.col("evidence")))))
    return out.withColumn("kept", F.col("score") >= 0.5).drop("_h", "_q", "_p", "_n", "_s")
