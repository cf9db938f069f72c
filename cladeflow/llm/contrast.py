"""A small softmax classifier of texts, fitted on a bounded labelled sample: shared by site quality and mixing.

Words, their beginnings and their shapes are hashed. A bucket has, for each class, the log of how much more often texts
of the class hold it than chance would have it, shrunk to 0 where it is rare. A text is described by the largest and the
mean contrasts of its words and by its repetition, all over the whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeflow.llm.common import CACHED_WORDS, raw

PER_CLASS, BUCKETS, SHRINK = 2500, 1 << 17, 3.0
# Letters and digits by kind; all else stands for itself.
_KIND = bytes(
    ord("a") if 97 <= c <= 122 or c > 127 else ord("A") if 65 <= c <= 90 else ord("0") if 48 <= c <= 57 else c for c in range(256)
)
_OUTER = bytes(c for c in range(128) if not chr(c).isalpha())


def buckets(words: list[bytes]) -> np.ndarray:
    """For each word, as split() gives them: of the bare word, its beginning, and its shape (kinds of its first two and last four bytes)."""
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    at = np.empty((len(words), 3), np.uint64)
    if words:
        bare = [w.strip(_OUTER) for w in joined.lower().split(b" ")]
        at[:, 0] = [*map(hashed, bare)]
        at[:, 1] = [hashed(b"^" + w[:5]) for w in bare]
        at[:, 2] = [hashed(b"#" + kinds[:2] + kinds[-4:]) for kinds in joined.translate(_KIND).split(b" ")]
    return (at % BUCKETS).astype(np.int32)


@dataclass
class Model:
    table: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @property
    def classes(self) -> int:
        return self.table.shape[1]


class Contrasts(dict):
    """Numbers of words; rows: contrasts of word and beginning, and of shape, for each class."""

    def __init__(self, table: np.ndarray):
        super().__init__()
        self.table, self.new = table, []
        self.rows = np.zeros((0, 2 * table.shape[1]), np.float32)

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        number = self[word] = len(self)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHED_WORDS:
            self.clear()
            self.rows = self.rows[:0]
        numbers = np.array([*map(self.__getitem__, words)], np.int64)
        if self.new:
            at = buckets(self.new)
            said = np.concatenate([self.table[at[:, 0]] + self.table[at[:, 1]], self.table[at[:, 2]]], axis=1)
            have = len(self) - len(self.new)
            if len(self) > len(self.rows):
                self.rows = np.concatenate([self.rows[:have], np.zeros((max(len(self), 2 * have) - have, said.shape[1]), np.float32)])
            self.rows[have : len(self)] = said
            self.new = []
        return self.rows.take(numbers, axis=0)


def describe(known: Contrasts, text: bytes, words: list[bytes]) -> np.ndarray:
    """words: those of the text."""
    n = len(words)
    if not n:
        return np.zeros(2 * known.rows.shape[1] + 4, np.float32)
    rows = known.of(words)
    lines = text.split(b"\n")
    share = (len(set(words)) / n, len(set(lines)) / len(lines), np.log1p(n) / 10, 1.0)
    return np.concatenate([np.ascontiguousarray(rows.T).max(axis=1), np.add.reduce(rows, axis=0, dtype=np.float64) / n * 5, share])


def posteriors(model: Model, described: np.ndarray) -> np.ndarray:
    """For rows of describe(). Each is worked out alone, without BLAS, whatever rows come with it."""
    logits = np.einsum("ij,jk->ik", (described - model.centre) / model.scale, model.weights)
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def posterior(model: Model, known: Contrasts, text: bytes) -> np.ndarray:
    return posteriors(model, describe(known, text, text.split())[None])[0]


def _table(texts: list[np.ndarray], label: np.ndarray, classes: int) -> np.ndarray:
    seen = np.zeros((BUCKETS, classes), np.float64)
    for at, c in zip(texts, label, strict=True):
        seen[at, c] += 1
    expected = seen.sum(axis=1, keepdims=True) * (np.bincount(label, minlength=classes) / max(len(label), 1))
    # in place: the tables are the largest arrays of the driver
    seen += SHRINK
    expected += SHRINK
    seen /= expected
    return np.log(seen, out=seen).astype(np.float32)


def train(texts: list[bytes], label: np.ndarray, prior: np.ndarray, steps: int = 400) -> Model:
    """prior: true shares of the classes; the sample may hold others.

    Each half of the sample is described by contrasts of the other half, so that no text is judged by itself.
    """
    classes = len(prior)
    held = [np.unique(buckets([*set(t.split())])) for t in texts]
    half = np.arange(len(texts)) % 2
    x = np.zeros((len(texts), 4 * classes + 4))
    for side in (0, 1):
        known = Contrasts(_table([h for h, s in zip(held, half, strict=True) if s != side], label[half != side], classes))
        for i in np.flatnonzero(half == side):
            x[i] = describe(known, texts[i], texts[i].split())
    centre, scale = x.mean(axis=0) if len(x) else 0 * x.sum(axis=0), np.maximum(x.std(axis=0), 1e-3) if len(x) else 1 + 0 * x.sum(axis=0)
    centre[-1], scale[-1] = 0, 1
    z = (x - centre) / scale
    counts = np.bincount(label, minlength=classes)
    weight = (prior / np.maximum(counts, 1))[label]
    target = np.eye(classes)[label]
    w = np.zeros((z.shape[1], classes))
    w[-1] = np.log(np.maximum(prior, 1e-6))
    speed = np.zeros_like(w)
    for _ in range(steps):
        logits = z @ w
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        grad = z.T @ ((p - target) * weight[:, None]) + 1e-4 * w
        speed = 0.9 * speed - 0.3 * grad
        w += speed
    return Model(_table(held, label, classes), centre, scale, w)


def sample(documents: DataFrame, labelled: DataFrame, classes: int, *, doc_id: str, text: str, per_class: int = PER_CLASS):
    """labelled: _id and _class (0 to classes - 1). At most per_class texts of each class, and the classes' true shares."""
    known = labelled.join(documents.select(F.col(doc_id).alias("_id")).distinct(), "_id", "left_semi")
    counts = {r["_class"]: r["n"] for r in known.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for c in range(classes):
        own = known.where(F.col("_class") == c).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        picked = own if picked is None else picked.unionByName(own)
    rows = documents.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(picked), "_id")
    table = rows.dropDuplicates(["_id"]).orderBy(F.xxhash64("_id"), "_id").select(F.col("_class").cast("bigint").alias("c"), "_text").toArrow()
    share = np.array([counts.get(c, 0) for c in range(classes)], float)
    share = (share + 1e-3) / (share + 1e-3).sum()
    return raw(table, "_text"), table.column("c").to_numpy(), share
