"""Language-model scores from a hashed maximum-entropy model.

The probability of a token is that of its class in context times that of the token in its class. Classes are the end
mark, the most frequent words, and shapes of words (letters, last letters, punctuation). The class softmax sums weights
of hashed features of the context: the word before, the two classes before (n-grams), and, skipping the word before,
the word and the classes further back. In its class a token has its smoothed share of the class's training tokens, so
the model differs from the smoothed unigram only in the classes; an unknown token keeps the unigram's probability.
Over the known tokens and one unknown the probabilities sum to one.

Training covers all rows to learn from, in each of its steps. Token counts are grouped by Spark, and the texts are packed
once to four bytes a token. Weights start from the class counts of each bucket and are updated in rounds: tasks return
counts by bucket and class, expected ones in the rounds and empirical ones before, these are summed in blocks of buckets,
and the weights follow the gradient, their difference, scaled by the counts. Scoring is one pass: dense sums of sparse features over blocks of tokens. Words of the ``head`` (a bounded list
of the most frequent) are scored in place, all others are joined to their counts by Spark, one row per text and word.

Null and empty texts consist of the end mark. Rows are scored one by one, repeated rows alike. Without any row to learn
from, every token has probability one half over one half (log 0). Extra columns are returned, columns named like results
are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
import zlib
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeflow.llm.common import CACHED_WORDS, columns_of, ddl, raw, stream
from cladeflow.session import cut

HEAD, ROUNDS, BITS, CLASSES, SINGLE = 200_000, 3, 14, 32, 15
LONGEST = 64
BUCKETS, FEATURES, BLOCK, SLICE, SUMS = 1 << BITS, 4, 1 << 17, 1 << 12, 1 << 10
# Classes before a token, the start of a text included.
STARTS = CLASSES + 1
END = b""
# Pseudo-counts that keep rare buckets near the prior.
SMOOTH = 8.0
RESULT = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
_PUNCTUATION = frozenset(b".,;:!?")
# Letters that tell languages apart.
_LETTERS = (frozenset("äöüß"), frozenset("ñáíóú"))


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def shape(word: bytes) -> int:
    """One of the classes from SINGLE + 1 on."""
    stop = word[-1] in _PUNCTUATION
    if word.isascii():
        return SINGLE + 1 + (7 + zlib.crc32(word[-3:-1]) % 3 if stop else zlib.crc32(word[-2:]) % 7)
    letters = set(word.decode("utf-8", "replace"))
    kind = next((k for k, own in enumerate(_LETTERS) if letters & own), 2)
    return SINGLE + 11 + 2 * kind + stop


@dataclass
class Vocabulary:
    """Counts of the head, the totals, and log10 of each class's share of the known tokens."""

    head: dict[bytes, int]
    total: int
    distinct: int
    single: dict[bytes, int]
    prior: np.ndarray

    def class_of(self, word: bytes) -> int:
        return self.single[word] if word in self.single else shape(word)

    @cached_property
    def tokens(self) -> Tokens:
        """Worked out once in each worker, as a broadcast stays there."""
        return Tokens(self)

    def base(self, count):
        return np.log10((count + 0.5) / (self.total + 0.5 * (self.distinct + 1)))


class Tokens(dict):
    """A word's class, its bucket as a feature and its place in the head plus 1 (0: not in it), packed. Words of the head are
    held ready; all others are rare, and worked out each time."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.single = vocabulary.single
        self.update((w, self[w] | k << 32) for k, w in enumerate(vocabulary.head, 1))
        self[None] = CLASSES  # before the start of a text

    def __missing__(self, word: bytes) -> int:
        own = self.single.get(word)
        return (shape(word) if own is None else own) | (xxhash.xxh64_intdigest(word) & 0xFFFFFF) << 8

    def blocks(self, texts: list[bytes], described=None) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
        """For blocks of whole texts: their tokens, these packed, the buckets of their contexts, and the texts' first tokens."""
        for words, packed, firsts in self.packed(texts):
            real = np.flatnonzero(packed != CLASSES)
            yield [w for w in words if w is not None], packed[real], (described or features)(packed, real), np.array(firsts)

    def packed(self, texts: list[bytes]) -> Iterator[tuple[list[bytes | None], np.ndarray, list[int]]]:
        """Blocks of whole texts, three tokens before the start with each: the tokens, these packed, and the texts' first tokens."""
        words: list[bytes | None] = []
        firsts: list[int] = []
        for k, text in enumerate(texts):
            firsts.append(len(words) - 3 * len(firsts))
            words += (None, None, None, *tokens(text))
            if len(words) >= BLOCK or k == len(texts) - 1:
                yield words, np.fromiter(map(self.__getitem__, words), np.int64, len(words)), firsts
                words, firsts = [], []


def features(packed: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Buckets (FEATURES by tokens) of the contexts of the real tokens."""
    classes, words = (packed & 0xFF).astype(np.uint64), (packed >> 8 & 0xFFFFFF).astype(np.uint64)
    c1, c2, c3 = (classes[real - k] for k in (1, 2, 3))
    return np.stack([_bucket(0, words[real - 1]), _bucket(1, c1, c2), _bucket(2, c2, c3), _bucket(3, words[real - 2])])


def _bucket(j: int, first: np.ndarray, second: np.ndarray | None = None) -> np.ndarray:
    key = first if second is None else first * np.uint64(64) + second
    return ((key + np.uint64(j << 32 | 1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.uint16)


def contexts(packed: np.ndarray, real: np.ndarray) -> np.ndarray:
    """The same contexts (3 by tokens) in which the three classes before, that two features come from, are one number."""
    c1, c2, c3 = (packed[real - k] & 0xFF for k in (1, 2, 3))
    words = (packed >> 8 & 0xFFFFFF).astype(np.uint64)
    return np.stack([_bucket(0, words[real - 1]), _bucket(3, words[real - 2]), ((c1 * STARTS + c2) * STARTS + c3).astype(np.uint16)])


def class_buckets() -> tuple[np.ndarray, np.ndarray]:
    """Buckets of both features that come from three classes, by the number of these."""
    c1, c2, c3 = np.indices((STARTS,) * 3).reshape(3, -1).astype(np.uint64)
    return _bucket(1, c1, c2), _bucket(2, c2, c3)


def tables(weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """What each row of contexts() looks up; three classes bring along the weights' last row, which is for all contexts."""
    near, far = class_buckets()
    return weights, weights, weights[near] + weights[far] + weights[-1]


def softmax(weights: np.ndarray, at: np.ndarray, *looked_up: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """In slices that stay in the cache: exponentials by class, and their sums. Each row of ``at`` looks up one of
    the tables(), or without them the weights."""
    plain = () if looked_up else (weights[-1],)
    looked_up = looked_up or (weights,) * len(at)
    for k in range(0, at.shape[1], SLICE):
        part = slice(k, min(k + SLICE, at.shape[1]))
        logits = np.take(looked_up[0], at[0, part], axis=0)
        for table, own in zip(looked_up[1:], at[1:, part], strict=True):
            logits += np.take(table, own, axis=0)
        for row in plain:
            logits += row
        np.clip(logits, -60, 60, out=logits)
        np.exp(logits, out=logits)
        yield part, logits, logits.sum(axis=1)


def _packed(texts: DataFrame, vocabulary) -> DataFrame:
    """Blocks of whole texts as 4 bytes a token: class and bucket; CLASSES before the start of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value.tokens
        for batch in batches:
            for block in known.packed(raw(batch, "_text")):
                yield pa.RecordBatch.from_arrays([pa.array([block[1].astype(np.uint32).tobytes()], pa.binary())], names=["tokens"])

    return texts.mapInArrow(run, "tokens binary")


def _sums(blocks: DataFrame, weights) -> np.ndarray:
    """Empirical or, given weights, expected counts by bucket and class over all blocks: BUCKETS by CLASSES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(BUCKETS * CLASSES, np.float64)
        words, classes = np.zeros((CLASSES, BUCKETS)), np.zeros((CLASSES, STARTS**3))
        if weights is not None:
            near, far = class_buckets()
            looked_up = tables(weights.value)
        for batch in batches:
            for block in batch.column("tokens"):
                packed = np.frombuffer(block.as_py(), np.uint32).astype(np.int64)
                real = np.flatnonzero(packed != CLASSES)
                if weights is None:
                    said = packed[real] & 0xFF
                    for own in features(packed, real):
                        out += np.bincount(own.astype(np.int64) * CLASSES + said, minlength=len(out))
                    continue
                at = contexts(packed, real)
                p = np.empty((CLASSES, at.shape[1]), np.float32)
                for part, raised, total in softmax(weights.value, at, *looked_up):
                    raised /= total[:, None]
                    p[:, part] = raised.T
                own = at.astype(np.int64)
                for c in range(CLASSES):
                    chance = p[c].astype(np.float64)
                    for j, sums in enumerate((words, words, classes)):
                        sums[c] += np.bincount(own[j], chance, sums.shape[1])
        if weights is not None:
            # the sums by three classes belong to both features that come from these
            for c in range(CLASSES):
                words[c] += np.bincount(near, classes[c], BUCKETS) + np.bincount(far, classes[c], BUCKETS)
            out = words.T.ravel()
        parts = out.reshape(-1, SUMS * CLASSES).astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "sums"]
        )

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SUMS * CLASSES, np.float64)
        for batch in batches:
            for sums in batch.column("sums").to_pylist():
                total += np.frombuffer(sums, np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    table = blocks.mapInArrow(run, "part int, sums binary").groupBy("part").applyInArrow(add, "part int, sums binary").toArrow().sort_by("part")
    parts = [np.frombuffer(x, np.float64) for x in table.column("sums").to_pylist()]
    return np.concatenate(parts or [np.zeros(BUCKETS * CLASSES)]).reshape(BUCKETS, CLASSES)


def count_tokens(texts: DataFrame) -> DataFrame:
    """word (bytes, lower-case; empty for the end mark) and count over all texts (column _text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in stream(batch.column("_text")):
                seen.update(tokens(text))
                if len(seen) > CACHED_WORDS:
                    yield rows(seen)
                    seen = Counter()
        yield rows(seen)

    def rows(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    return texts.mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def build_vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    """counts: rows of count_tokens. The head is all words above the lowest count that keeps it within its bound, but for
    those of more than LONGEST bytes."""
    step = F.floor(F.log2("n") * 8).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).orderBy(F.desc("step")).collect()
    beyond = np.cumsum([r.words for r in steps])
    lowest = next((r.step for r, sofar in zip(reversed(steps), reversed(beyond), strict=True) if sofar <= head), None)
    table = (counts.where((step >= lowest) & (F.length("word") <= LONGEST)) if lowest is not None else counts.limit(0)).toArrow()
    top = sorted(zip(table.column("word").to_pylist(), table.column("n").to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))
    single = {END: 0} | {w: k + 1 for k, (w, _) in enumerate([x for x in top if x[0] != END][:SINGLE])}
    vocabulary = Vocabulary(dict(top), sum(r.n for r in steps), sum(r.words for r in steps), single, np.zeros(CLASSES))
    shared = counts.sparkSession.sparkContext.broadcast(vocabulary)

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array([shared.value.class_of(w) for w in batch.column("word").to_pylist()], np.int64)
            mass = np.bincount(own, batch.column("n").to_numpy() + 0.5, CLASSES)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(mass)], names=["class", "mass"])

    mass = np.zeros(CLASSES)
    for r in counts.mapInArrow(classes, "class bigint, mass double").groupBy("class").agg(F.sum("mass").alias("mass")).collect():
        mass[r["class"]] = r.mass
    with np.errstate(divide="ignore"):
        vocabulary.prior = np.log10(mass / max(mass.sum(), 1e-300))
    return vocabulary


def train(texts: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Weights: BUCKETS + 1 by CLASSES; the last row is the class prior."""
    context = texts.sparkSession.sparkContext
    shared = context.broadcast(vocabulary)
    prior = np.where(np.isfinite(vocabulary.prior), vocabulary.prior * np.log(10), -30.0)
    blocks = cut(_packed(texts, shared))
    seen = _sums(blocks, None)
    expected = seen.sum(axis=1, keepdims=True) * np.exp(prior)
    weights = np.concatenate([0.4 * np.log((seen + SMOOTH * np.exp(prior) + 1e-9) / (expected + SMOOTH * np.exp(prior) + 1e-9)), [prior]])
    weights = weights.astype(np.float32)
    for _ in range(rounds):
        modelled = _sums(blocks, context.broadcast(weights))
        weights[:-1] += (seen - modelled) / (np.maximum(seen, modelled) + SMOOTH) / 2
    return weights


def _score_texts(documents: DataFrame, fields, vocabulary: Vocabulary, weights: np.ndarray) -> DataFrame:
    """Sums over the words of the head, and for each other word of a text its number and its sum of class terms."""
    shared = documents.sparkSession.sparkContext.broadcast((vocabulary, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights = shared.value
        known, looked_up = vocabulary.tokens, tables(weights)
        head = np.concatenate([[0.0], vocabulary.base(np.array(list(vocabulary.head.values()), np.float64))])
        for batch in batches:
            sums: list[np.ndarray] = [np.empty((4, 0))]
            sizes, words, times, terms = [0], [], [], []
            for said, packed, at, firsts in known.blocks(raw(batch, "_text"), contexts):
                classes, place = packed & 0xFF, packed >> 32
                term = np.empty(len(said))
                for part, raised, total in softmax(weights, at, *looked_up):
                    term[part] = np.log10(raised[np.arange(len(total)), classes[part]] / total)
                term -= vocabulary.prior[classes]
                base = head[place]
                inside = place > 0
                sums.append(np.add.reduceat(np.stack([np.ones(len(said)), inside, base, base + np.where(inside, term, 0)]), firsts, axis=1))
                outside = np.flatnonzero(~inside)
                ends = np.searchsorted(outside, [*firsts[1:], len(said)])
                for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    other: dict[bytes, int] = {}
                    for k in outside[a:b].tolist():
                        n = other.setdefault(said[k], len(times))
                        if n == len(times):
                            words.append(said[k])
                            times.append(0)
                            terms.append(0.0)
                        times[n] += 1
                        terms[n] += term[k]
                    sizes.append(len(times))
            total = np.concatenate(sums, axis=1)
            others = pa.ListArray.from_arrays(
                pa.array(sizes, pa.int32()),
                pa.StructArray.from_arrays([pa.array(words, pa.binary()), pa.array(times, pa.int64()), pa.array(terms, pa.float64())], names=["word", "times", "term"]),
            )
            yield pa.RecordBatch.from_arrays(
                [*columns_of(fields, batch), *(pa.array(x.astype(np.int64)) for x in total[:2]), *map(pa.array, total[2:]), others],
                names=[*(f.name for f in fields), "n_tokens", "_known", "_base", "_score", "_other"],
            )

    schema = "n_tokens bigint, _known bigint, _base double, _score double, _other array<struct<word:binary, times:bigint, term:double>>"
    return documents.mapInArrow(run, ", ".join(filter(None, (ddl(fields), schema))))


def score(documents: DataFrame, learn_from: DataFrame, *, text: str = "text", head: int = HEAD) -> DataFrame:
    """The documents without their text, with n_tokens, n_known, train_tokens, base_score and score."""
    fields = [f for f in documents.schema.fields if f.name not in (*RESULT, text)]
    own = learn_from.select(F.col(text).alias("_text"))
    counts = cut(count_tokens(own))
    vocabulary = build_vocabulary(counts, head)
    weights = train(own, vocabulary)
    texts = documents.select(*[f"`{f.name}`" for f in fields], F.col(text).alias("_text"))
    found = cut(_score_texts(texts, fields, vocabulary, weights).withColumn("_row", F.monotonically_increasing_id()))
    other = found.select("_row", F.explode("_other").alias("o")).select("_row", "o.*").join(counts, "word", "left")
    base = F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(vocabulary.total + 0.5 * (vocabulary.distinct + 1)))
    sums = other.groupBy("_row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("_more"),
        F.sum(base).alias("_more_base"),
        F.sum(base + F.when(F.col("n").isNotNull(), F.col("term")).otherwise(0.0)).alias("_more_score"),
    )
    add = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return found.join(sums, "_row", "left").select(
        *[f"`{f.name}`" for f in fields],
        "n_tokens",
        add("_known", "_more").alias("n_known"),
        F.lit(vocabulary.total).cast("bigint").alias("train_tokens"),
        add("_base", "_more_base").alias("base_score"),
        add("_score", "_more_score").alias("score"),
    )
