"""Removal of passages that recur anywhere in the documents, by repeated-phrase automata.

A window is ``window`` consecutive words. Every window whose words also start elsewhere is removed, all its
occurrences included.

1. Confirm. Each text is cut into segments: runs of windows that share the k-gram of least hash (their anchor). Equal
   windows have equal anchors, so only segments with an anchor seen twice can matter. Equal segments are counted as a
   whole; only where an anchor heads different segments are single windows counted, once per distinct segment.
2. Compile. The confirmed windows of a text form passages; the distinct passages of a shard of texts (about 4 MB) are
   compiled into one automaton over word numbers.
3. Stream. The texts of the shard are read through it; words of any occurrence go.

Counting uses two 64-bit hashes together (anchor, and segment or window). No group of rows is gathered but the marks of
one document. Rows with an anchor that half the corpus shares are counted with partial sums, and joined to one row.

Null and empty texts have no words; texts below one window lose nothing. Rows repeated as a whole are copies of each
other. Extra columns are returned; columns named like results are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeflow.llm.common import WordIds, bit_filter, columns_of, ddl, may_be_in, passes, raw, stream
from cladeflow.session import cut

WINDOW = 35
SHARD_BYTES = 4_000_000
RESULT = ("n_words", "n_removed", "kept_sha256")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Profile:
    """Hashes of stretches of one text at a time."""

    def __init__(self, window: int):
        self.window = window
        self.gram = min(window, max(8, window - 59))
        self.ids = WordIds()
        self.power = self.inverse = np.ones(1, np.uint64)

    def read(self, words: list[bytes]) -> None:
        n = len(words)
        if len(self.power) <= n:
            size = 2 * n + 1
            self.power, self.inverse = (
                np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, base)])) for base in (_BASE, _INVERSE)
            )
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(self.ids.of(words) * self.inverse[:n])])
        self.n = n

    def hashes(self, first: np.ndarray, beyond: np.ndarray) -> np.ndarray:
        x = (self.sums[beyond] - self.sums[first]) * self.power[first]
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return x ^ (x >> np.uint64(29))

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First windows, numbers of windows, anchors and hashes of all segments."""
        k, windows = self.gram, self.n - self.window + 1
        starts = np.arange(self.n - k + 1)
        grams = self.hashes(starts, starts + k)
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | starts.astype(np.uint64)
        width, span = 1, self.window - k + 1
        while width < span:
            step = min(width, span - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        count = np.diff(np.concatenate([first, [windows]]))
        return first, count, grams[place[first]].view(np.int64), self.hashes(first, first + count + self.window - 1).view(np.int64)


def _table(*columns: np.ndarray, names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names.split())


def _anchors(texts: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profile = Profile(window)
        for batch in batches:
            found = [np.empty(0, np.int64)]
            for text in stream(batch.column("_text")):
                words = text.split()
                if len(words) >= window:
                    profile.read(words)
                    found.append(profile.segments()[2])
            anchors, n = np.unique(np.concatenate(found), return_counts=True)
            yield _table(anchors, n, names="anchor n")

    return texts.select("_text").mapInArrow(run, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")


def _segments(texts: DataFrame, window: int, shared) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profile = Profile(window)
        for batch in batches:
            rows: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(5)]
            for key, text in zip(batch.column("_key").to_pylist(), stream(batch.column("_text")), strict=True):
                words = text.split()
                if len(words) < window:
                    continue
                profile.read(words)
                first, count, anchor, segment = profile.segments()
                at = np.flatnonzero(passes(shared.value, anchor))
                for to, values in zip(rows, (np.full(len(at), key), first[at], count[at], anchor[at], segment[at]), strict=True):
                    to.append(values)
            yield _table(*map(np.concatenate, rows), names="key first windows anchor segment")

    return texts.select("_key", "_text").mapInArrow(run, "key bigint, first bigint, windows bigint, anchor bigint, segment bigint")


def _windows(texts: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The windows of the wanted segments, read in one text that has them."""
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("first", "windows", "anchor", "segment", "copies")).alias("at"))
    own = texts.select("_key", "_text").where(may_be_in(bit_filter(texts.sparkSession, lists.select("key")), F.col("_key")))
    both = own.join(lists, F.col("_key") == F.col("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profile = Profile(window)
        for batch in batches:
            rows: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(5)]
            for text, places in zip(stream(batch.column("_text")), batch.column("at").to_pylist(), strict=True):
                profile.read(text.split())
                first, n, anchor, segment, copies = (np.array([p[c] for p in places]) for c in ("first", "windows", "anchor", "segment", "copies"))
                offset = np.concatenate([np.arange(x) for x in n])
                start = np.repeat(first, n) + offset
                values = (np.repeat(anchor, n), np.repeat(segment, n), offset, profile.hashes(start, start + window).view(np.int64), np.repeat(copies, n))
                for to, v in zip(rows, values, strict=True):
                    to.append(v)
            yield _table(*map(np.concatenate, rows), names="anchor segment offset said copies")

    return both.select("_text", "at").mapInArrow(run, "anchor bigint, segment bigint, offset bigint, said bigint, copies bigint")


def _bit(offset: str):
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(offset).cast("int"))


def confirm(texts: DataFrame, window: int) -> DataFrame:
    """key and marks: for each text its segments' first windows, and bits of the windows that recur."""
    spark = texts.sparkSession
    found = cut(_segments(texts, window, bit_filter(spark, _anchors(texts, window).select("anchor"))))
    distinct = cut(
        found.groupBy("anchor", "segment").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("key", "first", "windows")).alias("at")
        )
    )
    heads = distinct.groupBy("anchor").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("kinds")).where("n > 1")
    kinds = distinct.join(heads, "anchor").select("anchor", "segment", "copies", "at.*", "kinds")
    whole = kinds.where("kinds = 1").select("anchor", "segment", ((_bit("windows")) - 1).alias("bits"))
    windows = cut(_windows(texts, kinds.where("kinds > 1"), window))
    again = windows.groupBy("anchor", "said").agg(F.sum("copies").alias("n")).where("n > 1")
    parts = windows.join(again, ["anchor", "said"]).groupBy("anchor", "segment").agg(F.bit_or(_bit("offset")).alias("bits"))
    marks = found.join(whole.unionByName(parts), ["anchor", "segment"]).select("key", "first", "bits").distinct()
    return marks.groupBy("key").agg(F.collect_list(F.struct("first", "bits")).alias("marks"))


def _recurring(n: int, marks: list[dict], window: int) -> list[tuple[int, int]]:
    """Word ranges of the maximal passages made of recurring windows that overlap or touch."""
    flags = np.zeros(n + 1, np.int32)
    for mark in marks:
        bits, first = mark["bits"], mark["first"]
        for offset in range(bits.bit_length()):
            if bits >> offset & 1:
                flags[first + offset] += 1
                flags[first + offset + window] -= 1
    return _ranges(np.cumsum(flags[:-1]) > 0)


def _ranges(covered: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _letter(number: int) -> str:
    """A character for a word of the shard's passages; surrogates are left out and 0 is any other word."""
    return chr(number + 1 if number < 0xD7FF else number + 0x801)


def locate(texts: list[list[bytes]], passages: list[list[tuple[int, int]]]) -> list[np.ndarray]:
    """For each text of a shard, which words lie in an occurrence of any passage of the shard."""
    letters: dict[bytes, str] = {}
    automaton = ahocorasick.Automaton()
    for words, ranges in zip(texts, passages, strict=True):
        for a, b in ranges:
            phrase = "".join([letters.setdefault(w, _letter(len(letters))) for w in words[a:b]])
            automaton.add_word(phrase, b - a)
    automaton.make_automaton()
    out = []
    for words in texts:
        steps = np.zeros(len(words) + 1, np.int32)
        if len(automaton):
            for end, length in automaton.iter("".join([letters.get(w, "\0") for w in words])):
                steps[end - length + 1] += 1
                steps[end + 1] -= 1
        out.append(np.cumsum(steps[:-1]) > 0)
    return out


def _kept(text: bytes, words: list[bytes], covered: np.ndarray, whole: bool) -> tuple:
    if not covered.any():
        return len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest(), text if whole else None
    left = [w for w, gone in zip(words, covered.tolist(), strict=True) if not gone]
    piece = None
    if whole:
        places = [m.span() for m in _WORD.finditer(text)]
        piece = b" ".join(text[places[a][0] : places[b - 1][1]] for a, b in _ranges(~covered))
    return len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest(), piece


def remove_repeated(documents: DataFrame, *, text: str = "text", window: int = WINDOW, keep_text: bool = True) -> DataFrame:
    """The documents with the text less the removed words, n_words, n_removed and kept_sha256.

    With keep_text=False the text is not returned.
    """
    spark = documents.sparkSession
    fields = [f for f in documents.schema.fields if f.name not in (*RESULT, text)]
    texts = documents.withColumn("_text", F.col(text)).withColumn("_key", F.xxhash64(F.struct(*documents.columns)))
    texts = texts.select(*[f"`{f.name}`" for f in fields], "_text", "_key")
    marks = cut(confirm(texts, window).select(F.col("key").alias("_at"), F.col("marks").alias("_marks")))
    shared = bit_filter(spark, marks.select("_at"))
    schema = f"{ddl(fields)}, n_words bigint, n_removed bigint, kept_sha256 string" + (f", `{text}` string" if keep_text else "")
    types = (pa.int64(), pa.int64(), pa.string(), pa.string())[: 3 + keep_text]

    def result(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in rows], pa.binary()).cast(t) if i == 3 else pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays(columns_of(fields, batch) + columns, names=[f.name for f in fields] + [*RESULT, text][: len(types)])

    def unmarked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(~passes(shared.value, batch.column("_key").to_numpy())))
            rows = [_kept(t, w := t.split(), np.zeros(len(w), bool), keep_text) for t in stream(batch.column("_text"))]
            yield result(batch, rows)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_texts = raw(batch, "_text")
            sizes = np.cumsum([len(t) for t in all_texts]) // SHARD_BYTES
            for shard in np.unique(sizes):
                a, b = np.searchsorted(sizes, [shard, shard + 1])
                part = batch.slice(a, b - a)
                words = [t.split() for t in all_texts[a:b]]
                lists = part.column("_marks").to_pylist()
                covered = locate(words, [_recurring(len(w), m or [], window) for w, m in zip(words, lists, strict=True)])
                yield result(part, [_kept(t, w, c, keep_text) for t, w, c in zip(all_texts[a:b], words, covered, strict=True)])

    rest = texts.mapInArrow(unmarked, schema)
    hit = texts.where(may_be_in(shared, F.col("_key"))).join(marks, F.col("_key") == F.col("_at"), "left")
    return rest.unionByName(hit.mapInArrow(marked, schema))
