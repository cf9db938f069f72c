"""Documents packed into token sequences of a fixed capacity, as few as can be.

Linear grouping. Only lengths matter for the plan, and a length is a whole number up to the capacity, so the plan is made
from a histogram of at most ``capacity`` counts, whatever the number of documents:

1. Lengths above a share of the capacity are large. They are sorted, cut into a bounded number of groups of equally many
   pieces, and rounded up to the longest length of their group. Which share is best depends on how many short pieces there
   are to fill gaps, so a few pairs of share and number of groups (CUTS) are planned and the best plan is taken.
2. How often each combination of rounded lengths (configuration) is used is a linear programme over a few sizes, solved by
   column generation: a revised simplex, priced by a knapsack over the capacity. Whole uses are taken.
3. The slots of the configurations are given to actual lengths, the longest of a group first. Sequences whose contents
   are alike stay one row of the plan with a count.
4. What whole uses leave over, and all small lengths, go by best fit, longest first, into the room that is left.

Spark then deals the pieces out: each is numbered within its length, in blocks of rows of the written table of pieces, so
that a length with a third of all pieces is many groups; the plan says which numbers of a length lie in which sequence and
where. The plan is the only broadcast; its size is bounded by capacity and CUTS (at most one configuration a group, of fewer
than eight lengths, split at most once per length; each length splits at most four kinds of sequences), not by the data.

Texts longer than the capacity are cut into pieces of the whole capacity, counted from their end, so that the first piece
may be shorter; nothing else is cut, dropped or capped.

Ids are those of the ``tokenizers`` vocabulary. Plain texts are merged by tiktoken with the ranks of the same file, which
gives the same ids in less than a third of the time (the order of the merges is checked on load, the ids in the tests). Of
other texts the plain stretches go that way, cut at blanks that the vocabulary's pattern never joins (single ones between
two characters that are surely not white space); the rest goes to the tokenizer as it is.

Defined results: a null or empty text is one piece, the end mark alone. Repeated rows, null and repeated ids are pieces of
their own. Texts of any length are read whole. An empty table gives an empty result. Columns other than the id and the text
are ignored, whatever their names are. Pieces with the same id, number and ids are interchangeable; sequence ids are dense
from 0.
"""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cladeflow.llm.token_counts import PATTERN
from cladeflow.session import cut

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CAPACITY = 2048
# Lengths of more than a share of the capacity (one third, ...) are large; they are rounded up in so many groups.
# Each pair is tried, and the plan with the fewest sequences is taken.
CUTS = ((3, 256), (4, 256), (8, 96))
# Rows of the table of pieces that are numbered together.
BLOCK = 65_536

# --- tokens ----------------------------------------------------------------------------------------

# Surely no white space: printable ASCII, letters of the alphabets up to Hebrew, CJK ideographs, kana, hangul.
_SURE = frozenset(chr(c) for a, b in ("!~", "\u00c0\u02ff", "\u0370\u05ea", "\u3041\u3096", "\u30a1\u30fa", "\u4e00\u9fff", "\uac00\ud7a3") for c in range(ord(a), ord(b) + 1))
# Of these, with blanks, tabs, line ends and common signs, all tables of characters agree since long.
_PLAIN = re.compile("[\t\n\r -~\u00a1-\u00ac\u00ae-\u024f\u0391-\u03a1\u03a3-\u03ce\u0400-\u045f\u2010-\u2027\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]+")


class _Vocabulary:
    """Ids of texts.

    Merging by the ids of the vocabulary gives what merging by its list of merges gives if the list is in the order of the ids.
    This is checked; plain texts without a special token then take the quicker library, all others the tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        vocabulary, merges = parts["model"]["vocab"], [m if isinstance(m, list) else m.split(" ") for m in parts["model"]["merges"]]
        self.special = [t["content"] for t in parts["added_tokens"]]
        sign = _signs()
        ranks = {bytes(map(sign.__getitem__, token)): k for token, k in vocabulary.items() if token not in self.special}
        single = sorted(k for token, k in ranks.items() if len(token) == 1)
        self.quick = None
        if [vocabulary["".join(m)] for m in merges] == list(range(256, 256 + len(merges))) and single == list(range(256)):
            self.quick = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def is_plain(self, text: str) -> bool:
        return bool(self.quick and _PLAIN.fullmatch(text)) and not any(t in text for t in self.special)

    def encode(self, text: str, plain: bool) -> bytes:
        ids = self.quick.encode_ordinary(text) if plain else self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()


def _signs() -> dict[str, int]:
    """How byte-level vocabularies write bytes: visible Latin-1 signs stand for themselves, the others follow from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> _Vocabulary:
    return _Vocabulary(path)


def token_ids(text: str, path: str = VOCABULARY) -> bytes:
    """Ids of a whole text, four bytes each, then the end mark 0."""
    if not text:
        return bytes(4)
    vocabulary = _vocabulary(path)
    if vocabulary.is_plain(text):
        return vocabulary.encode(text, True) + bytes(4)
    # The pattern never joins what a blank between two sure characters parts: a token ends there, and the next one begins with it.
    parts = text.split(" ")
    stretches = [parts[0]]
    for left, right in zip(parts, parts[1:], strict=False):
        if right and left and right[0] in _SURE and left[-1] in _SURE:
            stretches.append(" " + right)
        else:
            stretches[-1] += " " + right
    alike = groupby(stretches, vocabulary.is_plain)
    return b"".join(vocabulary.encode("".join(group), plain) for plain, group in alike) + bytes(4)


def pieces(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` for all pieces of all documents."""
    fields = pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def split(content: str | None) -> list[dict]:
        ids = token_ids(content or "", vocabulary)
        count = len(ids) // 4
        edges = [0, *range((count - 1) % capacity + 1, count + 1, capacity)]
        return [
            {"piece": k, "start": a, "length": b - a, "ids_crc32": zlib.crc32(memoryview(ids)[4 * a : 4 * b])}
            for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
        ]

    @F.arrow_udf("array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>")
    def read(texts: pa.Array) -> pa.Array:
        return pa.array([split(texts[k].as_py()) for k in range(len(texts))], pa.list_(fields))

    listed = documents.select(F.col(doc_id).alias("doc_id"), read(F.col(text)).alias("pieces"))
    # "outer" only keeps Spark from filtering for texts without pieces, of which there are none, by reading all texts again
    return listed.select("doc_id", F.inline_outer("pieces"))


# --- the plan --------------------------------------------------------------------------------------


@dataclass
class Plan:
    """Which pieces lie where. Row k: the pieces of lengths[k] numbered from numbers[k] on lie in the sequences from
    sequences[k] on, copies[k] in each, the first one at offsets[k]."""

    lengths: np.ndarray
    numbers: np.ndarray
    sequences: np.ndarray
    copies: np.ndarray
    offsets: np.ndarray
    n_sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """sequence_id and offset"""
        first = np.searchsorted(self.lengths, length, side="left")
        until = np.searchsorted(self.lengths, length, side="right")
        # numbers ascend within a length: the last row that does not begin after the piece
        while (open_ := until - first > 1).any():
            middle = (first + until) // 2
            begun = self.numbers[np.minimum(middle, len(self.numbers) - 1)] <= number
            first = np.where(open_ & begun, middle, first)
            until = np.where(open_ & ~begun, middle, until)
        past = number - self.numbers[first]
        return self.sequences[first] + past // self.copies[first], self.offsets[first] + past % self.copies[first] * length


def _groups(counts: dict[int, int], capacity: int, share: int, groups: int) -> list[list[int]]:
    """Large lengths, longest first, in groups of about equally many pieces; a length is never in two groups."""
    large = sorted((n for n in counts if n * share > capacity), reverse=True)
    each = sum(counts[n] for n in large) / groups
    out, size = [], 0
    for n in large:
        if not out or size >= each:
            out.append([])
            size = 0
        out[-1].append(n)
        size += counts[n]
    return out


def _knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each size to take for the greatest value within the capacity. Sizes descend."""
    most = int(capacity // sizes[-1])
    # layer k: best value and last size of at most k pieces, by room; the last layer is asked at the whole capacity only
    best, taken = np.zeros(capacity + 1), []
    for k in range(most):
        rooms = np.arange(capacity + 1) if k < most - 1 else np.array([capacity])
        if k == 0:
            # only single pieces: the best of the sizes that fit
            top = np.maximum.accumulate(values[::-1])
            fits = np.searchsorted(sizes[::-1], rooms, side="right") - 1
            gain = np.where(fits >= 0, top[np.maximum(fits, 0)], 0)
            first = np.maximum.accumulate(np.where(values[::-1] == top, np.arange(len(sizes)), 0))
            choice = np.where((fits >= 0) & (gain > 0), len(sizes) - 1 - first[np.maximum(fits, 0)], -1)
        else:
            left = rooms[None, :] - sizes[:, None]
            options = np.where(left >= 0, best[np.maximum(left, 0)] + values[:, None], -1.0)
            choice = options.argmax(axis=0)
            gain = options[choice, np.arange(len(rooms))]
            better = gain > best[rooms] + 1e-12
            choice, gain = np.where(better, choice, -1), np.where(better, gain, best[rooms])
        best = gain
        taken.append(choice)
    use, room = np.zeros(len(sizes), np.int64), capacity
    for k in reversed(range(most)):
        g = int(taken[k][room if len(taken[k]) > 1 else 0])
        if g >= 0:
            use[g] += 1
            room -= int(sizes[g])
    return use


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 2000) -> list[tuple[np.ndarray, float]]:
    """Uses of each size in a sequence, with how often: the least number of sequences that hold the demand, in fractions.

    Sizes descend. Ends within a ten-thousandth of the optimum. Every step is a feasible answer, so the bound on rounds costs
    quality at most.
    """
    if not len(sizes):
        return []
    base = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1 / np.diag(base))
    for _ in range(rounds):
        # products by rows: libraries that start threads for such small ones only lose time
        amount = np.maximum((inverse * demand).sum(axis=1), 0)
        prices = inverse.sum(axis=0)
        column = _knapsack(sizes, np.maximum(prices, 0), capacity)
        if column @ prices <= 1 + 1e-4:
            break
        change = (inverse * column).sum(axis=1)
        leaves = np.where(change > 1e-9, amount / np.where(change > 1e-9, change, 1), np.inf)
        out = int(leaves.argmin())
        base[:, out] = column
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
    amount = np.maximum(np.linalg.solve(base, demand), 0)
    return [(np.rint(base[:, k]).astype(np.int64), float(amount[k])) for k in range(len(sizes))]


class _Room:
    """Kinds of sequences by the room left in them. A kind: how many, and its contents as a chain (length, copies, rest)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.kinds: list[list[tuple[int, tuple | None]]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, count: int, contents: tuple | None) -> None:
        if count:
            self.kinds[room].append((count, contents))

    def best_fit(self, length: int, count: int) -> None:
        """Put so many pieces of a length into the fullest sequences that hold them, or else into new ones."""
        room = length
        while count:
            while room <= self.capacity and not self.kinds[room]:
                room += 1
            if room > self.capacity:
                self._fill(self.capacity, -(-count // (self.capacity // length)), None, length, count)
                return
            many, contents = self.kinds[room].pop()
            count = self._fill(room, many, contents, length, count)

    def _fill(self, room: int, many: int, contents: tuple | None, length: int, count: int) -> int:
        """Fill as many sequences of a kind as the pieces suffice for; what is left of the pieces."""
        fits = room // length
        full = min(many, count // fits)
        self.add(room - fits * length, full, (length, fits, contents))
        count -= full * fits
        many -= full
        if many and count:
            self.add(room - count * length, 1, (length, count, contents))
            many, count = many - 1, 0
        self.add(room, many, contents)
        return count


def plan(counts: dict[int, int], capacity: int = CAPACITY, cuts: tuple[tuple[int, int], ...] = CUTS) -> Plan:
    """The plan with the fewest sequences. counts: pieces of each length."""
    least = -(-sum(n * k for n, k in counts.items()) // capacity)
    best = None
    for share, groups in cuts:
        found = _grouped_plan(counts, capacity, share, groups)
        if best is None or found.n_sequences < best.n_sequences:
            best = found
        if best.n_sequences == least:
            break
    return best


def _grouped_plan(counts: dict[int, int], capacity: int, share: int, groups: int) -> Plan:
    left = dict(counts)
    room = _Room(capacity)
    grouped = _groups(counts, capacity, share, groups)
    sizes = np.array([g[0] for g in grouped], np.int64)
    demand = np.array([sum(counts[n] for n in g) for g in grouped], float)
    longest = [list(g) for g in grouped]  # of each group, longest first, as long as pieces are left
    for uses, amount in configurations(sizes, demand, capacity):
        times = int(amount + 1e-6)
        slots = [g for g in np.flatnonzero(uses) for _ in range(uses[g])]
        while times:
            # as many sequences as get the same actual lengths in all slots
            lengths = _next_lengths(slots, longest, left)
            if lengths is None:
                break
            wanted = {n: lengths.count(n) for n in lengths}
            same = min(times, *(left[n] // k for n, k in wanted.items()))
            contents = None
            for n, k in wanted.items():
                left[n] -= same * k
                contents = (n, k, contents)
            room.add(capacity - sum(lengths), same, contents)
            times -= same
    for n in sorted((n for n in left if left[n]), reverse=True):
        room.best_fit(n, left[n])
    return _numbered(room, capacity)


def _next_lengths(slots: list[int], longest: list[list[int]], left: dict[int, int]) -> list[int] | None:
    """The longest lengths that are left of each slot's group, a length as often as there are pieces of it."""
    taken: dict[int, int] = {}
    out = []
    for g in slots:
        while longest[g] and not left[longest[g][0]]:
            longest[g].pop(0)
        n = next((n for n in longest[g] if left[n] > taken.get(n, 0)), None)
        if n is None:
            return None
        taken[n] = taken.get(n, 0) + 1
        out.append(n)
    return out


def _numbered(room: _Room, capacity: int) -> Plan:
    rows, seen, first = [], {}, 0
    for kinds in room.kinds:
        for many, contents in kinds:
            if contents is None:
                continue
            offset = 0
            while contents:
                length, copies, contents = contents
                rows.append((length, seen.get(length, 0), first, copies, offset))
                seen[length] = seen.get(length, 0) + many * copies
                offset += length * copies
            first += many
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Plan(*(np.ascontiguousarray(table[:, k]) for k in range(5)), first)


# --- the whole -------------------------------------------------------------------------------------


def _numbers(table: DataFrame) -> DataFrame:
    """The written table of pieces with ``number``: dense from 0 within each length, block of rows by block of rows."""
    located = table.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).withColumn(
        "block", F.expr(f"row div {BLOCK}")
    )
    blocks = located.groupBy("length", "file", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("length", "file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "file", "block").orderBy("row")) - 1
    return located.withColumn("within", within).join(blocks, ["length", "file", "block"]).select(*table.columns, (F.col("before") + F.col("within")).alias("number"))


def pack(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: all pieces of all documents, each in its place."""
    table = cut(pieces(documents, doc_id, text, capacity, vocabulary))
    counts = {r.length: r.n for r in table.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    shared = documents.sparkSession.sparkContext.broadcast(plan(counts, capacity))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = shared.value.place(length.to_numpy(), number.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = _numbers(table).withColumn("place", place("length", "number"))
    return placed.select(*table.columns, "place.sequence_id", "place.offset")
