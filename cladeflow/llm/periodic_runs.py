"""Periodic runs of words: stretches that repeat one period of words over and over.

Enhanced suffix arrays with the branching tandem test. The words of a batch of texts are sorted by prefix doubling, all
texts at once (words of different texts never compare as equal, so no text sees another). Neighbours' common prefixes give
the LCP intervals. In each interval of depth d, the suffixes of all children but the largest are looked up d words to the
right and to the left: where the inverse suffix array says that the other one lies in the interval, but below another child,
both halves agree in d words and no further, that is, a square whose period cannot go on to the right. Each run ends in one
such square for every multiple of its period that fits twice. Rotating a square to the left as far as it goes gives where
the run begins; of squares with one beginning and one end the least period stays. All of it is array work over SA, ISA, LCP
and the ranks of the doubling rounds; there are no tree nodes.

Documents never meet: a text is worked out where it is read, without a shuffle. Memory is bounded by the larger of BATCH
words and one text (about 250 bytes a word for a text without periods, more with the logarithm of its longest repetition).

Defined results: a null, empty or blank text has no words and no runs. Texts of any length are read whole. Rows stand for
themselves, so repeated rows give repeated results; an empty table gives none. Among runs with the same exponent the one
that starts first is shown, then the one with the smaller period. Columns other than the id and the text are ignored, whatever
their names are. A null id stays null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeflow.llm.common import stream

# Words sorted together, and suffixes looked up together.
BATCH = 100_000
LOOKED_UP = 1 << 20

RESULT = pa.struct(
    [("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()),
     ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])))]
)
_DDL = (
    "struct<n_runs:bigint,start:bigint,length:bigint,period:bigint,exponent_milli:bigint,runs_sha256:string,collapsed_sha256:string,"
    "runs:array<struct<start:bigint,length:bigint,period:bigint>>>"
)


def find_runs(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = 6,
    min_exponent: int = 4,
    rewrite: Callable[[list[bytes], int], list[bytes]] | None = None,
    seed: Column | None = None,
) -> DataFrame:
    """``doc_id, n_runs``, the run of the greatest exponent, two digests and all runs (``runs``) of each document.

    Runs have at least min_length words and min_exponent periods. rewrite(words, seed) may change the words first.
    """
    one = F.lit(0).cast("bigint") if seed is None else seed.cast("bigint")

    @F.arrow_udf(_DDL)
    def read(texts: pa.Array, seeds: pa.Array) -> pa.Array:
        found: list[dict] = []
        for group in _batches(texts, seeds, rewrite):
            found += _described(group, min_length, min_exponent)
        return pa.array(found, RESULT)

    return documents.select(F.col(doc_id).alias("doc_id"), read(F.col(text), one).alias("found")).select("doc_id", "found.*")


def _batches(texts: pa.Array, seeds: pa.Array, rewrite) -> Iterator[list[list[bytes]]]:
    group, size = [], 0
    for text, seed in zip(stream(texts), seeds.to_pylist(), strict=True):
        words = text.split()
        if rewrite and words:
            words = rewrite(words, seed or 0)
        if group and size + len(words) > BATCH:
            yield group
            group, size = [], 0
        group.append(words)
        size += len(words)
    if group:
        yield group


def _described(group: list[list[bytes]], min_length: int, min_exponent: int) -> list[dict]:
    bounds = np.concatenate([[0], np.cumsum([len(words) for words in group])]).astype(np.int64)
    start, length, period = runs_of(group, bounds, min_length, min_exponent)
    first = np.searchsorted(start, bounds)
    out = []
    for k, words in enumerate(group):
        own = slice(first[k], first[k + 1])
        runs = list(zip((start[own] - bounds[k]).tolist(), length[own].tolist(), period[own].tolist(), strict=True))
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        out.append(
            {
                "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
                "exponent_milli": 1000 * best[1] // best[2] if runs else None,
                "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
                "collapsed_sha256": hashlib.sha256(b" ".join(_collapsed(words, runs))).hexdigest(),
                "runs": [{"start": s, "length": n, "period": q} for s, n, q in runs],
            }
        )
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Without what any run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for s, n, q in runs:
        edge[s + q] += 1
        edge[s + n] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def runs_of(group: list[list[bytes]], bounds: np.ndarray, min_length: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, length and period of all runs, sorted by start and period. Starts count through all texts of the group."""
    none = np.zeros(0, np.int64)
    size = int(bounds[-1])
    if not size:
        return none, none, none
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for words in group for w in words), np.int64, size)
    owner = np.repeat(np.arange(len(group)), np.diff(bounds))
    order, place, ranks = _suffixes(owner * len(numbers) + ids, bounds[1:][owner])
    square, period = _branching_squares(order, place, _common_prefixes(order, ranks))
    begin = _rotated(square, period, bounds[:-1][owner], ranks)
    end = square + 2 * period
    # squares of one run: same beginning, same end
    by = np.lexsort((period, end, begin))
    begin, end, period = begin[by], end[by], period[by]
    least = np.ones(len(by), bool)
    least[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    kept = least & (end - begin >= np.maximum(min_length, min_exponent * period))
    begin, end, period = begin[kept], end[kept], period[kept]
    by = np.lexsort((period, begin))
    return begin[by], (end - begin)[by], period[by]


def _suffixes(keys: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Suffix array, its inverse, and the ranks of all stretches of 1, 2, 4, ... words: equal where the stretches are equal.

    Only suffixes that share their rank with another one are sorted again. Ranks have a last entry of -1 beyond all words.
    """
    size = len(keys)
    order = np.argsort(keys, kind="stable")
    rank = np.full(size + 1, -1, np.int64)
    active, at = np.arange(size), keys[order]
    ranks, step = [], 0
    while True:
        new = np.ones(len(active), bool)
        new[1:] = at[1:] != at[:-1]
        head = active[np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))]
        rank[order[active]] = head
        ranks.append(rank.astype(np.int32))
        last = np.append(new[1:], True)
        active = active[~(new & last)]
        if not len(active):
            return order, rank, ranks
        step = step * 2 if step else 1
        suffix = order[active]
        beyond = suffix + step
        second = np.where(beyond < ends[suffix], rank[np.minimum(beyond, size)], -1)
        at = rank[suffix] * (size + 1) + second + 1
        by = np.argsort(at, kind="stable")
        order[active], at = suffix[by], at[by]


def _common_prefixes(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix shares with the one before it in the suffix array."""
    lcp = np.zeros(len(order) + 1, np.int64)
    single = ranks[0]
    at = np.flatnonzero(single[order[1:]] == single[order[:-1]]) + 1
    left, right = order[at - 1].copy(), order[at].copy()
    for level in reversed(range(len(ranks))):
        same = ranks[level][left] == ranks[level][right]
        step = same.astype(np.int64) << level
        left += step
        right += step
    lcp[at] = left - order[at - 1]
    return lcp


def _rotated(square: np.ndarray, period: np.ndarray, first: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Where the run of each square begins: it is rotated to the left, in halving steps, while the words before both halves agree."""
    left, right = square.copy(), square + period
    limit = first[square]
    for level in reversed(range(len(ranks))):
        step = 1 << level
        fits = left - step >= limit
        back = np.where(fits, step, 0)
        same = fits & (ranks[level][left - back] == ranks[level][right - back])
        left -= np.where(same, step, 0)
        right -= np.where(same, step, 0)
    return left


def _extents(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each boundary: first and last row of the suffix array that agree with its neighbours in as many words."""
    size = len(lcp)
    zero = np.flatnonzero(lcp == 0)
    longest = int(np.diff(np.append(zero, size)).max())
    least = [lcp]
    while (2 << (len(least) - 1)) <= longest:
        half = 1 << (len(least) - 1)
        least.append(np.minimum(least[-1][:-half], least[-1][half:]))
    depth = lcp[at]
    low, high = at.copy(), at + 1
    for level in reversed(range(len(least))):
        step, table = 1 << level, least[level]
        fits = low >= step
        low = np.where(fits & (table[np.clip(low - step, 0, len(table) - 1)] >= depth), low - step, low)
        fits = high + step <= size
        high = np.where(fits & (table[np.minimum(high, len(table) - 1)] >= depth), high + step, high)
    return low - 1, high - 1


def _branching_squares(order: np.ndarray, place: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and period of all squares that do not go on to the right."""
    at = np.flatnonzero(lcp)
    if not len(at):
        return at, at
    low, high = _extents(lcp, at)
    by = np.lexsort((at, high, low))
    at, low, high = at[by], low[by], high[by]
    opens = np.ones(len(at), bool)
    opens[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    closes = np.append(opens[1:], True)
    # A child from each boundary to the next, and one from the beginning of the interval to its first boundary.
    until = np.where(closes, high + 1, np.append(at[1:], 0))
    begin = np.concatenate([at, low[opens]])
    end = np.concatenate([until, at[opens]])
    depth = np.concatenate([lcp[at], lcp[at[opens]]])
    left, right = np.concatenate([low, low[opens]]), np.concatenate([high, high[opens]])
    interval = np.concatenate([np.cumsum(opens) - 1, np.arange(opens.sum())])
    # The largest child of each interval is spared.
    by = np.lexsort((end - begin, interval))
    largest = by[np.append(np.flatnonzero(np.diff(interval[by])), len(by) - 1)]
    small = np.ones(len(begin), bool)
    small[largest] = False
    begin, end, depth, left, right = begin[small], end[small], depth[small], left[small], right[small]
    total = np.concatenate([[0], np.cumsum(end - begin)])
    squares, periods = [], []
    for k in range(0, int(total[-1]), LOOKED_UP):
        # suffixes k to k + LOOKED_UP of all children one after the other
        item = np.arange(k, min(k + LOOKED_UP, int(total[-1])))
        child = np.searchsorted(total, item, side="right") - 1
        suffix = order[begin[child] + item - total[child]]
        for shift in (depth[child], -depth[child]):
            other = suffix + shift
            inside = other >= 0
            row = place[np.where(inside, other, 0)]
            found = inside & (row >= left[child]) & (row <= right[child]) & ((row < begin[child]) | (row >= end[child]))
            squares.append(np.minimum(suffix, other)[found])
            periods.append(depth[child][found])
    square, period = np.concatenate(squares), np.concatenate(periods)
    pairs = np.unique(square * (len(order) + 1) + period)
    return pairs // (len(order) + 1), pairs % (len(order) + 1)
