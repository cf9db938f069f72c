"""Benchmark decontamination with an Aho-Corasick automaton over the normalised test items.

Texts and items are lower-cased (A-Z) and cut into words. Every run of ``window`` item words is a pattern, an item of
fewer words is one pattern. Each text is read once; hits are told as words and as character offsets of the original.
The patterns are sent to the tasks, so their size is checked: items beyond ``max_chars`` characters are dealt to
several automata that read the texts one after the other.

Null and empty texts have no words and no hits. Items without an id or without words are ignored; rows repeated in
either table are treated alike; extra columns of the documents are returned, those of the benchmark are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeflow.llm.common import normal_words, raw, stream

WINDOW = 13
MAX_CHARS = 4_000_000
FOUND = ("n_words", "n_hit", "items", "spans")
_SCHEMA = "n_words bigint, n_hit bigint, items array<bigint>, spans array<struct<begin:bigint, end:bigint>>, _ranges array<bigint>"
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def compile_items(items: list[tuple[int, bytes]], window: int) -> ahocorasick.Automaton:
    """Patterns hold their words with a blank on either side; values are (length, words, items)."""
    owners: dict[str, tuple[int, set[int]]] = {}
    for item, text in items:
        words = normal_words(text)
        for k in range(max(1, len(words) - window + 1) if words else 0):
            part = words[k : k + window]
            owners.setdefault(f" {b' '.join(part).decode('latin-1')} ", (len(part), set()))[1].add(item)
    automaton = ahocorasick.Automaton()
    for pattern, (n, owned) in owners.items():
        automaton.add_word(pattern, (len(pattern), n, sorted(owned)))
    automaton.make_automaton()
    return automaton


def _find(automaton, text: bytes) -> tuple[int, list[int], set[int]]:
    """Words of the text, hit words as flat (first, beyond) pairs, items."""
    words = normal_words(text)
    if not words or not len(automaton):
        return len(words), [], set()
    line = f" {b' '.join(words).decode('latin-1')} "
    found = list(automaton.iter(line))
    if not found:
        return len(words), [], set()
    blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    ranges: list[int] = []
    items: set[int] = set()
    for end, (length, n, owned) in found:
        first = int(np.searchsorted(blanks, end - length + 1))
        ranges += [first, first + n]
        items.update(owned)
    return len(words), ranges, items


def _merged(ranges: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, beyond in sorted(zip(ranges[::2], ranges[1::2], strict=True)):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(beyond, out[-1][1]))
        else:
            out.append((first, beyond))
    return out


def _offsets(text: bytes, merged: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Character offsets in the original text."""
    if not merged:
        return []
    places = [m.span() for m in _WORD.finditer(text.lower())]
    return [
        {"begin": len(text[: places[a][0]].decode("utf-8", "replace")), "end": len(text[: places[b - 1][1]].decode("utf-8", "replace"))}
        for a, b in merged
    ]


def _scan(documents: DataFrame, automaton, column: str) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(automaton)
    before = "_ranges" in documents.columns
    kept = [f for f in documents.schema.fields if f.name not in (*FOUND, "_ranges")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            earlier = zip(batch.column("items").to_pylist(), batch.column("_ranges").to_pylist(), strict=True) if before else ()
            rows: list[list] = [[], [], [], [], []]
            for k, (text, more) in enumerate(zip(stream(batch.column(column)), earlier or [([], [])] * batch.num_rows, strict=True)):
                n, ranges, items = _find(shared.value, text)
                ranges, items = ranges + more[1], items.union(more[0])
                merged = _merged(ranges)
                for to, value in zip(rows, (n, sum(b - a for a, b in merged), sorted(items), _offsets(text, merged), [x for y in merged for x in y]), strict=True):
                    to.append(value)
            types = (pa.int64(), pa.int64(), pa.list_(pa.int64()), _SPANS, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [pa.array(r, t) for r, t in zip(rows, types, strict=True)],
                names=[f.name for f in kept] + [*FOUND, "_ranges"],
            )

    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return documents.mapInArrow(run, head + _SCHEMA)


def find_items(documents: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", window: int = WINDOW, max_chars: int = MAX_CHARS) -> DataFrame:
    """The documents with n_words, n_hit, items and spans; columns of these names are replaced."""
    items = benchmark.select(F.col(item_id).cast("bigint").alias("item"), F.col(item_text).alias("said")).where(
        "item is not null and said is not null"
    ).distinct()
    chars = items.agg(F.sum(F.length("said"))).first()[0] or 0
    shards = -(-chars // max_chars) or 1
    found = documents.drop(*FOUND, "_ranges")
    for shard in range(shards):
        own = items.where(F.pmod(F.xxhash64("item"), F.lit(shards)) == shard).toArrow()
        pairs = list(zip(own.column("item").to_pylist(), raw(own, "said"), strict=True))
        found = _scan(found, compile_items(pairs, window), text)
    return found.drop("_ranges")


def contaminated(share: float = 0.05):
    """Verdict on rows of find_items: hit words make up the share of all words at least."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * round(1 / share) >= F.col("n_words"))
