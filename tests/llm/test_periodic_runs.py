"""Runs against all periods tried one by one."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest
from brute import TEXTS, words
from pyspark.sql import functions as F

from cladeflow.llm.periodic_runs import find_runs, runs_of
from cladeflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_runs(said, min_length=6, min_exponent=4):
    """start, length, period: every stretch that agrees with itself shifted, by the least shift."""
    found = {}
    for q in range(1, len(said) // 2 + 1):
        i = 0
        while i + q < len(said):
            j = i
            while j + q < len(said) and said[j] == said[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= max(min_length, min_exponent * q))


def plain_row(said):
    runs = plain_runs(said)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        digest(" ".join(w for i, w in enumerate(said) if i not in gone)),
    )


@pytest.mark.parametrize("least, exponent", [(6, 4), (2, 2), (1, 3)])
def test_small_texts_together(least, exponent):
    draw = random.Random(least)
    for _ in range(200):
        texts = []
        for _ in range(draw.randint(1, 4)):
            said = [bytes([97 + draw.randrange(draw.randint(1, 3))]) for _ in range(draw.randint(0, 40))]
            if said and draw.random() < 0.5:
                a, p = draw.randrange(len(said)), draw.randint(1, 5)
                said = said[:a] + [said[min(a + (i - a) % p, len(said) - 1)] for i in range(a, len(said))]
            texts.append(said)
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
        got = list(zip(*[x.tolist() for x in runs_of(texts, bounds, least, exponent)], strict=True))
        assert got == [(s + int(b), n, q) for b, x in zip(bounds, texts, strict=False) for s, n, q in plain_runs(x, least, exponent)]


def test_long_periodic_text():
    """Half a million words of one period, and of a word that never repeats its neighbour's pattern."""
    said = [b"a", b"b", b"c"] * 160_000 + [b"end"]
    start, length, period = runs_of([said], np.array([0, len(said)]), 6, 4)
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [480_000], [3])


def test_odd_rows(spark):
    """Null, empty and blank texts, repeated rows, null and text ids, columns with the operator's own names."""
    texts = [*filter(lambda t: len(t or "") < 1000, TEXTS + TEXTS), "x " * 500, "go go go go go go stop", "\x1ca a a a a a"]
    frame = spark.createDataFrame([(None if k == 1 else f"d{k % 7}", t, k, {"x": k}) for k, t in enumerate(texts)], "doc_id string, text string, found int, `a.b` map<string,int>")
    rows = find_runs(frame.withColumn("start", F.lit(1))).drop("runs").collect()
    key = lambda r: tuple(str(x) for x in r)
    expected = [(None if k == 1 else f"d{k % 7}", *plain_row(words(t))) for k, t in enumerate(texts)]
    assert sorted(map(tuple, rows), key=key) == sorted(expected, key=key)
    assert find_runs(frame.where("false")).count() == 0


def rewritten(doc_id, said):
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest or not said:
        return said
    a = g % len(said)
    p = 1 + (len(said) - a) // (3 + g % 8)
    return [said[i] if i < a else said[a + (i - a) % p] for i in range(len(said))]


def test_query(spark):
    table = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    found = {r[0]: tuple(r)[1:] for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert len(found) == len(table["doc_id"])
    for d, text in zip(table["doc_id"], table["text"], strict=True):
        said = rewritten(d, words(text))
        if len(said) < 800:
            assert found[d] == plain_row(said)
    assert any(r[0] for r in found.values())
