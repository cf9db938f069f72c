"""Hard negatives against all scores."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cladeflow.llm import hard_negatives
from cladeflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(rows, asks, positives=5, negatives=5):
    """rows: (id, label, vector); asks tells anchors by id. Rows listed first win ties after the id."""
    good = [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    whole = [[math.floor(256 * float(x)) for x in r[2]] for r in good]
    out = []
    for k, (d, label, _) in enumerate(good):
        if d is None or not asks(d):
            continue
        score = [sum(a * b for a, b in zip(whole[k], v, strict=False)) for v in whole]
        order = sorted(range(len(good)), key=lambda n: (-score[n], good[n][0] is not None, good[n][0] or 0, n))
        best = [n for n in order if n != k and good[n][1] == label][:positives]
        for p in best:
            hard = [n for n in order if good[n][1] != label and 80 * score[p] <= 100 * score[n] <= 100 * score[p]][:negatives]
            out += [(d, good[p][0], r, good[n][0], score[p], score[n]) for r, n in enumerate(hard, 1)]
    return sorted(out, key=str)


def test_query(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet").to_pydict()
    rows = [(d, (n + 1) % 10 if d % 7 == 0 else n, v) for d, n, v in zip(table["vec_id"], table["label"], table["embedding"], strict=True)]
    found = [tuple(r) for r in QUERIES["op13_hard_negatives"](spark, SF).collect()]
    assert found and sorted(found, key=str) == plain(rows, lambda d: d % 100 == 0)


def clustered(draw, count, width):
    """Tight clusters far from each other, of mixed labels, so that cells can be left out."""
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(12)]
    return [(k, draw.randrange(3), [x + draw.gauss(0, 0.05) for x in draw.choice(centres)]) for k in range(count)]


def frame(spark, rows):
    listed = spark.createDataFrame([(*r, "x", {"y": 1}) for r in rows], "vec_id bigint, label int, embedding array<double>, cell string, `a.b` map<string,int>")
    return listed.coalesce(1).withColumn("score", F.lit(1))


@pytest.mark.parametrize("block", [None, 7])
def test_clusters(spark, monkeypatch, block):
    """Also with blocks of a few rows and visitors."""
    if block:
        monkeypatch.setattr(hard_negatives, "ROWS", 50 * block)
        monkeypatch.setattr(hard_negatives, "VISITORS", block)
    monkeypatch.setattr(hard_negatives, "LEAF", 20)
    rows = clustered(random.Random(2), 600, 6)
    found = hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain(rows, lambda d: d % 20 == 0)


def test_cells_are_left_out():
    """The ranges spare most cells where the data has clusters, and never one that holds a row of the annulus."""
    draw = random.Random(3)
    rows = np.floor(256 * np.array([v for _, _, v in clustered(draw, 3000, 6)]))
    longest = float(np.sqrt((rows**2).sum(axis=1).max()))
    lifted = hard_negatives._lifted(rows, longest)
    tree = hard_negatives._grow(lifted[::5], 8, 40)
    cells = tree.place(lifted)
    for split, _, far, near in tree.walk(lifted):
        while len(tree.low) <= split:
            tree.low.append(None), tree.high.append(None)
        size = len(tree.points[split])
        tree.low[split] = np.array([[far[near == j, i].min(initial=np.inf) for j in range(size)] for i in range(size)])
        tree.high[split] = np.array([[far[near == j, i].max(initial=-np.inf) for j in range(size)] for i in range(size)])
    anchors = lifted[::50].copy()
    anchors[:, -1] = 0
    inner, outer = np.full(len(anchors), 0.3), np.full(len(anchors), 0.6)
    visited = set(zip(*[x.tolist() for x in tree.visits(anchors, inner, outer)], strict=True))
    far = hard_negatives._distances(anchors, lifted)
    needed = {(a, int(cells[n])) for a, n in zip(*np.nonzero((far >= inner[:, None]) & (far <= outer[:, None])), strict=True)}
    assert needed <= visited and len(visited) < len(anchors) * tree.cells * 0.7


def test_odd_rows(spark):
    """Null ids, labels, vectors and components, infinities, other lengths, copies, repeated ids, all-zero and huge vectors."""
    draw = random.Random(4)
    rows = clustered(draw, 80, 3) + [
        (100, None, [1.0, 1.0, 1.0]), (120, 1, None), (140, 1, [1.0, None, 2.0]), (160, 1, [math.inf, 0.0, 0.0]), (180, 1, [math.nan, 0.0, 0.0]),
        (200, 1, []), (220, 0, [0.0, 0.0, 0.0]), (240, 2, [1.5]), (260, 1, [2.0**40, 3.0, 1.0]), (261, 0, [2.0**19, 3.0, 1.0]), (None, 1, [1.0, 1.0, 0.5]),
    ]
    rows += rows[:30] + [rows[20]] * 40
    found = hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain(rows, lambda d: d % 20 == 0)
    assert hard_negatives.mine(frame(spark, rows).where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_no_other_label(spark):
    rows = [(k, 1, [1.0, float(k)]) for k in range(30)]
    assert hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 20 == 0).count() == 0
