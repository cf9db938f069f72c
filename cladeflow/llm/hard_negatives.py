"""Hard negatives: rows of another label that an anchor scores nearly as high as its positives.

A multiway tree of hyperplane cells (GNAT). Scores are whole inner products. Every vector gets one more coordinate that
brings all of them to the length of the longest, M; then the squared distance of an anchor to a row is |a|^2 + M^2 - 2 score,
and a window of scores is an annulus around the anchor. A split of the tree has up to DEGREE split points; a row belongs to
the child whose point is nearest. For each pair of siblings i and j the tree holds the least and the greatest distance of
point i to any row below j, taken over all rows. With d the distance of an anchor to point i, rows of its annulus [r, R] lie
between max(d - R, r - d, 0) and d + R from that point, so a sibling j whose range does not meet this is left out with all
below it. Cells that stay are compared whole, in whole numbers, so nothing is missed.

Only the split points are fitted on a bounded sample (SAMPLE rows with the least hash); all rows are placed, and all ranges
are over all rows. The sample also gives each anchor a first bound: it needs no row below the last it would take from the
sample. Splits, ranges and sample are all that is broadcast, of a size bounded by SAMPLE, DEGREE and the dimension.

Work is dealt by cell. A cell with many rows, or many anchors that look into it, is dealt as a grid of blocks of about ROWS
by about VISITORS, so a vector that a third of all rows share is many blocks. A block returns the best few of each anchor.
In high dimensions, where all distances are alike, few cells can be left out: the work then is anchors times rows, in blocks.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part. Components are
floor(scale * x), saturated at a long; scores are exact, saturated at a long. Vectors of different lengths are compared in
the components that both have. Repeated rows, and rows with the same id, are rows of their own: each is a candidate, and an
anchor's positives leave out only the anchor's own row. Ties in score go to the smaller id, then to the row listed first. Null ids
come first. Positives with a negative score have no window. Anchors without positives, and positives without negatives,
give no rows. Columns other than the three named ones are ignored, whatever their names are. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeflow.session import cut

SAMPLE = 8_192
DEGREE = 8
# A cell of the sample this small is not split.
LEAF = 160
ROWS = 16_384
VISITORS = 2_048
LONG = 2**63 - 1


def quantized(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of all components; null if one is null or not finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(good, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint")))


# --- vectors ---------------------------------------------------------------------------------------


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors of whole numbers, filled up with zeros to the width."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    values = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()] if len(column) else np.zeros(0, np.int64)
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of both. Doubles hold them as long as no sum reaches 2^53."""
    top = [float(np.abs(x.astype(float)).max(initial=0)) for x in (left, right)]
    if top[0] * top[1] * left.shape[1] < 2**53:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    exact = left.astype(object) @ right.astype(object).T
    return np.clip(exact, -LONG - 1, LONG).astype(np.int64)


def _lifted(rows: np.ndarray, longest: float) -> np.ndarray:
    """With the coordinate that brings every row to the length of the longest, all of them scaled to length 1."""
    real = rows.astype(float)
    rest = np.maximum(longest**2 - (real**2).sum(axis=1), 0)
    return np.column_stack([real, np.sqrt(rest)]) / (longest or 1)


def _distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    square = (left**2).sum(axis=1)[:, None] + (right**2).sum(axis=1)[None, :] - 2 * (left @ right.T)
    return np.sqrt(np.maximum(square, 0))


# --- the tree --------------------------------------------------------------------------------------


@dataclass
class Tree:
    """points: of each split; child[s][i]: the split below, or -1 - cell. low, high[s][i, j]: distances of point i to the rows
    below j."""

    points: list[np.ndarray] = field(default_factory=list)
    child: list[list[int]] = field(default_factory=list)
    low: list[np.ndarray] = field(default_factory=list)
    high: list[np.ndarray] = field(default_factory=list)
    cells: int = 0

    def walk(self, rows: np.ndarray):
        """For each split with the rows that reach it: split, rows, their distances to the points, the nearest point. At the
        end ``self.place(rows)`` is known as the cell of each."""
        todo = [(0, np.arange(len(rows)))] if self.points else []
        while todo:
            split, own = todo.pop()
            far = _distances(rows[own], self.points[split])
            near = far.argmin(axis=1)
            yield split, own, far, near
            for i, below in enumerate(self.child[split]):
                if below >= 0 and (near == i).any():
                    todo.append((below, own[near == i]))

    def place(self, rows: np.ndarray) -> np.ndarray:
        cell = np.zeros(len(rows), np.int64)
        for split, own, _, near in self.walk(rows):
            below = np.array(self.child[split])[near]
            cell[own[below < 0]] = -1 - below[below < 0]
        return cell

    def visits(self, anchors: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """anchor, cell: cells that may hold rows between inner and outer from the anchor."""
        slack = 1e-6
        if not self.points:
            return np.arange(len(anchors)), np.zeros(len(anchors), np.int64)
        found, todo = [], [(0, np.arange(len(anchors)))]
        while todo:
            split, own = todo.pop()
            far = _distances(anchors[own], self.points[split])
            least = np.maximum(np.maximum(far - outer[own, None], inner[own, None] - far), 0) - slack
            most = far + outer[own, None] + slack
            # every point's range has a say on every sibling
            stays = ((most[:, :, None] >= self.low[split]) & (least[:, :, None] <= self.high[split])).all(axis=1)
            for j, below in enumerate(self.child[split]):
                kept = own[stays[:, j]]
                if not len(kept):
                    continue
                if below < 0:
                    found.append((kept, np.full(len(kept), -1 - below)))
                else:
                    todo.append((below, kept))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([c for _, c in found])


def _grow(sample: np.ndarray, degree: int, leaf: int) -> Tree:
    """Split points are chosen far from each other, one after the other. Copies of one vector never make a split."""
    tree = Tree()
    todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(sample)), -1, -1)]
    while todo:
        own, above, at = todo.pop(0)
        chosen = _far_points(sample[own], degree) if len(own) > leaf else np.zeros(0, np.int64)
        if len(chosen) < 2:
            if above >= 0:
                tree.child[above][at] = -1 - tree.cells
            tree.cells += 1
            continue
        points = sample[own[chosen]]
        near = _distances(sample[own], points).argmin(axis=1)
        split = len(tree.points)
        if above >= 0:
            tree.child[above][at] = split
        tree.points.append(points)
        tree.child.append([0] * len(points))
        todo += [(own[near == i], split, i) for i in range(len(points))]
    return tree


def _far_points(rows: np.ndarray, degree: int) -> np.ndarray:
    chosen = [int(_distances(rows, rows.mean(axis=0)[None, :])[:, 0].argmax())]
    gap = np.full(len(rows), np.inf)
    while len(chosen) < degree:
        gap = np.minimum(gap, _distances(rows, rows[chosen[-1:]])[:, 0])
        if gap.max() < 1e-4:
            break
        chosen.append(int(gap.argmax()))
    return np.array(chosen)


def _with_ranges(tree: Tree, placed: DataFrame, shared, width: int, longest: float) -> Tree:
    """Least and greatest distances over all rows, gathered per split in the tasks and then by Spark: a row for each pair of
    siblings at most."""

    def measure(batches):
        low = [np.full((len(p), len(p)), np.inf) for p in shared.value.points]
        high = [np.full((len(p), len(p)), -np.inf) for p in shared.value.points]
        for batch in batches:
            rows = _lifted(_matrix(batch.column("v"), width), longest)
            for split, _, far, near in shared.value.walk(rows):
                for j in np.unique(near):
                    low[split][:, j] = np.minimum(low[split][:, j], far[near == j].min(axis=0))
                    high[split][:, j] = np.maximum(high[split][:, j], far[near == j].max(axis=0))
        at = [(s, i, j) for s in range(len(low)) for i, j in zip(*np.nonzero(np.isfinite(low[s])), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(x[k]) for x in at], pa.int32()) for k in range(3)]
            + [pa.array([float(side[s][i, j]) for s, i, j in at], pa.float64()) for side in (low, high)],
            names=["s", "i", "j", "low", "high"],
        )

    ranges = placed.select("v").mapInArrow(measure, "s int, i int, j int, low double, high double")
    tree.low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    tree.high = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
    for r in ranges.groupBy("s", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        tree.low[r.s][r.i, r.j], tree.high[r.s][r.i, r.j] = r.low, r.high
    return tree


# --- mining ----------------------------------------------------------------------------------------


@dataclass
class _Index:
    """All rows by cell, and what is sent to the tasks."""

    rows: DataFrame  # row, id, label, v, cell
    width: int
    longest: float
    per_cell: dict[int, int]
    shared: object


def _index(rows: DataFrame) -> _Index:
    spark = rows.sparkSession
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    width, longest = rows.agg(F.max(F.size("v")), F.sqrt(F.max(squares))).first()
    width, longest = width or 0, longest or 0.0
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("row", "id", "label", "v").toArrow()
    points = _matrix(sample.column("v"), width)
    tree = _grow(_lifted(points, longest), DEGREE, LEAF)
    bare = spark.sparkContext.broadcast(tree)

    @F.arrow_udf("int")
    def cell_of(vectors: pa.Array) -> pa.Array:
        return pa.array(bare.value.place(_lifted(_matrix(vectors, width), longest)).astype(np.int32))

    placed = cut(rows.withColumn("cell", cell_of("v")))
    per_cell = {r.cell: r.n for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    tree = _with_ranges(tree, placed, bare, width, longest)
    seen = {"points": points, "label": _codes(sample.column("label")), "row": sample.column("row").to_numpy()}
    return _Index(placed, width, longest, per_cell, spark.sparkContext.broadcast((tree, seen)))


def _codes(column) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=object)


def _last_of(scores: np.ndarray, holds: np.ndarray, count: int) -> np.ndarray:
    """Of each row the count-th greatest score that holds; the least long where there are fewer."""
    best = np.where(holds, scores, -LONG - 1)
    if best.shape[1] < count:
        return np.full(len(best), -LONG - 1)
    return np.partition(best, best.shape[1] - count, axis=1)[:, best.shape[1] - count]


def _visits(index: _Index, anchors: DataFrame, windows: str | None, count: int) -> DataFrame:
    """Anchors with the cells they look into, and the least score of use for each window. windows: a column of positives'
    scores, one window for each; without it the only window has no upper end and holds rows of the anchor's label."""
    width, longest, shared = index.width, index.longest, index.shared

    def look(batches):
        tree, seen = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                vectors, label, row = _matrix(part.column("v"), width), _codes(part.column("label")), part.column("row").to_numpy()
                scores = _scores(vectors, seen["points"])
                same = label[:, None] == seen["label"][None, :]
                lows: list[list[int]] = [[] for _ in label]
                tops = np.full(len(label), LONG)
                if windows is None:
                    last = _last_of(scores, same & (row[:, None] != seen["row"][None, :]), count)
                    lows = [[int(x)] for x in last]
                else:
                    given = part.column(windows).to_pylist()
                    for k in range(max(map(len, given), default=0)):
                        have = np.array([len(x) > k for x in given])
                        top = np.array([x[k] if len(x) > k else -1 for x in given], dtype=np.int64)
                        floor = _floor_of(top)
                        last = _last_of(scores, ~same & (scores <= top[:, None]) & (scores >= floor[:, None]), count)
                        for n in np.flatnonzero(have):
                            lows[n].append(int(max(floor[n], last[n])))
                    tops = np.array([max(x, default=-1) for x in given], dtype=np.int64)
                bottom = np.array([min(x) for x in lows], dtype=float)
                lifted = _lifted(vectors, longest)
                own = lifted.copy()
                own[:, -1] = 0
                scale = longest**2 or 1
                base = (own**2).sum(axis=1) + 1
                inner = np.sqrt(np.maximum(base - 2 * tops.astype(float) / scale, 0))
                outer = np.sqrt(np.maximum(base - 2 * bottom / scale, 0))
                who, cell = tree.visits(own, inner, outer)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row").take(pa.array(who)), pa.array(cell.astype(np.int32)), pa.array([lows[n] for n in who], pa.list_(pa.int64()))],
                    names=["row", "cell", "lows"],
                )

    given = ["row", "label", "v", *([windows] if windows else [])]
    return anchors.select(*given).mapInArrow(look, "row bigint, cell int, lows array<bigint>")


def _floor_of(top: np.ndarray) -> np.ndarray:
    """Least score s with 5 s >= 4 top, for top >= 0."""
    return np.where(top < 0, LONG, top - top // 5)


def _search(index: _Index, anchors: DataFrame, windows: str | None, count: int) -> DataFrame:
    """``row, window, other_id, other_row, score``: the best of each block for each anchor and window."""
    width = index.width
    visits = cut(_visits(index, anchors, windows, count))
    looking = {r.cell: r.n for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    grid = [(c, -(-n // ROWS), -(-looking[c] // VISITORS)) for c, n in index.per_cell.items() if c in looking]
    spark = visits.sparkSession
    sizes = F.broadcast(spark.createDataFrame(grid, "cell int, across int, down int"))  # a row for each cell
    dealt = visits.join(sizes, "cell").join(anchors, "row")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("row"), F.col("down").cast("bigint"))).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("across") - 1)))
    held = index.rows.join(sizes, "cell")
    held = held.withColumn("block", F.pmod(F.xxhash64("row"), F.col("across").cast("bigint")).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("down") - 1).cast("bigint")))
    )
    id_type = index.rows.schema["id"].dataType.simpleString()
    names = ["row", "window", "other_id", "other_row", "score"]

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        ids = right.column("id").to_pylist()
        labels, rows = _codes(right.column("label")), right.column("row").to_numpy()
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is not None, ids[k], rows[k]) if ids[k] is not None else (False, 0, rows[k]))
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        there = _matrix(right.column("v"), width)
        lows, given = left.column("lows").to_pylist(), left.column(windows).to_pylist() if windows else None
        own_rows, own_labels = left.column("row").to_numpy(), _codes(left.column("label"))
        vectors = _matrix(left.column("v"), width)
        for at in range(0, len(vectors), 128):
            scores = _scores(vectors[at : at + 128], there)
            for k, line in enumerate(scores, at):
                near = np.flatnonzero(line >= min(lows[k]))
                if windows is None:
                    near = near[(labels[near] == own_labels[k]) & (rows[near] != own_rows[k])]
                    picks = [(0, near)]
                else:
                    near = near[labels[near] != own_labels[k]]
                    picks = [(w, near[(line[near] >= low) & (line[near] <= top)]) for w, (low, top) in enumerate(zip(lows[k], given[k], strict=True))]
                for w, near in picks:
                    best = near[np.lexsort((rank[near], -line[near]))[:count]]
                    found += [(own_rows[k], w, ids[n], rows[n], line[n]) for n in best]
        kinds = [pa.int64(), pa.int32(), right.schema.field("id").type, pa.int64(), pa.int64()]
        return pa.table([pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)], names=names)

    key = ["cell", "part", "block"]
    asked = dealt.select(*key, "row", "label", "v", "lows", *([windows] if windows else []))
    # renamed, as both sides come from one table
    grouped = asked.toDF(*asked.columns).groupBy(*key).cogroup(held.select(*key, "row", "id", "label", "v").groupBy(*key))
    return grouped.applyInArrow(compare, f"row bigint, window int, other_id {id_type}, other_row bigint, score bigint")


def _first(found: DataFrame, count: int) -> DataFrame:
    best = Window.partitionBy("row", "window").orderBy(F.col("score").desc(), F.col("other_id").asc_nulls_first(), "other_row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    row_id: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    positives: int = 5,
    negatives: int = 5,
    scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For each anchor and each of its best rows of the same label, the best rows of another label whose score is between 80 and
    100 percent of the positive's.
    """
    named = F.col(label) if isinstance(label, str) else label
    taken = rows.select(F.col(row_id).alias("id"), named.alias("label"), quantized(F.col(vector), scale).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    index = _index(taken.where(F.col("v").isNotNull() & F.col("label").isNotNull()))
    anchors = index.rows.where("asks").select("row", F.col("id").alias("anchor_id"), "label", "v")
    found = _first(_search(index, anchors, None, positives), positives)
    # at most `positives` rows of an anchor come together
    best = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", F.col("other_id").alias("id"), "score"))).alias("best"))
    asking = cut(anchors.join(best.where(F.col("best")[0]["score"] >= 0), "row").withColumn("tops", F.col("best")["score"]))
    hard = _first(_search(index, asking, "tops", negatives), negatives)
    return hard.join(asking.select("row", "anchor_id", "best"), "row").select(
        "anchor_id",
        F.col("best")[F.col("window")]["id"].alias("positive_id"),
        "rank",
        F.col("other_id").alias("negative_id"),
        F.col("best")[F.col("window")]["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
