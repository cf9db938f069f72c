"""Exact near-duplicate groups of SimHash fingerprints, by vantage-point trees.

A fingerprint has 64 bits, each the majority of that bit over the hashes of the text's word shingles; a text of fewer
words is one shingle, a text without words has fingerprint 0 and is linked like any other. Fingerprints link at
``radius`` or fewer differing bits; a group is what links reach.

In 64 bits nearly all distances lie within a few bits of 32, where a bound of 4 prunes next to nothing. The bits are
therefore read as three bands: of a pair within 4 bits, one band differs by at most 1. For each band a vantage-point
tree splits the fingerprints at the median distance to vantage points taken from a sample. A fingerprint owns the leaf
it falls in, and visits every leaf which the triangle inequality leaves open within the band's radius. Each leaf compares
owners with owners and visitors in full, by sorted distance to one vantage point more. The sample decides the size of
leaves, never which pairs are found.

Leaves with many owners are dealt in chunks, each met by the visitors and the owners of earlier chunks. A task returns
no pairs, only a spanning forest of what it saw, and groups are the components of these links, contracted in rounds
that are written below spark.checkpoint.dir.

Null and empty texts have fingerprint 0. Rows repeated with their id link to themselves. Extra columns are returned,
those named like results are replaced. A null id is never a group's name unless the group has no other id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeflow.llm.common import columns_of, ddl, stream
from cladeflow.session import cut

RADIUS = 4
SHINGLE = 4
BANDS = ((0, 22), (22, 21), (43, 21))
# Fingerprints the trees are built from, owners aimed at per leaf, deepest tree, owners compared in one task.
SAMPLE, LEAF, DEEPEST, CHUNK = 40_000, 1_500, 14, 6_000
RESULT = ("fingerprint", "component_id")
_LINKS = "a bigint, b bigint"


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-1]])
        digest = xxhash.xxh64_intdigest
        spans = zip(starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)
        hashes = np.array([digest(line[a:b], 42) for a, b in spans], np.uint64)
    set_bits = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k : k + (1 << 16)]
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(documents: DataFrame, *, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The documents without their text, with _fp."""
    fields = [f for f in documents.schema.fields if f.name not in (*RESULT, text, "_fp")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t, shingle) for t in stream(batch.column(text))], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns_of(fields, batch), found], names=[*(f.name for f in fields), "_fp"])

    return documents.mapInArrow(run, f"{ddl(fields)}, _fp bigint" if fields else "_fp bigint")


class Tree:
    """A vantage-point tree over one band; nodes in heap order, the leaves are numbered from the left."""

    def __init__(self, sample: np.ndarray, band: tuple[int, int], depth: int, radius: int, seed: int):
        self.shift, self.mask = np.uint64(band[0]), np.uint64((1 << band[1]) - 1)
        self.depth, self.radius = depth, radius
        self.points = np.zeros(1 << depth, np.uint64)
        self.cuts = np.zeros(1 << depth, np.int64)
        self._grow(1, self.band(sample), np.random.default_rng(seed))

    def band(self, fps: np.ndarray) -> np.ndarray:
        return (fps >> self.shift) & self.mask

    def _grow(self, node: int, values: np.ndarray, rng) -> None:
        if node >= len(self.points):
            return
        point = rng.choice(values) if len(values) else rng.integers(0, int(self.mask), dtype=np.uint64, endpoint=True)
        far = np.bitwise_count(values ^ point).astype(np.int64)
        # the median, or the next lower distance if that splits more evenly
        cut_at = int(np.median(far)) if len(far) else int(self.mask).bit_count() // 2
        if cut_at and abs((far <= cut_at - 1).sum() * 2 - len(far)) < abs((far <= cut_at).sum() * 2 - len(far)):
            cut_at -= 1
        self.points[node], self.cuts[node] = point, cut_at
        self._grow(2 * node, values[far <= cut_at], rng)
        self._grow(2 * node + 1, values[far > cut_at], rng)

    def route(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows (index of fingerprint, leaf, whether it owns the leaf).

        Of a pair that a node parts, the outer one visits the inside, so an owner need not visit the outside.
        """
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        values = self.band(fps)
        todo = [(1, np.arange(len(fps)), np.ones(len(fps), bool))]
        while todo:
            node, at, owns = todo.pop()
            if not len(at):
                continue
            if node >= len(self.points):
                out.append((at, np.full(len(at), node - len(self.points)), owns))
                continue
            far = np.bitwise_count(values[at] ^ self.points[node]).astype(np.int64) - self.cuts[node]
            inside, near = far <= 0, (far > 0) & (far <= self.radius)
            todo.append((2 * node, np.concatenate([at[inside], at[near]]), np.concatenate([owns[inside], np.zeros(near.sum(), bool)])))
            over = (far <= 0) & (far > -self.radius) & ~owns
            todo.append((2 * node + 1, np.concatenate([at[~inside], at[over]]), np.concatenate([owns[~inside], owns[over]])))
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        at, leaf, owns = (np.concatenate(x) for x in zip(*out, strict=True))
        return at, leaf, owns


def forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what pairs of left with left, and left with right, within the radius connect."""
    both = np.concatenate([left, right])
    far = np.bitwise_count(both ^ both[0]).astype(np.int64)
    owners = np.argsort(far[: len(left)], kind="stable")
    distance, owned = far[owners], left[owners]
    label = np.arange(len(both))
    order = np.argsort(far, kind="stable")
    for k in range(0, len(order), 256):
        rows = order[k : k + 256]
        a = np.searchsorted(distance, far[rows[0]] - radius)
        b = np.searchsorted(distance, far[rows[-1]] + radius, side="right")
        if a == b:
            continue
        near = np.bitwise_count(both[rows][:, None] ^ owned[None, a:b]) <= radius
        r, c = np.nonzero(near)
        r, c = rows[r], owners[a:b][c]
        new = label[r] != label[c]
        for i in np.unique(r[new]):
            own = label[i]
            others = np.unique(label[c[r == i]])
            others = others[others != own]
            if len(others):
                label[np.isin(label, np.append(others, own))] = min(own, others[0])
    linked = np.flatnonzero(label != np.arange(len(both)))
    return both[linked].view(np.int64), both[label[linked]].view(np.int64)


def _leaf_rows(distinct: DataFrame, trees: list[Tree]) -> DataFrame:
    shared = distinct.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for number, tree in enumerate(shared.value):
                at, leaf, owns = tree.route(fps)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((leaf << 2) + number), pa.array(fps[at].view(np.int64)), pa.array(owns)], names=["leaf", "fp", "owns"]
                )

    return distinct.mapInArrow(run, "leaf bigint, fp bigint, owns boolean")


def links(distinct: DataFrame, *, radius: int = RADIUS, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints, enough to connect all that links connect. distinct: one bigint column."""
    n = distinct.count()
    share = min(1.0, 1.2 * sample / max(n, 1))
    rows = distinct.sample(share, seed=7).limit(sample).toArrow()
    taken = np.sort(rows.column(0).to_numpy()).view(np.uint64)
    depth = min(DEEPEST, max(0, int(np.ceil(np.log2(max(n, 1) / leaf)))))
    trees = [Tree(taken, band, depth, radius // len(BANDS), seed) for seed, band in enumerate(BANDS)]
    owned = _leaf_rows(distinct, trees)
    # one row for each leaf: at most 3 * 2^DEEPEST
    sizes = owned.where("owns").groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CHUNK).toArrow()
    chunks = distinct.sparkSession.createDataFrame(
        [(k, -(-n // CHUNK)) for k, n in zip(sizes.column("leaf").to_pylist(), sizes.column("n").to_pylist(), strict=True)],
        "leaf bigint, many int",
    )
    many = F.coalesce("many", F.lit(1))
    # an owner goes to a chunk of its own, and visits the later ones; a visitor meets all
    mine = F.when(F.col("owns"), F.pmod(F.xxhash64("fp"), many).cast("int")).otherwise(0)
    dealt = owned.join(F.broadcast(chunks), "leaf", "left").select(
        "leaf", "fp", "owns", F.posexplode(F.sequence(mine, many - 1)).alias("nth", "chunk")
    ).select("leaf", "chunk", "fp", (F.col("owns") & (F.col("nth") == 0)).alias("owns"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        fps, owns = pdf["fp"].to_numpy().view(np.uint64), pdf["owns"].to_numpy()
        if not owns.any():
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        a, b = forest(fps[owns], fps[~owns], radius)
        return pd.DataFrame({"a": a, "b": b})

    return dealt.groupBy("leaf", "chunk").applyInPandas(compare, _LINKS).where("a <> b").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """node and root, the least node reachable, for all nodes of the pairs; large-star and small-star rounds.

    Both operations replace links by links to a smaller node and keep what is connected, until all are stars.
    """
    def ordered(frame: DataFrame) -> DataFrame:
        return frame.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    def star(frame: DataFrame, large: bool) -> DataFrame:
        """Each node's neighbours, the larger (or the smaller) ones with itself, are linked to the least of them."""
        turned = frame.select(F.col("b").alias("a"), F.col("a").alias("b"))
        around = frame.unionByName(turned) if large else frame
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
        side = around.where("b > a") if large else around
        moved = side.join(least, "a").select(F.col("b").alias("x"), F.col("a").alias("own"), "root")
        linked = moved.select(F.col("x").alias("a"), F.col("root").alias("b"))
        if not large:
            linked = linked.unionByName(moved.select(F.col("own").alias("a"), F.col("root").alias("b")))
        return ordered(linked)

    now = cut(ordered(pairs))
    print_of = lambda f: tuple(f.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    before = print_of(now)
    while before[0]:
        now = cut(star(star(now, True), False))
        after = print_of(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def groups(documents: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents without their text, with fingerprint (hex) and component_id, the least id of the group."""
    found = _rooted(documents, text=text, doc_id=doc_id, shingle=shingle, radius=radius)
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("_fp"), 16, "0"))).select(
        *[f"`{c}`" for c in found.columns if c not in ("_fp", "_root", "component_id")], "fingerprint", "component_id"
    )


def _rooted(documents: DataFrame, *, text: str, doc_id: str, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents without their text, with _fp, _root (the least fingerprint of the group) and component_id."""
    marked = cut(fingerprints(documents, text=text, shingle=shingle))
    distinct = cut(marked.groupBy("_fp").agg(F.min(doc_id).alias("least")))
    linked = components(links(distinct.select("_fp"), radius=radius))
    rooted = distinct.join(linked, F.col("_fp") == F.col("node"), "left").select("_fp", "least", F.coalesce("root", "_fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    lookup = rooted.join(named, "root").select("_fp", F.col("root").alias("_root"), "component_id")
    return marked.join(lookup, "_fp")


def keep_one(documents: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of each group, with all its columns: that with the least id, of equal ids with the least hash of the row.

    An id that is null or repeated in several groups stays once in each; a null id only where the group has no other.
    """
    # two hashes over the whole row name it; equal rows are of one group and count as one
    whole = [F.to_json(F.struct(c)) if kind.startswith("map") else F.col(f"`{c}`") for c, kind in documents.dtypes]
    isnull = [F.col(f"`{c}`").isNull() for c in documents.columns]
    keyed = documents.withColumns({f"_h{k}": F.xxhash64(F.lit(k), *whole, *isnull) for k in (1, 2)})
    found = _rooted(keyed.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), "_h1", "_h2"), text="_text", doc_id="_id")
    first = found.groupBy("_root").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_h1", "_h2")).alias("first")).select("first._h1", "first._h2")
    return keyed.join(first, ["_h1", "_h2"], "left_semi").dropDuplicates(["_h1", "_h2"]).select(*[f"`{c}`" for c in documents.columns])
