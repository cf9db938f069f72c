"""Preorder intervals, counts, membership, common ancestors and painting, against listed paths."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cladeflow.operators.intervals import common_ancestors, group_ancestors, intervals, is_below, range_sums, subtree_sums
from cladeflow.operators.tree import TreeError, paint_groups

DDL = "node bigint, parent bigint, genome string, magset string"


def forest(seed, count=120):
    """Parents by node: some roots, one chain, one node with many children, one missing parent."""
    draw = random.Random(seed)
    parents = {1: 1, 500: 500, 700: 999}
    for node in range(2, count):
        kind = draw.random()
        parents[node] = node - 1 if kind < 0.4 else 3 if kind < 0.6 and node > 3 else draw.randrange(1, node)
    parents |= {501: 500, 502: 501, 503: 502, 701: 700, 702: 700, 800: 800}
    return parents


def path(parents, node):
    """The node and all above it that have a row."""
    steps = [node]
    while parents[steps[-1]] != steps[-1] and parents[steps[-1]] in parents:
        steps.append(parents[steps[-1]])
    return steps


def tree(spark, parents, genomes=None):
    genomes = genomes or {}
    return spark.createDataFrame([(n, p, f"g{n}" if n in genomes else None, genomes.get(n)) for n, p in parents.items()], DDL)


def numbered(parents):
    """node: root, depth, first, last"""
    order = sorted(parents, key=lambda n: path(parents, n)[::-1])
    roots = {n: path(parents, n)[-1] for n in parents}
    seen, first = Counter(), {}
    for n in order:
        first[n] = seen[roots[n]]
        seen[roots[n]] += 1
    below = Counter(a for n in parents for a in path(parents, n)[1:])
    return {n: (roots[n], len(path(parents, n)) - 1, first[n], first[n] + below[n]) for n in parents}


@pytest.mark.parametrize("seed", [1, 2])
def test_intervals(spark, seed):
    parents = forest(seed)
    labels = intervals(tree(spark, parents))
    assert {r.node: (r.root, r.depth, r.first, r.last) for r in labels.collect()} == numbered(parents)
    assert {r.node: r.up for r in labels.collect()} == {n: p if p != n and p in parents else None for n, p in parents.items()}

    draw = random.Random(seed)
    weights = {n: draw.randrange(5) for n in draw.sample(sorted(parents), 70)}
    wanted = draw.sample(sorted(parents), 50)
    summed = range_sums(labels, spark.createDataFrame(list(weights.items()), "node bigint, w bigint"), spark.createDataFrame([(n,) for n in wanted + wanted], "node bigint"), ["w"], piece=16)
    assert sorted(map(tuple, summed.collect())) == sorted((n, sum(w for m, w in weights.items() if n in path(parents, m))) for n in wanted)

    pairs = [(draw.choice(sorted(parents)), draw.choice(sorted(parents))) for _ in range(200)] + [(5, 5), (5, 12345)]
    told = is_below(spark.createDataFrame(pairs, "node bigint, ancestor bigint"), labels).collect()
    assert Counter(map(tuple, told)) == Counter((n, a, a in path(parents, n)[1:] if a in parents else None) for n, a in pairs)


@pytest.mark.parametrize("seed", [3, 4])
def test_common_ancestors(spark, seed):
    parents, draw = forest(seed), random.Random(seed)
    labels = intervals(tree(spark, parents))

    def lowest(nodes):
        """By root."""
        found = {}
        for root in {path(parents, n)[-1] for n in nodes}:
            own = [path(parents, n) for n in nodes if path(parents, n)[-1] == root]
            found[root] = max(set.intersection(*map(set, own)), key=lambda n: len(path(parents, n)))
        return found

    marked = draw.sample(sorted(parents), 6)
    found = common_ancestors(labels, spark.createDataFrame([(n,) for n in marked], "node bigint"))
    assert dict(map(tuple, found.collect())) == lowest(marked)
    groups = {f"g{k}": draw.sample(sorted(parents), draw.randint(1, 4)) for k in range(30)}
    members = spark.createDataFrame([(n, g) for g, own in groups.items() for n in own], "node bigint, group string")
    found = {(r.root, r.group): r.node for r in group_ancestors(labels, members).collect()}
    assert found == {(root, g): n for g, own in groups.items() for root, n in lowest(own).items()}


def test_subtree_sums(spark):
    parents = forest(5)
    nodes = tree(spark, parents).withColumn("one", F.lit(1).cast("bigint")).withColumn("odd", (F.col("node") % 2).cast("bigint"))
    found = {r.node: (r.top, r.depth, r.one, r.odd) for r in subtree_sums(nodes, ["one", "odd"]).collect()}
    below = {a: [n for n in parents if a in path(parents, n)[1:]] for a in parents}
    assert found == {
        a: (path(parents, a)[-1], len(path(parents, a)) - 1, len(own), sum(n % 2 for n in own)) for a, own in below.items() if own
    }


@pytest.mark.parametrize("seed, references", [(6, 8), (7, 1), (8, 0), (9, 30)])
def test_painting_to_the_common_ancestor(spark, seed, references):
    """Both ends of all edges between a group's tips and their common ancestor; a single tip's edge to its parent."""
    parents, draw = forest(seed), random.Random(seed)
    tips = sorted(set(parents) - {p for n, p in parents.items() if n != p})
    known = set(draw.sample(tips, min(references, len(tips) - 1)))
    genomes = {n: "GTDB" if n in known else "other" for n in tips}
    expected = dict.fromkeys(parents, "0")
    for group, own in (("nongtdb", set(tips) - known), ("gtdb", known)):
        for root in {path(parents, n)[-1] for n in own}:
            there = [path(parents, n) for n in own if path(parents, n)[-1] == root]
            common = set.intersection(*map(set, there))
            top = max(common - ({there[0][0]} if len(there) == 1 else set()), key=lambda n: len(path(parents, n)), default=None)
            for steps in there:
                expected.update(dict.fromkeys(steps[: steps.index(top) + 1] if top is not None else steps[:1], group))
    painted = paint_groups(tree(spark, parents, genomes), reach="common")
    assert {r.node: r.nongtdb_group for r in painted.collect()} == expected


def test_cycles_and_repeated_nodes_raise(spark):
    with pytest.raises(TreeError, match="cycle"):
        intervals(tree(spark, {1: 1, 2: 1, 5: 6, 6: 5, 7: 5}))
    with pytest.raises(TreeError, match="more than once"):
        twice = tree(spark, {1: 1, 2: 1, 3: 2, 4: 3, 5: 4, 6: 5})
        subtree_sums(twice.unionByName(twice.where("node = 2")).withColumn("one", F.lit(1).cast("bigint")), ["one"])


def test_a_long_chain(spark):
    chain = spark.range(1, 20_001).select(F.col("id").alias("node"), F.greatest(F.col("id") - 1, F.lit(1)).alias("parent"))
    wrong = intervals(chain).where("first <> node - 1 or last <> 19999 or depth <> node - 1 or root <> 1")
    assert wrong.count() == 0


def test_intervals_by_rounds_from_the_tips_and_along_pointers_agree(spark):
    """Bushy trees, a chain, several roots, a missing parent and a hub: the same numbers, however many rounds are taken."""
    rng = random.Random(5)
    parents = {1: 1} | {n: rng.randint(1, n - 1) for n in range(2, 200)} | {n: n - 1 for n in range(200, 230)}
    parents |= {300: 300} | {n: 300 for n in range(301, 340)} | {400: 999, 401: 400, 402: 400, 403: 402}
    nodes = tree(spark, parents)
    plain = sorted(map(tuple, intervals(nodes).collect()))
    assert len(plain) == len(parents)
    for few in (0, 5, 60):
        assert sorted(map(tuple, intervals(nodes, few=few).collect())) == plain
    by_node = {r[0]: r for r in plain}
    assert by_node[400][1:4] == (None, 400, 0) and by_node[403][1:4] == (402, 400, 2) and by_node[300][4:] == (0, 39)
    with pytest.raises(TreeError):
        intervals(nodes.unionByName(nodes.where("node = 402")), few=0)


def test_intervals_rounds_shrink(spark, monkeypatch):
    """Rounds write a fraction of the last one's rows, instead of all inner nodes again and again."""
    from cladeflow.operators import intervals as module

    rows, counting = [], module.cut_counting

    def counted(frame, **counts):
        written, count = counting(frame, **counts)
        rows.append(count["rows"])
        return written, count

    monkeypatch.setattr(module, "cut_counting", counted)
    n = 1 << 12
    intervals(tree(spark, {k: max(k // 2, 1) for k in range(1, n)}), few=10)
    assert sum(rows[1:-1]) < n + 100, rows
