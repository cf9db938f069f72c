"""Preorder intervals: "below v" as a range of numbers.

Nodes are numbered in preorder, children in order of their ids. A node and all below it then have the numbers ``first`` to
``last``, so descendants are counted by subtracting two running counts, membership is a comparison, and the lowest common
ancestor of any set of nodes is the last interval that holds the set's least and greatest number. No pair of a node and an
ancestor is ever built.

The numbers come from two passes over the inner nodes: how many nodes lie below each, and, with the sizes of the earlier
siblings, how many come before it on its path. Going up, nodes whose children are all done are done themselves and stay in the
table of their round, so on bushy trees each round has a fraction of the last one's rows; going down, these tables are taken in
reverse. What is left where that no longer pays, such as long chains, is done in about log2(D) rounds along doubling pointers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeflow.operators.running import PIECE, running
from cladeflow.operators.tree import _is_root, _raise_open, _rounds, jump_until_done
from cladeflow.session import cut, cut_counting

# Nodes are done round by round from the tips as long as so many are left, and a round leaves at most this share of them.
FEW, SHRINKS = 100_000, 0.75


def _rooted(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``node, up`` and the values; ``up`` is the parent, null at roots and where the parent's row is missing."""
    known = nodes.select(F.col("node").alias("_known")).distinct()
    up = F.when(~_is_root(), F.col("parent"))
    rows = nodes.select("node", up.alias("up"), *values)
    return rows.join(known, rows["up"] == known["_known"], "left").select("node", F.col("_known").alias("up"), *values)


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Sums of the value columns (null counts as 0) over all proper descendants of each inner node, with its root and depth:
    ``node, top, depth`` and the sums. Nodes without children have no row.

    Values are summed per parent first, so tips take no part in the rounds. After k rounds a node holds the sums of all
    nodes up to 2^k edges below it.
    """
    rooted = _rooted(nodes, values)
    return _sums(rooted, values)


def _sums(rooted: DataFrame, values: list[str]) -> DataFrame:
    direct = rooted.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("node")).agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in values])
    at_root = F.col("up").isNull()
    state = rooted.select("node", "up").join(direct, "node").select(
        "node", F.col("up").alias("jump"), F.coalesce("up", "node").alias("top"), F.when(at_root, 0).otherwise(1).cast("bigint").alias("depth"), *values
    )
    state, count = cut_counting(state, open=F.col("jump").isNotNull())
    total, limit = count["rows"], _rounds(count["rows"] + 1)
    while count["open"]:
        if not limit:
            _raise_open("parents form a cycle", state.where(F.col("jump").isNotNull()))
        going = state.where(F.col("jump").isNotNull())
        sent = going.groupBy(F.col("jump").alias("_to")).agg(*[F.sum(v).alias(f"_{v}") for v in values])
        onward = state.select(F.col("node").alias("_via"), F.col("jump").alias("_next"), F.col("top").alias("_top"), F.col("depth").alias("_depth"))
        moved = (
            state.join(onward, state["jump"] == onward["_via"], "left")
            .join(sent, F.col("node") == sent["_to"], "left")
            .select(
                "node",
                F.col("_next").alias("jump"),
                F.coalesce("_top", "top").alias("top"),
                (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
                *[(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values],
            )
        )
        state, count = cut_counting(moved, open=F.col("jump").isNotNull())
        if count["rows"] != total:
            _raise_open("nodes are listed more than once", state)
        limit -= 1
    return state


def _before_siblings(rows: DataFrame) -> DataFrame:
    """The rows ``node, up, size, …`` with ``first``: 1 and the sizes of the earlier siblings, 0 at roots.

    One sort of all children by parent and id cuts even a node with very many children into blocks; running sums are taken
    within a block, and over the few blocks of a parent.
    """
    ordered = cut(rows.orderBy("up", "node").withColumn("_at", F.monotonically_increasing_id())).withColumn("_block", F.shiftright("_at", 33))
    sums = ordered.groupBy("up", "_block").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("up").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sums.select("up", "_block", F.sum("_sum").over(earlier).alias("_earlier")).where(F.col("_earlier").isNotNull())
    within = Window.partitionBy("up", "_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce("_own", F.lit(0)) + F.coalesce("_earlier", F.lit(0)) + 1
    return (
        ordered.withColumn("_own", F.sum("size").over(within))
        .join(blocks, ["up", "_block"], "left")
        .select(*rows.columns, F.when(F.col("up").isNull(), 0).otherwise(before).cast("bigint").alias("first"))
    )


def _layers(nodes: DataFrame, few: int) -> tuple[DataFrame, list[DataFrame], DataFrame, int]:
    """Sizes of subtrees, tips first: all nodes without children, the inner nodes done in each round, and those left, as
    ``node, up, size``, and the number of nodes. ``up`` is null at roots and where the parent's row is missing."""
    pointers = nodes.select("node", F.when(~_is_root(), F.col("parent")).alias("up"))
    children = pointers.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("_node")).agg(F.count(F.lit(1)).alias("waiting"))
    missing = F.col("node").isNull() & F.col("_node").isNotNull()
    state = pointers.join(children, pointers["node"] == children["_node"], "full").select(F.coalesce("node", "_node").alias("node"), "up", "waiting", missing.alias("missing"))
    state, count = cut_counting(state, missing=F.col("missing"), tips=F.col("waiting").isNull())
    if count["missing"]:
        gone = state.where("missing").select(F.col("node").alias("_gone"))
        there = state.where("not missing")
        up = F.when(F.col("_gone").isNull(), F.col("up")).alias("up")
        state = cut(there.join(gone, there["up"] == gone["_gone"], "left").select("node", up, "waiting"))
    total = count["rows"] - count["missing"]
    state = state.select("node", "up", "waiting", F.lit(1).cast("bigint").alias("size"))
    tips, left = state.where("waiting is null").drop("waiting"), state.where("waiting is not null")
    rows, now, done, layers = total - count["tips"], total, tips, []
    while rows > few and rows <= SHRINKS * now:
        sent = done.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("_to")).agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_size"))
        step, count = cut_counting(
            left.join(sent, left["node"] == sent["_to"], "left").select(
                "node", "up", (F.col("waiting") - F.coalesce("_n", F.lit(0))).alias("waiting"), (F.col("size") + F.coalesce("_size", F.lit(0))).alias("size")
            ),
            done=F.col("waiting") == 0,
        )
        done, left = step.where("waiting = 0").drop("waiting"), step.where("waiting > 0")
        layers.append(done)
        now, rows = rows, rows - count["done"]
    return tips, layers, _left(left.select("node", "up", "size"), done), total


def _left(left: DataFrame, done: DataFrame) -> DataFrame:
    """Whole sizes of the nodes left, given those done last, which no node left has counted yet."""
    sent = done.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("_to")).agg(F.sum("size").alias("_size"))
    own = cut(left.join(sent, left["node"] == sent["_to"], "left").select("node", "up", (F.col("size") + F.coalesce("_size", F.lit(0))).alias("size")))
    below = _sums(own, ["size"]).select(F.col("node").alias("_node"), F.col("size").alias("_below"))
    return own.join(below, own["node"] == below["_node"], "left").select("node", "up", (F.col("size") + F.coalesce("_below", F.lit(0))).alias("size"))


def intervals(nodes: DataFrame, few: int = FEW) -> DataFrame:
    """``node, up, root, depth, first, last`` for every node: first is its number in preorder within its tree, from 0, last the
    greatest number below it (its own if there is none), up its parent. A node whose parent has no row is a root; up is null
    there. Up to ``few`` nodes go along doubling pointers at once."""
    tips, layers, left, total = _layers(nodes, few)
    # the rows of a round are told apart by its number
    sized = left.withColumn("layer", F.lit(len(layers) + 1))
    for k, rows in enumerate([tips, *layers]):
        sized = sized.unionByName(rows.withColumn("layer", F.lit(k)))
    placed = cut(_before_siblings(sized))
    done = F.col("up").isNull()
    state = placed.where(F.col("layer") > len(layers)).select(
        "node", F.col("up").alias("jump"), done.alias("done"), "first",
        F.when(done, 0).otherwise(1).cast("bigint").alias("depth"), F.when(done, F.col("node")).alias("root"),
    )
    along = jump_until_done(
        state,
        {
            "first": lambda near, far: near("first") + far("first"),
            "depth": lambda near, far: near("depth") + far("depth"),
            "root": lambda near, far: far("root"),
        },
    ).select("node", "root", "depth", "first")
    for k in range(len(layers), 0, -1):
        own = placed.where(F.col("layer") == k)
        along = along.unionByName(cut(_below(own, along).select("node", "root", "depth", "first")))
    inner = along.join(placed.where("layer > 0").select("node", "up", "size"), "node")
    every = inner.unionByName(_below(placed.where("layer = 0"), along))
    written, count = cut_counting(every.select("node", "up", "root", "depth", "first", (F.col("first") + F.col("size") - 1).alias("last")))
    if count["rows"] != total:
        _raise_open("nodes are listed more than once", written)
    return written


def _below(rows: DataFrame, above: DataFrame) -> DataFrame:
    """``node, root, depth, first, up, size`` of rows whose parents, if they have any, are among those above."""
    above = above.select(F.col("node").alias("_up"), F.col("root").alias("_root"), F.col("depth").alias("_depth"), F.col("first").alias("_first"))
    return rows.join(above, rows["up"] == above["_up"], "left").select(
        "node",
        F.coalesce("_root", "node").alias("root"),
        F.coalesce(F.col("_depth") + 1, F.lit(0)).cast("bigint").alias("depth"),
        (F.col("first") + F.coalesce("_first", F.lit(0))).alias("first"),
        "up",
        "size",
    )


def range_sums(labels: DataFrame, weights: DataFrame, wanted: DataFrame, values: list[str], piece: int = PIECE) -> DataFrame:
    """Sums of the value columns of ``weights(node, …)`` over each wanted node and all below it: ``node`` and the sums.

    Running sums in preorder, read off at the two ends of each wanted interval. Windows see a bounded number of positions;
    nodes whose intervals end together ask once.
    """
    there = weights.select("node", *values).join(labels.select("node", "root", "first"), "node")
    # positions: what lies before number n is known at 2n, what number n adds stands at 2n + 1
    marks = there.groupBy("root", (2 * F.col("first") + 1).alias("at")).agg(*[F.sum(v).alias(v) for v in values])
    asked = labels.join(wanted.select("node").distinct(), "node", "left_semi").select(
        "node", "root", (2 * F.col("first")).alias("low"), (2 * F.col("last") + 2).alias("high")
    )
    asked = cut(asked)
    zero = [F.lit(0).cast(marks.schema[v].dataType).alias(v) for v in values]
    asks = asked.select("root", F.explode(F.array("low", "high")).alias("at")).distinct().select("root", "at", *zero)
    summed = running(cut(marks.unionByName(asks)), ["root"], "at", sums=values, piece=piece).where("at % 2 = 0")
    summed = cut(summed)
    low = summed.select("root", F.col("at").alias("low"), *[F.col(v).alias(f"_low_{v}") for v in values])
    high = summed.select("root", F.col("at").alias("high"), *[F.col(v).alias(f"_high_{v}") for v in values])
    return asked.join(low, ["root", "low"]).join(high, ["root", "high"]).select("node", *[(F.col(f"_high_{v}") - F.col(f"_low_{v}")).alias(v) for v in values])


def is_below(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """``pairs(node, ancestor, …)`` with ``below``: whether the node lies below the ancestor (a node is not below itself).
    Null if one of them is no node."""
    own = labels.select("node", F.col("root").alias("_root"), F.col("first").alias("_at"))
    above = labels.select(F.col("node").alias("ancestor"), F.col("root").alias("_top"), F.col("first").alias("_first"), F.col("last").alias("_last"))
    holds = (F.col("_root") == F.col("_top")) & (F.col("_at") > F.col("_first")) & (F.col("_at") <= F.col("_last"))
    return pairs.join(own, "node", "left").join(above, "ancestor", "left").select(*[pairs[c] for c in pairs.columns if c not in ("node", "ancestor")], "node", "ancestor", holds.alias("below"))


def common_ancestors(labels: DataFrame, marked: DataFrame) -> DataFrame:
    """The lowest node at or above all marked nodes of each tree that has any: ``root, node``. ``marked`` has ``node``; a
    single marked node is its own common ancestor."""
    there = labels.join(marked.select("node").distinct(), "node", "left_semi")
    ends = there.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("_least"), F.max("first").alias("_most"))
    holding = labels.join(ends, labels["root"] == ends["_root"]).where((F.col("first") <= F.col("_least")) & (F.col("last") >= F.col("_most")))
    return holding.groupBy("root").agg(F.max_by("node", "first").alias("node"))


def group_ancestors(labels: DataFrame, members: DataFrame) -> DataFrame:
    """The same for any number of groups: ``root, group, node`` for ``members(node, group)``.

    From each group's first member the path is climbed in halving steps, while the interval reached ends before the group's
    last member: a join a step, of one row a group with one row a node. Only inner nodes lie above others, so all further
    steps start at these.
    """
    there = members.select("node", "group").join(labels.select("node", "root", "first"), "node")
    ends = there.groupBy("root", "group").agg(F.min_by("node", "first").alias("at"), F.max("first").alias("most"))
    least = labels.select(F.col("node").alias("at"), F.col("last").alias("_last"))
    climbing = cut(ends.join(least, "at").withColumn("inside", F.col("_last") < F.col("most")).drop("_last"))
    # inside: the group goes beyond ``at``; groups of one node, or with a member above all others, have arrived
    parent = labels.select(F.col("node").alias("at"), "up")
    reach = cut(labels.where(F.col("last") > F.col("first")).select("node", "up", "last"))
    ends = reach.select(F.col("node").alias("_up"), F.col("last").alias("_last"))

    def climbed(step: DataFrame) -> DataFrame:
        # Groups that go up are found by inner joins, in which few groups need no shuffle of the nodes.
        above = step.select(F.col("node").alias("at"), F.col("up").alias("_up"))
        going = climbing.where("inside").join(above, "at").join(ends, "_up").where(F.col("_last") < F.col("most"))
        going = going.select(F.col("root").alias("_root"), F.col("group").alias("_group"), "_up")
        same = (F.col("root") == F.col("_root")) & F.col("group").eqNullSafe(F.col("_group"))
        return climbing.join(going, same, "left").select("root", "group", F.coalesce("_up", "at").alias("at"), "most", "inside")

    # The first members may be leaves: their parents are inner nodes, or above the common ancestor.
    climbing = cut(climbed(labels.select("node", "up")))
    steps = [reach.where(F.col("up").isNotNull()).select("node", "up")]
    while True:
        onward = steps[-1].select(F.col("node").alias("_via"), F.col("up").alias("_next"))
        longer, count = cut_counting(steps[-1].join(onward, F.col("up") == F.col("_via")).select("node", F.col("_next").alias("up")))
        if not count["rows"]:
            break
        steps.append(longer)
    for step in reversed(steps):
        climbing = cut(climbed(step))
    return climbing.join(parent, "at").select("root", "group", F.when(F.col("inside"), F.col("up")).otherwise(F.col("at")).alias("node"))
