"""Tree traversals as joins.

A tree is a node table with ``node`` and ``parent``; a root is its own parent. Paths are followed by
pointer jumping: each round looks three pointers up in the table of the last one, so the distance covered
grows four times, and a tree of depth D takes about log4(D) rounds. The joined side always has one row per key, so a hot key (a node with
very many children) only makes the other side large, which adaptive execution splits; values sent
upwards are combined per target before and after the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeflow.session import cut, cut_counting

Merge = dict[str, Callable[[Callable[[str], Column], Callable[[str], Column]], Column]]


# Lookups in one table a round: the distance covered grows by one more than this, and the rounds, each a job that writes its
# open rows, become fewer.
HOPS = 3


class TreeError(ValueError):
    """The parents do not form a tree."""


def _rounds(rows: int) -> int:
    """Rounds after which every path of a tree of so many nodes has been followed."""
    return max(1, (max(rows, 1) - 1).bit_length()) + 1


def _raise_open(problem: str, rows: DataFrame) -> None:
    nodes = [str(row[0]) for row in rows.select("node").take(5)]
    raise TreeError(f"{problem}, among them below node {', '.join(nodes)}")


def jump_until_done(state: DataFrame, merge: Merge | None = None, cycles: str = "raise") -> DataFrame:
    """Follow ``jump`` pointers until every row is ``done``.

    ``state`` has ``node``, ``jump``, ``done`` and payload columns describing the path from ``node``
    (included) to ``jump`` (excluded). ``merge[name](near, far)`` joins two adjoining stretches. A
    pointer to a row that does not exist ends the path there. Repeated nodes raise TreeError, and so do cycles;
    with ``cycles="keep"`` their rows come back undone, after more steps than there are nodes.
    """
    merge = merge or {}
    step, count = cut_counting(state.select("node", "jump", "done", *merge), open=~F.col("done"))
    arrived, limit = step.where("done"), _rounds(count["rows"])
    while count["open"]:
        open_rows = step.where("not done")
        if not limit:
            if cycles == "keep":
                return arrived.unionByName(open_rows)
            _raise_open("parents form a cycle", open_rows)
        # Rows that have arrived stay in the table of their round; only the others are written again.
        known, moved = arrived.unionByName(open_rows), open_rows
        for _ in range(HOPS):
            moved = _hop(moved, known, merge)
        expected = count["open"]
        step, count = cut_counting(moved, open=~F.col("done"))
        if count["rows"] != expected:
            _raise_open("nodes are listed more than once", step)
        arrived, limit = arrived.unionByName(step.where("done")), limit - 1
    return arrived


def _hop(rows: DataFrame, known: DataFrame, merge: Merge) -> DataFrame:
    """Rows that are not done go on to where the row they point to leads; they are done where there is no such row."""
    near, far = _named("near"), _named("far")
    stays = far("node").isNull()
    # Rows that are done point to few nodes, or to none: they are dealt by their own node, which keeps them apart.
    to = F.when(near("done"), near("node")).otherwise(near("jump"))
    return rows.alias("near").join(known.alias("far"), (to == far("node")) & ~near("done"), "left").select(
        near("node"),
        F.when(stays, near("jump")).otherwise(far("jump")).alias("jump"),
        F.coalesce(far("done"), F.lit(True)).alias("done"),
        *[F.when(stays, near(name)).otherwise(join(near, far)).alias(name) for name, join in merge.items()],
    )


def _named(side: str) -> Callable[[str], Column]:
    return lambda column: F.col(f"{side}.{column}")


def with_parent(nodes: DataFrame, columns: list[str], prefix: str = "parent_") -> DataFrame:
    """Add columns of the parent row (null if there is none; a root is its own parent)."""
    parents = nodes.select(
        F.col("node").alias("_parent"), *[F.col(name).alias(prefix + name) for name in columns]
    )
    return nodes.join(parents, nodes["parent"] == parents["_parent"], "left").drop("_parent")


def child_counts(nodes: DataFrame) -> DataFrame:
    """Number of internal children per node that has any: ``node, n_int``."""
    return (
        nodes.where(F.col("genome").isNull() & (F.col("node") != F.col("parent")))
        .groupBy(F.col("parent").alias("node"))
        .agg(F.count(F.lit(1)).alias("n_int"))
    )


def _is_root() -> Column:
    return F.col("parent").isNull() | (F.col("parent") == F.col("node"))


def depths(nodes: DataFrame) -> DataFrame:
    """Edges between each node and its root: ``node, depth``. Only nodes with children are followed, all others lie one edge
    below one of these."""
    pointers = nodes.select("node", F.when(~_is_root(), F.col("parent")).alias("jump"))
    parents = pointers.where(F.col("jump").isNotNull()).select(F.col("jump").alias("_inner")).distinct()
    inner = pointers.join(parents, pointers["node"] == parents["_inner"], "left_semi")
    at_root = F.col("jump").isNull()
    state = inner.select("node", "jump", at_root.alias("done"), F.when(at_root, 0).otherwise(1).cast("bigint").alias("depth"))
    along = jump_until_done(state, {"depth": lambda near, far: near("depth") + far("depth")})
    above = along.select(F.col("node").alias("_above"), F.col("depth").alias("_depth"))
    # A root has nothing above it and is dealt by its node.
    found = pointers.join(above, F.coalesce("jump", "node") == F.col("_above"), "left").select(
        "node", F.when(at_root, 0).otherwise(F.coalesce("_depth", F.lit(0)) + 1).cast("bigint").alias("depth")
    )
    written, count = cut_counting(found)
    if count["rows"] != nodes.count():
        _raise_open("nodes are listed more than once", written)
    return written


def nearest_marked(nodes: DataFrame, marked: str = "marked") -> DataFrame:
    """Nearest node at or above each node for which the column ``marked`` holds:
    ``node, reached`` (null if there is none up to the root)."""
    stop = F.coalesce(F.col(marked), F.lit(False))
    state = nodes.select(
        "node",
        F.when(stop, F.col("node")).when(~_is_root(), F.col("parent")).alias("jump"),
        (stop | _is_root()).alias("done"),
    )
    return jump_until_done(state).select("node", F.col("jump").alias("reached"))


def path_ends(nodes: DataFrame) -> DataFrame:
    """Where the path of each node ends: ``node, kind, cycle``. Kind is ``root``, ``missing`` (a parent without row),
    ``cycle`` (the node lies on one) or ``below_cycle``; cycle is the least node of the cycle."""
    state = nodes.select(
        "node", F.when(~_is_root(), F.col("parent")).alias("jump"), _is_root().alias("done"),
        F.when(_is_root(), "root").alias("kind"), F.col("node").alias("least"),
    )
    reached = jump_until_done(
        state, {"kind": lambda near, far: far("kind"), "least": lambda near, far: F.least(near("least"), far("least"))}, cycles="keep"
    )
    # As many steps as there are nodes end on the cycle, wherever they began, and reach all of it from there.
    turning = reached.where("not done").select(F.col("jump").alias("_on")).distinct()
    on_cycle = reached.join(turning, reached["node"] == turning["_on"]).select(F.col("node").alias("_on"), F.col("least").alias("_cycle"))
    named = reached.join(on_cycle, F.when(~F.col("done"), F.col("jump")) == F.col("_on"), "left")
    own = turning.withColumnRenamed("_on", "_own")
    return named.join(own, named["node"] == own["_own"], "left").select(
        "node",
        F.when(F.col("done"), F.coalesce("kind", F.lit("missing"))).when(F.col("_own").isNotNull(), "cycle").otherwise("below_cycle").alias("kind"),
        F.col("_cycle").alias("cycle"),
    )


def ancestors(nodes: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """All proper ancestors of the wanted nodes (a column ``node``; all nodes if there is none):
    ``node, ancestor, distance``, distance 1 for the parent.

    The result has one row per wanted node and ancestor, which is all that is ever built besides one pointer per node.
    """
    edges = nodes.where(~_is_root()).select("node", F.col("parent").alias("ancestor"))
    pointers, count = cut_counting(edges)
    limit = _rounds(count["rows"] + 1)
    starts = pointers if wanted is None else pointers.join(wanted.select("node").distinct(), "node", "left_semi")
    closure = cut(starts.withColumn("distance", F.lit(1).cast("bigint")))
    span = 1
    while True:
        # Whoever is up to 2^k away is known, and for each node the one 2^k above it.
        above = pointers.select(F.col("node").alias("_via"), F.col("ancestor").alias("_next"))
        further, count = cut_counting(
            closure.join(above, closure["ancestor"] == above["_via"]).select("node", F.col("_next").alias("ancestor"), (F.col("distance") + span).alias("distance"))
        )
        if not count["rows"]:
            return closure
        if not limit:
            _raise_open("parents form a cycle", further)
        closure = closure.unionByName(further)
        pointers = cut(pointers.join(above, pointers["ancestor"] == above["_via"]).select("node", F.col("_next").alias("ancestor")))
        span, limit = span * 2, limit - 1


def paths(closure: DataFrame) -> DataFrame:
    """Ancestor list per node, bottom up, from ``ancestors``: a view for small trees."""
    return closure.groupBy("node").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("distance", "ancestor"))), lambda step: step["ancestor"]).alias(
            "parents"
        )
    )


def descendants(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """All proper descendants of the wanted nodes: ``ancestor, node``.

    The tree is first reduced to the wanted nodes, so only pairs of the result are ever built.
    """
    marks = wanted.select(F.col("node").alias("_wanted")).distinct()
    marked = nodes.join(marks, nodes["node"] == marks["_wanted"], "left").select(
        nodes["node"], nodes["parent"], F.col("_wanted").isNotNull().alias("marked")
    )
    reached = nearest_marked(marked)
    lowest = (
        marked.where(~_is_root())
        .join(reached.withColumnRenamed("node", "parent"), "parent")
        .where(F.col("reached").isNotNull())
        .select("node", F.col("reached").alias("ancestor"), "marked")
    )
    lowest = cut(lowest)
    above = ancestors(lowest.where("marked").select("node", F.col("ancestor").alias("parent")))
    higher = lowest.join(above.select(F.col("node").alias("_low"), F.col("ancestor").alias("_high")), F.col("ancestor") == F.col("_low"))
    return lowest.select("ancestor", "node").unionByName(higher.select(F.col("_high").alias("ancestor"), "node"))


def any_descendant(nodes: DataFrame, flagged: str) -> DataFrame:
    """Internal nodes above a tip for which the column ``flagged`` holds: ``node``.

    Flags travel up along the jump pointers: after k rounds a flag has reached all ancestors less
    than 4^k edges away.
    """
    inner = nodes.where(F.col("genome").isNull())
    seeds = nodes.where(F.col("genome").isNotNull() & F.col(flagged)).select(F.col("parent").alias("node")).distinct()
    seeds = cut(inner.select("node").join(seeds, "node", "left_semi"))
    pointers = inner.where(~_is_root()).select("node", F.col("parent").alias("jump"))
    state = pointers.join(seeds.withColumn("flag", F.lit(True)), "node", "left").withColumn("flag", F.coalesce("flag", F.lit(False)))
    above, rows, limit = seeds, None, 1
    while True:
        state, count = cut_counting(farther(state, pointers), open=F.col("jump4").isNotNull())
        if rows is None:
            limit = _rounds(count["rows"] + 1)
        elif count["rows"] > rows:
            _raise_open("nodes are listed more than once", state)
        # a flag has reached all ancestors nearer than four times the distance
        sent = state.where("flag").select(F.explode(F.array_compact(F.array("jump", "jump2", "jump3"))).alias("node")).distinct()
        above = above.unionByName(sent)
        if not count["open"]:
            return inner.select("node").join(above.distinct(), "node", "left_semi")
        if not limit:
            _raise_open("parents form a cycle", state)
        # A pointer that leads to the top has nothing more to tell: only rows that can go on are written again.
        going = state.where(F.col("jump4").isNotNull())
        pointers = going.select("node", F.col("jump4").alias("jump"))
        state = going.join(sent.withColumn("_now", F.lit(True)), "node", "left").select(
            "node", F.col("jump4").alias("jump"), (F.col("flag") | F.col("_now").isNotNull()).alias("flag")
        )
        rows, limit = count["rows"], limit - 1


def farther(state: DataFrame, pointers: DataFrame, values: list[str] = ()) -> DataFrame:
    """``state`` (with ``jump``) and the targets two, three and four times as far: ``jump2`` to ``jump4``, null beyond the top.
    With the values of the targets before the last: ``<name>1`` to ``<name>3``."""
    for k in (1, 2, 3):
        last = "jump" if k == 1 else f"jump{k}"
        onward = pointers.select(F.col("node").alias("_via"), F.col("jump").alias(f"jump{k + 1}"), *[F.col(v).alias(f"{v}{k}") for v in values])
        state = state.join(onward, state[last] == onward["_via"], "left").drop("_via")
    return state


def paint_groups(nodes: DataFrame, reference: Column | None = None, reach: str = "root") -> DataFrame:
    """Add ``nongtdb_group``.

    ``reach="root"``: ``gtdb`` for reference tips and every node above one, else ``nongtdb``. ``reach="common"``: each of the
    two groups of tips marks its tips and the nodes on their paths, up to the lowest node above all of the group (for a
    single tip its parent). Reference marks win, nodes without a mark are ``0``.
    """
    is_reference = F.col("magset") == "GTDB" if reference is None else reference
    flagged = nodes.withColumn("_reference", F.coalesce(is_reference, F.lit(False)))
    if reach == "common":
        return _painted_to_common(flagged)
    above = any_descendant(flagged, "_reference").select(F.col("node").alias("_above"))
    tip = F.col("genome").isNotNull() & F.col("_reference")
    return (
        flagged.join(above, flagged["node"] == above["_above"], "left")
        .withColumn("nongtdb_group", F.when(tip | F.col("_above").isNotNull(), "gtdb").otherwise("nongtdb"))
        .drop("_above", "_reference")
    )


def _painted_to_common(flagged: DataFrame) -> DataFrame:
    """Tips of both groups are counted below every node. A node is on a path up to the group's common ancestor if it holds
    some of the group's tips but not all, or all and no child does."""
    from cladeflow.operators.intervals import subtree_sums

    tip = F.col("genome").isNotNull()
    counted = flagged.select(
        "node", "parent", (tip & F.col("_reference")).cast("bigint").alias("gtdb"), (tip & ~F.col("_reference")).cast("bigint").alias("nongtdb")
    )
    groups = ("gtdb", "nongtdb")
    below = cut(subtree_sums(counted, list(groups)).select(F.col("node").alias("_node"), "top", *[F.col(g).alias(f"_{g}") for g in groups]))
    totals = below.where(F.col("_node") == F.col("top")).select("top", *[F.col(f"_{g}").alias(f"_all_{g}") for g in groups])
    held = below.join(totals, "top")
    parents = counted.where(~_is_root()).select("node", "parent")
    # the most a single child holds; a tip that is the whole group leaves its parent as the common ancestor
    most = (
        parents.join(below, F.col("node") == F.col("_node")).groupBy(F.col("parent").alias("_parent")).agg(*[F.max(f"_{g}").alias(f"_most_{g}") for g in groups])
    )
    marked = held.join(most, F.col("_node") == F.col("_parent"), "left")

    def marks(group: str) -> Column:
        own, every, child = (F.col(f"{prefix}{group}") for prefix in ("_", "_all_", "_most_"))
        return (own > 0) & ((own < every) | (F.coalesce(child, F.lit(0)) < every))

    marked = marked.select("_node", *[marks(g).alias(f"_on_{g}") for g in groups])
    own = F.when(tip & F.col("_reference"), "gtdb").when(tip, "nongtdb")
    inner = F.when(F.col("_on_gtdb"), "gtdb").when(F.col("_on_nongtdb"), "nongtdb").otherwise("0")
    painted = flagged.join(marked, flagged["node"] == marked["_node"], "left")
    return painted.withColumn("nongtdb_group", F.coalesce(own, inner)).drop("_node", "_on_gtdb", "_on_nongtdb", "_reference")


def naming_groups(nodes: DataFrame) -> DataFrame:
    """Topmost non-reference node above each new tip, itself if it hangs on a reference node:
    ``node, genome, top``. Genomes of different groups never influence each other's names."""
    inner = nodes.where(F.col("genome").isNull()).select(
        "node", "parent", (F.coalesce("nongtdb_group", F.lit("gtdb")) == "gtdb").alias("gtdb")
    )
    linked = with_parent(inner, ["gtdb"])
    marked = linked.where(~F.col("gtdb")).withColumn("marked", F.col("parent_gtdb") | _is_root())
    tops = nearest_marked(marked).select(F.col("node").alias("parent"), F.col("reached").alias("top"))
    tips = new_tips(nodes).select("node", "parent", "genome")
    return tips.join(tops, "parent", "left").select("node", "genome", F.coalesce("top", "node").alias("top"))


def new_tips(nodes: DataFrame) -> DataFrame:
    """Tips to be named: a genome with a source other than the reference set."""
    return nodes.where(F.col("magset").isNotNull() & (F.col("magset") != "GTDB") & F.col("genome").isNotNull())
