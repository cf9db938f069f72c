"""Checks on a node table. Nothing is changed; every finding is one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeflow.functions.labels import label_issue
from cladeflow.functions.ranks import rank_index, rank_word
from cladeflow.operators.tree import new_tips, path_ends, with_parent
from cladeflow.params import SPECIES
from cladeflow.session import cut, cut_counting


def tree_issues(nodes: DataFrame, by: list[str] | None = None, one_root: bool = False) -> DataFrame:
    """``issue, node, genome`` for one tree, or for one per value of the columns ``by``, which are then added.

    ``red_not_increasing`` and ``reference_below_new`` are harmless to naming as such: the first may
    let a rank be named twice on a path (the upper name then applies), the second is ignored. ``cycle``, ``below_cycle``,
    ``below_missing_parent`` and ``no_root`` tell of tables that are no tree, and ``several_roots`` of those that hold more
    than one where ``one_root`` is asked for.
    """
    by = by or []
    nodes = nodes.withColumns(
        {name: F.when(F.col(name).isNotNull(), F.struct(*by, F.col(name).cast("bigint").alias("node"))) for name in ("node", "parent")}
    )
    inner = nodes.where(F.col("genome").isNull()).select(
        "node",
        "parent",
        F.col("RED").cast("double").alias("red"),
        rank_index(rank_word(F.col("novelty_red"))).alias("rank"),
        (F.coalesce("nongtdb_group", F.lit("gtdb")) == "gtdb").alias("gtdb"),
    )
    linked = with_parent(inner, ["red", "rank", "gtdb"])
    below_root = F.col("node") != F.col("parent")
    same_rank = F.col("rank") == F.col("parent_rank")
    checks: dict[str, Column] = {
        "no_rank": F.col("rank").isNull(),
        "rank_decreasing": ~F.col("gtdb") & (F.col("rank") < F.col("parent_rank")),
        "red_not_increasing": below_root
        & ~F.col("gtdb")
        & (F.col("red") <= F.col("parent_red"))
        & same_rank
        & (F.col("rank") < SPECIES),
        "reference_below_new": F.col("gtdb") & ~F.col("parent_gtdb"),
    }
    no_genome = F.lit(None).cast("string").alias("genome")
    # Where RED rises along every edge no path can turn back, and all of them end at a root.
    flat = below_root & ~F.coalesce(F.col("red") > F.col("parent_red"), F.lit(False))
    checked, count = cut_counting(linked.select("node", _names_of(checks).alias("issues"), flat.alias("flat")), flat=F.col("flat"))
    found = checked.select("node", F.explode("issues").alias("issue")).select("issue", "node", no_genome)

    parents = inner.select(F.col("node").alias("_parent"))
    orphans = (
        nodes.join(parents, nodes["parent"] == parents["_parent"], "left_anti")
        .where(F.col("genome").isNotNull() | below_root)
        .select(F.lit("missing_parent").alias("issue"), "node", "genome")
    )
    twice = (
        nodes.groupBy("node").count().where("count > 1").select(F.lit("duplicate_node").alias("issue"), "node", no_genome)
    )
    named_twice = (
        new_tips(nodes)
        .groupBy(*by, "genome")
        .agg(F.count(F.lit(1)).alias("count"), F.min("node").alias("node"))
        .where("count > 1")
        .select(F.lit("duplicate_genome").alias("issue"), "node", "genome")
    )
    every = [found, orphans, twice, named_twice, _root_issues(inner, by, one_root)]
    if count["flat"]:
        every.append(_path_issues(nodes, inner))
    every = reduce(DataFrame.unionByName, every)
    return every.select("issue", F.col("node.node").alias("node"), "genome", *[F.col(f"node.{c}").alias(c) for c in by])


def _root_issues(inner: DataFrame, by: list[str], one_root: bool) -> DataFrame:
    """One row for a tree that has no root, and each root of a tree that has several and must not."""
    is_root = F.coalesce(F.col("parent") == F.col("node"), F.lit(True))
    keys = [f"_{c}" for c in by] or ["_tree"]
    tree = [F.col(f"node.{c}").alias(f"_{c}") for c in by] or [F.lit(0).alias("_tree")]
    roots = inner.groupBy(*tree).agg(F.count_if(is_root).alias("_roots"), F.first("node").alias("_any"))
    none = F.struct(*[F.col(f"_any.{c}").alias(c) for c in by], F.lit(None).cast("bigint").alias("node"))
    rootless = roots.where("_roots = 0").select(F.lit("no_root").alias("issue"), none.alias("node"))
    many = roots.where(F.lit(one_root) & (F.col("_roots") > 1)).drop("_any")
    listed = inner.where(is_root).select("node", *tree)
    found = listed.join(many, keys).select(F.lit("several_roots").alias("issue"), "node").unionByName(rootless)
    return found.withColumn("genome", F.lit(None).cast("string"))


def _path_issues(nodes: DataFrame, inner: DataFrame) -> DataFrame:
    """Nodes and tips whose path does not end at a root. An orphan itself is a ``missing_parent``."""
    kinds = {"cycle": "cycle", "below_cycle": "below_cycle", "missing": "below_missing_parent"}
    once = inner.select("node", "parent").dropDuplicates(["node"])
    ends = cut(path_ends(once).select("node", F.col("kind")).where("kind <> 'root'"))
    issue = F.coalesce(*[F.when(F.col("kind") == kind, name) for kind, name in kinds.items()])
    parents = once.select(F.col("node").alias("_parent"))
    own = ends.join(once, "node").join(parents, F.col("parent") == F.col("_parent"), "left")
    listed = own.where((F.col("kind") != "missing") | F.col("_parent").isNotNull()).select(issue.alias("issue"), "node", F.lit(None).cast("string").alias("genome"))
    tips = nodes.where(F.col("genome").isNotNull()).select("node", "parent", "genome")
    above = ends.select(F.col("node").alias("parent"), F.when(F.col("kind") == "cycle", "below_cycle").otherwise(issue).alias("issue"))
    return listed.unionByName(tips.join(above, "parent").select("issue", "node", "genome"))


def _names_of(checks: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(holds, F.lit(name)) for name, holds in checks.items()]))


def label_issues(raw_nodes: DataFrame) -> DataFrame:
    """``issue, node, genome`` for labels whose numbers are not read as they stand; genome is the label."""
    found = raw_nodes.select(label_issue(F.col("label")).alias("issue"), "node", F.col("label").alias("genome"))
    return found.where(F.col("issue").isNotNull())


def table_issues(frame: DataFrame, key: list[str], issue: str) -> DataFrame:
    """``issue, node, genome`` for ids that a table of genomes lists more than once; the id is the key's last column."""
    repeated = frame.where(F.col(key[-1]).isNotNull()).groupBy(*key).count().where("count > 1")
    return repeated.select(F.lit(issue).alias("issue"), F.lit(None).cast("bigint").alias("node"), F.col(key[-1]).alias("genome"))
