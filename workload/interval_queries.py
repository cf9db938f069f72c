"""Queries over preorder intervals of the derived trees."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeflow.operators.intervals import common_ancestors, group_ancestors, intervals, is_below, range_sums, subtree_sums
from cladeflow.operators.tree import paint_groups
from workload import inputs
from workload.inputs import sql_tree
from workload.registry import query

TREE = "irregular"


def _with(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes} {select}"


@lru_cache(maxsize=4)
def labels(spark: SparkSession, sf_dir: str, tree: str) -> DataFrame:
    return intervals(inputs.nodes(spark, sf_dir, tree))


# The path from the root as a list puts nodes in preorder, children by id.
_SQL_LABELS = """
listed AS (
  SELECT n.node, n.depth, list_append(coalesce(list_reverse(p.above), []), n.node) AS route
  FROM nodes n LEFT JOIN (SELECT node, list(ancestor ORDER BY distance) AS above FROM path GROUP BY node) p ON n.node = p.node),
sizes AS (SELECT ancestor AS node, count(*) AS below FROM path GROUP BY ancestor),
labels AS (
  SELECT l.node, l.route[1] AS root, l.depth, row_number() OVER (ORDER BY route) - 1 AS first,
         row_number() OVER (ORDER BY route) - 1 + coalesce(below, 0) AS last
  FROM listed l LEFT JOIN sizes s ON l.node = s.node)"""

for _tree in inputs.PARAMS:

    @query(f"t2_interval_labels_{_tree}", _with(sql_tree(_tree) + "," + _SQL_LABELS, "SELECT node, root, depth, first, last FROM labels"))
    def t2_labels(spark, sf_dir, tree=_tree):
        return intervals(inputs.nodes(spark, sf_dir, tree)).drop("up")


@query(
    "t2_descendant_counts",
    _with(
        sql_tree(TREE),
        """SELECT a.node, count(n.node) + 1 AS n_nodes,
                  count(*) FILTER (n.genome IS NOT NULL) + (a.genome IS NOT NULL)::BIGINT AS n_tips,
                  count(*) FILTER (n.magset = 'GTDB') + (a.magset = 'GTDB')::BIGINT AS n_reference
           FROM nodes a LEFT JOIN path p ON p.ancestor = a.node LEFT JOIN nodes n ON n.node = p.node GROUP BY a.node, a.genome, a.magset""",
    ),
)
def t2_counts(spark, sf_dir):
    """Sums over the range of every node, itself included: as many rows as nodes, however deep the tree is."""
    nodes = inputs.nodes(spark, sf_dir, TREE)
    weights = nodes.select(
        "node",
        F.lit(1).cast("bigint").alias("n_nodes"),
        F.col("genome").isNotNull().cast("bigint").alias("n_tips"),
        (F.col("magset") == "GTDB").cast("bigint").alias("n_reference"),
    )
    return range_sums(labels(spark, sf_dir, TREE), weights, nodes, ["n_nodes", "n_tips", "n_reference"])


@query(
    "t2_membership",
    _with(
        sql_tree(TREE),
        """, pairs AS (SELECT node, node // 2 AS ancestor FROM nodes UNION SELECT node, node % 1000 FROM nodes UNION SELECT node, parent FROM nodes)
           SELECT q.node, q.ancestor, p.node IS NOT NULL AS below FROM pairs q JOIN nodes a ON a.node = q.ancestor
           LEFT JOIN path p ON p.node = q.node AND p.ancestor = q.ancestor""",
    ),
)
def t2_membership(spark, sf_dir):
    """Whether each node lies below its parent, and below two nodes picked by its number."""
    nodes = inputs.nodes(spark, sf_dir, TREE)
    picked = F.array_distinct(F.array(F.expr("node div 2"), F.expr("node % 1000"), "parent"))
    # dealt by node before they become three rows, as is_below() joins by node first
    pairs = nodes.select("node", "parent").repartition("node").select("node", F.explode(picked).alias("ancestor"))
    return is_below(pairs, labels(spark, sf_dir, TREE)).where(F.col("below").isNotNull())


@query(
    "t2_subtree_sums",
    _with(
        sql_tree("balanced"),
        """SELECT p.ancestor AS node, count(*) AS n_nodes, sum(m."Completeness") AS completeness
           FROM path p JOIN nodes n ON n.node = p.node LEFT JOIN metadata m ON m."Name" = n.genome GROUP BY p.ancestor""",
    ),
)
def t2_sums(spark, sf_dir):
    nodes, metadata = inputs.nodes(spark, sf_dir, "balanced"), inputs.metadata(spark, sf_dir, "balanced")
    scored = nodes.join(metadata.select(F.col("Name").alias("genome"), "Completeness"), "genome", "left")
    values = scored.select("node", "parent", F.lit(1).cast("bigint").alias("n_nodes"), F.col("Completeness").alias("completeness"))
    return subtree_sums(values, ["n_nodes", "completeness"]).select("node", "n_nodes", "completeness")


@query(
    "t6_common_ancestor",
    _with(
        sql_tree(TREE),
        """, own AS (
             SELECT n.node, n.node AS above FROM nodes n WHERE n.magset = 'GTDB'
             UNION ALL SELECT p.node, p.ancestor FROM path p JOIN nodes n ON n.node = p.node WHERE n.magset = 'GTDB')
           SELECT arg_max(a.node, a.depth) AS node FROM (SELECT above, count(*) AS n FROM own GROUP BY above) c JOIN nodes a ON a.node = c.above
           WHERE c.n = (SELECT count(*) FROM nodes WHERE magset = 'GTDB')""",
    ),
)
def t6_common(spark, sf_dir):
    reference = inputs.nodes(spark, sf_dir, TREE).where("magset = 'GTDB'")
    return common_ancestors(labels(spark, sf_dir, TREE), reference).select("node")


@query(
    "t6_lineage_ancestors",
    _with(
        sql_tree(TREE),
        """, members AS (
             SELECT n.node, regexp_extract(x.taxonomy, '(.*);f__', 1) AS lineage FROM nodes n JOIN taxonomy x ON x.genome = n.genome),
           own AS (
             SELECT node, lineage, node AS above FROM members
             UNION ALL SELECT m.node, lineage, p.ancestor FROM members m JOIN path p ON p.node = m.node)
           SELECT c.lineage, arg_max(a.node, a.depth) AS node
           FROM (SELECT lineage, above, count(*) AS n FROM own GROUP BY ALL) c JOIN nodes a ON a.node = c.above
           JOIN (SELECT lineage, count(*) AS n FROM members GROUP BY lineage) t ON t.lineage = c.lineage AND t.n = c.n GROUP BY c.lineage""",
    ),
)
def t6_lineages(spark, sf_dir):
    """Where the genomes of each order come together."""
    nodes = inputs.nodes(spark, sf_dir, TREE).select("node", "genome")
    lineage = F.substring_index("taxonomy", ";f__", 1)
    members = nodes.join(inputs.taxonomy(spark, sf_dir, TREE), "genome").select("node", lineage.alias("group"))
    return group_ancestors(labels(spark, sf_dir, TREE), members).select(F.col("group").alias("lineage"), "node")


# Each clade's marks over a tree of which only the lower part is used, so that the common ancestors lie below the root.
_SQL_PAINT = """, kept AS (SELECT * FROM nodes WHERE genome IS NULL OR node % 5 = 0),
marked AS (
  SELECT node, CASE WHEN genome IS NOT NULL AND magset = 'GTDB' THEN 'gtdb' WHEN genome IS NOT NULL THEN 'nongtdb' END AS side FROM kept
  WHERE genome IS NOT NULL),
total AS (SELECT side, count(*) AS n FROM marked GROUP BY side),
held AS (SELECT p.ancestor AS node, m.side, count(*) AS n FROM path p JOIN marked m ON m.node = p.node GROUP BY ALL),
on_path AS (
  SELECT h.node, h.side FROM held h JOIN total t ON t.side = h.side
  WHERE h.n < t.n OR NOT EXISTS (SELECT 1 FROM kept c JOIN held k ON k.node = c.node AND k.side = h.side WHERE c.parent = h.node AND c.node <> c.parent AND k.n = t.n))"""


@query(
    "t6_paint_to_common_ancestor",
    _with(
        sql_tree(TREE) + _SQL_PAINT,
        """SELECT k.node, coalesce(m.side, CASE WHEN g.node IS NOT NULL THEN 'gtdb' WHEN o.node IS NOT NULL THEN 'nongtdb' ELSE '0' END) AS nongtdb_group
           FROM kept k LEFT JOIN marked m ON m.node = k.node
           LEFT JOIN (SELECT DISTINCT node FROM on_path WHERE side = 'gtdb') g ON g.node = k.node
           LEFT JOIN (SELECT DISTINCT node FROM on_path WHERE side = 'nongtdb') o ON o.node = k.node""",
    ),
)
def t6_paint_common(spark, sf_dir):
    """Inner nodes and one tip in five: inner nodes without a tip stay unmarked."""
    nodes = inputs.nodes(spark, sf_dir, TREE).where("genome is null or node % 5 = 0").drop("nongtdb_group")
    return paint_groups(nodes, reach="common").select("node", "nongtdb_group")
