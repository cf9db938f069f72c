"""Views of the driver tables as trees, metadata, taxonomies, catalogues and labels.

The tables hold no trees. Two are derived, both from all rows of a table:

* ``balanced``: customers as a binary heap, node n below n div 2;
* ``irregular``: orders as a random tree, each below an earlier one, urgent ones all below order 1.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeflow.functions.ranks import novelty_red
from cladeflow.operators.naming import Naming
from cladeflow.operators.tree import depths, paint_groups
from cladeflow.params import DomainParams, preset
from cladeflow.session import cut, tune

PARAMS = {"balanced": preset("d__Archaea"), "irregular": preset("d__Bacteria")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lineage(domain: str, key: Column, node: Column) -> Column:
    parts = [F.lit(f"{domain};p__P")]
    for modulus, letter in ((3, "c__C"), (5, "o__O"), (7, "f__F"), (11, "g__G"), (13, "s__S")):
        parts += [(key % modulus).cast("string"), F.lit(f";{letter}")]
    return F.concat(*parts, node.cast("string"))


def _with_tips(base: DataFrame) -> DataFrame:
    """Nodes nobody names as parent are tips; only these keep genome and reference mark."""
    parents = base.where("node <> parent").select(F.col("parent").alias("_inner")).distinct()
    joined = base.join(parents, base["node"] == parents["_inner"], "left")
    tip = F.col("_inner").isNull()
    return joined.select(
        "node",
        "parent",
        F.when(tip, F.col("id")).alias("genome"),
        (tip & F.col("reference")).alias("reference"),
        "key",
        "extra",
    )


def _balanced_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    node = F.col("c_custkey") + 1
    return table(spark, sf_dir, "customer").select(
        node.alias("node"),
        F.when(F.col("c_custkey") == 0, 1).otherwise(F.expr("(c_custkey + 1) div 2")).cast("bigint").alias("parent"),
        F.col("c_name").alias("id"),
        (F.col("c_acctbal") > 9800).alias("reference"),
        F.col("c_nationkey").cast("bigint").alias("key"),
        F.col("c_custkey").alias("extra"),
    )


def _irregular_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    node = F.col("o_orderkey") + 1
    # A mixer whose modulus lies beyond any number of nodes in view.
    earlier = 1 + ((node * 2654435761) % 4294967291) % F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        node.alias("node"),
        F.when(F.col("o_orderkey") == 0, 1)
        .when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderkey") > 1), 2)
        .when(F.col("o_orderkey") > 0, earlier)
        .cast("bigint")
        .alias("parent"),
        F.concat(F.substr("o_orderpriority", F.lit(3)), F.lit("_"), F.col("o_orderkey").cast("string")).alias("id"),
        (F.col("o_totalprice") > 495000).alias("reference"),
        F.col("o_custkey").alias("key"),
        F.col("o_custkey").alias("extra"),
    )


def _red(tree: str, depth: Column, node: Column, deepest: int) -> Column:
    if tree == "balanced":
        return (depth + (node % 7) / 10.0) / (F.lit(float(deepest)) - F.lit(0.3))
    # Large uneven steps, so that a step may cross several ranks.
    tenths = depth * 22 + node % 22
    return F.lit(1.0) - F.lit(1.0) / (F.lit(1.0) + F.lit(0.045) * tenths)


@lru_cache(maxsize=16)
def base(spark: SparkSession, sf_dir: str, tree: str) -> DataFrame:
    """``node, parent, genome, reference, key, extra``."""
    tune(spark)
    return cut(_with_tips((_balanced_base if tree == "balanced" else _irregular_base)(spark, sf_dir)))


@lru_cache(maxsize=16)
def nodes(spark: SparkSession, sf_dir: str, tree: str) -> DataFrame:
    """Annotated node table of a derived tree."""
    located = depths(base(spark, sf_dir, tree))
    deepest = located.agg(F.max("depth")).first()[0]
    tip = F.col("genome").isNotNull()
    red = F.when(tip, 1.0).otherwise(_red(tree, F.col("depth"), F.col("node"), deepest))
    marked = base(spark, sf_dir, tree).select("parent", "node", "genome", F.when(F.col("reference"), "GTDB").otherwise("other").alias("magset"))
    # painted before the depths are joined, as painting reads its table several times
    annotated = paint_groups(marked).join(located, "node").withColumn("RED", red)
    columns = ("parent", "node", "genome", "magset", "RED", "nongtdb_group")
    return cut(annotated.select(*columns, novelty_red(F.col("RED"), PARAMS[tree]).alias("novelty_red")))


def metadata(spark: SparkSession, sf_dir: str, tree: str) -> DataFrame:
    return base(spark, sf_dir, tree).where(F.col("genome").isNotNull()).select(
        F.col("genome").alias("Name"),
        (50 + F.col("extra") % 50).cast("double").alias("Completeness"),
        ((F.col("extra") % 37) / 10.0).alias("Contamination"),
    )


def taxonomy(spark: SparkSession, sf_dir: str, tree: str) -> DataFrame:
    return base(spark, sf_dir, tree).where("reference").select(
        "genome", _lineage(PARAMS[tree].domain, F.col("key"), F.col("node")).alias("taxonomy")
    )


@lru_cache(maxsize=16)
def naming(spark: SparkSession, sf_dir: str, tree: str) -> Naming:
    return Naming(nodes(spark, sf_dir, tree), metadata(spark, sf_dir, tree), (PARAMS[tree],))


@lru_cache(maxsize=4)
def both_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [nodes(spark, sf_dir, tree).withColumn("domain", F.lit(p.domain)) for tree, p in PARAMS.items()]
    return parts[0].unionByName(parts[1])


def both_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata(spark, sf_dir, "balanced").unionByName(metadata(spark, sf_dir, "irregular"))


def both_taxonomies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy(spark, sf_dir, "balanced").unionByName(taxonomy(spark, sf_dir, "irregular"))


def raw_nodes(spark: SparkSession, sf_dir: str, tree: str) -> DataFrame:
    """The tree as a RED-decorated tree file has it: parent, node, branch_length, label."""
    thousandths = F.floor(F.col("RED") * 1000).cast("string")
    red = F.concat(F.lit("0."), F.lpad(thousandths, 3, "0"))
    named = F.concat(F.lit("'0."), F.lpad((F.col("node") % 1000).cast("string"), 3, "0"), F.lit(":g__G"), F.col("node").cast("string"))
    label = (
        F.when(F.col("genome").isNotNull(), F.concat(F.lit("'"), F.col("genome"), F.lit("|RED=1.000'")))
        .when(F.col("node") % 2 == 0, F.concat(named, F.lit("|RED="), red, F.lit("'")))
        .otherwise(F.concat(F.lit("'1.0|RED="), red, F.lit("'")))
    )
    return nodes(spark, sf_dir, tree).select(
        "parent", "node", ((F.col("node") % 10) / 10.0).alias("branch_length"), label.alias("label")
    )


# --- the same views in SQL -------------------------------------------------------------------------

_SQL_BASE = {
    "balanced": """
base AS (
  SELECT c_custkey + 1 AS node,
         CASE WHEN c_custkey = 0 THEN 1 ELSE (c_custkey + 1) // 2 END AS parent,
         c_name AS id, c_acctbal > 9800 AS reference, CAST(c_nationkey AS BIGINT) AS key, c_custkey AS extra
  FROM customer)""",
    "irregular": """
base AS (
  SELECT o_orderkey + 1 AS node,
         CASE WHEN o_orderkey = 0 THEN 1
              WHEN o_orderpriority = '1-URGENT' AND o_orderkey > 1 THEN 2
              ELSE 1 + (((o_orderkey + 1) * 2654435761) % 4294967291) % o_orderkey END AS parent,
         substr(o_orderpriority, 3) || '_' || o_orderkey AS id, o_totalprice > 495000 AS reference,
         o_custkey AS key, o_custkey AS extra
  FROM orders)""",
}
_SQL_RED = {
    "balanced": "(depth + (node % 7) / 10e0) / (CAST((SELECT max(depth) FROM located) AS DOUBLE) - 3e-1)",
    "irregular": "1e0 - 1e0 / (1e0 + 45e-3 * (depth * 22 + node % 22))",
}


NOVELTY = {
    "d__Archaea": [
        "'Phylum (0-0.29]'",
        "'Class (0.29-0.45]'",
        "'Order (0.45-0.63]'",
        "'Family (0.63-0.82]'",
        "'Genus (0.82-0.95]'",
        "'Species/Strain (0.95-1]'",
    ],
    "d__Bacteria": [
        "'Phylum (0-0.39]'",
        "'Class (0.39-0.53]'",
        "'Order (0.53-0.68]'",
        "'Family (0.68-0.84]'",
        "'Genus (0.84-0.96]'",
        "'Species/Strain (0.96-1]'",
    ],
}


def sql_double(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def sql_rank(red: str, params: DomainParams) -> str:
    edges = " ".join(
        f"WHEN {red} <= {sql_double(edge)} THEN {rank}" for rank, edge in enumerate(params.upper_edges)
    )
    return f"CASE WHEN {red} <= 0 OR {red} > 1 THEN NULL {edges} END"


def sql_pick(index: str, values: list[str]) -> str:
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN {value}" for i, value in enumerate(values)) + " END"


def sql_tree(tree: str) -> str:
    """CTEs ``base, path, located, painted, nodes``; nodes also has ``rank`` (0..5) and ``reference``."""
    params = PARAMS[tree]
    domain = params.domain
    lineage = (
        f"'{domain};p__P' || (key % 3) || ';c__C' || (key % 5) || ';o__O' || (key % 7) || ';f__F' || (key % 11)"
        " || ';g__G' || (key % 13) || ';s__S' || node"
    )
    return f"""{_SQL_BASE[tree]},
path AS (
  SELECT node, parent AS ancestor, CAST(1 AS BIGINT) AS distance FROM base WHERE node <> parent
  UNION ALL
  SELECT p.node, b.parent, p.distance + 1 FROM path p JOIN base b ON p.ancestor = b.node WHERE b.node <> b.parent),
located AS (
  SELECT b.node, b.parent, b.id, b.reference, b.key, b.extra, coalesce(d.depth, 0) AS depth, i.parent IS NULL AS tip
  FROM base b
  LEFT JOIN (SELECT node, max(distance) AS depth FROM path GROUP BY node) d ON b.node = d.node
  LEFT JOIN (SELECT DISTINCT parent FROM base WHERE node <> parent) i ON b.node = i.parent),
reds AS (
  SELECT *, CASE WHEN tip THEN 1e0 ELSE {_SQL_RED[tree]} END AS red FROM located),
painted AS (
  SELECT DISTINCT p.ancestor AS node FROM path p JOIN located l ON p.node = l.node WHERE l.tip AND l.reference),
nodes AS (
  SELECT r.parent, r.node, CASE WHEN tip THEN id END AS genome,
         CASE WHEN tip AND reference THEN 'GTDB' ELSE 'other' END AS magset, red AS "RED",
         CASE WHEN (tip AND reference) OR p.node IS NOT NULL THEN 'gtdb' ELSE 'nongtdb' END AS nongtdb_group,
         {sql_pick(sql_rank("red", params), NOVELTY[domain])} AS novelty_red,
         {sql_rank("red", params)} AS rank, r.depth
  FROM reds r LEFT JOIN painted p ON r.node = p.node),
metadata AS (
  SELECT id AS "Name", CAST(50 + extra % 50 AS DOUBLE) AS "Completeness", (extra % 37) / 10e0 AS "Contamination"
  FROM located WHERE tip),
taxonomy AS (SELECT id AS genome, {lineage} AS taxonomy FROM located WHERE tip AND reference)"""
