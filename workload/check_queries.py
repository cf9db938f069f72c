"""Checks on what is read and written: broken rows, tables that are no tree, the order of outputs, rounding of labels."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cladeflow.functions.ranks import two_digits
from cladeflow.operators.validate import tree_issues
from cladeflow.plans.run import names_order
from cladeflow.session import cut, shared_folder
from cladeflow.sources import tsv
from cladeflow.sources.ordered import read_in_order, write_in_order
from workload import inputs
from workload.inputs import PARAMS, table
from workload.naming_sql import sql_naming
from workload.registry import query


def _scratch(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- broken rows --------------------------------------------------------------------------------------

# Of 97 orders one lacks a field, one has a field too many, three have values that are no numbers; one is NA, which is fine.
_COLUMNS = {"node": "bigint", "parent": "bigint", "RED": "double", "label": "string"}
_SQL_LINES = """
parts AS (
  SELECT o_orderkey AS k, o_orderkey % 97 AS kind, CAST(o_orderkey + 1 AS VARCHAR) AS node,
         CASE WHEN o_orderkey % 97 IN (2, 4) THEN 'x' ELSE '' END || (o_orderkey // 2) AS parent,
         CASE WHEN o_orderkey % 97 IN (3, 4) THEN '0,5' WHEN o_orderkey % 97 = 5 THEN 'NA' ELSE '0.' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') END AS red,
         o_orderpriority AS label FROM orders),
lines AS (
  SELECT *, node || chr(9) || parent || chr(9) || red || CASE WHEN kind = 0 THEN '' ELSE chr(9) || label END || CASE WHEN kind = 1 THEN chr(9) || 'more' ELSE '' END AS record
  FROM parts)"""


def _lines(spark, sf_dir: str) -> str:
    """A headered table of orders as nodes, written as it is; its path."""
    key, kind = F.col("o_orderkey"), F.col("o_orderkey") % 97
    red = F.when(kind.isin(3, 4), "0,5").when(kind == 5, "NA").otherwise(F.concat(F.lit("0."), F.lpad((key % 1000).cast("string"), 3, "0")))
    record = F.concat_ws(
        "\t",
        (key + 1).cast("string"),
        F.concat(F.when(kind.isin(2, 4), "x").otherwise(""), F.expr("o_orderkey div 2").cast("string")),
        red,
        F.when(kind != 0, F.col("o_orderpriority")),
        F.when(kind == 1, "more"),
    )
    path = _scratch(spark, "lines")
    lines = table(spark, sf_dir, "orders").select(record.alias("\t".join(_COLUMNS)))
    lines.write.option("header", True).option("sep", "\x01").option("quote", "").csv(path)
    return path


@query(
    "s1_f3_malformed_rows",
    f"""WITH {_SQL_LINES}
        SELECT CASE kind WHEN 0 THEN 'too_few_fields' WHEN 1 THEN 'too_many_fields' ELSE 'bad_value' END AS issue, record,
               CASE kind WHEN 2 THEN 'parent' WHEN 3 THEN 'RED' WHEN 4 THEN 'parent,RED' ELSE '' END AS columns
        FROM lines WHERE kind <= 4""",
)
def malformed(spark, sf_dir):
    _, issues = tsv.read_checked(spark, _lines(spark, sf_dir), _COLUMNS, null="NA")
    return issues.select("issue", "record", "columns")


@query(
    "s1_sound_rows",
    f"""WITH {_SQL_LINES}
        SELECT CAST(node AS BIGINT) AS node, CAST(parent AS BIGINT) AS parent, CASE WHEN red <> 'NA' THEN CAST(red AS DOUBLE) END AS "RED", label FROM lines WHERE kind > 4""",
)
def sound(spark, sf_dir):
    rows, _ = tsv.read_checked(spark, _lines(spark, sf_dir), _COLUMNS, null="NA")
    return rows


@query(
    "s3_malformed_taxonomy",
    """SELECT 'too_few_fields' AS issue, s_name AS record FROM supplier WHERE s_suppkey % 7 = 0
       UNION ALL SELECT 'too_many_fields', s_name || chr(9) || 'd__B' || chr(9) || s_suppkey FROM supplier WHERE s_suppkey % 7 = 1""",
)
def malformed_taxonomy(spark, sf_dir):
    path = _scratch(spark, "taxonomy")
    kind = F.col("s_suppkey") % 7
    line = F.concat_ws("\t", "s_name", F.when(kind != 0, "d__B"), F.when(kind == 1, F.col("s_suppkey").cast("string")))
    table(spark, sf_dir, "supplier").select(line.alias("value")).write.text(path)
    _, issues = tsv.read_taxonomy_checked(spark, path)
    return issues.select("issue", "record")


# --- tables that are no tree --------------------------------------------------------------------------

STRIDE = 32
# By shape: (node, parent, is a tip); every part is a tree of its own. Issues as (issue, node, of a tip).
_SHAPES = [
    # a cycle of three with a tail, beside a sound tree
    ([(0, 0, 0), (5, 0, 0), (1, 2, 0), (2, 3, 0), (3, 1, 0), (4, 3, 0), (6, 4, 1), (7, 1, 1), (8, 5, 1)],
     [("cycle", 1, 0), ("cycle", 2, 0), ("cycle", 3, 0), ("below_cycle", 4, 0), ("below_cycle", 6, 1), ("below_cycle", 7, 1)]),
    # a node whose parent is missing, with nodes below it
    ([(0, 0, 0), (1, 20, 0), (2, 1, 0), (6, 2, 1), (7, 0, 1)], [("missing_parent", 1, 0), ("below_missing_parent", 2, 0), ("below_missing_parent", 6, 1)]),
    ([(0, 0, 0), (1, 1, 0), (2, 1, 0), (6, 2, 1)], [("several_roots", 0, 0), ("several_roots", 1, 0)]),
    ([(1, 2, 0), (2, 1, 0), (6, 1, 1)], [("cycle", 1, 0), ("cycle", 2, 0), ("below_cycle", 6, 1), ("no_root", None, 0)]),
    ([(0, 0, 0), (1, 0, 0), (6, 1, 1)], []),
]
_KINDS = ("cycle", "below_cycle", "below_missing_parent", "several_roots", "no_root", "missing_parent")


def _sql_issue(shape: int, issue: str, node: int | None, tip: int) -> str:
    own = "CAST(NULL AS BIGINT)" if node is None else f"p_partkey * {STRIDE} + {node}"
    genome = f"'g' || (p_partkey * {STRIDE} + {node})" if tip else "CAST(NULL AS VARCHAR)"
    return f"SELECT CAST(p_partkey AS BIGINT) AS tree, '{issue}' AS issue, {own} AS node, {genome} AS genome FROM part WHERE p_partkey % {len(_SHAPES)} = {shape}"


@query("f3_structure_checks", " UNION ALL ".join(_sql_issue(s, *row) for s, (_, rows) in enumerate(_SHAPES) for row in rows))
def structure(spark, sf_dir):
    rows = [(s, *row) for s, (nodes, _) in enumerate(_SHAPES) for row in nodes]
    shapes = spark.createDataFrame(rows, "shape int, n bigint, p bigint, tip int")  # a fixed, small table
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("bigint").alias("tree"))
    at = lambda c: F.col("tree") * STRIDE + F.col(c)
    tip = F.col("tip") == 1
    nodes = parts.join(F.broadcast(shapes), F.pmod("tree", F.lit(len(_SHAPES))) == F.col("shape")).select(
        "tree", at("p").alias("parent"), at("n").alias("node"), F.lit("nongtdb").alias("nongtdb_group"),
        F.when(tip, F.concat(F.lit("g"), at("n"))).alias("genome"), F.when(tip, "other").alias("magset"),
        F.when(tip, 1.0).otherwise(0.5).alias("RED"), F.lit("Class (a]").alias("novelty_red"),
    )
    return tree_issues(cut(nodes), ["tree"], one_root=True).where(F.col("issue").isin(*_KINDS)).select("tree", "issue", "node", "genome")


# --- order and rounding ---------------------------------------------------------------------------------


def _sql_ordered() -> str:
    parts = [
        f"SELECT * FROM (WITH RECURSIVE {sql_naming(tree)} SELECT '{p.domain}' AS domain, node, clade, genome_rep FROM node_names)" for tree, p in PARAMS.items()
    ]
    place = "row_number() OVER (PARTITION BY domain ORDER BY clade, node NULLS LAST, genome_rep)"
    return f"SELECT *, {place} AS \"row\" FROM ({' UNION ALL '.join(parts)})"


@query("o2_ordered_names", _sql_ordered())
def ordered(spark, sf_dir):
    """Names of both trees, written in order and numbered as the files have them."""
    names = [inputs.naming(spark, sf_dir, tree).node_names.withColumn("domain", F.lit(p.domain)) for tree, p in PARAMS.items()]
    path = _scratch(spark, "ordered")
    write_in_order(names[0].unionByName(names[1]), path, names_order(), "domain")
    return read_in_order(spark, path, tsv.schemas.NODE_NAMES, "domain")


@query(
    "x2_exact_digits",
    r"""SELECT o_orderkey AS k, regexp_replace(regexp_replace(format('{:.2f}', a), '\.00$', ''), '(\.\d)0$', '\1') AS thousandths,
              regexp_replace(regexp_replace(format('{:.2f}', b), '\.00$', ''), '(\.\d)0$', '\1') AS eighths,
              regexp_replace(regexp_replace(format('{:.2f}', c), '\.00$', ''), '(\.\d)0$', '\1') AS middles
       FROM (SELECT o_orderkey, (o_orderkey % 3000) / 1000e0 AS a, (o_orderkey % 64) / 8e0 AS b,
                    ((o_orderkey % 700) / 700e0 + (o_orderkey % 900) / 900e0) / 2e0 AS c FROM orders)""",
)
def digits(spark, sf_dir):
    """Thousandths, of which every tenth is printed half way but seldom lies there; eighths, which do; and middles of two values."""
    key = F.col("o_orderkey")
    values = {"thousandths": (key % 3000) / 1000.0, "eighths": (key % 64) / 8.0, "middles": ((key % 700) / 700.0 + (key % 900) / 900.0) / 2.0}
    return table(spark, sf_dir, "orders").select(key.alias("k"), *[two_digits(v).alias(name) for name, v in values.items()])
