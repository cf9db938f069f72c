"""Small trees of known results, one per part: the rules that the two large derived trees do not reach.

Each part gets the shape of its key modulo the number of shapes. The results of a shape are worked by hand and stated
as rows, in Spark as input only and in SQL as the result, so the two sides share no formulation. Node n of part k is
k * 32 + n, genome g of part k is g_k. RED bins (bacterial cutoffs) end at 0.389, 0.529, 0.683, 0.840, 0.961.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeflow.functions.ranks import novelty_red
from cladeflow.operators.naming import Naming
from cladeflow.operators.validate import tree_issues
from cladeflow.plans.run import input_issues, name_and_fill
from cladeflow.session import cut
from workload.inputs import PARAMS, table
from workload.registry import query

BACTERIA = PARAMS["irregular"]
STRIDE = 32
LINEAGE = "d__Bacteria;p__P;c__C;o__O;f__F;g__G;s__G sp1"

# A shape: inner nodes (node, parent, RED), tips (node, parent, genome, quality; None: no metadata, "ref": reference),
# taxonomy by genome ({g} is the genome's id, {n} node n's), attached names (node, clade letter, genome), issues.
SHAPES = [
    # Node 1 supplies the class, of class and order only the order is left to node 2: it waits for a genome that names
    # a clade below, f1. f0 came before and keeps its own order.
    dict(
        inner=[(0, 0, 0.44), (1, 0, 0.52), (2, 1, 0.75), (3, 2, 0.9)],
        tips=[(4, 1, "ref", "ref"), (5, 2, "f0", 90), (6, 3, "f1", 80), (7, 2, "f2", 70)],
        taxonomy={
            "f0": ("{1}", "f0", "f0", "f0"), "f1": ("{1}", "f1", "f1", "f1"), "f2": ("{1}", "f1", "f2", "f2"),
        },
        attached=[(2, "o", "f1"), (3, "f", "f1")],
        issues=[],
        waiting=[2],
    ),
    # The same node with nothing named below: it stays without a name.
    dict(
        inner=[(0, 0, 0.44), (1, 0, 0.52), (2, 1, 0.75)],
        tips=[(4, 1, "ref", "ref"), (5, 2, "g0", 90), (6, 2, "g1", 80)],
        taxonomy={"g0": ("{1}", "g0", "g0", "g0"), "g1": ("{1}", "g1", "g1", "g1")},
        attached=[],
        issues=[],
        waiting=[2],
    ),
    # Equal RED on a path: node 1 spans phylum and class, node 2 is an order by its parent, node 3 adds nothing.
    dict(
        inner=[(0, 0, 0.25), (1, 0, 0.55), (2, 1, 0.55), (3, 2, 0.55)],
        tips=[(5, 3, "h0", 90), (6, 2, "h1", 80), (7, 1, "h2", 70)],
        taxonomy={
            "h0": (None, "h0", "h0", "h0", "h0", "h0"), "h1": (None, "h0", "h0", "h0", "h1", "h1"), "h2": (None, "h0", "h0", "h2", "h2", "h2"),
        },
        attached=[(1, "p", "h0"), (1, "c", "h0"), (2, "o", "h0")],
        issues=[],
        checks=[(2, "red_not_increasing"), (3, "red_not_increasing")],
    ),
    # A root without RED has no rank; a genome without metadata.
    dict(
        inner=[(0, 0, 0.0), (1, 0, 0.55), (2, 1, 0.9)],
        tips=[(5, 2, "i0", 90), (6, 1, "i1", None)],
        taxonomy={},
        attached=[],
        issues=[("invalid_node_on_path", "i0"), ("no_metadata", "i1")],
        checks=[(0, "no_rank")],
    ),
    # A new tree that starts at an order: nothing supplies phylum and class.
    dict(
        inner=[(0, 0, 0.6), (1, 0, 0.9)],
        tips=[(5, 1, "j0", 90)],
        taxonomy={},
        attached=[],
        issues=[("no_phylum", "j0")],
    ),
    # A tip whose parent is missing, and ranks that rise towards the tips again.
    dict(
        inner=[(0, 0, 0.5), (1, 0, 0.3)],
        tips=[(5, 20, "k0", 90), (6, 1, "k1", 80)],
        taxonomy={},
        attached=[],
        issues=[("invalid_node_on_path", "k0"), ("invalid_node_on_path", "k1"), ("missing_parent", "k0")],
        checks=[(5, "missing_parent"), (1, "rank_decreasing")],
    ),
    # The child is nearer to the order's median than its parent: node 2 is passed over, node 3 is the order.
    dict(
        inner=[(0, 0, 0.25), (1, 0, 0.55), (2, 1, 0.6), (3, 2, 0.7)],
        tips=[(5, 3, "l0", 90), (6, 2, "l1", 80), (7, 3, "l2", 70)],
        taxonomy={
            "l0": (None, "l0", "l0", "l0", "l0", "l0"), "l1": (None, "l0", "l0", "l1", "l1", "l1"), "l2": (None, "l0", "l0", "l0", "l2", "l2"),
        },
        attached=[(1, "p", "l0"), (1, "c", "l0"), (3, "o", "l0")],
        issues=[],
    ),
]


def _of(shape: int):
    return F.col("p_partkey") % len(SHAPES) == shape


def _per_part(spark: SparkSession, sf_dir: str, rows: list[tuple], schema: str) -> DataFrame:
    """Rows of each part's shape; the shapes are a fixed, small table."""
    shapes = spark.createDataFrame(rows, f"shape int, {schema}")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("bigint").alias("k"))
    return parts.join(F.broadcast(shapes), F.pmod("k", F.lit(len(SHAPES))) == F.col("shape"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = []
    for s, shape in enumerate(SHAPES):
        known = {1, 0} if any(t[3] == "ref" for t in shape["tips"]) else set()
        rows += [(s, n, p, "gtdb" if n in known else "nongtdb", None, None, red) for n, p, red in shape["inner"]]
        rows += [(s, n, p, "gtdb" if q == "ref" else "nongtdb", g, "GTDB" if q == "ref" else "other", 1.0) for n, p, g, q in shape["tips"]]
    found = _per_part(spark, sf_dir, rows, "n bigint, p bigint, nongtdb_group string, g string, magset string, RED double")
    at = lambda c: F.col("k") * STRIDE + F.col(c)
    return found.select(
        at("p").alias("parent"),
        at("n").alias("node"),
        "nongtdb_group",
        F.concat("g", F.lit("_"), "k").alias("genome"),
        "magset",
        "RED",
        F.when(F.col("RED") > 0, novelty_red(F.col("RED"), BACTERIA)).alias("novelty_red"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(s, g, float(q)) for s, shape in enumerate(SHAPES) for _, _, g, q in shape["tips"] if isinstance(q, int)]
    found = _per_part(spark, sf_dir, rows, "g string, q double")
    return found.select(F.concat("g", F.lit("_"), "k").alias("Name"), F.col("q").alias("Completeness"), F.lit(0.0).alias("Contamination"))


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(s, g) for s, shape in enumerate(SHAPES) for _, _, g, q in shape["tips"] if q == "ref"]
    found = _per_part(spark, sf_dir, rows, "g string")
    return found.select(F.concat("g", F.lit("_"), "k").alias("genome"), F.lit(LINEAGE).alias("taxonomy"))


def naming(spark: SparkSession, sf_dir: str) -> Naming:
    return Naming(cut(nodes(spark, sf_dir)), metadata(spark, sf_dir), (BACTERIA,))


# --- the results in SQL ----------------------------------------------------------------------------

_LETTERS = "pcofg"


def _sql(select: str, values: list[str], columns: str) -> str:
    return f"SELECT {select} FROM part JOIN (VALUES {', '.join(values)}) AS v(shape, {columns}) ON p_partkey % {len(SHAPES)} = shape"


def _id(genome: str) -> str:
    return f"'{genome}_' || p_partkey"


def _text(genome: str, parts: tuple) -> str:
    """SQL of a taxonomy string: start, then the genomes of the last ranks down to the genus, then the species."""
    start, *names = parts
    head = "'d__Bacteria'" if start is None else f"(p_partkey * {STRIDE} + {start.strip('{}')})"
    ranks = [f"'{letter}__' || {_id(name)}" for letter, name in zip(_LETTERS[5 - len(names) :], names, strict=True)]
    return " || ';' || ".join([head, *ranks, f"'s__' || {_id(names[-1])} || ' ' || {_id(genome)}"])


def _union(selects: list[str], none: str) -> str:
    return " UNION ALL ".join(selects) if selects else none


SQL_TAXONOMY = _union(
    [
        f"SELECT {_id(g)} AS genome, {_text(g, parts)} AS taxonomy FROM part WHERE p_partkey % {len(SHAPES)} = {s}"
        for s, shape in enumerate(SHAPES)
        for g, parts in shape["taxonomy"].items()
    ],
    "",
)


def _name_rows() -> list[str]:
    out = []
    for s, shape in enumerate(SHAPES):
        where = f"FROM part WHERE p_partkey % {len(SHAPES)} = {s}"
        for node, letter, g in shape["attached"]:
            out.append(f"SELECT p_partkey * {STRIDE} + {node} AS node, '{letter}__' || {_id(g)} AS clade, {_id(g)} AS genome_rep {where}")
        placed = {(letter, g) for _, letter, g in shape["attached"]}
        for g, (_, *names) in shape["taxonomy"].items():
            for letter, name in zip(_LETTERS[5 - len(names) :], names, strict=True):
                if name == g and (letter, g) not in placed:
                    out.append(f"SELECT CAST(NULL AS BIGINT), '{letter}__' || {_id(g)}, {_id(g)} {where}")
            out.append(f"SELECT CAST(NULL AS BIGINT), 's__' || {_id(names[-1])} || ' ' || {_id(g)}, {_id(g)} {where}")
    return out


@query("t10_t13_rare_taxonomy", SQL_TAXONOMY)
def rare_taxonomy(spark, sf_dir):
    return naming(spark, sf_dir).genomes


@query("t10_t13_rare_node_names", _union(_name_rows(), ""))
def rare_names(spark, sf_dir):
    return naming(spark, sf_dir).node_names


@query(
    "t8_rare_waiting_nodes",
    _union([f"SELECT p_partkey * {STRIDE} + {n} AS node FROM part WHERE p_partkey % {len(SHAPES)} = {s}" for s, shape in enumerate(SHAPES) for n in shape.get("waiting", [])], ""),
)
def rare_waiting(spark, sf_dir):
    return naming(spark, sf_dir).spans.where("deferred").select("node")


@query(
    "t22_rare_issues",
    _union([f"SELECT '{issue}' AS issue, {_id(g)} AS genome FROM part WHERE p_partkey % {len(SHAPES)} = {s}" for s, shape in enumerate(SHAPES) for issue, g in shape["issues"]], ""),
)
def rare_issues(spark, sf_dir):
    found = name_and_fill(cut(nodes(spark, sf_dir)), metadata(spark, sf_dir), taxonomy(spark, sf_dir), BACTERIA).issues
    return found.select("issue", "genome")


@query(
    "f3_rare_tree_checks",
    _union(
        [f"SELECT '{issue}' AS issue, p_partkey * {STRIDE} + {n} AS node FROM part WHERE p_partkey % {len(SHAPES)} = {s}" for s, shape in enumerate(SHAPES) for n, issue in shape.get("checks", [])]
        # the second copy of the reference trees' nodes and genomes
        + [f"SELECT 'duplicate_node', p_partkey * {STRIDE} + {n} FROM part WHERE p_partkey % {len(SHAPES)} = 1" for n in (0, 1, 2, 4, 5, 6)]
        + [f"SELECT 'duplicate_genome', p_partkey * {STRIDE} + {n} FROM part WHERE p_partkey % {len(SHAPES)} = 1" for n in (5, 6)],
        "",
    ),
)
def rare_checks(spark, sf_dir):
    """The trees of one shape are listed twice."""
    once = cut(nodes(spark, sf_dir))
    again = once.where(F.pmod(F.floor(F.col("node") / STRIDE), F.lit(len(SHAPES))) == 1)
    return tree_issues(once.unionByName(again)).select("issue", "node").distinct()


@query(
    "f3_rare_input_checks",
    "SELECT 'duplicate_metadata' AS issue, genome FROM (" + _union([f"SELECT {_id(g)} AS genome FROM part WHERE p_partkey % {len(SHAPES)} = 1" for g in ("g0", "g1")], "")
    + ") UNION ALL SELECT 'duplicate_taxonomy', " + _id("ref") + f" FROM part WHERE p_partkey % {len(SHAPES)} = 1"
    + f" UNION ALL SELECT 'missing_parent', {_id('k0')} FROM part WHERE p_partkey % {len(SHAPES)} = 5",
)
def rare_input_checks(spark, sf_dir):
    """Metadata and taxonomy of one shape are listed twice."""
    quality, lineages = metadata(spark, sf_dir), taxonomy(spark, sf_dir)
    quality = quality.unionByName(quality.where(F.col("Name").rlike("^g[01]_")))
    last = F.substring_index("genome", "_", -1).cast("bigint")
    lineages = lineages.unionByName(lineages.where(last % len(SHAPES) == 1))
    found = input_issues(cut(nodes(spark, sf_dir)), quality, lineages)
    return found.where(F.col("issue").isin("duplicate_metadata", "duplicate_taxonomy", "missing_parent")).select("issue", "genome")
