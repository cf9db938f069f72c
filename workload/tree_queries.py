"""Queries over the derived trees: traversals, naming, fill."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cladeflow.functions.ranks import rank_table
from cladeflow.operators.annotate import annotate_nodes, flag_reference
from cladeflow.operators.fill import Fill, prefix_votes, vote_prefix
from cladeflow.operators.naming import naming_paths
from cladeflow.operators.ordering import enumerate_genomes, with_quality
from cladeflow.operators.tree import (
    ancestors,
    child_counts,
    depths,
    descendants,
    naming_groups,
    new_tips,
    paint_groups,
    paths,
    with_parent,
)
from cladeflow.operators.summary import PLURALS
from cladeflow.operators.validate import tree_issues
from cladeflow.plans.run import name_and_fill
from cladeflow.session import shared_folder
from cladeflow.sources import tsv
from workload import inputs
from workload.inputs import NOVELTY, PARAMS, sql_pick, sql_rank, sql_tree
from workload.naming_sql import sql_facts, sql_filled, sql_naming
from workload.registry import query

TREE = "irregular"


def _with(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes} {select}"


def _scratch(spark, name: str) -> str:
    """A new place in the shared folder for a round trip through files."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- sources ----------------------------------------------------------------------------------------


@query(
    "s1_tree_tsv",
    _with(sql_tree(TREE), 'SELECT parent, node, nongtdb_group, genome, magset, "RED", novelty_red FROM nodes'),
)
def s1(spark, sf_dir):
    path = _scratch(spark, "tree")
    tsv.write_nodes(inputs.nodes(spark, sf_dir, TREE), path)
    names = ("parent", "node", "nongtdb_group", "genome", "magset", "RED", "novelty_red")
    return tsv.read_nodes(spark, path, {name: tsv.schemas.NODES[name] for name in names})


@query("s4_node_names_tsv", _with(sql_naming(TREE), "SELECT node, clade, genome_rep FROM node_names"))
def s4(spark, sf_dir):
    path = _scratch(spark, "node_names")
    tsv.write_tsv(inputs.naming(spark, sf_dir, TREE).node_names, path)
    return tsv.read_node_names(spark, path)


@query("s3_taxonomy_headerless", _with(sql_tree(TREE), "SELECT genome, taxonomy FROM taxonomy"))
def s3(spark, sf_dir):
    path = _scratch(spark, "taxonomy")
    tsv.write_tsv(inputs.taxonomy(spark, sf_dir, TREE), path, header=False)
    return tsv.read_taxonomy(spark, path)


@query(
    "s7_rank_table_counts",
    _with(
        sql_tree(TREE),
        "SELECT novelty_red AS label, count(*) AS n FROM nodes WHERE novelty_red IS NOT NULL GROUP BY 1",
    ),
)
def s7(spark, sf_dir):
    ranks = rank_table(spark, PARAMS[TREE]).select("label")
    nodes = inputs.nodes(spark, sf_dir, TREE)
    return nodes.join(ranks, nodes["novelty_red"] == ranks["label"]).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


# --- selections, joins ---------------------------------------------------------------------------------


@query("f1_f2_new_tips", _with(sql_tree(TREE), "SELECT node, genome FROM nodes WHERE genome IS NOT NULL AND magset <> 'GTDB'"))
def f1(spark, sf_dir):
    return new_tips(inputs.nodes(spark, sf_dir, TREE)).select("node", "genome")


@query(
    "f6_any_all_children",
    _with(
        sql_tree(TREE),
        """SELECT parent AS node, bool_or(nongtdb_group = 'gtdb') AS any_reference,
                  bool_and(nongtdb_group = 'gtdb') AS all_reference FROM nodes WHERE node <> parent GROUP BY parent""",
    ),
)
def f6(spark, sf_dir):
    reference = F.col("nongtdb_group") == "gtdb"
    return (
        inputs.nodes(spark, sf_dir, TREE)
        .where("node <> parent")
        .groupBy(F.col("parent").alias("node"))
        .agg(F.bool_or(reference).alias("any_reference"), F.bool_and(reference).alias("all_reference"))
    )


@query(
    "j1_p2_genome_quality",
    _with(sql_naming(TREE), "SELECT genome, quality FROM tips"),
)
def j1(spark, sf_dir):
    nodes, metadata = inputs.nodes(spark, sf_dir, TREE), inputs.metadata(spark, sf_dir, TREE)
    return with_quality(nodes, metadata).select("genome", "quality")


@query("w2_o1_genome_order", _with(sql_naming(TREE), "SELECT genome, ord AS genome_order FROM tips"))
def w2(spark, sf_dir):
    nodes, metadata = inputs.nodes(spark, sf_dir, TREE), inputs.metadata(spark, sf_dir, TREE)
    return enumerate_genomes(with_quality(nodes, metadata).select("genome", "quality")).select("genome", "genome_order")


@query(
    "j2_ordered_tree_genomes",
    _with(sql_naming(TREE), "SELECT node, genome, ord AS genome_order FROM tips"),
)
def j2(spark, sf_dir):
    nodes, metadata = inputs.nodes(spark, sf_dir, TREE), inputs.metadata(spark, sf_dir, TREE)
    ordered = enumerate_genomes(with_quality(nodes, metadata).select("genome", "quality"))
    return nodes.join(ordered, "genome").select("node", "genome", "genome_order")


@query(
    "j3_f4_descendant_lineages",
    _with(
        sql_tree(TREE),
        """SELECT p.ancestor, x.genome, x.taxonomy FROM path p JOIN nodes a ON a.node = p.ancestor
           JOIN nodes n ON n.node = p.node JOIN taxonomy x ON x.genome = n.genome WHERE a.novelty_red LIKE 'Order%'""",
    ),
)
def j3(spark, sf_dir):
    nodes = inputs.nodes(spark, sf_dir, TREE)
    wanted = nodes.where(F.col("novelty_red").startswith("Order")).select("node")
    below = descendants(nodes, wanted)
    tips = nodes.where(F.col("genome").isNotNull()).select("node", "genome")
    return (
        tips.join(inputs.taxonomy(spark, sf_dir, TREE), "genome").join(below, "node").select("ancestor", "genome", "taxonomy")
    )


@query(
    "j5_p6_p8_reference_flags",
    _with(sql_tree(TREE), "SELECT node, genome, magset FROM nodes"),
)
def j5(spark, sf_dir):
    plain = inputs.nodes(spark, sf_dir, TREE).select("node", "genome")
    return flag_reference(plain, inputs.taxonomy(spark, sf_dir, TREE)).select("node", "genome", "magset")


@query(
    "j7_t4_parent_red",
    _with(
        sql_tree(TREE),
        """SELECT n.node, n."RED" AS red, CASE WHEN n.node = n.parent THEN 0e0 ELSE p."RED" END AS parent_red,
                  p.novelty_red AS parent_novelty FROM nodes n JOIN nodes p ON n.parent = p.node""",
    ),
)
def j7(spark, sf_dir):
    linked = with_parent(inputs.nodes(spark, sf_dir, TREE), ["RED", "novelty_red"])
    return linked.select(
        "node",
        F.col("RED").alias("red"),
        F.when(F.col("node") == F.col("parent"), 0.0).otherwise(F.col("parent_RED")).alias("parent_red"),
        F.col("parent_novelty_red").alias("parent_novelty"),
    )


@query(
    "j8_t3_internal_children",
    _with(
        sql_tree(TREE),
        "SELECT parent AS node, count(*) AS n_int FROM nodes WHERE genome IS NULL AND node <> parent GROUP BY parent",
    ),
)
def j8(spark, sf_dir):
    return child_counts(inputs.nodes(spark, sf_dir, TREE))


# --- traversals ---------------------------------------------------------------------------------------------


_NEW_TIPS = "node IN (SELECT node FROM nodes WHERE genome IS NOT NULL AND magset <> 'GTDB')"


@query("t1_ancestors", _with(sql_tree("balanced"), f"SELECT node, ancestor, distance FROM path WHERE {_NEW_TIPS}"))
def t1(spark, sf_dir):
    nodes = inputs.nodes(spark, sf_dir, "balanced")
    return ancestors(nodes, new_tips(nodes))


@query(
    "t1_ancestor_paths",
    _with(
        sql_tree(TREE),
        f"""SELECT node, string_agg(CAST(ancestor AS VARCHAR), '>' ORDER BY distance) AS parents
            FROM path WHERE {_NEW_TIPS} GROUP BY node""",
    ),
)
def t1_paths(spark, sf_dir):
    nodes = inputs.nodes(spark, sf_dir, TREE)
    listed = paths(ancestors(nodes, new_tips(nodes)))
    return listed.select("node", F.array_join(F.col("parents").cast("array<string>"), ">").alias("parents"))


@query(
    "t1_depths_of_turns",
    """SELECT conv_id * 1000000 + turn AS node, turn AS depth FROM conversations""",
)
def t1_depths(spark, sf_dir):
    # Long chains: each turn of a conversation hangs below the one before.
    turns = inputs.table(spark, sf_dir, "conversations").select("conv_id", "turn")
    node = F.col("conv_id") * 1000000 + F.col("turn")
    return depths(turns.select(node.alias("node"), F.when(F.col("turn") == 0, node).otherwise(node - 1).alias("parent")))


@query("t1_depths", _with(sql_tree(TREE), "SELECT node, depth FROM nodes"))
def t1_tree_depths(spark, sf_dir):
    return depths(inputs.nodes(spark, sf_dir, TREE))


@query(
    "t2_descendants",
    _with(
        sql_tree(TREE),
        """SELECT p.ancestor, p.node FROM path p JOIN nodes a ON a.node = p.ancestor
           WHERE a.novelty_red LIKE 'Order%' OR a.novelty_red LIKE 'Class%'""",
    ),
)
def t2(spark, sf_dir):
    nodes = inputs.nodes(spark, sf_dir, TREE)
    wanted = nodes.where(F.col("novelty_red").startswith("Order") | F.col("novelty_red").startswith("Class"))
    return descendants(nodes, wanted.select("node"))


@query("t6_paint_groups", _with(sql_tree(TREE), "SELECT node, nongtdb_group FROM nodes"))
def t6(spark, sf_dir):
    return paint_groups(inputs.nodes(spark, sf_dir, TREE).drop("nongtdb_group")).select("node", "nongtdb_group")


@query(
    "t6_naming_groups",
    _with(
        sql_naming(TREE),
        """SELECT t.genome, coalesce(arg_max(p.ancestor, p.distance) FILTER (NOT f.gtdb), t.node) AS top
           FROM tips t JOIN path p ON p.node = t.node JOIN facts f ON f.node = p.ancestor GROUP BY t.genome, t.node""",
    ),
)
def t6_groups(spark, sf_dir):
    return naming_groups(inputs.nodes(spark, sf_dir, TREE)).select("genome", "top")


# --- naming ----------------------------------------------------------------------------------------------


@query(
    "t5_naming_bounds",
    _with(
        sql_facts(TREE),
        """SELECT node, CASE WHEN gtdb THEN NULL ELSE top END AS upper, rank AS own FROM facts""",
    ),
)
def t5(spark, sf_dir):
    facts = inputs.naming(spark, sf_dir, TREE).facts
    return facts.select("node", F.when(~F.col("gtdb"), F.col("top")).alias("upper"), F.col("rank").alias("own"))


@query("t7_closer_to_median", _with(sql_facts(TREE), "SELECT node, closer FROM facts"))
def t7(spark, sf_dir):
    return inputs.naming(spark, sf_dir, TREE).facts.select("node", "closer")


@query(
    "t8_naming_spans",
    _with(sql_facts(TREE), "SELECT node, first, last, deferred FROM spans"),
)
def t8(spark, sf_dir):
    return inputs.naming(spark, sf_dir, TREE).spans.select("node", "first", "last", "deferred")


@query("t8_naming_spans_balanced", _with(sql_facts("balanced"), "SELECT node, first, last, deferred FROM spans"))
def t8_balanced(spark, sf_dir):
    return inputs.naming(spark, sf_dir, "balanced").spans.select("node", "first", "last", "deferred")


@query("t9_passed_over", _with(sql_facts(TREE), "SELECT node, n_int, passed_over FROM facts"))
def t9(spark, sf_dir):
    return inputs.naming(spark, sf_dir, TREE).facts.select("node", "n_int", "passed_over")


@query(
    "t10_a7_winners",
    _with(sql_naming(TREE), "SELECT n.node, r.genome AS winner_genome FROM named n JOIN records r ON r.ord = n.winner"),
)
def t10(spark, sf_dir):
    return inputs.naming(spark, sf_dir, TREE).named.select("node", "winner_genome")


@query(
    "t10_naming_paths",
    _with(
        sql_facts(TREE),
        """SELECT b.node, 1 + count(c.node) AS steps FROM bearing b LEFT JOIN path p ON p.node = b.node
           LEFT JOIN bearing c ON c.node = p.ancestor GROUP BY b.node""",
    ),
)
def t10_paths(spark, sf_dir):
    run = inputs.naming(spark, sf_dir, TREE)
    return naming_paths(run.spans, run.landings).select("node", F.size("steps").cast("bigint").alias("steps"))


@query("t11_anchors", _with(sql_naming(TREE), "SELECT genome, a AS anchor_rank, anchor FROM final WHERE a >= 0"))
def t11(spark, sf_dir):
    run = inputs.naming(spark, sf_dir, TREE)
    anchored = run.resolved.where("settled and anchor is not null")
    return anchored.select("genome", "anchor_rank", run.keys.node(F.col("anchor")).alias("anchor"))


@query(
    "t12_inherited_ranks",
    _with(
        sql_naming(TREE),
        """SELECT r.genome, g.genome AS source_genome, r.inherits FROM records r JOIN records g ON g.ord = r.source""",
    ),
)
def t12(spark, sf_dir):
    records = inputs.naming(spark, sf_dir, TREE).records
    sources = records.select(F.col("ord").alias("source"), F.col("genome").alias("source_genome"))
    return records.join(sources, "source").select("genome", "source_genome", "inherits")


@query(
    "t13_own_names",
    _with(
        sql_naming(TREE),
        "SELECT r.genome, o.rank FROM own o JOIN records r ON r.ord = o.ord WHERE o.kept",
    ),
)
def t13(spark, sf_dir):
    records = inputs.naming(spark, sf_dir, TREE).records
    return records.select("genome", F.explode("kept").alias("rank"))


@query("t14_species_names", _with(sql_naming(TREE), "SELECT genome, clade AS species FROM species"))
def t14(spark, sf_dir):
    names = inputs.naming(spark, sf_dir, TREE).node_names
    return names.where(F.col("clade").startswith("s__")).select(F.col("genome_rep").alias("genome"), F.col("clade").alias("species"))


for _tree in PARAMS:

    @query(f"t15_genome_taxonomy_{_tree}", _with(sql_naming(_tree), "SELECT genome, taxonomy FROM genome_taxonomy"))
    def t15(spark, sf_dir, tree=_tree):
        return inputs.naming(spark, sf_dir, tree).genomes

    @query(f"t10_t13_node_names_{_tree}", _with(sql_naming(_tree), "SELECT node, clade, genome_rep FROM node_names"))
    def t13_names(spark, sf_dir, tree=_tree):
        return inputs.naming(spark, sf_dir, tree).node_names

    @query(f"t16_fill_taxonomy_{_tree}", _with(sql_filled(_tree), "SELECT genome, taxonomy FROM filled_taxonomy"))
    def t16(spark, sf_dir, tree=_tree):
        return _fill(spark, sf_dir, tree).genomes

    @query(f"t16_u1_filled_names_{_tree}", _with(sql_filled(_tree), "SELECT node, clade, genome_rep FROM filled_names"))
    def t16_names(spark, sf_dir, tree=_tree):
        return _fill(spark, sf_dir, tree).node_names


def _fill(spark, sf_dir, tree, mode="least_common"):
    run = inputs.naming(spark, sf_dir, tree)
    return Fill(
        inputs.nodes(spark, sf_dir, tree), run.genomes, run.node_names, inputs.taxonomy(spark, sf_dir, tree), (PARAMS[tree],), mode
    )


@query(
    "a1_prefix_votes",
    _with(
        sql_tree(TREE),
        """SELECT p.ancestor AS node, regexp_extract(x.taxonomy, '(.*);f__', 1) AS lineage, count(*) AS votes
           FROM path p JOIN nodes a ON a.node = p.ancestor JOIN nodes n ON n.node = p.node
           JOIN taxonomy x ON x.genome = n.genome WHERE a.nongtdb_group = 'gtdb' GROUP BY ALL""",
    ),
)
def a1(spark, sf_dir):
    nodes = inputs.nodes(spark, sf_dir, TREE)
    wanted = nodes.where("genome is null and nongtdb_group = 'gtdb'").select("node", F.lit(3).alias("rank"))
    votes = prefix_votes(nodes, wanted, inputs.taxonomy(spark, sf_dir, TREE))
    return votes.select("node", "lineage", "votes")


@query(
    "a6_o3_rarest_prefix",
    _with(
        sql_tree(TREE),
        """SELECT node, prefix FROM (
             SELECT p.ancestor AS node, regexp_extract(x.taxonomy, '(.*);g__', 1) AS prefix, count(*) AS votes
             FROM path p JOIN nodes a ON a.node = p.ancestor JOIN nodes n ON n.node = p.node
             JOIN taxonomy x ON x.genome = n.genome WHERE a.nongtdb_group = 'gtdb' GROUP BY ALL)
           QUALIFY row_number() OVER (PARTITION BY node ORDER BY votes, prefix) = 1""",
    ),
)
def a6(spark, sf_dir):
    nodes = inputs.nodes(spark, sf_dir, TREE)
    wanted = nodes.where("genome is null and nongtdb_group = 'gtdb'").select(
        "node", F.lit(4).alias("rank"), F.lit(False).alias("bare")
    )
    votes = prefix_votes(nodes, wanted, inputs.taxonomy(spark, sf_dir, TREE))
    return vote_prefix(votes, wanted).select("node", "prefix")


@query(
    "t21_annotated_nodes",
    _with(
        sql_tree("balanced"),
        f""", labelled AS (
             SELECT *, CASE WHEN genome IS NULL THEN floor("RED" * 1000) / 1000e0 ELSE 1e0 END AS shown FROM nodes)
           SELECT parent, node, (node % 10) / 10e0 AS branch_length, shown AS "RED",
             CASE WHEN genome IS NOT NULL THEN NULL WHEN node % 2 = 0 THEN (node % 1000) / 1000e0 ELSE 1e0 END AS bootstrap,
             CASE WHEN genome IS NULL AND node % 2 = 0 THEN 'g__G' || node END AS taxa,
             genome, magset, nongtdb_group,
             {sql_pick(sql_rank("shown", PARAMS["balanced"]), NOVELTY["d__Archaea"])} AS novelty_red FROM labelled""",
    ),
)
def t21(spark, sf_dir):
    raw = inputs.raw_nodes(spark, sf_dir, "balanced")
    return annotate_nodes(raw, inputs.taxonomy(spark, sf_dir, "balanced"), PARAMS["balanced"]).drop("label")


def _both(select: str) -> str:
    """The same over both trees: the irregular one's CTEs are nested in a subquery of their own."""
    parts = []
    for tree, params in PARAMS.items():
        inner = _with(sql_filled(tree), select.format(domain=params.domain))
        parts.append(f"SELECT * FROM ({inner})")
    return " UNION ALL ".join(parts)


def _run_both(spark, sf_dir):
    return name_and_fill(
        inputs.both_nodes(spark, sf_dir),
        inputs.both_metadata(spark, sf_dir),
        inputs.both_taxonomies(spark, sf_dir),
        list(PARAMS.values()),
    )


@query("t22_both_domains", _both("SELECT '{domain}' AS domain, genome, taxonomy FROM filled_taxonomy"))
def t22(spark, sf_dir):
    return _run_both(spark, sf_dir).genome_taxonomy


@query("t22_both_domains_names", _both("SELECT '{domain}' AS domain, node, clade, genome_rep FROM filled_names"))
def t22_names(spark, sf_dir):
    return _run_both(spark, sf_dir).node_names


_COUNTS = ", ".join(f"count(*) FILTER (taxon_novelty = '{n[0]}') AS {n}" for n in PLURALS)


@query(
    "t17_domain_summary",
    f"""WITH names AS ({_both("SELECT '{domain}' AS domain, clade, genome_rep FROM filled_names")}),
        sources AS (
          SELECT domain, CASE WHEN genome_rep LIKE 'MGYG%' THEN 'MGYG' WHEN genome_rep LIKE 'GWH%' THEN 'GWH'
                   ELSE nullif(regexp_extract(genome_rep, '^([^_]+)', 1), '') END AS magset, clade[1] AS taxon_novelty
          FROM names)
        SELECT domain, CASE WHEN grouping(magset) = 1 THEN 'all' ELSE magset END AS magset, {_COUNTS}
        FROM sources WHERE magset NOT IN ('GCA', 'GCF') GROUP BY GROUPING SETS ((domain, magset), (domain))""",
)
def t17_domains(spark, sf_dir):
    return _run_both(spark, sf_dir).clade_summary


@query(
    "t22_issues",
    _with(sql_filled(TREE), "SELECT 'no_phylum' AS issue, genome FROM final WHERE NOT settled"),
)
def t22_issues(spark, sf_dir):
    return name_and_fill(
        inputs.nodes(spark, sf_dir, TREE),
        inputs.metadata(spark, sf_dir, TREE),
        inputs.taxonomy(spark, sf_dir, TREE),
        PARAMS[TREE],
    ).issues.select("issue", "genome")


@query(
    "f3_tree_checks",
    _with(
        sql_tree(TREE),
        """SELECT 'rank_decreasing' AS issue, n.node FROM nodes n JOIN nodes p ON n.parent = p.node
             WHERE n.genome IS NULL AND n.nongtdb_group = 'nongtdb' AND n.rank < p.rank
           UNION ALL
           SELECT 'red_not_increasing', n.node FROM nodes n JOIN nodes p ON n.parent = p.node
             WHERE n.genome IS NULL AND n.nongtdb_group = 'nongtdb' AND n.node <> n.parent AND n."RED" <= p."RED"
               AND n.rank = p.rank AND n.rank < 5
           UNION ALL
           SELECT 'duplicate_node', node FROM nodes GROUP BY node HAVING count(*) > 1""",
    ),
)
def f3(spark, sf_dir):
    return tree_issues(inputs.nodes(spark, sf_dir, TREE)).select("issue", "node")
