"""Queries over catalogues, labels, clade lists and Newick texts derived from the driver tables."""

from __future__ import annotations

import uuid
from functools import lru_cache

from pyspark.sql import functions as F

from cladeflow.functions import genomes as ids
from cladeflow.functions.labels import label_columns
from cladeflow.functions.ranks import novelty_red, rank_index, rank_word, red_rank, with_cutoffs
from cladeflow.functions.taxonomy import below_anchor
from cladeflow.operators.catalogue import build_catalogue, genome_batches, genome_metadata, trim_accessions
from cladeflow.operators.validate import label_issues
from cladeflow.operators.summary import clade_sources, counts_by_rank, summarise_clades, with_total
from cladeflow.params import preset
from cladeflow.session import cut, shared_folder
from cladeflow.sources import tsv
from cladeflow.sources.newick import newick_edges
from workload.inputs import NOVELTY, sql_double, sql_pick, sql_rank, table
from workload.registry import query

BACTERIA = preset("d__Bacteria")


def _scratch(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- catalogue ----------------------------------------------------------------------------------------

SQL_INFO = """
info AS (
  SELECT 'part_' || p_partkey AS "ID",
         CASE p_type WHEN 'ECONOMY' THEN 'd__Archaea;p__' || p_brand WHEN 'SMALL' THEN NULL
                     WHEN 'PROMO' THEN 'unclassified' ELSE 'd__Bacteria;p__' || p_brand END AS domain,
         CAST(50 + p_size AS DOUBLE) AS checkm2_completeness, p_size / 10e0 AS checkm2_contamination
  FROM part),
fasta AS (
  SELECT DISTINCT '/genomes/' || l_returnflag || '/part_' || l_partkey || '.fa.gz' AS fasta FROM lineitem),
catalogue AS (
  SELECT i."ID", i.domain, i.checkm2_completeness, i.checkm2_contamination, i."ID" || '.fa.gz' AS f, x.fasta
  FROM (SELECT "ID", checkm2_completeness, checkm2_contamination,
               CASE WHEN domain LIKE '%Archaea%' THEN 'archaea' WHEN domain LIKE '%Bacteria%' THEN 'bacteria'
                    ELSE 'unknown' END AS domain FROM info) i
  JOIN (SELECT fasta, regexp_extract(fasta, '([^/]+[.]fa[.]gz)$', 1) AS f FROM fasta) x ON x.f = i."ID" || '.fa.gz'
  WHERE i.domain <> 'unknown')"""


def info(spark, sf_dir):
    classification = (
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("d__Archaea;p__"), F.col("p_brand")))
        .when(F.col("p_type") == "SMALL", None)
        .when(F.col("p_type") == "PROMO", "unclassified")
        .otherwise(F.concat(F.lit("d__Bacteria;p__"), F.col("p_brand")))
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("ID"),
        classification.alias("domain"),
        (50 + F.col("p_size")).cast("double").alias("checkm2_completeness"),
        (F.col("p_size") / 10.0).alias("checkm2_contamination"),
    )


def fasta(spark, sf_dir):
    path = F.concat(
        F.lit("/genomes/"), F.col("l_returnflag"), F.lit("/part_"), F.col("l_partkey").cast("string"), F.lit(".fa.gz")
    )
    return table(spark, sf_dir, "lineitem").select(path.alias("fasta")).distinct()


@query(
    "p3_x10_domain_classes",
    f"""WITH {SQL_INFO} SELECT "ID", CASE WHEN domain LIKE '%Archaea%' THEN 'archaea'
        WHEN domain LIKE '%Bacteria%' THEN 'bacteria' ELSE 'unknown' END AS domain FROM info""",
)
def p3(spark, sf_dir):
    return info(spark, sf_dir).select("ID", ids.domain_of(F.col("domain")).alias("domain"))


@query("p4_x9_fasta_keys", f"WITH {SQL_INFO} SELECT fasta, regexp_extract(fasta, '([^/]+[.]fa[.]gz)$', 1) AS f FROM fasta")
def p4(spark, sf_dir):
    return fasta(spark, sf_dir).select("fasta", ids.fasta_file(F.col("fasta")).alias("f"))


@query("t18_j4_catalogue", f"WITH {SQL_INFO} SELECT * FROM catalogue")
def t18(spark, sf_dir):
    return build_catalogue(info(spark, sf_dir), fasta(spark, sf_dir))


@query("t19_s5_s6_domain_batches", f'WITH {SQL_INFO} SELECT domain, fasta, "ID" FROM catalogue')
def t19(spark, sf_dir):
    path = _scratch(spark, "batches")
    tsv.write_per_domain(genome_batches(build_catalogue(info(spark, sf_dir), fasta(spark, sf_dir))), path, header=False)
    return spark.read.schema("fasta string, ID string, domain string").option("sep", "\t").csv(path)


@query(
    "s2_p1_metadata_tsv",
    f"""WITH {SQL_INFO} SELECT "ID" AS "Name", checkm2_completeness AS "Completeness",
        checkm2_contamination AS "Contamination" FROM info""",
)
def s2(spark, sf_dir):
    path = _scratch(spark, "info")
    tsv.write_tsv(info(spark, sf_dir), path)
    return tsv.read_metadata(spark, path)


@query(
    "p1_p2_quality",
    f"""WITH {SQL_INFO} SELECT "ID" AS "Name", checkm2_completeness - 5 * checkm2_contamination AS quality FROM info""",
)
def p1(spark, sf_dir):
    scores = genome_metadata(info(spark, sf_dir))
    return scores.select("Name", ids.quality(F.col("Completeness"), F.col("Contamination")).alias("quality"))


@query(
    "t20_trim_accessions",
    """WITH ids AS (
         SELECT CASE o_orderstatus WHEN 'F' THEN 'RS_GCF_' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '.1'
                  WHEN 'O' THEN 'GB_GCA_' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '.2'
                  ELSE 'UBA' || o_orderkey END AS id, 'd__Bacteria;p__P' || o_custkey AS taxonomy FROM orders)
       SELECT nullif(regexp_extract(id, '(GC[AF]_[0-9]+)', 1), '') AS genome, taxonomy FROM ids""",
)
def t20(spark, sf_dir):
    number = F.lpad(F.col("o_orderkey").cast("string"), 9, "0")
    genome = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("RS_GCF_"), number, F.lit(".1")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("GB_GCA_"), number, F.lit(".2")))
        .otherwise(F.concat(F.lit("UBA"), F.col("o_orderkey").cast("string")))
    )
    lineage = F.concat(F.lit("d__Bacteria;p__P"), F.col("o_custkey").cast("string"))
    return trim_accessions(table(spark, sf_dir, "orders").select(genome.alias("genome"), lineage.alias("taxonomy")))


# --- clade lists ---------------------------------------------------------------------------------------------

SQL_CLADES = """
clades AS (
  SELECT p_partkey AS node, substr('pcofgs', p_size % 6 + 1, 1) || '__' || p_name AS clade,
         CASE p_brand WHEN 'Brand#1' THEN 'MGYG' || p_partkey WHEN 'Brand#2' THEN 'GWH' || p_partkey
           WHEN 'Brand#3' THEN 'GCA_' || p_partkey WHEN 'Brand#4' THEN 'GCF_' || p_partkey
           WHEN 'Brand#5' THEN NULL ELSE p_brand || '_' || p_partkey END AS genome_rep
  FROM part),
sources AS (
  SELECT * FROM (
    SELECT CASE WHEN starts_with(genome_rep, 'MGYG') THEN 'MGYG' WHEN starts_with(genome_rep, 'GWH') THEN 'GWH'
             ELSE nullif(regexp_extract(genome_rep, '^([^_]+)', 1), '') END AS magset, clade[1] AS taxon_novelty
    FROM clades) WHERE magset NOT IN ('GCA', 'GCF')),
counts AS (
  SELECT magset, count(*) FILTER (taxon_novelty = 'p') AS phyla, count(*) FILTER (taxon_novelty = 'c') AS classes,
         count(*) FILTER (taxon_novelty = 'o') AS orders, count(*) FILTER (taxon_novelty = 'f') AS families,
         count(*) FILTER (taxon_novelty = 'g') AS genera, count(*) FILTER (taxon_novelty = 's') AS species
  FROM sources GROUP BY magset),
total AS (
  SELECT 'all' AS magset, CAST(sum(phyla) AS BIGINT) AS phyla, CAST(sum(classes) AS BIGINT) AS classes,
         CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(families) AS BIGINT) AS families,
         CAST(sum(genera) AS BIGINT) AS genera, CAST(sum(species) AS BIGINT) AS species FROM counts HAVING count(*) > 0)"""


def clades(spark, sf_dir):
    key = F.col("p_partkey").cast("string")
    brand = F.col("p_brand")
    genome = (
        F.when(brand == "Brand#1", F.concat(F.lit("MGYG"), key))
        .when(brand == "Brand#2", F.concat(F.lit("GWH"), key))
        .when(brand == "Brand#3", F.concat(F.lit("GCA_"), key))
        .when(brand == "Brand#4", F.concat(F.lit("GCF_"), key))
        .when(brand != "Brand#5", F.concat(brand, F.lit("_"), key))
    )
    letter = F.substr(F.lit("pcofgs"), F.col("p_size") % 6 + 1, F.lit(1))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("node"),
        F.concat(letter, F.lit("__"), F.col("p_name")).alias("clade"),
        genome.alias("genome_rep"),
    )


@query("p5_f5_x11_clade_sources", f"WITH {SQL_CLADES} SELECT * FROM sources")
def p5(spark, sf_dir):
    return clade_sources(clades(spark, sf_dir))


@query("a2_source_rank_counts", f"WITH {SQL_CLADES} SELECT magset, taxon_novelty, count(*) AS n FROM sources GROUP BY ALL")
def a2(spark, sf_dir):
    return clade_sources(clades(spark, sf_dir)).groupBy("magset", "taxon_novelty").agg(F.count(F.lit(1)).alias("n"))


@query("a3_p6_p7_pivoted_counts", f"WITH {SQL_CLADES} SELECT * FROM counts")
def a3(spark, sf_dir):
    return counts_by_rank(clade_sources(clades(spark, sf_dir)))


@query("a4_u2_total_row", f"WITH {SQL_CLADES} SELECT * FROM total")
def a4(spark, sf_dir):
    return with_total(counts_by_rank(clade_sources(clades(spark, sf_dir)))).where("magset = 'all'")


@query("t17_o4_clade_summary", f"WITH {SQL_CLADES} SELECT * FROM counts UNION ALL SELECT * FROM total")
def t17(spark, sf_dir):
    return summarise_clades(clades(spark, sf_dir))


# --- labels and ranks --------------------------------------------------------------------------------------------

SQL_LABELS = """
labelled AS (
  SELECT o_orderkey AS key, o_orderkey % 6 AS kind, lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS digits FROM orders)"""


def labels(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    digits = F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0")
    kind = F.col("o_orderkey") % 6
    label = (
        F.when(kind == 0, F.concat(F.lit("ord_"), key))
        .when(kind == 1, F.concat(F.lit("0."), digits))
        .when(kind == 2, F.concat(F.lit("'0."), digits, F.lit(":g__G"), key, F.lit("'")))
        .when(kind == 3, F.concat(F.lit("'0."), digits, F.lit(":g__G"), key, F.lit("|RED=0."), digits, F.lit("'")))
        .when(kind == 4, F.concat(F.lit("'ord_"), key, F.lit("|RED=1.000'")))
        .otherwise("")
    )
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), label.alias("label"))


@query(
    "x3_x7_label_issues",
    """SELECT o_orderkey AS key,
         CASE o_orderkey % 4 WHEN 0 THEN 'red_cut' WHEN 1 THEN 'number_as_genome' ELSE 'bootstrap_lost' END AS issue,
         CASE o_orderkey % 4 WHEN 0 THEN TRY_CAST('0.1234' || o_orderkey AS DOUBLE) END AS full_red,
         CASE o_orderkey % 4 WHEN 1 THEN TRY_CAST('0.9876' || o_orderkey AS DOUBLE) WHEN 2 THEN 100e0 END AS full_bootstrap
       FROM orders WHERE o_orderkey % 4 < 3""",
)
def label_numbers(spark, sf_dir):
    """Labels with numbers longer than tree files usually have; a fourth of them has none."""
    key = F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % 4
    label = (
        F.when(kind == 0, F.concat(F.lit("'ord_"), key, F.lit("|RED=0.1234"), key, F.lit("'")))
        .when(kind == 1, F.concat(F.lit("0.9876"), key))
        .when(kind == 2, F.concat(F.lit("'100:g__G"), key, F.lit("'")))
        .otherwise(F.lit("'0.9:g__G|RED=0.123'"))
    )
    found = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("node"), label.alias("label"))
    parts = label_columns(F.col("genome"), full=True)
    return label_issues(found).select(
        F.col("node").alias("key"), "issue", parts["RED"].alias("full_red"), parts["bootstrap"].alias("full_bootstrap")
    )


@query(
    "x3_x4_x5_x6_x7_labels",
    f"""WITH {SQL_LABELS} SELECT key,
          CASE kind WHEN 3 THEN TRY_CAST('0.' || digits AS DOUBLE) WHEN 4 THEN 1e0 END AS "RED",
          CASE WHEN kind IN (1, 2, 3) THEN TRY_CAST('0.' || digits AS DOUBLE) END AS bootstrap,
          CASE WHEN kind IN (2, 3) THEN 'g__G' || key END AS taxa,
          CASE WHEN kind IN (0, 4) THEN 'ord_' || key END AS genome FROM labelled""",
)
def x3(spark, sf_dir):
    return labels(spark, sf_dir).select("key", *[column.alias(name) for name, column in label_columns(F.col("label")).items()])


@query(
    "x1_red_bins",
    f"""WITH reds AS (SELECT o_orderkey, o_totalprice / 5e5 AS red FROM orders),
        ranked AS (SELECT *, {sql_rank("red", BACTERIA)} AS rank FROM reds)
        SELECT o_orderkey, rank, {sql_pick("rank", NOVELTY["d__Bacteria"])} AS novelty_red FROM ranked""",
)
def x1(spark, sf_dir):
    red = F.col("o_totalprice") / 500000.0
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        red_rank(red, BACTERIA.upper_edges).alias("rank"),
        novelty_red(red, BACTERIA).alias("novelty_red"),
    )


@query(
    "x8_x12_x13_rank_words",
    f"""WITH reds AS (SELECT o_orderkey, o_totalprice / 5e5 AS red FROM orders)
        SELECT o_orderkey, {sql_rank("red", BACTERIA)} AS rank,
          {sql_pick(sql_rank("red", BACTERIA), ["'phylum'", "'class'", "'order'", "'family'", "'genus'", "'species'"])} AS word
        FROM reds""",
)
def x8(spark, sf_dir):
    word = rank_word(novelty_red(F.col("o_totalprice") / 500000.0, BACTERIA))
    return table(spark, sf_dir, "orders").select("o_orderkey", rank_index(word).alias("rank"), word.alias("word"))


@query(
    "x2_w1_a5_j6_rank_tables",
    """WITH medians AS (
         SELECT domain, rank, least(lowest / 1e6 + rank / 1e1, 1e0) AS median_red
         FROM (SELECT n_name AS domain, min(o_totalprice) AS lowest, unnest([0, 1, 2, 3, 4, 5]) AS rank FROM orders
               JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)),
       cutoffs AS (
         SELECT *, CASE WHEN lead(median_red) OVER w IS NULL THEN 1e0
                        ELSE (median_red + lead(median_red) OVER w) / 2 END AS cutoff_red
         FROM medians WINDOW w AS (PARTITION BY domain ORDER BY rank))
       SELECT domain, rank, median_red, cutoff_red FROM cutoffs""",
)
def x2(spark, sf_dir):
    # One set of medians per nation, from its cheapest order.
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("domain"))
    lowest = (
        orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
        .join(nations, F.col("c_nationkey") == nations["n_nationkey"])
        .groupBy("domain")
        .agg(F.min("o_totalprice").alias("lowest"))
    )
    medians = lowest.select("domain", "lowest", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("rank")).select(
        "domain",
        "rank",
        F.lit("Rank").alias("title"),
        F.least(F.col("lowest") / 1000000.0 + F.col("rank") / 10.0, F.lit(1.0)).alias("median_red"),
    )
    return with_cutoffs(medians).select("domain", "rank", "median_red", "cutoff_red")


@query(
    "x14_x15_x16_prefix_cleaning",
    """SELECT p_partkey, CASE WHEN contains(s, ';') THEN substr(s, strpos(s, ';') + 1) ELSE '' END AS rest,
              round(abs(p_retailprice - 1000e0) / 7e0) AS distance
       FROM (SELECT p_partkey, p_retailprice, CASE WHEN p_type = 'SMALL' THEN CAST(p_partkey AS VARCHAR)
                    ELSE p_partkey || ';g__' || p_brand || ';s__' || p_name END AS s FROM part)""",
)
def x14(spark, sf_dir):
    key = F.col("p_partkey").cast("string")
    string = F.when(F.col("p_type") == "SMALL", key).otherwise(
        F.concat(key, F.lit(";g__"), F.col("p_brand"), F.lit(";s__"), F.col("p_name"))
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        below_anchor(string).alias("rest"),
        F.round(F.abs(F.col("p_retailprice") - 1000.0) / 7.0).alias("distance"),
    )


# --- Newick ----------------------------------------------------------------------------------------------------

SQL_LINES = """
lines AS (
  SELECT l_orderkey AS tree_id, l_returnflag AS flag,
         'l' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS label, l_quantity AS branch_length,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag, l_linenumber, l_partkey, l_suppkey,
                            l_quantity, l_extendedprice, l_shipdate) AS tip,
         count(*) OVER (PARTITION BY l_orderkey) AS tips,
         dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag) AS clade
  FROM lineitem)"""


@lru_cache(maxsize=4)
def newick_texts(spark, sf_dir):
    """One tree per order: its lines as tips, grouped by return flag (an order has few lines)."""
    lines = table(spark, sf_dir, "lineitem")
    tip = F.concat(
        F.lit("l"),
        F.col("l_linenumber").cast("string"),
        F.lit("_"),
        F.col("l_partkey").cast("string"),
        F.lit("_"),
        F.col("l_suppkey").cast("string"),
        F.lit(":"),
        F.col("l_quantity").cast("int").cast("string"),
    )
    in_order = ["l_returnflag", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    orders = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(*in_order, tip.alias("tip")))).alias("lines"))
    flags = F.array_distinct(F.transform("lines", lambda line: line["l_returnflag"]))

    def clade(flag):
        own = F.filter("lines", lambda line: line["l_returnflag"].eqNullSafe(flag))
        tips = F.array_join(F.transform(own, lambda line: line["tip"]), ",")
        return F.concat(F.lit("("), tips, F.lit(")'0.5:"), flag, F.lit("|RED=0.500':1"))

    text = F.concat(
        F.lit("("),
        F.array_join(F.transform(flags, clade), ","),
        F.lit(")order"),
        F.col("l_orderkey").cast("string"),
        F.lit(";"),
    )
    return cut(orders.select(F.col("l_orderkey").alias("tree_id"), text.alias("newick")))


@query(
    "s8_newick_edges",
    f"""WITH {SQL_LINES}
        SELECT tree_id, tips + 1 + clade AS parent, tip AS node, branch_length, label FROM lines
        UNION ALL
        SELECT DISTINCT tree_id, tips + 1, tips + 1 + clade, 1e0, '''0.5:' || flag || '|RED=0.500''' FROM lines
        UNION ALL
        SELECT DISTINCT tree_id, tips + 1, tips + 1, CAST(NULL AS DOUBLE), 'order' || tree_id FROM lines""",
)
def s8(spark, sf_dir):
    return newick_edges(newick_texts(spark, sf_dir))
