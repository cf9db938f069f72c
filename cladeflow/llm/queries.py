"""The operators over their whole tables, with SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import uuid

from cladeflow.llm import decontamination, hard_negatives, html_extraction, lm_scoring, mixing, packing, periodic_runs, quality_classifier, quality_rules, simhash_dedup, substring_dedup, token_counts, toxicity
from cladeflow.llm.common import bounded_batches, held_out
from cladeflow.session import cut, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run

    return register


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@_query(
    "op4_benchmark_decontamination",
    r"""
WITH w AS (
    SELECT doc_id, list_filter(string_split_regex(regexp_replace(lower_az, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS ws
    FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents)
), i AS (
    SELECT item_id, list_filter(string_split_regex(regexp_replace(lower_az, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS ws
    FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM benchmark)
), p AS (
    SELECT item_id, least(len(ws), 13) AS n, array_to_string(ws[k : k + least(len(ws), 13) - 1], ' ') AS said
    FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 13, 0) + 2)) AS k FROM i WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT n FROM p),
d AS (
    SELECT doc_id, k, n, array_to_string(ws[k : k + n - 1], ' ') AS said
    FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM w, sizes WHERE len(ws) >= n)
), hits AS (SELECT DISTINCT doc_id, item_id, k, d.n FROM d JOIN p USING (n, said)),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS j FROM hits) GROUP BY 1),
owners AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS said
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(said, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN owners USING (doc_id)
""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_items(documents, _read(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


@_query(
    "op5_substring_dedup",
    r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (
    SELECT doc_id, k, md5(array_to_string(ws[k : k + 34], ' ')) AS said
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS k FROM d WHERE len(ws) >= 35)
), again AS (SELECT said FROM w GROUP BY said HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 35)) AS j FROM w JOIN again USING (said)),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS said, count(*) AS n
    FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM d) ANTI JOIN gone USING (doc_id, j) GROUP BY 1
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(said, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeated(documents, keep_text=False)


@_query("op2_simhash_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.groups(_read(spark, sf_dir, "documents").select("doc_id", "text"))


@_query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = cut(quality_rules.counts(_read(spark, sf_dir, "documents").select("doc_id", "text", "lang")).drop("text"))
    limits = quality_rules.cutoffs(measured, _read(spark, sf_dir, "labels"))
    return quality_rules.judge(measured, limits).select("doc_id", *quality_rules.BASE, "base_failed", "kept")


@_query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents").select("doc_id", "text")
    network = toxicity.fit(documents.where(~held_out("doc_id", 0)), _read(spark, sf_dir, "labels"))
    return toxicity.apply(documents.withColumn("held_out", held_out("doc_id", 0)), network)


@_query("op10_lm_scoring")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out("doc_id", 1))
    return lm_scoring.score(documents, documents.where("not held_out"))


@_query("op7_html_extraction")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extraction.main_text(_read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", "n_chars")


@_query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six batches, one of them delivered twice: provisional counts, true counts, toxic documents taken out and put back,
    and another tokenizer version, provisional and revised."""
    version, other = "byte_bpe_50k", "byte_bpe_multi_50k"
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("bigint")
    documents = _read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    counted = cut(
        documents.select(
            "doc_id", "source", "lang", F.coalesce(words, F.lit(0)).alias("words"), token_counts.token_counter(spark, version)("text").alias("n"),
            token_counts.token_counter(spark, other)("text").alias("m"),
        )
    )
    toxic = _read(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    disputed = counted.join(toxic, "doc_id", "left_semi")
    rollup = token_counts.Rollup(spark, f"{shared_folder(spark)}/rollup-{uuid.uuid4().hex}")
    rollup.commit("1-load", token_counts.inserted(counted, version, F.col("words")))
    rollup.commit("2-count", token_counts.revised(counted, version, F.col("words"), F.col("n")))
    rollup.commit("3-dispute", token_counts.deleted(disputed, version, F.col("n")))
    rollup.commit("2-count", token_counts.revised(counted, version, F.col("words"), F.col("n")))
    rollup.commit("4-settle", token_counts.inserted(disputed, version, F.col("n")))
    rollup.commit("5-load-other", token_counts.inserted(counted, other, F.col("n")))
    rollup.commit("6-count-other", token_counts.revised(counted, other, F.col("n"), F.col("m")))
    return rollup.totals()


@_query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's url names its document by the last number of its path; documents without page have source and language."""
    labels = _read(spark, sf_dir, "labels")
    read = cut(quality_classifier.evidence(_read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"), labels))
    path = F.regexp_extract("url", r"^\w+://[^/]+(/[^?#]*)", 1)
    pages = _read(spark, sf_dir, "pages").select(
        F.expr("try_cast(regexp_extract(url, '/([0-9]+)(?:[./][^?#]*)?(?:[?#].*)?$', 1) AS BIGINT)").alias("doc_id"),
        F.struct(html_extraction.host_of(F.col("url")).alias("host"), F.regexp_extract(path, "^/([^/]*)/", 1).alias("path")).alias("site"),
    )
    sites = pages.where("doc_id is not null").groupBy("doc_id").agg(F.min("site").alias("site"))
    sited = read.join(sites, "doc_id", "left").select(
        "doc_id", "evidence", F.coalesce("site.host", "source").alias("host"), F.coalesce("site.path", "lang").alias("path")
    )
    return quality_classifier.combine(sited, labels)


@_query("op9_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "labels")
    domains = list(mixing.TARGETS)
    model = mixing.fit_domains(documents, labels, mixing.label_domain(), domains)
    members = cut(mixing.posterior(documents, model).drop("text"))
    gaps = mixing.fit_rates(members, np.array(list(mixing.TARGETS.values())))
    return mixing.shown(mixing.with_rates(members, gaps), domains)


@_query("op11_best_fit_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def looped(words: list[bytes], seed: int) -> list[bytes]:
    """One text in ten, by its seed, goes over to repeating a stretch of its own words."""
    g, rest = divmod(seed, 10)
    if rest:
        return words
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    stretch = words[a : a + p]
    return words[:a] + (stretch * ((len(words) - a) // p + 1))[: len(words) - a]


@_query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents").select("doc_id", "text")
    seed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return periodic_runs.find_runs(documents, rewrite=looped, seed=seed).drop("runs")


@_query("op13_hard_negatives")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0, label=label)
