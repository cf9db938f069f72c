"""The registered queries over the smallest tables, against plain Python."""

import hashlib

import pyarrow.parquet as pq
import pytest
from brute import contamination, held, quality_counts, repeated, unigram
from test_simhash_dedup import plain_groups

from cladeflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    table = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    return list(zip(table["doc_id"], table["text"], strict=True))


def rows(spark, name):
    return {r[0]: r for r in QUERIES[name](spark, SF).collect()}


def test_op2(spark, documents):
    found = rows(spark, "op2_simhash_near_dedup")
    assert [(d, found[d].fingerprint, found[d].component_id) for d in sorted(found)] == plain_groups(documents)


def test_op4(spark, documents):
    table = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()
    items = list(zip(table["item_id"], table["text"], strict=True))
    found = rows(spark, "op4_benchmark_decontamination")
    for d, text in documents[::4]:
        n, hit, owned = contamination(text, items)
        digest = hashlib.sha256(",".join(sorted(map(str, owned))).encode()).hexdigest()
        assert tuple(found[d])[1:] == (n, len(hit), len(owned), digest, bool(hit) and 20 * len(hit) >= n)


def test_op5(spark, documents):
    found = rows(spark, "op5_substring_dedup")
    assert [tuple(found[d])[1:] for d, _ in documents] == repeated([t for _, t in documents])


def test_op8(spark, documents):
    found = rows(spark, "op8_quality_rules")
    for d, text in documents:
        own = quality_counts(text)
        failed = own[0] < 50 or 100 * own[4] > 50 * own[0]
        assert tuple(found[d])[1:7] == (*own, failed) and not (failed and found[d].kept)


def test_op10(spark, documents):
    found = rows(spark, "op10_lm_scoring")
    plain = unigram(documents, lambda d: not held(d, 1))
    for d, _ in documents:
        n, known, total, base = plain[d]
        assert (found[d].held_out, found[d].n_tokens, found[d].n_known, found[d].train_tokens) == (held(d, 1), n, known, total)
        assert found[d].base_score == pytest.approx(base, rel=1e-9)


def test_stages_release_what_the_driver_holds(spark, monkeypatch):
    """Before each stage, and in mixing once its sample is fitted."""
    import corpus_pipeline
    from cladeflow.llm import mixing

    calls = []
    monkeypatch.setattr(corpus_pipeline, "release", lambda: calls.append("driver"))
    monkeypatch.setattr(corpus_pipeline, "tidy_workers", lambda spark: calls.append("workers"))
    corpus_pipeline._stage(lambda spark, docs, sf_dir: calls.append("work"))(spark, None, "")
    assert calls == ["driver", "workers", "work"]
    monkeypatch.setattr(mixing, "release", lambda: calls.append("mixing"))
    docs = spark.createDataFrame([(k, f"word{k % 3} and {k}") for k in range(12)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2, int(k % 3 == 0)) for k in range(12)], "doc_id bigint, quality int, toxic int")
    assert mixing.mix(docs, labels).count() == 12 and calls[-1] == "mixing"
