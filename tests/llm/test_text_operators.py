"""Contracts against plain Python on small tables with nulls, empty, long and repeated rows."""

import random

import pytest
from brute import TEXTS, contamination, held, quality_counts, repeated, sha, unigram
from pyspark.sql import functions as F

from cladeflow.llm import decontamination, lm_scoring, quality_rules, substring_dedup


def corpus(seed=1, size=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    shared = [[rng.choice(vocabulary) for _ in range(n)] for n in (34, 35, 36, 50, 90)]
    texts = list(TEXTS)
    for _ in range(size):
        own = [rng.choice(vocabulary) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(own))
            own[at:at] = rng.choice(shared)
        texts.append(rng.choice([" ", "\n", "  "]).join(own))
    return texts + texts[-3:] + ["a b " * 60, " ".join(shared[4][10:70])]


def test_substring_dedup(spark):
    texts = corpus()
    frame = spark.createDataFrame([(k, t, "x", 1, k, "m") for k, t in enumerate(texts)], "doc_id bigint, text string, n_words string, first int, key bigint, marks string")
    found = substring_dedup.remove_repeated(frame)
    assert found.columns == ["doc_id", "first", "key", "marks", "n_words", "n_removed", "kept_sha256", "text"]
    rows = sorted(found.collect(), key=lambda r: r.doc_id)
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in rows] == repeated(texts)
    assert all(sha((r.text or "").split()) == r.kept_sha256 for r in rows if "\xa0" not in (r.text or ""))
    assert {r.n_removed for r in rows} > {0}
    untouched = [(r.text or "", texts[r.doc_id] or "") for r in rows if not r.n_removed]
    assert all(a == b for a, b in untouched)


@pytest.mark.parametrize("window", [3, 12])
def test_substring_dedup_other_windows(spark, window):
    texts = corpus(2, 25)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = sorted(substring_dedup.remove_repeated(frame, window=window, keep_text=False).collect())
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in rows] == repeated(texts, window)


def test_substring_dedup_repeated_rows_and_empty_table(spark):
    long = " ".join(f"v{k}" for k in range(40))
    frame = spark.createDataFrame([(1, long), (1, long), (None, None)], "doc_id bigint, text string")
    assert sorted(r.n_removed for r in substring_dedup.remove_repeated(frame).collect()) == [0, 40, 40]
    assert substring_dedup.remove_repeated(frame.limit(0)).count() == 0


@pytest.mark.parametrize("max_chars", [4_000_000, 200])
def test_decontamination(spark, max_chars):
    rng = random.Random(3)
    vocabulary = [f"q{k}" for k in range(50)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 5, 13, 14, 30])))) for k in range(12)]
    items += [(3, items[4][1]), (20, None), (21, "?!"), (None, "q1 q2")]
    texts = [t for t in TEXTS]
    for _ in range(40):
        own = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        part = rng.choice(items[:12])[1].split()[rng.randint(0, 3) :]
        at = rng.randint(0, len(own))
        own[at:at] = part
        texts.append(rng.choice([" ", ", ", "--"]).join(w.upper() if rng.random() < 0.3 else w for w in own))
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id bigint, text string, items string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontamination.find_items(docs, bench, max_chars=max_chars).collect()
    usable = [(k, t) for k, t in items if k is not None]
    for r in rows:
        n, hit, found = contamination(texts[r.doc_id], usable)
        assert (r.n_words, r.n_hit, set(r["items"])) == (n, len(hit), found)
        for span in r.spans:
            assert not contamination(r.text[span.begin : span.end], usable)[0] < 1
    assert {bool(r.n_hit) for r in rows} == {True, False}
    assert decontamination.find_items(docs.limit(0), bench).count() == 0
    assert {r.n_hit for r in decontamination.find_items(docs, bench.limit(0)).collect()} == {0}


def test_quality_counts(spark):
    texts = corpus(4, 30) + ["a\nb\na\n \na", "ÄÖ ÄÖ ÄÖ ÄÖ ÄÖ", "x <y> | $5 & 7%"]
    frame = spark.createDataFrame([(k, t, 7) for k, t in enumerate(texts)], "doc_id bigint, text string, n_lines int")
    for r in quality_rules.counts(frame).collect():
        own = quality_counts(texts[r.doc_id])
        assert tuple(r[c] for c in quality_rules.BASE) == own
        assert r.base_failed == (own[0] < 50 or 100 * own[4] > 50 * own[0])
    assert quality_rules.counts(frame.limit(0)).count() == 0


def test_quality_cutoffs_keep_their_promise(spark):
    """One stratum with enough labels and a clear rule, one with too few labels, one without; ties at one value."""
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(2400):
        bad = k % 4 == 0
        own = [f"u{rng.randrange(10**6)}" for _ in range(60)]
        if bad:
            own = [w + "%" for w in own[:50]] + own[50:]
        lang = "aa" if k < 2300 else "bb" if k < 2380 else None
        rows.append((k, " ".join(own), lang))
        labels.append((k, 0 if bad else 1))
    labels += [(0, 0), (1, None), (None, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    table = spark.createDataFrame(labels, "doc_id bigint, quality int")
    measured = quality_rules.counts(docs)
    limits = {r.stratum: r for r in quality_rules.cutoffs(measured, table).collect()}
    assert limits["aa"].symbols_per_word is not None and limits["bb"].symbols_per_word is None and set(limits) == {"aa", "bb", ""}
    kept = {r.doc_id for r in quality_rules.apply_rules(docs, table).where("kept").collect()}
    assert kept == {k for k in range(2400) if k % 4 or k >= 2300}
    assert quality_rules.apply_rules(docs, table.limit(0)).where("not kept").count() == 0
    assert not quality_rules.certified(0, 50, 0.01, 0.05) and quality_rules.certified(0, 300, 0.01, 0.05)
    assert quality_rules.certified(2, 800, 0.01, 0.05) and not quality_rules.certified(3, 700, 0.01, 0.05)


def test_lm_scoring(spark):
    rng = random.Random(6)
    rows = [(k, t) for k, t in enumerate(TEXTS)]
    for k in range(len(rows), 150):
        lang = k % 2
        own = [f"{'äß'[j % 2] if lang else ''}t{min(rng.randrange(60), rng.randrange(60))}{'.' if rng.random() < 0.2 else ''}" for j in range(rng.randint(1, 80))]
        rows.append((k, " ".join(own) + " THE End"))
    docs = spark.createDataFrame([(*r, 1, None) for r in rows], "doc_id bigint, text string, score int, word string")
    learn = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 1")
    found = lm_scoring.score(docs, learn, head=20).collect()
    plain = unigram(rows, lambda d: not held(d, 1))
    for r in found:
        n, known, total, base = plain[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    unseen = [r for r in found if held(r.doc_id, 1)]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
    assert lm_scoring.score(docs.limit(0), learn).count() == 0
    assert all(r.n_known == 0 for r in lm_scoring.score(docs, learn.limit(0)).collect())


def test_lm_training_reads_all_rows_in_each_round(spark):
    import numpy as np

    rng = random.Random(8)
    texts = [" ".join(rng.choice(["aa", "bbb", "cc.", "dd,", "eee", "ü"]) for _ in range(rng.randint(1, 30))) for _ in range(30)] + ["aa bbb aa bbb cc."] * 20
    frame = spark.createDataFrame([(t,) for t in texts], "_text string").repartition(3)
    vocabulary = lm_scoring.build_vocabulary(lm_scoring.count_tokens(frame))
    (_, packed, at, _), = lm_scoring.Tokens(vocabulary).blocks([t.encode() for t in texts])
    prior = np.where(np.isfinite(vocabulary.prior), vocabulary.prior * np.log(10), -30.0)
    seen = np.zeros((lm_scoring.BUCKETS, lm_scoring.CLASSES))
    for row in at:
        np.add.at(seen, (row, packed & 0xFF), 1)
    smooth = lm_scoring.SMOOTH * np.exp(prior) + 1e-9
    weights = 0.4 * np.log((seen + smooth) / (seen.sum(axis=1, keepdims=True) * np.exp(prior) + smooth))
    for _ in range(2):
        p = np.exp(weights[at].sum(axis=0) + prior)
        p /= p.sum(axis=1, keepdims=True)
        modelled = np.zeros_like(seen)
        for row in at:
            np.add.at(modelled, row, p)
        weights = weights + (seen - modelled) / (np.maximum(seen, modelled) + lm_scoring.SMOOTH) / 2
    assert np.abs(lm_scoring.train(frame, vocabulary, 2)[:-1] - weights).max() < 1e-3


def test_lm_probabilities_sum_to_one():
    import numpy as np

    vocabulary = lm_scoring.Vocabulary({b"": 3, b"a": 5, b"b": 2}, 12, 5, {b"": 0, b"a": 1, b"b": 2}, np.zeros(lm_scoring.CLASSES))
    words = {b"": 3, b"a": 5, b"b": 2, b"cc": 1, b"dd.": 1}
    mass = np.zeros(lm_scoring.CLASSES)
    for w, n in words.items():
        mass[vocabulary.class_of(w)] += n + 0.5
    with np.errstate(divide="ignore"):
        vocabulary.prior = np.log10(mass / mass.sum())
    weights = np.random.default_rng(0).normal(0, 1, (lm_scoring.BUCKETS + 1, lm_scoring.CLASSES)).astype(np.float32)
    weights[-1] = np.where(mass > 0, 0, -60)
    at = np.random.default_rng(1).integers(0, lm_scoring.BUCKETS, (lm_scoring.FEATURES, 1)).astype(np.uint16)
    (_, raised, total), = lm_scoring.softmax(weights, at)
    chance = np.log10(raised[0] / total[0]) - np.where(mass > 0, vocabulary.prior, 0)
    known = sum(10 ** (float(vocabulary.base(n)) + chance[vocabulary.class_of(w)]) for w, n in words.items())
    assert known + 10 ** float(vocabulary.base(0)) == pytest.approx(1, abs=1e-5)


def test_lm_contexts_by_three_classes_equal_the_four_features():
    import numpy as np

    rng = np.random.default_rng(3)
    packed = rng.integers(0, lm_scoring.CLASSES + 1, 5000) | rng.integers(0, 1 << 24, 5000) << 8
    real = np.arange(3, 5000)
    weights = rng.normal(0, 1, (lm_scoring.BUCKETS + 1, lm_scoring.CLASSES)).astype(np.float32)
    near, far = lm_scoring.class_buckets()
    four, three = lm_scoring.features(packed, real), lm_scoring.contexts(packed, real)
    assert (four == [three[0], near[three[2]], far[three[2]], three[1]]).all()
    plain = lm_scoring.softmax(weights, four)
    for (part, raised, total), (_, raised3, total3) in zip(plain, lm_scoring.softmax(weights, three, *lm_scoring.tables(weights)), strict=True):
        assert np.allclose(raised, raised3, rtol=1e-4) and np.allclose(total, total3, rtol=1e-4)


def test_places_in_the_grid_take_one_short_expression(spark, monkeypatch, capsys):
    """A comparison for each rule and cutoff made plans that fill the driver."""
    rows = [(k, float(v)) for k, v in enumerate([0, -1, 0.005, 1e9, *quality_rules.GRID, *(c * 1.0001 for c in quality_rules.GRID)])]
    found = spark.createDataFrame(rows, "k int, v double").select("k", "v", quality_rules._place(F.col("v")).alias("place")).collect()
    assert [r.place for r in found] == [sum(r.v <= c for c in quality_rules.GRID) for r in found]
    docs = spark.createDataFrame([(k, "some words! " * (30 + k)) for k in range(8)], "doc_id bigint, text string").withColumn("lang", F.lit("aa"))
    labels = spark.createDataFrame([(k, k % 2) for k in range(8)], "doc_id bigint, quality int")
    monkeypatch.setattr(quality_rules, "cut", lambda frame: frame)
    capsys.readouterr()
    quality_rules.cutoffs(quality_rules.counts(docs), labels).explain()
    assert capsys.readouterr().out.count("<=") <= 10
