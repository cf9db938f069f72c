"""Classifiers by held-out accuracy, rollups and mixing by their sums, wrappers on hand-made hosts, the pipeline's stages."""

import random

import numpy as np
import pytest
import xxhash
from brute import contamination, held, quality_counts, repeated
from pyspark.sql import functions as F
from test_simhash_dedup import plain_groups

import corpus_pipeline
from cladeflow.llm import contrast, html_extraction, mixing, quality_classifier, queries, token_counts, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def labelled_corpus(size=700, seed=1):
    """(doc_id, text, lang, source, n_chars), (doc_id, quality, toxic)"""
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdgkl" for b in "aeiou" for c in "mnrst"]
    rows, labels = [], []
    for k in range(size):
        own = [rng.choice(words) for _ in range(rng.randint(60, 140))]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                own[rng.randrange(len(own))] = rng.choice(["zwarq", "zwarqen", "vyxxit", "jjuko,"])
        poor = k % 7 == 0
        if poor:
            own = [w.upper() + "!!" for w in own]
        text = " ".join(own)
        rows.append((k, text, "en" if k % 2 else "de", f"s{k % 3}", len(text)))
        labels.append((k, 0 if poor else 1, 1 if toxic else 0))
    return rows, labels


ODD = [(900, None, None, None, None), (901, "", "en", "s0", 0), (902, "x " * 5000, "en", "s1", 10000), (903, "same words here", "en", "s1", 15), (903, "same words here", "en", "s1", 15)]


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = labelled_corpus()
    return spark.createDataFrame(rows + ODD, SCHEMA), spark.createDataFrame([*labels, (900, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")


def test_toxicity_on_rows_held_out(spark, tables):
    docs, labels = tables
    network = toxicity.fit(docs.where("doc_id % 4 <> 0"), labels)
    scored = {r.doc_id: r for r in toxicity.apply(docs.withColumn("score", F.lit("x")), network).collect()}
    assert len(scored) == docs.select("doc_id").distinct().count()
    truth = {r.doc_id: r.toxic for r in labels.where("toxic is not null and doc_id is not null").collect()}
    unseen = [d for d in truth if d % 4 == 0]
    assert np.mean([scored[d].predicted == truth[d] for d in unseen]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scored.values())
    assert scored[900].score == scored[901].score
    assert toxicity.apply(docs.limit(0), network).count() == 0
    assert max(r.score for r in toxicity.apply(docs, toxicity.fit(docs, labels.limit(0))).collect()) < 1e-9


def test_site_quality(spark, tables):
    docs, labels = tables
    sited = docs.withColumn("host", F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("h"), F.col("doc_id") % 3))).withColumn("path", F.col("lang")).withColumn("n", F.lit("x"))
    known = labels.where("doc_id % 4 <> 0")
    read = quality_classifier.evidence(sited, known)
    found = quality_classifier.combine(read, known)
    assert found.count() == docs.count() and "n" not in read.drop("n").columns
    truth = {r.doc_id: r.quality for r in labels.where("doc_id % 4 = 0 and quality is not null").collect()}
    kept = {r.doc_id: r.kept for r in found.collect()}
    assert np.mean([kept[d] == bool(q) for d, q in truth.items()]) > 0.95
    assert quality_classifier.combine(read.limit(0), known).count() == 0
    none = quality_classifier.combine(quality_classifier.evidence(sited, labels.limit(0)), labels.limit(0))
    assert all(r.score == pytest.approx(0.5) for r in none.collect())


def test_sites_shrink_towards_the_level_above(spark):
    """No evidence; rates of two hosts differ, a path of one document follows its host."""
    rows = [(k, 0.0, "good" if k < 300 else "bad", "p") for k in range(600)] + [(600, 0.0, "good", "q"), (601, 0.0, "bad", "q"), (602, 0.0, "new", "p")]
    labels = [(k, int((k < 300) == (k % 10 > 0)), None) for k in range(600)]
    read = spark.createDataFrame(rows, "doc_id bigint, evidence double, host string, path string")
    found = {r.doc_id: r for r in quality_classifier.combine(read, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()}
    assert found[600].score > 0.8 and found[601].score < 0.2 and 0.3 < found[602].score < 0.7
    assert quality_classifier.strength(1, 10, 100, 1.0, 0.0) == 1e6


def test_token_rollup(spark, tables, tmp_path):
    docs, _ = tables
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open("/opt/tokenizers/byte_bpe_50k.tiktoken", "rb"))}
    encoding = tiktoken.Encoding("t", pat_str=token_counts.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = spark.createDataFrame([(1000, "ab  cd\n\n e's <|endoftext|> 12 é", "fr", None, 1)], SCHEMA)
    counted = docs.unionByName(odd).withColumn("n", token_counts.token_counter(spark)("text"))
    counted.write.parquet(str(tmp_path / "counted"))
    counted = spark.read.parquet(str(tmp_path / "counted"))
    assert all(r.n == len(encoding.encode_ordinary(r.text or "")) for r in counted.collect())
    rollup = token_counts.Rollup(spark, str(tmp_path / "rollup"))
    assert rollup.totals().count() == 0
    n = F.col("n")
    assert rollup.commit("a", token_counts.inserted(counted, "v1", n))
    assert not rollup.commit("a", token_counts.inserted(counted, "v1", n))
    gone = counted.where("doc_id % 2 = 0")
    assert rollup.commit("b", token_counts.deleted(gone, "v1", n))
    assert rollup.commit("c", token_counts.revised(counted.where("doc_id % 2 = 1"), "v1", n, n + 3))
    assert rollup.commit("d", token_counts.inserted(counted.limit(0), "v2", n))
    plain = {}
    for r in counted.where("doc_id % 2 = 1").collect():
        old = plain.get((r.source, r.lang), (0, 0))
        plain[r.source, r.lang] = (old[0] + 1, old[1] + r.n + 3)
    assert {(r.source, r.lang): (r.docs, r.tokens) for r in rollup.totals().collect()} == plain
    assert rollup.committed() == ["a", "b", "c", "d"]


def test_rates_reach_targets(spark, tables):
    docs, labels = tables
    mixed = mixing.mix(docs, labels, targets={"good": 0.8, "poor": 0.15, "toxic": 0.05})
    rows = mixed.collect()
    total = sum(r.n_tokens for r in rows)
    for domain, share in (("good", 0.8), ("poor", 0.15), ("toxic", 0.05)):
        assert sum(r.n_tokens * r.rate * r[f"p_{domain}"] for r in rows) / total == pytest.approx(share, abs=0.01)
    assert all(0 <= r.rate <= mixing.MOST and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    assert mixed.columns[:5] == docs.columns and {r.n_tokens for r in rows if r.doc_id in (900, 901)} == {0}
    assert mixing.mix(docs.limit(0), labels).count() == 0


def test_targets_out_of_reach_are_reported(spark):
    members = spark.createDataFrame([(100, [1.0, 0.0])] * 9 + [(100, [0.0, 1.0])], "_tokens bigint, _posterior array<double>")
    with pytest.warns(UserWarning, match="miss the targets"):
        mixing.fit_rates(members, np.array([0.1, 0.9]), steps=3)


def test_a_pass_of_the_rates_is_one_sum(spark):
    """No sort, and no more jobs than the sum's two stages; rows of any batch size give the same gaps."""
    rng = np.random.default_rng(9)
    p, tokens = rng.dirichlet([0.5, 0.5, 0.5], 400), rng.integers(1, 50, 400)
    members = spark.createDataFrame([(int(n), q.tolist()) for n, q in zip(tokens, p, strict=True)], "_tokens bigint, _posterior array<double>")
    target, plain = np.array([0.5, 0.3, 0.2]), []
    for _ in range(3):
        plain.append((tokens * mixing.rates(p, plain)[1]) @ p / tokens.sum() - target)
    sc = spark.sparkContext
    sc.setJobGroup("rates", "rates")
    try:
        with pytest.warns(UserWarning, match="miss the targets"):
            gaps = mixing.fit_rates(members, target, steps=3, gap=0.0)
    finally:
        sc._jsc.clearJobGroup()
    assert np.allclose(gaps, plain, atol=1e-12)
    assert len(sc.statusTracker().getJobIdsForGroup("rates")) <= 2 * 4


def test_a_pass_of_the_rates_is_one_stage(spark):
    """Plans and events of sixty passes fill the driver: each is one job of one stage, and all tasks' sums count."""
    rng = np.random.default_rng(10)
    p, tokens = rng.dirichlet([0.5, 0.5], 300), rng.integers(1, 50, 300)
    members = spark.createDataFrame([(int(n), q.tolist()) for n, q in zip(tokens, p, strict=True)], "_tokens bigint, _posterior array<double>")
    sc = spark.sparkContext
    sc.setJobGroup("passes", "passes")
    try:
        sums, total = mixing._expected(members.repartition(5).localCheckpoint(), [], 2, 4.0, 0.001)
        before = {*sc.statusTracker().getJobIdsForGroup("passes")}
        again, _ = mixing._expected(members, [np.array([0.1, -0.1])], 2, 4.0, 0.001)
        jobs = {*sc.statusTracker().getJobIdsForGroup("passes")} - before
    finally:
        sc._jsc.clearJobGroup()
    assert np.allclose(sums, [tokens @ p] * 2) and total == tokens.sum()
    assert np.allclose(again, [(tokens * r) @ p for r in mixing.rates(p, [np.array([0.1, -0.1])])])
    assert [len(sc.statusTracker().getJobInfo(j).stageIds) for j in jobs] == [1]


def test_words_are_hashed_together_as_one_by_one():
    words = [b"Haanth.", b"'", b"!!", "\u00e9treeAU".encode(), b"\xff\xc3", b"12ab\x1cCD", b"a"]
    def plain(w):
        bare, kinds = w.lower().strip(contrast._OUTER), w.translate(contrast._KIND)
        return [xxhash.xxh64_intdigest(x) % contrast.BUCKETS for x in (bare, b"^" + bare[:5], b"#" + kinds[:2] + kinds[-4:])]

    assert contrast.buckets(words).tolist() == [plain(w) for w in words] and contrast.buckets([]).shape == (0, 3)


def test_mixing_stage_keeps_all_documents(spark, tables, tmp_path):
    docs, labels = tables
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    mixed = corpus_pipeline.mix(spark, docs, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in mixed) == sorted(str(r.doc_id) for r in docs.collect())
    assert any(r.copies == 0 for r in mixed)


def test_rates_solve_the_least_squares():
    """Against plain projected gradients with stored rates."""
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.4, 0.4, 0.4], 300)
    tokens, target = rng.integers(1, 100, 300).astype(float), np.array([0.7, 0.2, 0.1])
    gaps = []
    for _ in range(400):
        point = mixing.rates(p, gaps, 2.0, 0.01)[1]
        gaps.append((tokens * point) @ p / tokens.sum() - target)
    plain = np.ones(300)
    for _ in range(20000):
        plain = np.clip(plain - (p @ ((tokens * plain) @ p / tokens.sum() - target) + 0.01 * (plain - 1)) / 1.01, 0, 2)
    assert np.abs(mixing.rates(p, gaps, 2.0, 0.01)[0] - plain).max() < 1e-3


ARTICLE = "<article><header><h1>{0}</h1></header><p>Body {0} one,<br>two &amp; &eacute;<p>Third <b>bold</b>text<form>Your mail</form><div class='comments'><p>I say</div></article>"
LAYOUTS = [
    ("<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><a href=/>Home</a></nav><div class='cookie-notice'>We use</div>"
     + ARTICLE + "<aside>More</aside><footer>&copy; x</footer><script>var a='</p>'</script></body></html>", "{0} Body {0} one, two & é Third boldtext"),
    ("<body><div id=menu><ul><li><a>A</a><li><a>B</a></ul></div><div id=content><h2>{0}</h2><p>Long {0} text  here\n with\tblanks</p><ul><li>item {0}<li>next</ul><p>End</p></div>"
     "<div class='sidebar widget'>Ads {0} and more words than the text itself has, to lead astray the reader {0}</div></body>", "{0} Long {0} text here with blanks item {0} next End"),
]


def test_wrappers(spark):
    rows, expected = [], {}
    for host, (page, text) in enumerate(LAYOUTS):
        for k in range(6):
            word = "w" * (k + 1) * 9
            rows.append((host * 100 + k, f"https://u@H{host}.example:80/p/{k}?q", page.replace("{0}", word)))
            expected[host * 100 + k] = text.replace("{0}", word)
    rows += [(500, None, None), (501, "http://h0.example/x", ""), (502, "odd", "just <b>text"), (503, "odd", "<p>a<p>a"), (503, "odd", "<p>a<p>a"), (None, "odd", "<p>z")]
    expected |= {500: "", 501: "", 502: "just text", 503: "a a", None: "z"}
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, path string")
    found = html_extraction.main_text(pages)
    assert found.columns == ["page_id", "url", "path", "text", "n_chars"] and found.count() == len(rows)
    for r in found.collect():
        assert (r.text, r.n_chars) == (expected[r.page_id], len(expected[r.page_id])), r.page_id
    assert html_extraction.main_text(pages.limit(0)).count() == 0


def test_simple_tree_matching():
    def slot(html):
        return html_extraction.Slot(html_extraction.parse(html), False)

    a, b = slot("<div><p>x</p><ul><li>1</ul></div>"), slot("<div><h1>t</h1><p>y</p><ul><li>2<li>3</ul></div>")
    assert html_extraction.matching(a, b)[0] == 5  # page, div, p, ul, li
    html_extraction.align(a, b)
    assert [c.key for c in a.children[0].children] == ["h1", "p", "ul"] and len(a.children[0].children[1].own) == 2


@pytest.mark.parametrize("block", ["<div class=para>{0}</div>", "<section>{0}</section>", "<blockquote>{0}</blockquote>", "<table><tr><td>{0}</td></tr><tr><td>{0} too</td></tr></table>"])
def test_repeated_siblings_are_all_read(spark, block):
    rows = [(k, "http://h.org/", f"<body><div id=content>{block.format(f'First words {k}')}{block.format(f'second words {k}')}</div></body>") for k in range(4)]
    rows.append((9, "http://alone.org/", f"<body><div id=content>{block.format('First words 9')}{block.format('second words 9')}</div></body>"))
    for r in html_extraction.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect():
        both = [f"First words {r.page_id}", f"second words {r.page_id}"]
        assert r.text == " ".join(f"{x} {x} too" if "table" in block else x for x in both)


def test_rare_layout_and_repeated_constants(spark):
    """60 pages with one layout, two with another that has the first one's content node as a teaser, on one host."""
    fixed = "<ul id=facts><li>A long line that all pages have and that is no part of the text</li><li>Another such line, as long as the first one</li></ul>"
    rows = [(k, "http://h.org/", f"<body>{fixed}<div id=content><p>Text {k} of the page, with words</p></div></body>") for k in range(60)]
    rows += [(k, "http://h.org/", f"<body><div id=content>See {k}</div><div id=story><p>{f'Story {k} goes on and on. ' * 9}</p></div></body>") for k in (60, 61)]
    for r in html_extraction.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)).collect():
        assert r.text == (f"Text {r.page_id} of the page, with words" if r.page_id < 60 else (f"Story {r.page_id} goes on and on. " * 9).strip()), r.page_id


def test_pipeline_stages(spark, tables, tmp_path):
    docs, labels = tables
    passage = " ".join(f"pass{k}" for k in range(60))
    item = " ".join(f"item{k}" for k in range(20))
    rows = [(800 + k, f"{' '.join(f'n{k}_{j}' for j in range(80))} {passage}", "en", "s0", 1) for k in range(3)]
    rows += [(810, " ".join(f"c{j}" for j in range(100)) + " " + item, "en", "s0", 1), (811, docs.where("doc_id = 1").first().text, "en", "s0", 1)]
    # a clean document that holds the passage in small part stays
    docs = docs.where("not (text is null)").dropDuplicates(["doc_id"]).unionByName(spark.createDataFrame(rows, SCHEMA))
    for name, frame in (("documents", docs), ("labels", labels), ("benchmark", spark.createDataFrame([(1, item)], "item_id bigint, text string"))):
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
    sf_dir, now = str(tmp_path), spark.read.parquet(str(tmp_path / "documents.parquet"))
    before = {r.doc_id: r.text for r in now.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, sf_dir)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"stage{k}"))
        now = spark.read.parquet(str(tmp_path / f"stage{k}"))
        after = {r.doc_id: r.text for r in now.collect()}
        if name == "quality_rules":
            failed = {d for d, t in before.items() for c in [quality_counts(t)] if c[0] < 50 or 100 * c[4] > 50 * c[0]}
            assert failed.isdisjoint(after) and {800, 810, 811} <= set(after)
        if name == "near_duplicates":
            assert set(after) == {g for *_, g in plain_groups(list(before.items()))} and 811 not in after
        if name == "repeated_passages":
            order = sorted(before)
            left = {d: w - r for d, (w, r, _) in zip(order, repeated([before[d] for d in order]), strict=True)}
            assert {d: len(t.split()) for d, t in after.items()} == {d: n for d, n in left.items() if n or not before[d].split()}
            assert "pass30" not in after[800] and "n0_79" in after[800]
        if name == "benchmark_passages":
            gone = {d for d, t in before.items() for n, hit, _ in [contamination(t, [(1, item)])] if hit and 20 * len(hit) >= n}
            assert set(after) == set(before) - gone and 810 in gone
        before = after
    assert set(corpus_pipeline.run(spark, sf_dir).columns) == set(now.columns)


def test_queries_run_on_the_given_tables(spark):
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 11)}
    rows = queries.QUERIES["op6_toxicity"](spark, "/root/testdata/sf0.001").collect()
    assert all(r.held_out == held(r.doc_id, 0) for r in rows) and len({r.doc_id for r in rows}) == len(rows)


def test_op3_counts_both_tokenizer_versions(spark):
    rows = queries.QUERIES["op3_token_counts"](spark, "/root/testdata/sf0.001").collect()
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for version in ("byte_bpe_50k", "byte_bpe_multi_50k"):
        plain = documents.select(F.sum(token_counts.token_counter(spark, version)("text"))).first()[0]
        own = [r for r in rows if r.tokenizer == version]
        assert (sum(r.docs for r in own), sum(r.tokens for r in own)) == (documents.count(), plain)
