"""Groups against all pairs on small inputs."""

import numpy as np
import pytest
import xxhash

from cladeflow.llm import simhash_dedup


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(rows, radius=4):
    prints = {doc: plain_fingerprint(text) for doc, text in rows}
    root = {doc: doc for doc in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    docs = sorted(prints)
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((d, f"{prints[d]:016x}", find(d)) for d in docs)


def test_groups_are_those_of_all_pairs(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(0, None), (1, ""), (2, " \n "), (3, "one"), (4, "One"), (5, "two words"), (6, "É a b c d"), (7, "é a b c d")]
    for k in range(8, 150):
        words = list(rng.choice(vocabulary, 120)) if k < 60 else list(rows[8 + k % 50][1].split())
        if k >= 60:
            words[k % len(words)] = "changed"
        rows.append((k, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(tuple(r) for r in simhash_dedup.groups(frame).collect())
    assert got == plain_groups(rows)
    assert len({g for *_, g in got}) < len(got)
    kept = {r.doc_id for r in simhash_dedup.keep_one(frame).collect()}
    assert kept == {g for *_, g in got}


@pytest.mark.parametrize("leaf", [5, 50])
def test_trees_find_all_links(spark, leaf, monkeypatch):
    """Clustered fingerprints; small leaves and chunks, so that pairs are parted in every way."""
    monkeypatch.setattr(simhash_dedup, "CHUNK", 20)
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    fps = set()
    for k in range(600):
        x = int(centres[k % 30])
        for bit in rng.choice(64, rng.integers(0, 7), replace=False):
            x ^= 1 << int(bit)
        fps.add(x - (1 << 64) if x >> 63 else x)
    frame = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    found = simhash_dedup.components(simhash_dedup.links(frame, leaf=leaf, sample=100)).collect()
    got = {r.node: r.root for r in found}
    items = sorted(fps)
    root = {x: x for x in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(items):
        for b in items[i + 1 :]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {x: got.get(x, x) for x in items} == {x: find(x) for x in items}


def test_empty_table_repeated_rows_and_other_columns(spark):
    schema = "doc_id bigint, text string, fingerprint string, leaf string"
    assert simhash_dedup.groups(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e", "x", "l")] * 2 + [(5, "a b c d e", None, None)]
    got = simhash_dedup.groups(spark.createDataFrame(rows, schema))
    assert got.columns == ["doc_id", "leaf", "fingerprint", "component_id"]
    assert [r.component_id for r in got.collect()] == [5, 5, 5]


def test_each_group_keeps_one_row_whatever_its_ids(spark):
    """Several groups without ids, groups that share an id, and an id that is least in one group and not in another."""
    texts = [" ".join(f"{x}{k}" for k in range(60)) for x in "abcdef"]
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (7, texts[3]), (2, texts[4]), (7, texts[4]), (None, texts[5]), (9, texts[5])]
    frame = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id bigint, text string, nth int")
    first = sorted(simhash_dedup.keep_one(frame).collect(), key=lambda r: r.text)
    assert [(r.doc_id, r.text) for r in first] == [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (2, texts[4]), (9, texts[5])]
    again = simhash_dedup.keep_one(frame.repartition(5)).collect()
    assert sorted(r.nth for r in again) == sorted(r.nth for r in first)
