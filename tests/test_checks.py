"""Broken rows and tables that are no tree are found, outputs have one order, labels are rounded by the exact double."""

from decimal import ROUND_HALF_EVEN, Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cladeflow import preset
from cladeflow.functions.ranks import two_digits
from cladeflow.operators.validate import tree_issues
from cladeflow.plans.run import DomainInputs, NamingError, name_and_fill, run_files
from cladeflow.sources import tsv
from cladeflow.sources.ordered import read_in_order, write_in_order

COLUMNS = {"node": "bigint", "RED": "double", "label": "string"}


def test_broken_rows(spark, tmp_path):
    lines = ["label\tnode\tRED", "a\t1\t0.5", "b\t2", "c\t3\t0.5\tx", "d\tthree\t0.5", "e\t4\tNA", '"f\tg"\t5\t0.5', '"h\ti"\t6', "j\tx\ty", "\t7\t1"]
    (tmp_path / "a.tsv").write_text("\n".join(lines) + "\n")
    rows, issues = tsv.read_checked(spark, str(tmp_path / "a.tsv"), COLUMNS, null="NA")
    assert sorted(map(tuple, rows.collect())) == [(1, 0.5, "a"), (4, None, "e"), (5, 0.5, "f\tg"), (7, 1.0, None)]
    found = issues.collect()
    assert sorted((r.issue, r.record, r.columns) for r in found) == sorted([
        ("bad_value", "d\tthree\t0.5", "node"), ("bad_value", "j\tx\ty", "node,RED"), ("too_few_fields", "b\t2", ""), ("too_few_fields", '"h\ti"\t6', ""),
        ("too_many_fields", "c\t3\t0.5\tx", ""),
    ])
    assert all(r.file.endswith("a.tsv") for r in found)
    with pytest.raises(ValueError, match="lacks"):
        tsv.read_checked(spark, str(tmp_path / "a.tsv"), {"other": "string"})


def test_no_header(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("g1\td__B;p__P\ng2\ng3\td__B\tmore\n")
    rows, issues = tsv.read_taxonomy_checked(spark, str(tmp_path / "t.tsv"))
    assert [tuple(r) for r in rows.collect()] == [("g1", "d__B;p__P")]
    assert sorted((r.issue, r.record) for r in issues.collect()) == [("too_few_fields", "g2"), ("too_many_fields", "g3\td__B\tmore")]


NODES = "parent bigint, node bigint, nongtdb_group string, genome string, magset string, RED double, novelty_red string"


def written(folder: Path, extra: str = ""):
    """Inputs of one domain: a tree with one new genome, its quality and no reference."""
    header = "\t".join(f.split()[0] for f in NODES.split(", "))
    rows = ["1\t1\tnongtdb\tNA\tNA\t0.2\tPhylum (a]", "1\t2\tnongtdb\tNA\tNA\t0.6\tOrder (a]", "2\t3\tnongtdb\tg_1\tother\t1.0\tSpecies/Strain (a]"]
    (folder / "nodes.tsv").write_text("\n".join([header, *rows]) + "\n" + extra)
    (folder / "taxonomy.tsv").write_text("")
    (folder / "quality.tsv").write_text("ID\tcheckm2_completeness\tcheckm2_contamination\ng_1\t90.0\t1.0\n")
    return [DomainInputs(preset("d__Bacteria"), str(folder / "nodes.tsv"), str(folder / "taxonomy.tsv"))], str(folder / "quality.tsv")


def test_runs_tell_of_broken_rows(spark, tmp_path):
    inputs, quality = written(tmp_path, "2\tx\tnongtdb\n")
    issues = run_files(spark, inputs, quality, str(tmp_path / "out")).issues.collect()
    assert [(r.issue, r.genome, r.domain) for r in issues] == [("malformed_nodes_too_few_fields", "2\tx\tnongtdb", "d__Bacteria")]
    with pytest.raises(NamingError, match="malformed_nodes_too_few_fields"):
        run_files(spark, inputs, quality, str(tmp_path / "strict"), strict=True)


def nodes(spark, rows):
    listed = [(p, n, "nongtdb", g, "other" if g else None, 1.0 if g else red, "Species/Strain (a]" if g else "Phylum (a]") for n, p, g, red in rows]
    return spark.createDataFrame(listed, NODES)


SOUND = [(1, 1, None, 0.1), (2, 1, None, 0.2), (3, 2, "g_1", None)]
CYCLE = [(5, 6, None, 0.1), (6, 5, None, 0.1), (7, 6, None, 0.2), (8, 7, "g_2", None)]


def test_cycles_are_listed_and_left_out(spark):
    metadata = spark.createDataFrame([("g_1", 90.0, 1.0), ("g_2", 90.0, 1.0)], "Name string, Completeness double, Contamination double")
    empty = spark.createDataFrame([], "genome string, taxonomy string")
    found = name_and_fill(nodes(spark, SOUND + CYCLE), metadata, empty, preset("d__Bacteria"))
    assert {r.genome for r in found.genome_taxonomy.collect()} == {"g_1"}
    assert {(r.issue, r.node) for r in found.issues.collect()} == {("cycle", 5), ("cycle", 6), ("below_cycle", 7), ("below_cycle", 8)}
    with pytest.raises(NamingError, match="cycle"):
        name_and_fill(nodes(spark, SOUND + CYCLE), metadata, empty, preset("d__Bacteria"), strict=True)


def test_roots_and_orphans(spark):
    """Several roots only where one is asked for; what hangs below a missing parent."""
    rows = [*SOUND, (10, 10, None, 0.1), (20, 99, None, 0.1), (21, 20, None, 0.2), (22, 21, "g_9", None)]
    kinds = lambda one: {(r.issue, r.node) for r in tree_issues(nodes(spark, rows), one_root=one).collect()}
    orphans = {("missing_parent", 20), ("below_missing_parent", 21), ("below_missing_parent", 22)}
    assert kinds(False) == orphans and kinds(True) == orphans | {("several_roots", 1), ("several_roots", 10)}
    rootless = tree_issues(nodes(spark, CYCLE)).where("issue = 'no_root'").collect()
    assert [(r.node, r.genome) for r in rootless] == [(None, None)]


def test_one_order_over_all_files(spark, tmp_path):
    frame = spark.range(0, 3000, 1, 7).select(F.pmod(F.xxhash64("id"), F.lit(1000)).cast("string").alias("clade"), F.col("id").alias("node"), (F.col("id") % 3).cast("string").alias("domain"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        write_in_order(frame, str(tmp_path / "o"), [F.col("clade"), F.col("node")], "domain")
        assert len(list((tmp_path / "o").glob("*/part-*.csv"))) > 3
        found = read_in_order(spark, str(tmp_path / "o"), {"clade": "string", "node": "bigint"}, "domain").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for domain in "012":
        rows = sorted((r.clade, r.node) for r in frame.where(F.col("domain") == domain).collect())
        assert sorted((r.row, r.clade, r.node) for r in found if r.domain == domain) == [(k, *row) for k, row in enumerate(rows, 1)]


def test_digits(spark):
    values = [0.0, 0.005, 0.015, 0.125, 0.285, 0.375, 0.575, 0.995, 0.9949999999999999, 1.0, 1.005, 2.675, 10.0, 100.5, -0.285, -0.001, 1e-9, None]
    values += [k / 1000 for k in range(0, 3000, 5)] + [(k / 7 + k / 13) / 2 for k in range(200)]
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double").select("k", two_digits(F.col("v")).alias("text"))
    for k, text in frame.collect():
        if values[k] is None:
            assert text is None
            continue
        exact = Decimal(values[k]).quantize(Decimal("0.01"), ROUND_HALF_EVEN)
        assert text == (f"{exact:.2f}".rstrip("0").rstrip(".") if exact else "0"), values[k]
