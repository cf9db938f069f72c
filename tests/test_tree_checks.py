"""Loops end on bad input, votes have no hot key, and a run from raw files to all outputs."""

import pytest
from pyspark.sql import functions as F

from cladeflow import preset, summarise_clades
from cladeflow.operators.fill import prefix_votes
from cladeflow.operators.tree import TreeError, ancestors, any_descendant, depths, paint_groups
from cladeflow.plans.run import NamingError, RawInputs, name_and_fill, run_raw
from cladeflow.session import drop_steps, shared_folder
from cladeflow.sources import tsv

CYCLE = [(1, 1), (2, 1), (5, 6), (6, 5), (7, 5)]
TWICE = [(1, 1), (2, 1), (2, 1), (3, 2), (4, 3), (5, 4), (6, 5)]


def tree(spark, rows):
    return spark.createDataFrame([(*r, None, False) for r in rows], "node bigint, parent bigint, genome string, flag boolean")


@pytest.mark.parametrize("walk", [depths, ancestors, lambda nodes: any_descendant(nodes, "flag")])
def test_cycles_raise(spark, walk):
    with pytest.raises(TreeError, match="cycle"):
        walk(tree(spark, CYCLE))


def test_repeated_nodes_raise(spark):
    with pytest.raises(TreeError, match="more than once"):
        depths(tree(spark, TWICE))


def test_dangling_parents_end_paths(spark):
    rows = [(1, 1), (2, 1), (3, 9), (4, 3), (5, 4)]
    assert {r.node: r.depth for r in depths(tree(spark, rows)).collect()} == {1: 0, 2: 1, 3: 1, 4: 2, 5: 3}
    found = ancestors(tree(spark, rows), tree(spark, rows).where("node = 5"))
    assert sorted((r.node, r.ancestor, r.distance) for r in found.collect()) == [(5, 3, 2), (5, 4, 1), (5, 9, 3)]


def test_painting_a_long_chain(spark):
    nodes = spark.range(1, 301).select(
        F.col("id").alias("node"), F.greatest(F.col("id") - 1, F.lit(1)).alias("parent"),
        F.when(F.col("id") == 300, "g").alias("genome"), F.when(F.col("id") == 300, "GTDB").alias("magset"),
    )
    side = spark.createDataFrame([(400, 100, None, None), (401, 400, "h", "x")], nodes.schema)
    painted = {r.node: r.nongtdb_group for r in paint_groups(nodes.unionByName(side)).collect()}
    assert {n for n, g in painted.items() if g == "gtdb"} == set(range(1, 301))


def test_votes_are_dealt_by_node_and_lineage(spark):
    """Between the join that brings all votes to their node and the count lies an exchange on node and lineage."""
    nodes = tree(spark, [(1, 1)]).select("node", "parent", "genome").unionByName(
        spark.range(50).select((F.col("id") + 10).alias("node"), F.lit(1).cast("bigint").alias("parent"), F.concat(F.lit("g"), "id").alias("genome"))
    )
    taxonomy = spark.range(50).select(
        F.concat(F.lit("g"), "id").alias("genome"),
        F.concat(F.lit("d__B;p__P;c__C;o__O;f__F;g__"), (F.col("id") % 3).cast("string"), F.lit(";s__"), "id").alias("taxonomy"),
    )
    plans = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        import cladeflow.operators.fill as fill

        kept, fill.cut = fill.cut, lambda frame: (plans.append(frame._jdf.queryExecution().executedPlan().toString()), kept(frame))[1]
        votes = prefix_votes(nodes, spark.createDataFrame([(1, 5)], "node bigint, rank int"), taxonomy)
    finally:
        fill.cut = kept
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {(r.lineage.split("__")[-1], r.votes) for r in votes.collect()} == {("0", 17), ("1", 17), ("2", 16)}
    plan = next(p for p in plans if "REPARTITION_BY_COL" in p and "taxonomy" in p)
    assert plan.index("hashpartitioning(node") < plan.index("REPARTITION_BY_COL") < plan.index("SortMergeJoin")


def test_inputs_are_checked_first(spark):
    row = (1, 1, "nongtdb", None, None, 0.2, "Phylum (a]")
    nodes = spark.createDataFrame(
        [row, (1, 2, "nongtdb", "n_1", "x", 1.0, None)], "parent bigint, node bigint, nongtdb_group string, genome string, magset string, RED double, novelty_red string"
    )
    metadata = spark.createDataFrame([("n_1", 90.0, 1.0), ("n_1", 80.0, 1.0)], "Name string, Completeness double, Contamination double")
    taxonomy = spark.createDataFrame([], "genome string, taxonomy string")
    with pytest.raises(NamingError, match="1 issues, such as duplicate_metadata: n_1"):
        name_and_fill(nodes, metadata, taxonomy, preset("d__Bacteria"), strict=True)
    found = name_and_fill(nodes, metadata.limit(1), taxonomy, preset("d__Bacteria"), strict=True)
    assert found.issues.isEmpty()


def test_metadata_of_the_other_domain_is_not_used(spark):
    nodes = spark.createDataFrame(
        [(d, p, n, "nongtdb", g, m, red, w) for d in ("d__Archaea", "d__Bacteria") for p, n, g, m, red, w in ((1, 1, None, None, 0.2, "Phylum (a]"), (1, 2, "n_1", "x", 1.0, None))],
        "domain string, parent bigint, node bigint, nongtdb_group string, genome string, magset string, RED double, novelty_red string",
    )
    metadata = spark.createDataFrame([("d__Bacteria", "n_1", 90.0, 1.0)], "domain string, Name string, Completeness double, Contamination double")
    taxonomy = spark.createDataFrame([], "genome string, taxonomy string")
    found = name_and_fill(nodes, metadata, taxonomy, [preset("d__Archaea"), preset("d__Bacteria")])
    assert [r.domain for r in found.genome_taxonomy.collect()] == ["d__Bacteria"]
    assert [(r.issue, r.domain) for r in found.issues.collect()] == [("no_metadata", "d__Archaea")]


def test_raw_files_of_two_domains(spark, tmp_path):
    inputs = []
    for domain, name in (("d__Bacteria", "b"), ("d__Archaea", "a")):
        text = f"(('GCA_00000000{ord(name)}.1|RED=1.000':1,'{name}1_x|RED=1.000':1)'1.0:o__O|RED=0.600':0.5,'{name}2_x|RED=1.000':1)'0.9|RED=0.200';"
        (tmp_path / f"{name}.tree").write_text(text)
        (tmp_path / f"{name}.tsv").write_text(f"RS_GCA_00000000{ord(name)}.1\t{domain};p__P;c__C;o__O;f__F;g__G;s__G s\n")
        inputs.append(RawInputs(preset(domain), str(tmp_path / f"{name}.tree"), str(tmp_path / f"{name}.tsv")))
    rows = ["ID\tdomain\tcheckm2_completeness\tcheckm2_contamination"]
    rows += [f"{g}\t{d}\t9{k}\t1" for k, (g, d) in enumerate((("b1_x", "Bacteria"), ("b2_x", "Bacteria"), ("a1_x", "Archaea"), ("a2_x", "Archaea")))]
    (tmp_path / "info.tsv").write_text("\n".join(rows) + "\n")
    (tmp_path / "fasta.txt").write_text("\n".join(f"/data/{g}.fa.gz" for g in ("b1_x", "b2_x", "a1_x")) + "\n")
    out = str(tmp_path / "out")
    run_raw(spark, inputs, str(tmp_path / "info.tsv"), str(tmp_path / "fasta.txt"), out)
    batches = spark.read.option("sep", "\t").csv(f"{out}/batches")
    assert {(r.domain, r._c1) for r in batches.collect()} == {("bacteria", "b1_x"), ("bacteria", "b2_x"), ("archaea", "a1_x")}
    names = spark.read.option("sep", "\t").option("header", True).csv(f"{out}/node_names")
    assert {r.domain for r in names.collect()} == {"d__Bacteria", "d__Archaea"}
    for part in (tmp_path / "out" / "node_names").rglob("*.csv"):
        clades = [line.split("\t")[1] for line in part.read_text().splitlines()[1:]]
        assert clades == sorted(clades)
    summary = spark.read.option("sep", "\t").option("header", True).csv(f"{out}/clade_summary")
    totals = {r.domain: (r.phyla, r.species) for r in summary.where("magset = 'all'").collect()}
    assert set(totals) == {"d__Bacteria", "d__Archaea"}
    taxonomy = tsv.read_headered(spark, f"{out}/genome_taxonomy", {"genome": "string", "taxonomy": "string"})
    assert {r.genome for r in taxonomy.collect()} == {"b1_x", "b2_x", "a1_x", "a2_x"}


def test_summary_by_group(spark):
    rows = [("x", "p__a", "MGYG1"), ("x", "s__b", "mag_2"), ("y", "g__c", "mag_3")]
    frame = spark.createDataFrame(rows, "domain string, clade string, genome_rep string")
    found = [(r.domain, r.magset, r.phyla, r.genera, r.species) for r in summarise_clades(frame, ["domain"]).collect()]
    assert found == [("x", "MGYG", 1, 0, 0), ("x", "mag", 0, 0, 1), ("x", "all", 1, 0, 1), ("y", "mag", 0, 1, 0), ("y", "all", 0, 1, 0)]


def test_steps_lie_in_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir")) and folder.endswith(spark.sparkContext.applicationId)
    assert callable(drop_steps)
