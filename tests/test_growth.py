"""What grows with a tree is dealt evenly, and loops see no more rows than they need."""

from pyspark.sql import functions as F

from cladeflow import preset
from cladeflow.functions.ranks import rank_word
from cladeflow.functions.taxonomy import below_anchor
from cladeflow.operators import intervals, tree
from cladeflow.operators.fill import Fill
from cladeflow.session import NARROW, tune


def star(spark, tips=100):
    """A root with one inner node, which has all tips."""
    own = spark.range(3, 3 + tips).select(F.col("id").alias("node"), F.lit(2).cast("bigint").alias("parent"))
    return spark.createDataFrame([(1, 1), (2, 1)], "node bigint, parent bigint").unionByName(own)


def test_settings_for_narrow_tables_leave_those_of_the_session(spark):
    key, other = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {k: spark.conf.get(k, None) for k in NARROW}
    try:
        for k in NARROW:
            spark.conf.unset(k)
        spark.conf.set(key, "-1")
        tree.depths(star(spark))
        assert spark.conf.get(key) == "-1" and spark.conf.get(other) == NARROW[other]
        tune(spark)
        assert spark.conf.get(key) == "-1"
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def test_rows_that_are_done_do_not_meet_in_one_task(spark):
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in changed}
    rows = spark.createDataFrame([(n, 1, True) for n in range(1, 401)], "node bigint, jump bigint, done boolean")
    try:
        for k, value in changed.items():
            spark.conf.set(k, value)
        places = tree._hop(rows, rows, {}).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)
    assert len(places) == 4 and max(r["count"] for r in places) < 200


def test_depths_follow_inner_nodes_only(spark, monkeypatch):
    seen, loop = [], tree.jump_until_done
    monkeypatch.setattr(tree, "jump_until_done", lambda state, *more: seen.append(state.count()) or loop(state, *more))
    found = {r.node: r.depth for r in tree.depths(star(spark)).collect()}
    assert seen == [2]
    assert found == {1: 0, 2: 1} | dict.fromkeys(range(3, 103), 2)


def test_group_ancestors_double_pointers_of_inner_nodes_only(spark, monkeypatch):
    labels, rows, counting = intervals.intervals(star(spark)), [], intervals.cut_counting
    monkeypatch.setattr(intervals, "cut_counting", lambda frame, **more: rows.append(frame.count()) or counting(frame, **more))
    members = spark.createDataFrame([(3, "a"), (90, "a"), (7, "b"), (1, None), (5, None)], "node bigint, group string")
    found = {r.group: r.node for r in intervals.group_ancestors(labels, members).collect()}
    assert found == {"a": 2, "b": 7, None: 1}
    assert rows == [0]


def test_strings_to_fill_are_worked_out_once(spark):
    nodes = star(spark).withColumn("genome", F.when(F.col("node") > 2, F.concat(F.lit("g"), "node")))
    strings = nodes.where("genome is not null").select("genome", F.concat_ws(";", F.lit("2"), F.concat(F.lit("g__"), "genome")).alias("taxonomy"))
    names = spark.createDataFrame([], "node bigint, clade string, genome_rep string")
    fill = Fill(nodes, strings, names, strings.limit(0), (preset("d__Bacteria"),))
    assert "concat_ws" not in fill._strings._jdf.queryExecution().optimizedPlan().toString()
    assert fill._strings.where("node = 2 and rank = 4 and rest = concat('g__', genome)").count() == 100


def test_parts_of_labels_and_strings(spark):
    rows = spark.createDataFrame([("Species/Strain (0.95-1]",), ("Phylum (0-0.3]",), ("Genus",), ("",), (None,)], "label string")
    assert [r[0] for r in rows.select(rank_word(F.col("label"))).collect()] == ["species", "phylum", "genus", "", None]
    rows = spark.createDataFrame([("12;g__A;s__B",), ("12",), (";x",), ("1\n2;x;",), ("é;y",), (None,)], "t string")
    assert [r[0] for r in rows.select(below_anchor(F.col("t"))).collect()] == ["g__A;s__B", "", "x", "x;", "y", ""]
