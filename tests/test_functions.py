"""Labels, ranks, ids, summaries, files."""

import pytest
from pyspark.sql import functions as F

from cladeflow import preset, summarise_clades
from cladeflow.functions import genomes as ids
from cladeflow.functions.labels import label_columns
from cladeflow.functions.ranks import novelty_labels, rank_index, rank_table, rank_word, red_rank
from cladeflow.functions.taxonomy import below_anchor
from cladeflow.operators.catalogue import trim_accessions
from cladeflow.operators.ordering import enumerate_genomes
from cladeflow.params import RANKS
from cladeflow.plans.run import DomainInputs, NamingError, annotate_tree_file, run_files
from cladeflow.sources import tsv

# The grammar of labels: [support][:taxa] or a genome, [|RED=value], in quotes if there is punctuation.
GENOMES = ("x_1", "12_34", "Q_AB_5.2", "p.7")
TAXA = ("f__N", "o__U; f__V", "s__N a b", "d__N")
SUPPORTS = ("1.0", "0.25", "0.875")
REDS = ("0.125", "1.000", "0.5")


def grammar():
    """label: (RED, bootstrap, taxa, genome)"""
    for red in (None, *REDS):
        value = None if red is None else float(red)
        for core, parts in (
            *((g, (None, None, g)) for g in GENOMES),
            *((s, (float(s), None, None)) for s in SUPPORTS),
            *((f"{s}:{t}", (float(s), t, None)) for s in SUPPORTS for t in TAXA),
        ):
            label = core if red is None else f"{core}|RED={red}"
            yield (f"'{label}'" if set(label) & set(":|; ") else label), (value, *parts)
    yield "c__N", (None, None, "c__N", None)
    yield "", (None, None, None, None)


def test_labels(spark):
    expected = dict(grammar())
    frame = spark.createDataFrame([(label,) for label in expected], "label string")
    rows = frame.select("label", *[column.alias(name) for name, column in label_columns(F.col("label")).items()]).collect()
    assert {row.label: (row.RED, row.bootstrap, row.taxa, row.genome) for row in rows} == expected


@pytest.mark.parametrize("domain", ["d__Bacteria", "d__Archaea"])
def test_red_bins(spark, domain):
    """Bins are closed on the right: each edge belongs to its rank, what lies just above to the next."""
    edges = preset(domain).upper_edges
    samples = {}
    for rank, edge in enumerate(edges):
        samples |= {edge: rank, edge - 1e-9: rank, edge + 1e-9: rank + 1 if rank + 1 < len(edges) else None}
    samples |= {0.0: None, 1e-9: 0, -1e-9: None}
    frame = spark.createDataFrame([(red,) for red in samples], "red double").select(
        "red", red_rank(F.col("red"), edges).alias("rank")
    )
    assert {row.red: row.rank for row in frame.collect()} == samples


def test_rank_words_and_table(spark):
    params = [preset("d__Bacteria"), preset("d__Archaea", "r232")]
    table = rank_table(spark, params)
    words = table.select("rank", rank_index(rank_word(F.col("label"))).alias("again"))
    assert all(row.rank == row.again for row in words.collect())
    found = {(row.domain, row.rank): (row.cutoff_red, row.label) for row in table.collect()}
    for p in params:
        for rank, (edge, label) in enumerate(zip(p.upper_edges, novelty_labels(p))):
            assert found[p.domain, rank] == (pytest.approx(edge), label)


def test_cutoffs_follow_the_domain():
    assert preset("d__Archaea").median_red != preset("d__Bacteria").median_red
    assert preset("d__Archaea", red_cutoffs=("0.1", "0.2", "0.3", "0.4", "0.5")).medians == (0.1, 0.2, 0.3, 0.4, 0.5, 1.0)
    with pytest.raises(ValueError):
        preset("d__Archaea", red_cutoffs=(0.1,))


def test_sources_and_accessions(spark):
    expected = {"MGYG000001": "MGYG", "GWHABC01": "GWH", "GCA_1.1": "GCA", "mag_1": "mag", "plain": "plain", "_x": None, None: None}
    frame = spark.createDataFrame([(genome,) for genome in expected], "genome string")
    assert {row[0]: row[1] for row in frame.select("genome", ids.source_of(F.col("genome"))).collect()} == expected
    trimmed = trim_accessions(spark.createDataFrame([("RS_GCF_000012345.1", "t"), ("odd", "t")], "genome string, taxonomy string"))
    assert [row.genome for row in trimmed.collect()] == ["GCF_000012345", None]
    classes = {"d__Archaea;p__Bacteria": "archaea", "x Bacteria": "bacteria", "none": "unknown", None: "unknown"}
    frame = spark.createDataFrame([(text,) for text in classes], "text string")
    assert {row[0]: row[1] for row in frame.select("text", ids.domain_of(F.col("text"))).collect()} == classes


def test_summary(spark):
    clades = [(1, "p__a", "MGYG1"), (None, "s__a", "MGYG1"), (None, "s__b", "mag_2"), (2, "g__c", "GCA_3"), (None, "s__d", None)]
    summary = summarise_clades(spark.createDataFrame(clades, "node bigint, clade string, genome_rep string"))
    assert summary.columns == ["magset", "phyla", "classes", "orders", "families", "genera", "species"]
    assert [tuple(row) for row in summary.collect()] == [
        ("MGYG", 1, 0, 0, 0, 0, 1),
        ("mag", 0, 0, 0, 0, 0, 1),
        ("all", 1, 0, 0, 0, 0, 2),
    ]
    assert summarise_clades(spark.createDataFrame([], "node bigint, clade string, genome_rep string")).isEmpty()


def test_enumeration_has_no_gaps(spark):
    genomes = spark.range(5000).select(F.concat(F.lit("g"), "id").alias("genome"), (F.col("id") % 7).cast("double").alias("quality"))
    genomes = genomes.withColumn("quality", F.when(F.col("quality") > 0, F.col("quality")))
    rows = enumerate_genomes(genomes.repartition(9)).orderBy("genome_order").collect()
    assert [row.genome_order for row in rows] == list(range(5000))
    key = lambda row: (row.quality is None, row.quality or 0, row.genome)
    assert [row.genome for row in rows] == [row.genome for row in sorted(rows, key=key, reverse=True)]


def test_taxonomy_parts(spark):
    texts = {"12;g__a;s__a b": "g__a;s__a b", "12": "", "12;s__x": "s__x"}
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    assert {row[0]: row[1] for row in frame.select("text", below_anchor(F.col("text"))).collect()} == texts


def test_files_to_files(spark, tmp_path):
    """A decorated tree file to names and summary."""
    params = preset("d__Bacteria")
    tree = "(('RS_1|RED=1.000':1,'new_1|RED=1.000':1)'1.0:o__O|RED=0.600':0.5,'new_2|RED=1.000':1)'0.9|RED=0.200';"
    (tmp_path / "x.tree").write_text(tree)
    (tmp_path / "tax.tsv").write_text("RS_1\td__Bacteria;p__P;c__C;o__O;f__F;g__G;s__G s\n")
    (tmp_path / "info.tsv").write_text(
        "extra\tcheckm2_contamination\tID\tcheckm2_completeness\n-\t1.5\tnew_1\t90\n-\t0.5\tnew_2\t95.5\n"
    )
    nodes = annotate_tree_file(spark, str(tmp_path / "x.tree"), str(tmp_path / "tax.tsv"), params)
    tsv.write_nodes(nodes, str(tmp_path / "nodes"))
    inputs = [DomainInputs(params, str(tmp_path / "nodes"), str(tmp_path / "tax.tsv"))]
    run_files(spark, inputs, str(tmp_path / "info.tsv"), str(tmp_path / "out"), strict=True)
    taxonomy = tsv.read_headered(spark, str(tmp_path / "out/genome_taxonomy"), {"genome": "string", "taxonomy": "string"})
    assert {tuple(row) for row in taxonomy.collect()} == {
        ("new_1", "d__Bacteria;p__P;c__C;o__new_1;f__new_1;g__new_1;s__new_1 new_1"),
        ("new_2", "d__Bacteria;p__new_2;c__new_2;o__new_2;f__new_2;g__new_2;s__new_2 new_2"),
    }
    names = tsv.read_node_names(spark, str(tmp_path / "out/node_names"))
    assert names.where("node is null").count() == 10
    summary = spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "out/clade_summary"))
    assert {(row.magset, row.phyla, row.species) for row in summary.collect()} == {("new", "1", "2"), ("all", "1", "2")}

    (tmp_path / "short.tsv").write_text("ID\tcheckm2_completeness\tcheckm2_contamination\nnew_1\t90\t1.5\n")
    with pytest.raises(NamingError, match="no_metadata: new_2"):
        run_files(spark, inputs, str(tmp_path / "short.tsv"), str(tmp_path / "strict"), strict=True)
