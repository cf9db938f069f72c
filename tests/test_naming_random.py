"""Naming and fill against the rules by brute force, on many random trees in one run."""

import random

import pytest

from cladeflow import fill_taxonomy, preset
from cladeflow.operators.naming import Naming
from forest import METADATA_DDL, NODE_DDL, Rules, filled, random_tree

PARAMS = preset("d__Bacteria")
STRIDE = 1000


@pytest.mark.parametrize("seed", [1, 2])
def test_same_names_as_by_rule(spark, seed):
    rng = random.Random(seed)
    trees = [random_tree(rng, f"t{number}") for number in range(300)]
    rows = [row for number, tree in enumerate(trees) for row in tree.rows(PARAMS, number * STRIDE)]
    quality = [(genome, value, 0.0) for tree in trees for genome, value in tree.quality.items()]
    nodes = spark.createDataFrame(rows, NODE_DDL)
    run = Naming(nodes, spark.createDataFrame(quality, METADATA_DDL), (PARAMS,))

    expected, expected_rows = {}, []
    expected_full, added = {}, []
    for number, tree in enumerate(trees):
        offset = number * STRIDE
        shifted, shifted_rows = Rules(tree, PARAMS).results()
        for genome, text in shifted.items():
            if not text.startswith("d__"):
                head, mark, rest = text.partition(";")
                text = f"{int(head) + offset}{mark}{rest}"
            expected[genome] = text
        expected_rows += [(None if node is None else node + offset, clade, genome) for node, clade, genome in shifted_rows]
        full, more = filled(tree, {g: expected[g] for g in shifted}, offset)
        expected_full |= full
        added += more

    found = {row.genome: row.taxonomy for row in run.genomes.collect()}
    different = {g: (expected.get(g), found.get(g)) for g in expected | found if expected.get(g) != found.get(g)}
    assert not different
    key = repr
    found_rows = sorted(map(tuple, run.node_names.collect()), key=key)
    assert found_rows == sorted(expected_rows, key=key)
    assert run.issues.isEmpty()
    # The rarer rules do occur in these trees.
    assert not run.spans.where("deferred").join(run.named, "node").isEmpty()
    assert not run.facts.where("passed_over").isEmpty()

    lineages = [pair for tree in trees for pair in tree.lineages.items()]
    taxonomy = spark.createDataFrame(lineages, "genome string, taxonomy string")
    genomes, names = fill_taxonomy(nodes, run.genomes, run.node_names, taxonomy, PARAMS)
    got = {row.genome: row.taxonomy for row in genomes.collect()}
    wrong = {g: (expected_full[g], got.get(g)) for g in expected_full if expected_full[g] != got.get(g)}
    assert not wrong
    assert sorted(map(tuple, names.collect()), key=key) == sorted(expected_rows + added, key=key)
