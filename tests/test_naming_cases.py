"""Worked cases of clade naming, all in one run, bacterial cutoffs unless said otherwise."""

import pytest

from cladeflow import name_clades, preset
from cladeflow.operators.naming import Naming
from cladeflow.operators.validate import tree_issues
from cladeflow.plans.run import name_and_fill
from forest import METADATA_DDL, NODE_DDL, Tree

BACTERIA, ARCHAEA = preset("d__Bacteria"), preset("d__Archaea")
REFERENCE = "d__Bacteria;p__P;c__C;o__O;f__F;g__G;s__G sp1"


def lineage(start, names, genome):
    """``names`` has one genome per rank, ending with the genus."""
    letters = "pcofg"[5 - len(names) :]
    clades = [f"{letter}__{name}" for letter, name in zip(letters, names)]
    return ";".join([start, *clades, f"s__{names[-1]} {genome}"])


CASES = {
    # Node 1 spans phylum and class, node 2 order and family; later genomes share what is named.
    "new_tree": (
        Tree({0: (0, 0.25), 1: (0, 0.55), 2: (1, 0.9)}, {"a1": 2, "a2": 2, "a3": 1}, {"a1": 90, "a2": 80, "a3": 70}),
        {
            "a1": lineage("d__Bacteria", ["a1"] * 5, "a1"),
            "a2": lineage("d__Bacteria", ["a1", "a1", "a1", "a1", "a2"], "a2"),
            "a3": lineage("d__Bacteria", ["a1", "a1", "a3", "a3", "a3"], "a3"),
        },
        {(1, "p__a1"), (1, "c__a1"), (2, "o__a1"), (2, "f__a1")},
    ),
    # The order name goes to node 3's clade, as node 2 is closer to the median than node 1 is.
    "child_closer": (
        Tree(
            {0: (0, 0.25), 1: (0, 0.55), 2: (1, 0.6), 3: (2, 0.7)}, {"b1": 3, "b2": 2, "b3": 3}, {"b1": 90, "b2": 80, "b3": 70}
        ),
        {
            "b1": lineage("d__Bacteria", ["b1"] * 5, "b1"),
            "b2": lineage("d__Bacteria", ["b1", "b1", "b2", "b2", "b2"], "b2"),
            "b3": lineage("d__Bacteria", ["b1", "b1", "b1", "b3", "b3"], "b3"),
        },
        {(1, "p__b1"), (1, "c__b1"), (3, "o__b1")},
    ),
    # Node 1 is closer to the order median than its parent: the order is new, the class is not.
    "anchor_above_order": (
        Tree({0: (0, 0.2), 1: (0, 0.6)}, {"c0": 1, "c1": 1}, {"c1": 90}, {"c0": REFERENCE}),
        {"c1": lineage("1", ["c1"] * 3, "c1")},
        set(),
    ),
    # Within a known genus only the species is new, left to the fill.
    "anchor_at_genus": (
        Tree({0: (0, 0.2), 1: (0, 0.9), 2: (1, 0.98)}, {"d0": 2, "d1": 2}, {"d1": 90}, {"d0": REFERENCE}),
        {"d1": "2"},
        set(),
    ),
    "new_phylum_beside_reference": (
        Tree({0: (0, 0.1), 1: (0, 0.3)}, {"e0": 1, "e1": 1}, {"e1": 90}, {"e0": REFERENCE}),
        {"e1": lineage("d__Bacteria", ["e1"] * 5, "e1")},
        set(),
    ),
    # Node 1 supplies the class, so of class and order only the order is left for node 2, and only the
    # first genome with a named family gets to name it. f0 came before, f2 after.
    "deferred": (
        Tree(
            {0: (0, 0.44), 1: (0, 0.52), 2: (1, 0.75), 3: (2, 0.9)},
            {"ref": 1, "f0": 2, "f1": 3, "f2": 2},
            {"f0": 90, "f1": 80, "f2": 70},
            {"ref": REFERENCE},
        ),
        {
            "f0": lineage("1", ["f0"] * 3, "f0"),
            "f1": lineage("1", ["f1"] * 3, "f1"),
            "f2": lineage("1", ["f1", "f2", "f2"], "f2"),
        },
        {(2, "o__f1"), (3, "f__f1")},
    ),
    # Node 1 is farther from the phylum median than the root, so the phylum is known and the class new.
    "anchor_at_phylum": (
        Tree({0: (0, 0.3), 1: (0, 0.388)}, {"n0": 1, "n1": 1}, {"n1": 90}, {"n0": REFERENCE}),
        {"n1": lineage("1", ["n1"] * 4, "n1")},
        set(),
    ),
    # Of reference nodes with equal RED the lowest is the anchor; it is no closer than the one above.
    "anchor_below_its_equal": (
        Tree({0: (0, 0.3), 1: (0, 0.388), 2: (1, 0.388)}, {"u0": 2, "u1": 2}, {"u1": 90}, {"u0": REFERENCE}),
        {"u1": lineage("2", ["u1"] * 4, "u1")},
        set(),
    ),
    # Node 2 is an order like node 1 above it, which is closer to the median and keeps what it bears.
    "parent_closer": (
        Tree({0: (0, 0.25), 1: (0, 0.6), 2: (1, 0.66)}, {"p1": 2, "p2": 1}, {"p1": 90, "p2": 80}),
        {"p1": lineage("d__Bacteria", ["p1"] * 5, "p1"), "p2": lineage("d__Bacteria", ["p1", "p1", "p2", "p2", "p2"], "p2")},
        {(1, "p__p1"), (1, "c__p1"), (2, "o__p1")},
    ),
    # Three orders in a row: the middle one is closer than the first and gives way to its child.
    "three_of_a_rank": (
        Tree(
            {0: (0, 0.25), 1: (0, 0.55), 2: (1, 0.57), 3: (2, 0.66)}, {"q1": 3, "q2": 2, "q3": 1}, {"q1": 90, "q2": 80, "q3": 70}
        ),
        {
            "q1": lineage("d__Bacteria", ["q1"] * 5, "q1"),
            "q2": lineage("d__Bacteria", ["q1", "q1", "q2", "q2", "q2"], "q2"),
            "q3": lineage("d__Bacteria", ["q1", "q1", "q3", "q3", "q3"], "q3"),
        },
        {(1, "p__q1"), (1, "c__q1"), (3, "o__q1")},
    ),
    # Node 2 spans three ranks, of which the reference parent supplies the first.
    "first_of_three_supplied": (
        Tree({0: (0, 0.44), 1: (0, 0.52), 2: (1, 0.9)}, {"r0": 1, "r1": 2, "r2": 2, "r3": 1}, {"r1": 90, "r2": 80, "r3": 70}, {"r0": REFERENCE}),
        {
            "r1": lineage("1", ["r1"] * 3, "r1"),
            "r2": lineage("1", ["r1", "r1", "r2"], "r2"),
            "r3": lineage("1", ["r3"] * 3, "r3"),
        },
        {(2, "o__r1"), (2, "f__r1")},
    ),
    # Within the species range a node bears the genus, never the species.
    "species_range": (
        Tree({0: (0, 0.25), 1: (0, 0.9), 2: (1, 0.98)}, {"s1": 2, "s2": 2}, {"s1": 90, "s2": 80}),
        {"s1": lineage("d__Bacteria", ["s1"] * 5, "s1"), "s2": lineage("d__Bacteria", ["s1"] * 5, "s2")},
        {(1, "p__s1"), (1, "c__s1"), (1, "o__s1"), (1, "f__s1"), (2, "g__s1")},
    ),
    # Two clades below one phylum: the second one's leader follows the first, and hands that on.
    "two_leaders": (
        Tree(
            {0: (0, 0.25), 1: (0, 0.55), 2: (1, 0.9), 3: (1, 0.9)}, {"t1": 2, "t2": 3, "t3": 3}, {"t1": 90, "t2": 80, "t3": 70}
        ),
        {
            "t1": lineage("d__Bacteria", ["t1"] * 5, "t1"),
            "t2": lineage("d__Bacteria", ["t1", "t1", "t2", "t2", "t2"], "t2"),
            "t3": lineage("d__Bacteria", ["t1", "t1", "t2", "t2", "t3"], "t3"),
        },
        {(1, "p__t1"), (1, "c__t1"), (2, "o__t1"), (2, "f__t1"), (3, "o__t2"), (3, "f__t2")},
    ),
    # Equal quality: the later id in byte order comes first.
    "equal_quality": (
        Tree({0: (0, 0.25), 1: (0, 0.55)}, {"g1": 1, "g_": 1}, {"g1": 90, "g_": 90}),
        {
            "g_": lineage("d__Bacteria", ["g_"] * 5, "g_"),
            "g1": lineage("d__Bacteria", ["g_", "g_", "g1", "g1", "g1"], "g1"),
        },
        {(1, "p__g_"), (1, "c__g_")},
    ),
}
STRIDE = 100


@pytest.fixture(scope="module")
def outcome(spark):
    rows, quality = [], []
    for number, (tree, _, _) in enumerate(CASES.values()):
        rows += tree.rows(BACTERIA, number * STRIDE)
        quality += [(genome, float(value), 0.0) for genome, value in tree.quality.items()]
    genomes, names = name_clades(spark.createDataFrame(rows, NODE_DDL), spark.createDataFrame(quality, METADATA_DDL), "d__Bacteria")
    return {row.genome: row.taxonomy for row in genomes.collect()}, [tuple(row) for row in names.collect()]


@pytest.mark.parametrize("name", CASES)
def test_case(outcome, name):
    taxonomy, rows = outcome
    number = list(CASES).index(name)
    tree, expected, attached = CASES[name]
    for genome, text in expected.items():
        head, mark, rest = text.partition(";")
        if not text.startswith("d__"):
            text = f"{int(head) + number * STRIDE}{mark}{rest}"
        assert taxonomy[genome] == text
    found = {(node - number * STRIDE, clade) for node, clade, genome in rows if genome in expected and node is not None}
    assert found == attached
    # Names without a node: every rank of a genome's own name that is not attached, and its species.
    loose = {(clade, genome) for node, clade, genome in rows if genome in expected and node is None}
    own = {
        (clade, genome)
        for genome, text in expected.items()
        for clade in text.split(";")
        if clade[1:] == f"__{genome}" and clade not in {c for _, c in attached} or clade.startswith("s__")
    }
    assert loose == own


def test_genomes_that_cannot_be_named(spark):
    trees = [
        # A new tree whose root is an order: nothing supplies phylum and class.
        Tree({0: (0, 0.6), 1: (0, 0.9)}, {"h1": 1}, {"h1": 90}),
        # A root without RED has no rank.
        Tree({0: (0, 0.0), 1: (0, 0.55), 2: (1, 0.9)}, {"i1": 2, "i2": 1}, {"i1": 90}),
        Tree({0: (0, 0.25), 1: (0, 0.55)}, {"j1": 1}, {"j1": 90}),
    ]
    rows = [row for number, tree in enumerate(trees) for row in tree.rows(BACTERIA, number * STRIDE)]
    metadata = [(genome, float(value), 0.0) for tree in trees for genome, value in tree.quality.items()]
    nodes = spark.createDataFrame(rows, NODE_DDL)
    run = Naming(nodes, spark.createDataFrame(metadata, METADATA_DDL), (BACTERIA,))
    assert {(row.issue, row.genome) for row in run.issues.collect()} == {
        ("no_phylum", "h1"),
        ("invalid_node_on_path", "i1"),
        ("no_metadata", "i2"),
    }
    assert [row.genome for row in run.genomes.collect()] == ["j1"]
    assert {row.genome_rep for row in run.node_names.collect()} == {"j1"}
    assert ("no_rank", STRIDE) in {(row.issue, row.node) for row in tree_issues(nodes).collect()}


def test_unknown_quality_comes_first(spark):
    tree = CASES["new_tree"][0]
    nodes = spark.createDataFrame(tree.rows(BACTERIA), NODE_DDL)
    metadata = spark.createDataFrame([("a1", 90.0, 0.0), ("a2", None, 0.0), ("a3", 80.0, 0.0)], METADATA_DDL)
    run = Naming(nodes, metadata, (BACTERIA,))
    assert {row.winner_genome for row in run.named.collect()} == {"a2"}


def test_two_domains_in_one_run(spark):
    """Same node ids in both domains; each keeps its own cutoffs and lineages."""
    tree = Tree({0: (0, 0.2), 1: (0, 0.53)}, {"k0": 1, "k1": 1}, {"k1": 90}, {"k0": REFERENCE})
    other = Tree(tree.inner, {"m0": 1, "m1": 1}, {"m1": 90}, {"m0": REFERENCE.replace("Bacteria", "Archaea")})
    rows = [("d__Bacteria", *row) for row in tree.rows(BACTERIA)] + [("d__Archaea", *row) for row in other.rows(ARCHAEA)]
    nodes = spark.createDataFrame(rows, "domain string, " + NODE_DDL)
    metadata = spark.createDataFrame([("k1", 90.0, 0.0), ("m1", 90.0, 0.0)], METADATA_DDL)
    lineages = spark.createDataFrame(
        [*tree.lineages.items(), *other.lineages.items()], "genome string, taxonomy string"
    )
    results = name_and_fill(nodes, metadata, lineages, [BACTERIA, ARCHAEA])
    assert {tuple(row) for row in results.genome_taxonomy.collect()} == {
        ("d__Bacteria", "k1", "d__Bacteria;p__P;c__C;o__k1;f__k1;g__k1;s__k1 k1"),
        ("d__Archaea", "m1", "d__Archaea;p__P;c__C;o__m1;f__m1;g__m1;s__m1 m1"),
    }
    assert results.issues.isEmpty()
