"""Newick texts and files against a small recursive reader."""

import random

import pytest

from cladeflow.sources.newick import NewickError, edges, newick_edges, newick_file_edges, text_tokens

LABELS = ["", "'it''s doubled'", "a_1", "'b|RED=1.000'", "0.98", "'0.9:g__X; s__X, y|RED=0.5'", "d.e-f"]


def random_newick(rng, depth):
    """A nested tuple tree (children, label, length) and its text."""
    label, length = rng.choice(LABELS), rng.choice([None, 0.5, 0.001, 3.0])
    suffix = label + ("" if length is None else f":{length}")
    if depth == 0 or rng.random() < 0.3:
        return ([], label, length), suffix
    parts = [random_newick(rng, depth - 1) for _ in range(rng.randint(1, 4))]
    return ([tree for tree, _ in parts], label, length), f"({','.join(text for _, text in parts)}){suffix}"


def numbered(tree):
    """Rows (parent, node, length, label): tips in order, then internal nodes in pre-order."""
    tips, inner = [], []

    def collect(node):
        (inner if node[0] else tips).append(node)
        for child in node[0]:
            collect(child)

    collect(tree)
    number = {id(node): at + 1 for at, node in enumerate(tips + inner)}
    rows = []

    def emit(node, parent):
        rows.append((parent, number[id(node)], node[2], node[1] or None))
        for child in node[0]:
            emit(child, number[id(node)])

    emit(tree, number[id(tree)])
    return sorted(rows, key=repr)


def trees(seed, count, depth):
    rng = random.Random(seed)
    made = []
    while len(made) < count:
        tree, text = random_newick(rng, depth)
        if tree[0]:
            made.append((tree, text + ";"))
    return made


def test_texts(spark):
    made = trees(5, 60, 5)
    texts = spark.createDataFrame([(at, text) for at, (_, text) in enumerate(made)], "tree_id bigint, newick string")
    for piece in (65536, 4):
        found = {}
        for row in newick_edges(texts, piece).collect():
            found.setdefault(row.tree_id, []).append((row.parent, row.node, row.branch_length, row.label))
        for at, (tree, _) in enumerate(made):
            assert sorted(found[at], key=repr) == numbered(tree)


def test_chain(spark):
    depth = 3000
    text = "(" * depth + "tip" + ",x)" * depth + ";"
    rows = newick_edges(spark.createDataFrame([(1, text)], "tree_id bigint, newick string"), 64)
    assert rows.count() == 2 * depth + 1
    assert rows.where("node = 1").first().parent == 2 * depth + 1


def test_file_in_splits(spark, tmp_path):
    # Small splits, so that labels and brackets of one tree come from many tasks.
    (tree, text) = max(trees(7, 40, 7), key=lambda made: len(made[1]))
    path = tmp_path / "one.tree"
    path.write_text(text + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = [tuple(row) for row in newick_file_edges(spark, str(path), 16).select("parent", "node", "branch_length", "label").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(found, key=repr) == numbered(tree)


def test_star_and_comments(spark):
    text = "(" + ",".join(f"t{k}[x:1]:{k}" for k in range(5000)) + ")[c]root;"
    rows = newick_edges(spark.createDataFrame([(1, text)], "tree_id bigint, newick string"), 64)
    assert rows.where("parent = 5001").count() == 5001 and rows.where("label = 'root'").first().node == 5001
    assert rows.where("node = 4000").first().branch_length == 3999


def test_one_file_with_one_tree(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.tree").write_text("(x,y)z;")
    with pytest.raises(NewickError):
        newick_file_edges(spark, str(tmp_path))
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "c.tree").write_text("(x,y)z;(v,w)u;")
    with pytest.raises(NewickError):
        newick_file_edges(spark, str(tmp_path / "two" / "c.tree"))


@pytest.mark.parametrize("long", [1, 7, 40, 4096])
def test_any_cut_gives_the_same(spark, long):
    """Quotes and brackets in comments, commas, brackets, doubled and lone quotes in labels, at whatever place a text is cut."""
    texts = [
        "('a, (b)':1[it's, (not) a label],o'brien:2,[x'']'it''s, [no] (c)':3)'root, ''r''':0.5;",
        "((,)[a],('','(((' :2)')))':1)[',']z;",
        "(((((a:1,b:1)'x,y':1,c)'q(''':2,d)e:3)f)g;",
        *(text for _, text in trees(11, 12, 5)),
    ]
    frame = spark.createDataFrame([(at, text) for at, text in enumerate(texts)], "tree_id bigint, newick string")
    listed = lambda tokens: sorted((r.tree_id, r.pos, r.token) for r in tokens.collect())
    assert listed(text_tokens(frame, 4, long)) == listed(text_tokens(frame))
    named = {(r.tree_id, r.label, r.branch_length) for r in edges(text_tokens(frame.where("tree_id < 3"), 4, long), 4).collect()}
    assert {(0, "'a, (b)'", 1.0), (0, "o'brien", 2.0), (0, "'it''s, [no] (c)'", 3.0), (0, "'root, ''r'''", 0.5), (1, "')))'", 1.0), (1, "z", None), (2, "'q('''", 2.0)} <= named


def test_quotes_and_commas_gather_nothing(spark, tmp_path):
    """A lone quote within a label, and commas in comments, leave a file's stretches apart."""
    text = "(" + ",".join(f"o'brien{k}[a, b's]:{k}" for k in range(300)) + ")root;"
    (tmp_path / "one.tree").write_text(text)
    rows = newick_file_edges(spark, str(tmp_path / "one.tree"), 16)
    assert rows.where("parent = 301").count() == 301 and rows.where("label = \"o'brien299\" and branch_length = 299").count() == 1


def test_short_texts_stay_in_their_task(spark):
    """One shuffle deals the texts; tokens, events and nodes are not dealt or summed again. Brackets may be left open."""
    texts = ["((a:1,b:2)c:3,d)e;", "(a,(b,'x)'", "a,b;", "(,);", "(a,b));", "a)(b,c)d;", ";", "", *(text for _, text in trees(13, 20, 4))]
    frame = spark.createDataFrame([(at, text) for at, text in enumerate(texts)], "tree_id bigint, newick string")
    found = newick_edges(frame)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Aggregate" not in plan and "Join" not in plan
    listed = lambda rows: sorted((repr(tuple(r)) for r in rows.select("tree_id", "parent", "node", "branch_length", "label").collect()))
    assert listed(found) == listed(edges(text_tokens(frame)))
