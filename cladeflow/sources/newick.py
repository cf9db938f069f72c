"""Newick trees to node tables.

Texts are cut into chunks, behind a comma or before a bracket. What a chunk means depends on whether it begins within a
quoted label or a comment, so each chunk first tells how it ends for each of the three ways it may begin. These transitions
are combined over chunks, within pieces of bounded length and over the pieces; every chunk is then taken apart on its own.
Only the parts of a quoted label that goes over several chunks are put together again. Running counts along a tree are taken
in the same two steps, so a very large tree is no hot group.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeflow.operators.running import PIECE, running
from cladeflow.session import cut, cut_counting

# Quoted label (a doubled quote stands for one), comment, punctuation, branch length, plain label (in which a
# quote is a sign like any other, unless it comes first).
COMPLETE = r"'[^']*(?:''[^']*)*'(?!')|\[[^\]]*\]|[(),;]|:[0-9eE.+-]+|[^(),:;'\s\[][^(),:;\s\[]*"
# A quote or comment that is not closed goes on to the end.
TOKEN = rf"({COMPLETE}|'[^']*(?:''[^']*)*$|\[[^\]]*$)"
CLOSING = r"^([^']*(?:''[^']*)*'(?!'))"
# Characters after which a chunk ends before the next bracket.
LONG = 4096
# Characters of short texts that one task takes apart; a row of a sort takes some tens of times its token.
TASK = 4 << 20


class NewickError(ValueError):
    """A file that does not hold one tree."""


def _tokens(text: str) -> Column:
    """Tokens of a text, comments left out."""
    return F.filter(F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(1)), lambda token: ~token.startswith("["))


def _is_label(token: Column) -> Column:
    return F.coalesce(~token.isin("(", ")", ",", ";") & ~token.startswith(":"), F.lit(False))


def _length(token: Column) -> Column:
    return F.when(token.startswith(":"), F.substr(token, F.lit(2)).try_cast("double"))


def _in_context(texts: DataFrame, text: str, *columns: str) -> DataFrame:
    """``pos, token, prev, next, after`` per token of each text: its place and its neighbours."""
    return _around(texts.select(*columns, _tokens(text).alias("_tokens")), *columns)


def _around(listed: DataFrame, *columns: str) -> DataFrame:
    # The neighbours are looked up behind the explode, in generated code, not built as structs within the array.
    exploded = listed.select(*columns, "_tokens", F.posexplode("_tokens").alias("pos", "token"))
    beside = {"prev": -1, "next": 1, "after": 2}
    return exploded.select(
        *columns, F.col("pos").cast("bigint").alias("pos"), "token", *[F.get("_tokens", F.col("pos") + step).alias(name) for name, step in beside.items()]
    )


def text_tokens(trees: DataFrame, piece: int = PIECE, long: int = LONG) -> DataFrame:
    """Tokens of ``trees(tree_id, newick)``: ``tree_id, pos, token, prev, next, after``. Short texts are taken apart as they
    are, the chunks of long ones are spread over tasks."""
    too_long = F.length("newick") > long
    short = _in_context(trees.where(~too_long), "newick", "tree_id")
    if trees.where(too_long).isEmpty():
        return short
    return short.unionByName(_long_tokens(trees.where(too_long), piece, long))


def _long_tokens(trees: DataFrame, piece: int, long: int) -> DataFrame:
    parts = F.posexplode(_chunks(F.col("newick"), long)).alias("at", "text")
    chunks = trees.select("tree_id", parts).withColumn("at", F.col("at").cast("bigint"))
    return chunk_tokens(cut(chunks.repartition("tree_id", "at")), piece)


def file_tokens(spark: SparkSession, path: str, piece: int = PIECE, long: int = LONG) -> DataFrame:
    """The same for a file holding one tree, however large: the file is read in parallel, split at its commas, wherever they
    stand. Stretches between commas are put in order by their place in the file."""
    read = spark.read.option("lineSep", ",").text(path).select(
        F.col("value"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row")
    )
    read = cut(read.withColumn("_parts", _chunks(F.concat("value", F.lit(",")), long)).drop("value"))
    files = [row[0] for row in read.select("_file").distinct().take(2)]
    if len(files) > 1:
        raise NewickError(f"one file with one tree is asked for, found {' and '.join(files)}")
    blocks = read.groupBy("_block").agg(F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first"))
    # One row per split of the file.
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("_block", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    stretches = read.join(F.broadcast(starts), "_block").select(
        F.lit(1).cast("bigint").alias("tree_id"), (F.col("_row") - F.col("_first") + F.col("_start")).alias("at"), F.size("_parts").alias("_own"), F.size("_parts").alias("_end"), "_parts"
    )
    counted = running(stretches, ["tree_id"], "at", ["_end"], piece=piece)
    chunks = counted.select("tree_id", (F.col("_end") - F.col("_own")).alias("_start"), F.posexplode("_parts").alias("_part", "text"))
    return chunk_tokens(cut(chunks.select("tree_id", (F.col("_start") + F.col("_part")).cast("bigint").alias("at"), "text")), piece)


def _chunks(text: Column, long: int) -> Column:
    """A text in stretches of about ``long`` characters that end before a bracket."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)(.{{{long}}}[^()]*|.+)"), F.lit(1))


def _end(text: Column) -> Column:
    """How a chunk ends that begins outside of labels and comments: ``n``, or within a quoted label ``q`` or a comment ``c``."""
    open_sign = F.regexp_extract(F.regexp_replace(text, COMPLETE, ""), r"(['\[])", 1)
    return F.when(open_sign == "'", "q").when(open_sign == "[", "c").otherwise("n")


def _transition(text: Column) -> Column:
    """How a chunk ends if it begins as n, q or c: three letters."""
    closed, comment = F.regexp_extract(text, CLOSING, 1), F.instr(text, "]")
    from_q = F.when(closed == "", "q").otherwise(_end(F.substr(text, F.length(closed) + 1)))
    from_c = F.when(comment == 0, "c").otherwise(_end(F.substr(text, comment + 1)))
    return F.when(~text.rlike(r"['\[\]]"), "nqc").otherwise(F.concat(_end(text), from_q, from_c))


def _after(code: str, state: str) -> str:
    return code["nqc".index(state)]


def _states(chunks: DataFrame, piece: int) -> DataFrame:
    """The chunks with ``state``, in which each begins, and ``ends``. A piece of so many chunks is one group, of letters only."""
    told = cut(chunks.withColumn("code", _transition(F.col("text"))))
    marks = told.where("code <> 'nqc'").select("tree_id", "at", "code", F.expr(f"at div {piece}").alias("piece"))

    def whole(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ends = "nqc"
        for code in rows.sort_values("at")["code"]:
            ends = "".join(_after(code, s) for s in ends)
        return pd.DataFrame({"tree_id": [key[0]], "piece": [key[1]], "code": [ends]})

    def over_pieces(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows, state, begun = rows.sort_values("piece"), "n", []
        for code in rows["code"]:
            begun.append(state)
            state = _after(code, state)
        return pd.DataFrame({"tree_id": rows["tree_id"], "piece": rows["piece"], "begun": begun})

    def within(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows, states = rows.sort_values("at"), []
        state = rows["begun"].iloc[0]
        for code in rows["code"]:
            states.append(state)
            state = _after(code, state)
        ends = [_after(code, s) for code, s in zip(rows["code"], states, strict=True)]
        return pd.DataFrame({"tree_id": rows["tree_id"], "at": rows["at"], "state": states, "ends": ends})

    totals = marks.groupBy("tree_id", "piece").applyInPandas(whole, "tree_id bigint, piece bigint, code string")
    # one row for each piece of a tree
    heads = totals.groupBy("tree_id").applyInPandas(over_pieces, "tree_id bigint, piece bigint, begun string")
    known = marks.join(heads, ["tree_id", "piece"]).groupBy("tree_id", "piece").applyInPandas(within, "tree_id bigint, at bigint, state string, ends string")
    # All other chunks begin and end as the last of these has ended.
    number = F.coalesce(F.instr(F.lit("nqc"), F.col("ends")) - 1 + 4 * (F.col("at") + 1), F.lit(0)).cast("bigint")
    placed = told.drop("code").join(known, ["tree_id", "at"], "left").withColumn("_last", number)
    lasting = running(placed, ["tree_id"], "at", maxima=["_last"], piece=piece)
    last = F.substr(F.lit("nqc"), (F.col("_last") % 4 + 1).cast("int"), F.lit(1))
    return lasting.select("tree_id", "at", "text", F.coalesce("state", last).alias("state"), F.coalesce("ends", last).alias("ends"))


def chunk_tokens(chunks: DataFrame, piece: int = PIECE) -> DataFrame:
    """Tokens of ``chunks(tree_id, at, text)``, numbered from 0 in each tree: ``tree_id, pos, token, prev, next, after``."""
    known = _states(chunks, piece)
    quoted, in_comment = F.col("state") == "q", F.col("state") == "c"
    closed, comment = F.regexp_extract("text", CLOSING, 1), F.instr("text", "]")
    # What belongs to the label or comment that has begun before.
    head = F.when(quoted, F.when(closed == "", F.col("text")).otherwise(closed)).when(
        in_comment, F.when(comment == 0, F.col("text")).otherwise(F.substr("text", F.lit(1), comment))
    ).otherwise("")
    parted = known.select("tree_id", "at", "state", "ends", head.alias("head"), F.substr("text", F.length(head) + 1).alias("body"))
    parted = parted.withColumn("tokens", _tokens("body"))
    opens = (F.col("ends") == "q") & F.element_at(F.col("tokens"), -1).startswith("'")
    parted = parted.withColumn("opens", F.coalesce((F.size("tokens") > 0) & opens, F.lit(False)).cast("bigint")).withColumn("label_no", F.col("opens"))
    size = F.size("tokens").cast("bigint")
    parted = cut(parted.withColumn("n", size).withColumn("end", size).withColumn("full_no", (size > 0).cast("bigint")))
    sums = ["label_no", "end", "full_no"]
    counted = running(parted.select("tree_id", "at", *sums), ["tree_id"], "at", sums=sums, piece=piece)
    placed = cut(parted.drop(*sums).join(counted, ["tree_id", "at"]).withColumn("first", F.col("end") - F.col("n")))

    # Labels that go over several chunks: the part that opens one stands last in its chunk.
    pieces = placed.where("opens = 1").select("tree_id", "label_no", "at", F.element_at("tokens", -1).alias("part")).unionByName(
        placed.where("state = 'q'").select("tree_id", (F.col("label_no") - F.col("opens")).alias("label_no"), "at", F.col("head").alias("part"))
    )
    labels = pieces.groupBy("tree_id", "label_no").agg(F.sort_array(F.collect_list(F.struct("at", "part"))).alias("parts"))
    said = F.array_join(F.transform("parts", lambda x: x["part"]), "")
    labels = labels.select("tree_id", "label_no", said.alias("whole"), F.lit(1).cast("bigint").alias("opens"))
    joined = F.concat(F.slice("tokens", F.lit(1), F.col("n").cast("int") - 1), F.array("whole"))
    full = placed.where("n > 0").join(labels, ["tree_id", "label_no", "opens"], "left").select(
        "tree_id", "full_no", "first", "n", F.when(F.col("whole").isNotNull(), joined).otherwise(F.col("tokens")).alias("tokens")
    )
    full = cut(full)

    # The neighbours of a chunk's tokens: the last token before it and the first two behind it.
    def beside(step: int, **tokens: Column) -> DataFrame:
        return full.select("tree_id", (F.col("full_no") + step).alias("full_no"), *[token.alias(name) for name, token in tokens.items()])

    one, two = F.get("tokens", F.lit(0)), F.get("tokens", F.lit(1))
    around = (
        full.join(beside(1, before=F.element_at("tokens", -1)), ["tree_id", "full_no"], "left")
        .join(beside(-1, next1=one, next2=two), ["tree_id", "full_no"], "left")
        .join(beside(-2, next3=one), ["tree_id", "full_no"], "left")
    )
    tokens = F.concat("tokens", F.array("next1", F.coalesce("next2", "next3")))
    found = _around(around.select("tree_id", "first", "n", "before", tokens.alias("_tokens")), "tree_id", "first", "n", "before").where("pos < n")
    before = F.when(F.col("pos") == 0, F.col("before")).otherwise(F.col("prev"))
    return found.select("tree_id", (F.col("pos") + F.col("first")).alias("pos"), "token", before.alias("prev"), "next", "after")


def newick_edges(trees: DataFrame, piece: int = PIECE, long: int = LONG) -> DataFrame:
    """``tree_id, parent, node, branch_length, label`` for ``trees(tree_id, newick)``. Texts of up to ``long`` characters are
    dealt whole, and what is in one stays in its task; the others are spread over tasks."""
    if long >= piece:
        return edges(text_tokens(trees, piece, long), piece)
    size = F.length("newick")
    held = trees.agg(F.sum(F.when(size <= long, size)).alias("short"), F.count_if(size > long).alias("long")).first()
    tasks = max(trees.sparkSession.sparkContext.defaultParallelism, (held["short"] or 0) // TASK + 1)
    found = _short_edges(trees.where((size <= long) & F.col("tree_id").isNotNull()).select("tree_id", "newick").repartition(tasks, "tree_id"))
    return found.unionByName(edges(_long_tokens(trees.where(size > long), piece, long), piece)) if held["long"] else found


def _short_edges(trees: DataFrame) -> DataFrame:
    """``edges`` of texts that are dealt by tree: windows and all rows of a tree stay where its text is."""
    marked = _marked(_in_context(trees, "newick", "tree_id"))
    closed = F.coalesce(F.col("bracket") == "close", F.lit(False))
    # A leaf at a closing bracket has neither label nor length.
    marked = marked.select(
        "tree_id", "pos", "bracket", "leaf", "depth", "tip_no", "open_no",
        F.when(closed, F.col("end_label")).otherwise(F.col("label")).alias("label"),
        F.when(closed, F.col("end_length")).otherwise(F.col("branch_length")).alias("branch_length"),
    )
    tree = Window.partitionBy("tree_id")
    so_far = tree.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    kept = ("tree_id", "pos", "bracket", "leaf", "label", "branch_length")
    counted = marked.select(*kept, *[F.sum(c).over(so_far).alias(c) for c in ("depth", "tip_no", "open_no")], F.sum("tip_no").over(tree).alias("tips"))

    # Along a level a child's parent is the last bracket opened one level above it, and what closes a child comes next after it.
    # A bracket that opens stands on its own level and, as a child, on the one above; a leaf may stand at a closing bracket.
    opened = F.coalesce(F.col("bracket") == "open", F.lit(False))
    both = opened | (F.col("leaf") & closed)
    events = counted.select("*", F.explode(F.when(both, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_side"))
    side, depth = F.col("_side"), F.col("depth")
    role = F.when(opened, F.when(side == 0, "open").otherwise("child")).when(closed & (~F.col("leaf") | (side == 1)), "close").otherwise("leaf")
    events = events.withColumn("role", role).select(
        "tree_id",
        "pos",
        "tips",
        "role",
        F.when(F.col("role") == "child", depth - 1).when(closed & (F.col("role") == "leaf"), depth + 1).otherwise(depth).alias("level"),
        F.when(F.col("role") == "open", F.col("open_no")).alias("around"),
        F.when(F.col("role") == "child", F.col("tips") + F.col("open_no")).when(F.col("role") == "leaf", F.col("tip_no")).alias("node"),
        *[F.when((F.col("role") == "close") | ((F.col("role") == "leaf") & ~closed), F.col(c)).alias(c) for c in ("label", "branch_length")],
    )
    level = Window.partitionBy("tree_id", "level").orderBy("pos")
    shut = F.lead("role").over(level) == "close"
    located = events.select(
        "tree_id",
        "tips",
        "level",
        "role",
        F.max("around").over(level.rowsBetween(Window.unboundedPreceding, 0)).alias("around"),
        "node",
        F.lag("role").over(level).isNull().alias("first"),
        *[F.when(F.col("role") != "child", F.col(c)).when(shut, F.lead(c).over(level)).alias(c) for c in ("branch_length", "label")],
    )
    # The first bracket that closes nothing leaves a row without node.
    shown = F.col("role").isin("child", "leaf") | ((F.col("role") == "close") & F.col("first") & (F.col("level") == -1))
    return located.where(shown).select(
        "tree_id",
        F.coalesce(F.col("tips") + F.col("around"), "node").cast("bigint").alias("parent"),
        F.col("node").cast("bigint").alias("node"),
        "branch_length",
        "label",
    )


def newick_file_edges(spark: SparkSession, path: str, piece: int = PIECE) -> DataFrame:
    """``parent, node, branch_length, label`` for a file holding one tree; anything else raises NewickError."""
    found, count = cut_counting(edges(file_tokens(spark, path, piece), piece).drop("tree_id"), roots=F.col("parent") == F.col("node"))
    if count["roots"] != 1:
        raise NewickError(f"{path} has {count['roots']} roots")
    return found


def _marked(tokens: DataFrame) -> DataFrame:
    """Brackets and leaves with what they say. Commas, labels and lengths are not counted themselves."""
    token = F.col("token")
    opens = token == "("
    closes = token == ")"
    leaf = F.coalesce(F.col("prev").isin("(", ","), F.lit(False)) & ~opens
    marked = tokens.select(
        "tree_id",
        "pos",
        F.when(opens, "open").when(closes, "close").alias("bracket"),
        leaf.alias("leaf"),
        F.when(leaf & _is_label(token), token).alias("label"),
        F.when(leaf, F.coalesce(_length(token), F.when(_is_label(token), _length(F.col("next"))))).alias("branch_length"),
        F.when(closes & _is_label(F.col("next")), F.col("next")).alias("end_label"),
        F.when(closes, F.coalesce(_length(F.col("next")), F.when(_is_label(F.col("next")), _length(F.col("after"))))).alias(
            "end_length"
        ),
        F.when(opens, 1).when(closes, -1).otherwise(0).alias("depth"),
        leaf.cast("int").alias("tip_no"),
        opens.cast("int").alias("open_no"),
    )
    return marked.where("leaf or bracket is not null")


def edges(tokens: DataFrame, piece: int = PIECE) -> DataFrame:
    """Node table from tokens.

    Tips are numbered 1..N in order of appearance, internal nodes from N+1 in pre-order; the root N+1
    is its own parent. Quotes stay part of a label.
    """
    # Texts are taken apart once only.
    marked, count = cut_counting(_marked(tokens), long=F.col("pos") >= piece)
    short = not count["long"]
    counted = running(marked, ["tree_id"], "pos", ["depth", "tip_no", "open_no"], piece=piece, short=short)

    # A bracket and everything directly inside it share a level. Along a level the bracket around a child, and the one
    # a ")" closes, is the last that was opened.
    number = F.lit(None).cast("bigint")
    end = F.struct(F.col("end_label").alias("label"), F.col("end_length").alias("branch_length"))
    own = F.struct("label", "branch_length")
    none = F.lit(None).cast("struct<label:string,branch_length:double>")

    def event(level: Column, role: str, around: Column, tip: Column, inner: Column, said: Column) -> Column:
        return F.struct(level.alias("level"), F.lit(role).alias("role"), around.alias("around"), tip.alias("tip"), inner.alias("inner"), said.alias("said"))

    depth, closed = F.col("depth"), F.coalesce(F.col("bracket") == "close", F.lit(False))
    opened = F.coalesce(F.col("bracket") == "open", F.lit(False))
    events = counted.select(
        "tree_id",
        "pos",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(opened, event(depth, "open", F.col("open_no"), number, number, none)),
                    F.when(opened, event(depth - 1, "child", number, number, F.col("open_no"), none)),
                    # A missing label may leave a leaf at its closing bracket, whose depth is one less.
                    F.when(F.col("leaf"), event(depth + closed.cast("int"), "child", number, F.col("tip_no"), number, own)),
                    F.when(closed, event(depth + 1, "close", number, number, number, end)),
                )
            )
        ).alias("event"),
    ).select("tree_id", "pos", "event.*")
    if not short:
        events = cut(events)
    located = running(events, ["tree_id", "level"], "pos", maxima=["around"], piece=piece, short=short).where("role <> 'open'")
    closing = F.col("role") == "close"
    # An inner node has two rows, one that tells its parent and one that tells its label.
    rows = located.groupBy("tree_id", F.col("tip"), F.when(closing, F.col("around")).otherwise(F.col("inner")).alias("inner")).agg(
        F.max(F.when(~closing, F.col("around"))).alias("around"), F.max("said").alias("said")
    )
    tip_counts = marked.groupBy("tree_id").agg(F.sum("tip_no").alias("tips"))
    node = F.coalesce("tip", F.col("tips") + F.col("inner"))
    return rows.join(tip_counts, "tree_id").select(
        "tree_id",
        F.coalesce(F.col("tips") + F.col("around"), node).cast("bigint").alias("parent"),
        node.cast("bigint").alias("node"),
        F.col("said.branch_length").alias("branch_length"),
        F.col("said.label").alias("label"),
    )
