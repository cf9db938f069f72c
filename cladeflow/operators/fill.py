"""Replace the reference node at the start of a taxonomy string by that node's own lineage.

The lineage of a node is voted on by the reference genomes below it. Votes are counted per lineage
prefix, not per genome: they are summed at the lowest node asked for and then passed up between the
nodes asked for, cut to the ranks that still matter there.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeflow.functions.taxonomy import anchor_node, below_anchor, genus_of, is_complete, species_name
from cladeflow.operators.keys import NodeKeys
from cladeflow.operators.tree import farther, nearest_marked
from cladeflow.params import RANK_LETTERS, SPECIES, DomainParams, as_domains, preset
from cladeflow.session import cut, cut_counting, tune

COMPLETE_LINEAGE = "^d__[^;]*" + "".join(f";{letter}__[^;]*" for letter in RANK_LETTERS) + "$"


def first_missing_rank(rest: Column) -> Column:
    """Rank at which the given part of a taxonomy starts; species if there is none. Null if the part
    does not start with a rank."""
    letters = F.array(*[F.lit(letter + "__") for letter in RANK_LETTERS])
    at = F.array_position(letters, F.substring(rest, 1, 3)).cast("int")
    return F.when(rest == "", SPECIES).when(at > 0, at - 1)


def leading_ranks(taxonomy: Column, rank: Column) -> Column:
    """The part of a complete lineage above a rank."""
    return F.array_join(F.slice(F.split(taxonomy, ";"), F.lit(1), rank + 1), ";")


def _domain(gtdb_taxonomy: DataFrame) -> list[str]:
    return ["domain"] if "domain" in gtdb_taxonomy.columns else []


def prefix_votes(nodes: DataFrame, wanted: DataFrame, gtdb_taxonomy: DataFrame) -> DataFrame:
    """Votes per wanted node and lineage: ``node, lineage, odd, votes``.

    ``wanted`` has ``node, rank`` (the first rank that is not asked for). Lineages are cut to the
    finest rank any wanted node further up needs; malformed ones (``odd``) stay whole. A taxonomy with
    a ``domain`` column votes in that domain's tree only; ``nodes`` then has that column too.
    """
    inner = nodes.where(F.col("genome").isNull()).select("node", "parent")
    ranks = wanted.groupBy(F.col("node").alias("_wanted")).agg(F.max("rank").alias("finest"))
    marked = inner.join(ranks, inner["node"] == ranks["_wanted"], "left").select(
        "node", "parent", F.col("_wanted").isNotNull().alias("marked"), "finest"
    )
    marked = cut(marked)
    reached = nearest_marked(marked).where(F.col("reached").isNotNull())
    reached_from = reached.select(F.col("node").alias("parent"), F.col("reached").alias("up"))

    links = (
        marked.where("marked")
        .join(reached_from, "parent", "left")
        .select("node", F.when(F.col("node") != F.col("parent"), F.col("up")).alias("jump"), "finest")
    )
    steps, needed = _wanted_steps(links)

    # Genomes are counted per node and full lineage before anything else, so what meets at a node afterwards is one row
    # per lineage, and these are dealt by node and lineage.
    tips = nodes.where(F.col("genome").isNotNull()).select("genome", "parent", *_domain(gtdb_taxonomy))
    lineages = gtdb_taxonomy.select("genome", "taxonomy", *_domain(gtdb_taxonomy))
    counted = (
        tips.join(lineages, ["genome", *_domain(gtdb_taxonomy)])
        .join(reached_from, "parent")
        .groupBy("up", "taxonomy")
        .agg(F.count(F.lit(1)).alias("votes"))
        .join(needed.withColumnRenamed("node", "up"), "up")
    )
    complete = F.col("taxonomy").rlike(COMPLETE_LINEAGE)
    votes = (
        counted.select(
            F.col("up").alias("node"),
            F.when(complete, leading_ranks(F.col("taxonomy"), F.col("finest"))).otherwise(F.col("taxonomy")).alias("lineage"),
            (~complete).alias("odd"),
            "votes",
        )
        .repartition("node", "lineage")
        .groupBy("node", "lineage", "odd")
        .agg(F.sum("votes").alias("votes"))
    )
    votes = cut(votes)

    finest_there = needed.withColumnRenamed("finest", "finest_there")
    for step in steps:
        # After k rounds each node holds the votes of all wanted nodes less than 4^k steps below.
        targets = F.explode(F.array_compact(F.array("jump", "jump2", "jump3")))
        sent = (
            votes.join(step.where(F.col("jump").isNotNull()), "node")
            .select(targets.alias("node"), "lineage", "odd", "votes")
            .join(finest_there, "node")
            .select(
                "node",
                F.when(F.col("odd"), F.col("lineage")).otherwise(leading_ranks(F.col("lineage"), F.col("finest_there"))).alias("lineage"),
                "odd",
                "votes",
            )
        )
        votes = cut(
            votes.unionByName(sent)
            .repartition("node", "lineage")
            .groupBy("node", "lineage", "odd")
            .agg(F.sum("votes").alias("votes"))
        )
    return votes


def _wanted_steps(links: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Per round the wanted nodes one, two and three times 4^k steps above each, ``node, jump, jump2, jump3``; and the finest
    rank that any of them or the node itself asks for, ``node, finest``. ``links``: ``node, jump, finest``.

    nearest_marked has followed the same pointers, so they end.
    """
    steps = []
    while True:
        ranks = F.greatest("finest", "finest1", "finest2", "finest3")
        far, count = cut_counting(
            farther(links, links, ["finest"]).select("node", "jump", "jump2", "jump3", "jump4", ranks.alias("finest")), open=F.col("jump4").isNotNull()
        )
        steps.append(far.select("node", "jump", "jump2", "jump3"))
        if not count["open"]:
            return steps, far.select("node", "finest")
        links = far.select("node", F.col("jump4").alias("jump"), "finest")


def vote_prefix(votes: DataFrame, wanted: DataFrame, mode: str = "least_common") -> DataFrame:
    """The lineage above ``rank`` per wanted node: ``node, rank, prefix``.

    The least common prefix wins (``mode="most_common"`` for the other way round), on equal counts the
    first one alphabetically. Null if lineages without that rank win.
    """
    sign = {"least_common": 1, "most_common": -1}[mode]
    limit = F.when(F.col("bare"), "").otherwise(
        F.concat(F.get(F.array(*[F.lit(letter) for letter in RANK_LETTERS]), F.col("rank")), F.lit("__"))
    )
    pattern = F.concat(F.lit("(.*);"), limit)
    odd_prefix = F.when(
        F.rlike(F.col("lineage"), pattern), F.call_function("regexp_extract", F.col("lineage"), pattern, F.lit(1))
    )
    prefix = F.when(F.col("odd"), odd_prefix).otherwise(leading_ranks(F.col("lineage"), F.col("rank")))
    counted = (
        wanted.join(votes, "node")
        .select("node", "rank", "bare", prefix.alias("prefix"), "votes")
        .repartition("node", "prefix")
        .groupBy("node", "rank", "bare", "prefix")
        .agg(F.sum("votes").alias("votes"))
    )
    choice = F.min(F.struct((F.col("votes") * sign).alias("votes"), F.col("prefix").isNull().alias("none"), "prefix"))
    return counted.groupBy("node", "rank", "bare").agg(choice["prefix"].alias("prefix"))


@dataclass
class Fill:
    """One fill run over taxonomy strings of one or several domains."""

    nodes: DataFrame
    genome_taxonomy: DataFrame
    names: DataFrame
    gtdb_taxonomy: DataFrame
    domains: tuple[DomainParams, ...]
    mode: str = "least_common"

    def __post_init__(self) -> None:
        tune(self.nodes.sparkSession)
        self.keys = NodeKeys(self.domains)

    @cached_property
    def _strings(self) -> DataFrame:
        # Written first: filters below would work the strings out anew for each thing that is read from them.
        tagged = cut(self.keys.tagged(self.genome_taxonomy).select("domain", "genome", "taxonomy"))
        rest = below_anchor(F.col("taxonomy"))
        return tagged.select(
            "domain",
            "genome",
            "taxonomy",
            is_complete(F.col("taxonomy")).alias("complete"),
            self.keys.key(anchor_node(F.col("taxonomy")), F.col("domain")).alias("node"),
            rest.alias("rest"),
            first_missing_rank(rest).alias("rank"),
            (rest == "").alias("bare"),
        )

    @cached_property
    def prefixes(self) -> DataFrame:
        """``node, rank, bare, prefix`` for every reference node the strings start at."""
        tree = self.keys.tagged(self.nodes).select(
            self.keys.key(F.col("node"), F.col("domain")).alias("node"),
            self.keys.key(F.coalesce("parent", "node"), F.col("domain")).alias("parent"),
            "genome",
            "domain",
        )
        wanted = cut(
            self._strings.where(~F.col("complete") & F.col("node").isNotNull() & F.col("rank").isNotNull())
            .select("node", "rank", "bare")
            .distinct()
        )
        return cut(vote_prefix(prefix_votes(tree, wanted, self.gtdb_taxonomy), wanted, self.mode))

    @cached_property
    def filled(self) -> DataFrame:
        joined = self._strings.join(self.prefixes, ["node", "rank", "bare"], "left")
        species = species_name(genus_of(F.col("prefix")), F.col("genome"))
        below = F.when(F.col("bare"), species).otherwise(F.col("rest"))
        full = F.concat(F.col("prefix"), F.lit(";"), below)
        return cut(joined.select(
            "domain",
            "genome",
            F.when(F.col("complete"), F.col("taxonomy")).otherwise(F.coalesce(full, "taxonomy")).alias("taxonomy"),
            F.when(~F.col("complete") & F.col("bare") & full.isNotNull(), species).alias("species"),
            (~F.col("complete") & full.isNull()).alias("open"),
        ))

    @property
    def genomes(self) -> DataFrame:
        return self.keys.untagged(self.filled.select("domain", "genome", "taxonomy"), self.genome_taxonomy)

    @property
    def node_names(self) -> DataFrame:
        added = self.filled.where(F.col("species").isNotNull()).select(
            "domain", F.lit(None).cast("bigint").alias("node"), F.col("species").alias("clade"), F.col("genome").alias("genome_rep")
        )
        return self.names.unionByName(self.keys.untagged(added, self.names))

    @property
    def issues(self) -> DataFrame:
        unfilled = self.filled.where("open").select("domain", F.lit("no_reference_lineage").alias("issue"), "genome")
        return self.keys.untagged(unfilled, self.genome_taxonomy)


def fill_taxonomy(
    nodes: DataFrame,
    genome_taxonomy: DataFrame,
    node_names: DataFrame,
    gtdb_taxonomy: DataFrame,
    domain: str | list[DomainParams] | DomainParams = "d__Bacteria",
    mode: str = "least_common",
) -> tuple[DataFrame, DataFrame]:
    """Complete the strings of ``name_clades`` from the reference taxonomy: (genomes, node_names)."""
    domains = (preset(domain),) if isinstance(domain, str) else as_domains(domain)
    run = Fill(nodes, genome_taxonomy, node_names, gtdb_taxonomy, domains, mode)
    return run.genomes, run.node_names
