"""Clade naming: every new genome gets a full taxonomy, every new clade the name of its best genome.

Genomes are taken in order of quality and walk up the tree, naming each clade they are the first to
reach. Which node carries which rank, and who gets there first, can be stated without the walk:

* A node's *span* is the ranks between its parent's RED bin and its own; the node bears these ranks
  unless a neighbour of the same rank is closer to the rank's median RED (`naming_spans`).
* A rank is named by the best genome below its node (`winners`).
* A genome stops at the lowest node that was named before it came, and shares the lineage of the
  genome that named it (`local_records`, `resolve`).
* A genome that is not stopped reaches the reference part of the tree (its *anchor*), which supplies
  the ranks above, or the root of an entirely new tree.

So the whole process is a handful of joins and aggregations over nodes and genomes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladeflow.functions.ranks import closer_to_median, median_red, per_domain, rank_index, rank_word
from cladeflow.functions.taxonomy import clade_name, lineage, species_name
from cladeflow.operators.keys import NodeKeys
from cladeflow.operators.ordering import in_order, with_quality
from cladeflow.operators.tree import child_counts, jump_until_done, with_parent
from cladeflow.params import GENUS, NAMED_RANKS, SPECIES, DomainParams, as_domains, preset
from cladeflow.session import cut, tune

RANK_COUNT = len(NAMED_RANKS)
NAMES = [f"name_{rank}" for rank in range(RANK_COUNT)]

# How a path of non-reference nodes ends, or is interrupted.
NAMED = "named"  # a node that bears names
ANCHOR = "anchor"  # the first reference node
ROOT = "root"  # the root of a tree without reference node on the way
INVALID = "invalid"  # a node whose RED bin is unknown or lies above its parent's


def node_facts(inner: DataFrame, domains: tuple[DomainParams, ...]) -> DataFrame:
    """What naming needs to know about each internal node, from the node, its parent and its children.

    ``inner`` has ``node, parent`` (keys), ``domain, gtdb, rank, red`` and no tips.
    """
    is_root = F.col("node") == F.col("parent")
    candidates = inner.where(~F.col("gtdb")).select("node", "parent", F.lit(None).alias("genome"))
    linked = with_parent(inner, ["rank", "red"]).join(child_counts(candidates), "node", "left")
    median = per_domain(F.col("domain"), {p.domain: median_red(F.col("rank"), p) for p in domains})
    parent_red = F.when(is_root, 0.0).otherwise(F.col("parent_red"))
    facts = linked.select(
        "node",
        "parent",
        "gtdb",
        "rank",
        is_root.alias("is_root"),
        F.col("parent_rank").alias("top"),
        (~F.col("gtdb") & (F.col("rank") == F.col("parent_rank"))).alias("same"),
        closer_to_median(F.col("red"), parent_red, median).alias("closer"),
        F.coalesce("n_int", F.lit(0)).alias("n_int"),
    )
    compared = F.col("gtdb") | (F.col("same") & (F.col("n_int") > 0))
    valid = (
        F.col("rank").isNotNull()
        & (F.col("gtdb") | F.coalesce(F.col("top") <= F.col("rank"), F.lit(False)))
        & (~compared | F.col("closer").isNotNull())
    )
    return facts.withColumn("valid", valid).withColumn(
        "passed_over",
        # A child of the same rank takes the name instead.
        F.coalesce(F.col("same") & F.col("closer") & (F.col("n_int") > 0), F.lit(False)),
    )


def naming_spans(facts: DataFrame) -> DataFrame:
    """Per non-reference internal node: the ranks it bears (``first`` to ``last``, null if none).

    ``deferred`` marks a single rank that is only named by a genome that already named a clade below.
    """
    linked = with_parent(
        facts.select("node", "parent", "gtdb", "rank", "is_root", "top", "same", "closer", "valid", "passed_over"),
        ["gtdb", "same", "closer", "rank", "valid"],
    ).where(~F.col("gtdb"))
    contested = F.col("parent_same") | F.col("parent_gtdb")
    keeps_top = ~contested | F.coalesce("parent_closer", F.lit(False))
    length = F.when(F.col("same"), 1).otherwise(F.col("rank") - F.col("top"))
    first = F.when(keeps_top, F.col("top")).when(length >= 2, F.col("top") + 1)
    # Species never attach to a node.
    last = F.least(F.col("top") + length - 1, F.lit(SPECIES - 1))
    bears = F.col("valid") & ~F.col("is_root") & ~F.col("passed_over") & (first <= last)
    return linked.select(
        "node",
        "parent",
        "is_root",
        "valid",
        "parent_gtdb",
        F.when(bears, first).alias("first"),
        F.when(bears, last).alias("last"),
        (bears & ~keeps_top & (length == 2)).alias("deferred"),
        # A reference parent supplies the ranks down to its own, or to the one above.
        _anchor_rank(F.col("parent_rank"), F.col("parent_closer")).alias("parent_anchor_rank"),
        F.col("parent_valid"),
    )


def _anchor_rank(rank: Column, closer: Column) -> Column:
    """Lowest rank supplied by a reference node: -1 if even the phylum is new."""
    return F.when(closer, rank - 1).otherwise(rank)


def landings(facts: DataFrame, spans: DataFrame) -> DataFrame:
    """Where a walk entering at each internal node first ends or meets a name:
    ``node, jump, kind, anchor_rank``."""
    bears = F.col("first").isNotNull()
    stays = bears | ~F.col("valid")
    on_reference = F.col("parent_gtdb")
    state = spans.select(
        "node",
        F.when(stays, F.col("node")).when(F.col("is_root"), None).otherwise(F.col("parent")).alias("jump"),
        (stays | F.col("is_root") | F.coalesce(on_reference, F.lit(False))).alias("done"),
        F.when(~F.col("valid"), INVALID)
        .when(bears, NAMED)
        .when(F.col("is_root"), ROOT)
        .when(on_reference, F.when(F.col("parent_valid"), ANCHOR).otherwise(INVALID))
        .alias("kind"),
        F.when(~stays & on_reference, F.col("parent_anchor_rank")).alias("anchor_rank"),
    )
    reached = jump_until_done(
        state,
        {
            "kind": lambda near, far: far("kind"),
            "anchor_rank": lambda near, far: far("anchor_rank"),
        },
    )
    on_anchor = facts.where("gtdb").select(
        "node",
        F.col("node").alias("jump"),
        F.when(F.col("valid"), ANCHOR).otherwise(INVALID).alias("kind"),
        _anchor_rank(F.col("rank"), F.col("closer")).alias("anchor_rank"),
    )
    return reached.select(
        "node", "jump", F.coalesce("kind", F.lit(INVALID)).alias("kind"), "anchor_rank"
    ).unionByName(on_anchor)


STEP = "array<struct<node:bigint,first:int,last:int,deferred:boolean>>"


def naming_paths(spans: DataFrame, landing: DataFrame) -> DataFrame:
    """Per name-bearing node the name-bearing nodes from it upwards, and how the path ends:
    ``node, steps, end, end_kind, anchor_rank``. Apart from ties in RED a path bears each rank once,
    so it has at most five steps."""
    bearing = spans.where(F.col("first").isNotNull())
    above = bearing.join(
        landing.select(F.col("node").alias("parent"), "jump", "kind", "anchor_rank"), "parent", "left"
    )
    goes_on = F.col("kind") == NAMED
    state = above.select(
        "node",
        F.when(goes_on, F.col("jump")).alias("jump"),
        F.coalesce(~goes_on, F.lit(True)).alias("done"),
        F.array(F.struct("node", "first", "last", "deferred")).cast(STEP).alias("steps"),
        F.when(~goes_on, F.col("jump")).alias("end"),
        F.coalesce("kind", F.lit(INVALID)).alias("end_kind"),
        "anchor_rank",
    )
    return jump_until_done(
        state,
        {
            "steps": lambda near, far: F.concat(near("steps"), far("steps")),
            "end": lambda near, far: far("end"),
            "end_kind": lambda near, far: far("end_kind"),
            "anchor_rank": lambda near, far: far("anchor_rank"),
        },
    ).drop("jump", "done")


def winners(paths: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Which genome names each node: ``node, winner`` (its ``ord``).

    ``arrivals`` has the best genome per node that is the first name-bearing one on its way. A genome
    that already bears a rank does not name it again further up (only possible with ties in RED).
    """
    steps = arrivals.join(paths, "node").select("best", "steps", F.posexplode("steps").alias("at", "step"))
    step = F.col("step")
    already = F.exists(
        F.slice("steps", 1, F.col("at")),
        lambda lower: ~lower["deferred"] & (lower["first"] <= step["last"]) & (lower["last"] >= step["first"]),
    )
    outright = (
        steps.where(~step["deferred"] & ~already)
        .groupBy(step["node"].alias("node"))
        .agg(F.min("best").alias("winner"))
    )
    outright = cut(outright)
    deferred = (
        paths.join(outright, "node")
        .select("winner", F.posexplode("steps").alias("at", "step"))
        .where((F.col("at") > 0) & step["deferred"])
        .groupBy(step["node"].alias("node"))
        .agg(F.min("winner").alias("winner"))
    )
    return outright.unionByName(deferred)


def named_paths(paths: DataFrame, named: DataFrame) -> DataFrame:
    """The paths again, with the winner's ``ord`` and genome at each step that has one."""
    steps = paths.select("node", F.posexplode("steps").alias("at", "step")).select(
        "node", "at", F.col("step.node").alias("_step"), F.col("step.first"), F.col("step.last")
    )
    with_winner = steps.join(named.withColumnRenamed("node", "_step"), "_step")
    collected = with_winner.groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("at", "first", "last", "winner", "winner_genome"))).alias("steps")
    )
    return paths.drop("steps").join(collected, "node", "left")


def local_records(genomes: DataFrame, paths: DataFrame) -> DataFrame:
    """Per genome what its own walk settles.

    ``name_0..4`` are the genomes its ranks are named after, ``source`` the ``ord`` of the genome whose
    lineage applies to rank ``inherits`` and above, ``anchor``/``anchor_rank`` the reference node.
    ``kept`` lists the ranks the genome fills with its own name without attaching them to a node.
    """
    walked = genomes.withColumnRenamed("anchor_rank", "_direct").join(
        paths.withColumnRenamed("node", "jump"), "jump", "left"
    )
    steps = F.coalesce("steps", F.expr("array()").cast("array<struct<at:int,first:int,last:int,winner:bigint,winner_genome:string>>"))
    kind = F.when(F.col("kind") == NAMED, F.col("end_kind")).otherwise(F.col("kind"))
    walked = walked.select(
        "domain",
        "genome",
        "ord",
        kind.alias("kind"),
        F.when(F.col("kind") == NAMED, F.col("end")).otherwise(F.col("jump")).alias("end"),
        F.when(F.col("kind") == NAMED, F.col("anchor_rank")).otherwise(F.col("_direct")).alias("anchor_rank"),
        steps.alias("steps"),
    )
    stop = F.get(F.filter("steps", lambda step: step["winner"] < F.col("ord")), F.lit(0))
    walked = walked.withColumn("stop", stop)

    # Nodes named after the genome itself below its stop, and the node it stops at.
    borne = F.filter(
        "steps",
        lambda step: (step["at"] == F.col("stop.at"))
        | ((step["winner"] == F.col("ord")) & (F.col("stop").isNull() | (step["at"] < F.col("stop.at")))),
    )
    walked = walked.withColumn("borne", borne)

    def at_rank(rank: int) -> Column:
        covering = F.filter("borne", lambda step: (step["first"] <= rank) & (step["last"] >= rank))
        return F.try_element_at(covering, F.lit(-1))["winner_genome"]

    walked = walked.select("*", *[at_rank(rank).alias(name) for rank, name in enumerate(NAMES)])
    highest = F.coalesce(*[F.when(F.col(name).isNotNull(), rank) for rank, name in enumerate(NAMES)])
    stopped = F.col("stop").isNotNull()
    anchored = ~stopped & (F.col("kind") == ANCHOR) & (F.col("anchor_rank") >= 0)
    walked = walked.withColumn("_highest", highest).select(
        "domain",
        "genome",
        "ord",
        "kind",
        F.col("stop.winner").alias("source"),
        # Ranks up to here come from the source; an unstopped genome depends on nobody.
        F.when(stopped, F.col("_highest")).otherwise(-1).alias("inherits"),
        F.when(anchored, F.col("end")).alias("anchor"),
        F.when(anchored, F.col("anchor_rank")).alias("anchor_rank"),
        # Own names start below the highest rank that is settled.
        F.when(anchored, F.col("anchor_rank")).otherwise(F.coalesce("_highest", F.lit(-1))).alias("_above"),
        # Without an anchor or a source the lineage has to start at the phylum.
        (stopped | anchored | (F.coalesce("_highest", F.lit(0)) == 0)).alias("settled"),
        *NAMES,
    )
    ranks_kept = F.array_compact(
        F.array(
            *[
                F.when(F.col(name).isNull() & (F.col("_above") < rank), rank)
                for rank, name in enumerate(NAMES)
            ]
        )
    )
    return walked.select(
        "domain",
        "genome",
        "ord",
        "kind",
        "source",
        "inherits",
        "anchor",
        "anchor_rank",
        "settled",
        ranks_kept.alias("kept"),
        *[
            F.when(F.col("_above") < rank, F.coalesce(name, "genome")).otherwise(F.col(name)).alias(name)
            for rank, name in enumerate(NAMES)
        ],
    )


def resolve(records: DataFrame) -> DataFrame:
    """Complete the records with the lineages of the genomes they follow.

    Sources follow earlier sources in turn, so their chains are closed first (few rows, few rounds);
    all other genomes then need a single join.
    """
    lineage_columns = ["inherits", "anchor", "anchor_rank", "settled", *NAMES]
    sources = records.where(F.col("source").isNotNull()).select(F.col("source").alias("ord")).distinct()
    state = records.join(sources, "ord", "left_semi").select(
        F.col("ord").alias("node"),
        F.col("source").alias("jump"),
        F.col("source").isNull().alias("done"),
        *lineage_columns,
    )
    merge = {
        "inherits": lambda near, far: F.least(near("inherits"), far("inherits")),
        "anchor": lambda near, far: far("anchor"),
        "anchor_rank": lambda near, far: far("anchor_rank"),
        "settled": lambda near, far: near("settled") & far("settled"),
        **{name: _inherited(rank, name) for rank, name in enumerate(NAMES)},
    }
    lineages = jump_until_done(state, merge).select(F.col("node").alias("_source"), *lineage_columns)
    own = records.alias("near").join(lineages.alias("far"), F.col("near.source") == F.col("far._source"), "left")

    def near(name: str) -> Column:
        return F.col(f"near.{name}")

    def far(name: str) -> Column:
        return F.col(f"far.{name}")

    followed = near("source").isNotNull()
    return own.select(
        near("domain"),
        near("genome"),
        near("ord"),
        near("kind"),
        near("kept"),
        *[
            F.when(followed, merge[name](near, far)).otherwise(near(name)).alias(name)
            for name in lineage_columns
            if name != "inherits"
        ],
    )


def _inherited(rank: int, name: str):
    return lambda near, far: F.when(near("inherits") < rank, near(name)).otherwise(far(name))


@dataclass
class Naming:
    """One naming run over the trees of one or several domains; results are built on demand."""

    nodes: DataFrame
    metadata: DataFrame
    domains: tuple[DomainParams, ...]

    def __post_init__(self) -> None:
        tune(self.nodes.sparkSession)
        self.keys = NodeKeys(self.domains)
        tagged = self.keys.tagged(self.nodes)
        self._tree = tagged.select(
            self.keys.key(F.col("node"), F.col("domain")).alias("node"),
            self.keys.key(F.coalesce("parent", "node"), F.col("domain")).alias("parent"),
            "domain",
            "genome",
            "magset",
            # Only an explicit other group makes a node new.
            (F.coalesce("nongtdb_group", F.lit("gtdb")) == "gtdb").alias("gtdb"),
            rank_index(rank_word(F.col("novelty_red"))).alias("rank"),
            F.col("RED").cast("double").alias("red"),
        )

    @cached_property
    def inner(self) -> DataFrame:
        """Internal nodes with their rank, read from the node table once."""
        internal = self._tree.where(F.col("genome").isNull())
        return cut(internal.select("node", "parent", "domain", "gtdb", "rank", "red"))

    @cached_property
    def facts(self) -> DataFrame:
        return cut(node_facts(self.inner, self.domains))

    @cached_property
    def spans(self) -> DataFrame:
        return cut(naming_spans(self.facts))

    @cached_property
    def landings(self) -> DataFrame:
        return landings(self.facts, self.spans)

    @cached_property
    def paths(self) -> DataFrame:
        return naming_paths(self.spans, self.landings)

    @cached_property
    def ordered(self) -> DataFrame:
        return in_order(with_quality(self._tree, self.metadata).select("domain", "genome", "parent", "quality"))

    @cached_property
    def landed(self) -> DataFrame:
        """Genomes with the landing of their parent; a parent that is not in the tree is invalid."""
        landing = self.landings.withColumnRenamed("node", "parent")
        joined = self.ordered.join(landing, "parent", "left")
        return cut(
            joined.select(
                "domain", "genome", "ord", "jump", F.coalesce("kind", F.lit(INVALID)).alias("kind"), "anchor_rank"
            )
        )

    @cached_property
    def named(self) -> DataFrame:
        """``node, winner, winner_genome`` for every named node."""
        valid_paths = self.paths.where(F.col("end_kind") != INVALID)
        arrivals = (
            self.landed.where(F.col("kind") == NAMED)
            .groupBy(F.col("jump").alias("node"))
            .agg(F.min("ord").alias("best"))
        )
        won = winners(valid_paths, arrivals)
        ids = self.ordered.select(F.col("ord").alias("winner"), F.col("genome").alias("winner_genome"))
        return cut(won.join(ids, "winner").select("node", "winner", "winner_genome"))

    @cached_property
    def records(self) -> DataFrame:
        every = local_records(self.landed, named_paths(self.paths, self.named))
        return cut(every)

    @cached_property
    def resolved(self) -> DataFrame:
        return cut(resolve(self.records.where(F.col("kind") != INVALID)))

    @cached_property
    def _final(self) -> DataFrame:
        return self.resolved.where("settled")

    @property
    def genomes(self) -> DataFrame:
        """``genome, taxonomy``: complete strings, or starting at the id of a reference node."""
        taxonomy = lineage(
            F.col("domain"),
            self.keys.node(F.col("anchor")),
            F.col("anchor_rank"),
            [F.col(name) for name in NAMES],
            F.col("genome"),
        )
        return self.keys.untagged(self._final.select("domain", "genome", taxonomy.alias("taxonomy")), self.nodes)

    @property
    def node_names(self) -> DataFrame:
        """``node, clade, genome_rep``: one row per named clade, node null if it has none."""
        no_node = F.lit(None).cast("bigint")
        clade_at = reduce(
            lambda case, rank: case.when(F.col("rank") == rank, clade_name(rank, F.col("genome_rep"))),
            range(1, RANK_COUNT),
            F.when(F.col("rank") == 0, clade_name(0, F.col("genome_rep"))),
        )
        attached = (
            self.named.join(self.spans.where(F.col("first").isNotNull()).select("node", "first", "last"), "node")
            .select(
                self.keys.domain(F.col("node")).alias("domain"),
                self.keys.node(F.col("node")).alias("node"),
                F.explode(F.sequence("first", "last")).alias("rank"),
                F.col("winner").alias("ord"),
                F.col("winner_genome").alias("genome_rep"),
            )
            .join(self.resolved.where(~F.col("settled")).select("ord"), "ord", "left_anti")
            .select("domain", "node", clade_at.alias("clade"), "genome_rep")
        )
        filled = self._final.select(
            "domain", no_node.alias("node"), F.explode("kept").alias("rank"), F.col("genome").alias("genome_rep")
        ).select("domain", "node", clade_at.alias("clade"), "genome_rep")
        genus = clade_name(GENUS, F.col(NAMES[GENUS]))
        species = self._final.where(F.coalesce("anchor_rank", F.lit(-1)) < GENUS).select(
            "domain",
            no_node.alias("node"),
            species_name(genus, F.col("genome")).alias("clade"),
            F.col("genome").alias("genome_rep"),
        )
        return self.keys.untagged(attached.unionByName(filled).unionByName(species), self.nodes)

    @property
    def issues(self) -> DataFrame:
        """Genomes left without taxonomy: ``issue, genome``."""
        by_domain = ["domain"] if "domain" in self.metadata.columns else []
        no_metadata = self._tree.where(
            F.col("magset").isNotNull() & (F.col("magset") != "GTDB") & F.col("genome").isNotNull()
        ).join(self.metadata.select(F.col("Name").alias("genome"), *by_domain), ["genome", *by_domain], "left_anti")
        parts = {
            "no_metadata": no_metadata,
            "invalid_node_on_path": self.records.where(F.col("kind") == INVALID),
            "no_phylum": self.resolved.where(~F.col("settled")),
        }
        frames = [frame.select("domain", F.lit(name).alias("issue"), "genome") for name, frame in parts.items()]
        return self.keys.untagged(reduce(DataFrame.unionByName, frames), self.nodes)


def name_clades(
    nodes: DataFrame,
    metadata: DataFrame,
    domain: str | list[DomainParams] | DomainParams = "d__Bacteria",
    red_cutoffs: tuple[float, ...] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Taxonomy per new genome and the list of new clades.

    ``nodes`` needs parent, node, nongtdb_group, genome, magset, RED and novelty_red, ``metadata``
    Name, Completeness and Contamination. ``domain`` is a domain's literal name, or the parameters of
    one or several domains, then with a ``domain`` column in ``nodes``.
    """
    domains = (preset(domain, red_cutoffs=red_cutoffs),) if isinstance(domain, str) else as_domains(domain)
    run = Naming(nodes, metadata, domains)
    return run.genomes, run.node_names
