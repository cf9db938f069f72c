"""From annotated trees, quality metadata and the reference taxonomy to named clades and their summary."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeflow.operators.annotate import annotate_nodes
from cladeflow.operators.catalogue import build_catalogue, genome_batches, trim_accessions
from cladeflow.operators.fill import Fill
from cladeflow.operators.naming import Naming
from cladeflow.operators.summary import summarise_clades
from cladeflow.operators.validate import table_issues, tree_issues
from cladeflow.params import DomainParams, as_domains
from cladeflow.sources import tsv
from cladeflow.session import cut, cut_counting
from cladeflow.sources.newick import newick_file_edges
from cladeflow.sources.ordered import write_in_order


class NamingError(ValueError):
    """Raised by strict runs when a genome could not be named or filled."""


@dataclass
class Results:
    genome_taxonomy: DataFrame
    node_names: DataFrame
    issues: DataFrame

    @property
    def clade_summary(self) -> DataFrame:
        """By domain if there are several."""
        return summarise_clades(self.node_names, ["domain"] if "domain" in self.node_names.columns else None)


# Findings that make results wrong or ambiguous; the others only tell of genomes left out.
FATAL = (
    "missing_parent", "duplicate_node", "duplicate_genome", "duplicate_metadata", "duplicate_taxonomy",
    "cycle", "below_cycle", "below_missing_parent", "several_roots", "no_root",
)
# With these a table is no tree, and nothing can be named.
ENDLESS = ("cycle", "below_cycle")


def input_issues(nodes: DataFrame, metadata: DataFrame, gtdb_taxonomy: DataFrame, one_root: bool = False) -> DataFrame:
    """``issue, node, genome``, with a domain column if ``nodes`` has one: checks on all inputs of a run. ``one_root``: whether
    the nodes (of each domain) have to be one tree."""
    by = ["domain"] if "domain" in nodes.columns else []
    found = tree_issues(nodes, by, one_root)
    for frame, name, issue in ((metadata, "Name", "duplicate_metadata"), (gtdb_taxonomy, "genome", "duplicate_taxonomy")):
        own = [c for c in by if c in frame.columns]
        repeated = table_issues(frame, [*own, name], issue)
        for column in by:
            repeated = repeated.withColumn(column, F.lit(None).cast("string"))
        found = found.unionByName(repeated)
    return found


def _raise(issues: DataFrame) -> None:
    count = issues.count()
    if count:
        shown = "; ".join(f"{row.issue}: {row.genome if row.genome is not None else row.node}" for row in issues.take(20))
        raise NamingError(f"{count} issues, such as {shown}")


def name_and_fill(
    nodes: DataFrame,
    metadata: DataFrame,
    gtdb_taxonomy: DataFrame,
    params: DomainParams | list[DomainParams],
    mode: str = "least_common",
    strict: bool = False,
    malformed: DataFrame | None = None,
    one_root: bool = False,
) -> Results:
    """Checks, then both naming stages. ``nodes`` has a ``domain`` column if ``params`` has several domains.

    Inputs that are ambiguous (FATAL) raise in strict runs before anything is computed; else they are listed in ``issues``.
    Nodes on or below a cycle of parents are listed and left out. ``malformed`` are rows that could not be read, as issues.
    """
    domains = as_domains(params)
    found = input_issues(nodes, metadata, gtdb_taxonomy, one_root).where(F.col("issue").isin(*FATAL))
    inputs, count = cut_counting(found if malformed is None else found.unionByName(malformed), endless=F.col("issue").isin(*ENDLESS))
    if strict:
        _raise(inputs)
    if count["endless"]:
        key = ["node", *([] if "domain" not in nodes.columns else ["domain"])]
        nodes = cut(nodes.join(inputs.where(F.col("issue").isin(*ENDLESS)).select(*key).distinct(), key, "left_anti"))
    naming = Naming(nodes, metadata, domains)
    fill = Fill(nodes, naming.genomes, naming.node_names, gtdb_taxonomy, domains, mode)
    left_out = naming.issues.unionByName(fill.issues)
    issues = inputs.unionByName(left_out.withColumn("node", F.lit(None).cast("bigint")))
    if strict:
        _raise(issues)
    return Results(fill.genomes, fill.node_names, issues)


def annotate_tree_file(spark: SparkSession, newick: str, taxonomy: str, params: DomainParams, full_numbers: bool = False) -> DataFrame:
    """Annotated nodes of a Newick file with one tree, reference genomes marked by the taxonomy file."""
    return annotate_nodes(newick_file_edges(spark, newick), tsv.read_taxonomy(spark, taxonomy), params, full_numbers)


def export_batches(spark: SparkSession, info: str, fasta_paths: str, out: str) -> None:
    """Catalogue genomes per domain, FASTA path and id, without header."""
    catalogue = build_catalogue(tsv.read_info(spark, info), tsv.read_fasta_paths(spark, fasta_paths))
    tsv.write_per_domain(genome_batches(catalogue), out, header=False)


def preprocess_taxonomy(spark: SparkSession, taxonomy: str, out: str) -> None:
    tsv.write_tsv(trim_accessions(tsv.read_taxonomy(spark, taxonomy)), out, header=False)


@dataclass(frozen=True)
class DomainInputs:
    """Files of one domain: annotated node table and reference taxonomy."""

    params: DomainParams
    nodes: str
    taxonomy: str


def run_files(
    spark: SparkSession, inputs: list[DomainInputs], metadata: str, out: str, strict: bool = False
) -> Results:
    """Name the trees of all domains in one job and write ``genome_taxonomy``, ``node_names`` and
    ``clade_summary`` below ``out``, each with one subfolder per domain."""
    trees, lineages, broken = [], [], []
    needed = {name: tsv.schemas.NODES[name] for name in ("parent", "node", "nongtdb_group", "genome", "magset", "RED", "novelty_red")}
    for part in inputs:
        domain = F.lit(part.params.domain)
        for (rows, issues), table, name in (
            (tsv.read_nodes_checked(spark, part.nodes, needed), trees, "nodes"),
            (tsv.read_taxonomy_checked(spark, part.taxonomy), lineages, "taxonomy"),
        ):
            table.append(rows.withColumn("domain", domain))
            broken.append(malformed_rows(issues, name, domain))
    quality, issues = tsv.read_metadata_checked(spark, metadata)
    broken.append(malformed_rows(issues, "metadata", F.lit(None).cast("string")))
    nodes, taxonomy, malformed = (reduce(DataFrame.unionByName, tables) for tables in (trees, lineages, broken))
    results = name_and_fill(nodes, quality, taxonomy, [part.params for part in inputs], strict=strict, malformed=malformed, one_root=True)
    write_results(results, out)
    return results


def malformed_rows(issues: DataFrame, table: str, domain: Column) -> DataFrame:
    """Rows of a file that could not be read, as issues of a run: ``genome`` is the text of the row."""
    return issues.select(
        F.concat(F.lit(f"malformed_{table}_"), "issue").alias("issue"), F.lit(None).cast("bigint").alias("node"), F.col("record").alias("genome"), domain.alias("domain")
    )


def names_order() -> list[Column]:
    return [F.col("clade"), F.col("node").asc_nulls_last(), F.col("genome_rep")]


def write_results(results: Results, out: str) -> None:
    """Tables below ``out`` with one subfolder per domain; node names in order of clade."""
    tsv.write_per_domain(results.genome_taxonomy, f"{out}/genome_taxonomy")
    write_in_order(results.node_names, f"{out}/node_names", names_order(), "domain")
    # few rows: sources by domain
    tsv.write_per_domain(results.clade_summary.coalesce(1), f"{out}/clade_summary")


@dataclass(frozen=True)
class RawInputs:
    """Files of one domain as they come: Newick tree with decorated labels, and reference taxonomy with full ids."""

    params: DomainParams
    tree: str
    taxonomy: str


def run_raw(spark: SparkSession, inputs: list[RawInputs], info: str, fasta_paths: str, out: str, strict: bool = False) -> Results:
    """From trees, reference taxonomies and the genome catalogue to all outputs below ``out``: batches for the marker
    search, trimmed taxonomies, annotated node tables, and the results of ``run_files``."""
    export_batches(spark, info, fasta_paths, f"{out}/batches")
    ready = []
    for part in inputs:
        folder = f"{part.params.domain}"
        preprocess_taxonomy(spark, part.taxonomy, f"{out}/taxonomy/{folder}")
        annotated = annotate_tree_file(spark, part.tree, f"{out}/taxonomy/{folder}", part.params)
        tsv.write_nodes(annotated, f"{out}/nodes/{folder}")
        ready.append(DomainInputs(part.params, f"{out}/nodes/{folder}", f"{out}/taxonomy/{folder}"))
    return run_files(spark, ready, info, out, strict)
