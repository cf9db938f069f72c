"""Genome ids, their sources and quality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of genome ids, file names and accessions.
FASTA_SUFFIX = ".fa.gz"
FASTA_FILE = r"([^/]+\.fa\.gz)$"
ACCESSION = r"(GC[AF]_\d+)"
PREFIXED_SOURCES = ("MGYG", "GWH")  # ids that run on without an underscore
REFERENCE_SOURCES = ("GCA", "GCF")


def quality(completeness: Column, contamination: Column) -> Column:
    return completeness - 5 * contamination


def domain_of(classification: Column) -> Column:
    """``archaea``, ``bacteria`` or ``unknown``; Archaea is looked for first."""
    return (
        F.when(F.contains(classification, F.lit("Archaea")), "archaea")
        .when(F.contains(classification, F.lit("Bacteria")), "bacteria")
        .otherwise("unknown")
    )


def fasta_key(genome: Column) -> Column:
    return F.concat(genome, F.lit(FASTA_SUFFIX))


def fasta_file(path: Column) -> Column:
    """File name of a FASTA path, null if it is none."""
    return F.regexp_substr(path, F.lit(FASTA_FILE))


def accession(genome: Column) -> Column:
    """Accession without database prefix and version, null if there is none."""
    return F.regexp_substr(genome, F.lit(ACCESSION))


def source_of(genome: Column) -> Column:
    """Data source of a genome id: a known prefix, else what comes before the first underscore."""
    case = F.when(genome.startswith(PREFIXED_SOURCES[0]), PREFIXED_SOURCES[0])
    for prefix in PREFIXED_SOURCES[1:]:
        case = case.when(genome.startswith(prefix), prefix)
    return case.otherwise(F.regexp_substr(genome, F.lit("^[^_]+")))
