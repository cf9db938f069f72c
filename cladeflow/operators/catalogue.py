"""Genome catalogue, per-domain batches and reference accessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeflow.functions.genomes import accession, domain_of, fasta_file, fasta_key


def build_catalogue(info: DataFrame, fasta_paths: DataFrame) -> DataFrame:
    """Genomes of a known domain with the path of their FASTA file.

    ``info`` has ID, domain, checkm2_completeness and checkm2_contamination, ``fasta_paths`` fasta.
    """
    genomes = info.select(
        "ID",
        domain_of(F.col("domain")).alias("domain"),
        "checkm2_completeness",
        "checkm2_contamination",
        fasta_key(F.col("ID")).alias("f"),
    ).where(F.col("domain") != "unknown")
    files = fasta_paths.select("fasta", fasta_file(F.col("fasta")).alias("f"))
    return genomes.join(files, "f")


def genome_batches(catalogue: DataFrame) -> DataFrame:
    """``domain, fasta, ID``: what each domain's marker search takes as input."""
    return catalogue.select("domain", "fasta", "ID")


def genome_metadata(info: DataFrame) -> DataFrame:
    """The quality columns under the names naming expects."""
    return info.select(
        F.col("ID").alias("Name"),
        F.col("checkm2_completeness").alias("Completeness"),
        F.col("checkm2_contamination").alias("Contamination"),
    )


def trim_accessions(taxonomy: DataFrame) -> DataFrame:
    """Reference taxonomy with bare accessions, null where an id holds none."""
    return taxonomy.withColumn("genome", accession(F.col("genome")))
