"""Tab-separated tables. Types are given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeflow import schemas
from cladeflow.operators.catalogue import genome_metadata

TREE_NULL = "NA"
_RECORD = "_record"


def _reader(spark: SparkSession, null: str):
    return spark.read.option("sep", "\t").option("nullValue", null).option("quote", '"').option("escape", '"')


def read_checked(spark: SparkSession, path: str, columns: dict[str, str], header: bool = True, null: str = "") -> tuple[DataFrame, DataFrame]:
    """The rows that can be read as their types, and ``issue, file, record, columns`` for all others: the text of the row, and
    whether it has ``too_few_fields``, ``too_many_fields`` or a ``bad_value`` (with the names of its columns).

    Both are lazy; each reads the whole rows, as only then Spark counts their fields.
    """
    types, names = _columns_of(spark, path, columns, null) if header else (columns, list(columns))
    reader = _reader(spark, null).option("header", header).option("enforceSchema", False).option("columnPruning", False)
    read = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RECORD).schema(schemas.ddl({**types, _RECORD: "string"})).csv(path)
    plain = read.toDF(*names, _RECORD)
    rows = plain.where(F.col(_RECORD).isNull()).select(*columns)
    # Quoted fields may hold tabs; where there are none the record is split as it is.
    record = F.col(_RECORD)
    fields = F.size(F.split(F.regexp_replace(record, r'"(?:[^"]|"")*"', ""), "\t"))
    value = {name: F.get(F.split(record, "\t"), F.lit(k)) for k, name in enumerate(names)}
    typed = {name: kind for name, kind in zip(names, types.values(), strict=True) if kind != "string"}
    wrong = [F.when(~value[n].isin(null, "") & value[n].try_cast(kind).isNull(), n) for n, kind in typed.items()]
    issue = F.when(fields < len(names), "too_few_fields").when(fields > len(names), "too_many_fields").otherwise("bad_value")
    told = F.when((issue == "bad_value") & ~record.contains('"'), F.array_join(F.array_compact(F.array(*wrong)), ",") if wrong else F.lit(""))
    # Spark does not read the record column alone, so the condition names the others.
    broken = plain.where(record.isNotNull() & (F.length(F.concat_ws("", *[F.col(n).cast("string") for n in names])) >= 0))
    issues = broken.select(issue.alias("issue"), F.col("_metadata.file_path").alias("file"), record.alias("record"), F.coalesce(told, F.lit("")).alias("columns"))
    return rows, issues


def _columns_of(spark: SparkSession, path: str, columns: dict[str, str], null: str) -> tuple[dict[str, str], list[str]]:
    """All columns of a headered table in the order of the file, with their types, and their names with dots as underscores."""
    present = _reader(spark, null).option("header", True).csv(path).columns
    renamed = [name.replace(".", "_") for name in present]
    missing = set(columns) - set(renamed)
    if missing:
        raise ValueError(f"{path} lacks {sorted(missing)}")
    return {name: columns.get(new, "string") for name, new in zip(present, renamed, strict=True)}, renamed


def read_headered(spark: SparkSession, path: str, columns: dict[str, str], null: str = "") -> DataFrame:
    """The named columns of a table with a header line, in whatever order the file has them.

    Part files of one table must agree in their header; Spark raises otherwise.
    """
    types, renamed = _columns_of(spark, path, columns, null)
    reader = _reader(spark, null).option("header", True).option("enforceSchema", False)
    return reader.schema(schemas.ddl(types)).csv(path).toDF(*renamed).select(*columns)


def read_headerless(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    return _reader(spark, "").option("header", False).schema(schemas.ddl(columns)).csv(path)


def read_nodes(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    """Annotated node table; ``NA`` is null."""
    return read_headered(spark, path, columns or schemas.NODES, TREE_NULL)


def read_info(spark: SparkSession, path: str) -> DataFrame:
    return read_headered(spark, path, schemas.INFO)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Completeness and contamination per genome from a catalogue table."""
    columns = {name: schemas.INFO[name] for name in ("ID", "checkm2_completeness", "checkm2_contamination")}
    return genome_metadata(read_headered(spark, path, columns))


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    return read_headerless(spark, path, schemas.TAXONOMY)


def read_fasta_paths(spark: SparkSession, path: str) -> DataFrame:
    return read_headerless(spark, path, schemas.FASTA_PATHS)


def read_nodes_checked(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    return read_checked(spark, path, columns or schemas.NODES, null=TREE_NULL)


def read_metadata_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    columns = {name: schemas.INFO[name] for name in ("ID", "checkm2_completeness", "checkm2_contamination")}
    rows, issues = read_checked(spark, path, columns)
    return genome_metadata(rows), issues


def read_taxonomy_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return read_checked(spark, path, schemas.TAXONOMY, header=False)


def read_node_names(spark: SparkSession, path: str) -> DataFrame:
    return read_headered(spark, path, schemas.NODE_NAMES)


def _writer(frame: DataFrame, header: bool, null: str, mode: str):
    return (
        frame.write.mode(mode)
        .option("sep", "\t")
        .option("header", header)
        .option("nullValue", null)
        .option("emptyValue", "")
        .option("escape", '"')
    )


def write_tsv(frame: DataFrame, path: str, header: bool = True, null: str = "", mode: str = "errorifexists") -> None:
    """A folder of part files, each with its own header line if there is one."""
    _writer(frame, header, null, mode).csv(path)


def write_per_domain(
    frame: DataFrame, path: str, header: bool = True, null: str = "", mode: str = "errorifexists", column: str = "domain"
) -> None:
    """One subfolder per domain (or value of another column), all written by one job."""
    _writer(frame, header, null, mode).partitionBy(column).csv(path)


def write_nodes(nodes: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_tsv(nodes.select(*[F.col(name) for name in nodes.columns]), path, null=TREE_NULL, mode=mode)
