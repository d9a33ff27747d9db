"""File sources and sinks: raw CSV exports, labelled CSVs, named datasets, CSV reports.

Datasets live under one root as ``<root>/<name>``: Parquet ones as versioned
tables, others in any Spark format (a connector format such as a document
store passes straight through ``format``/``options``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plume.schemas import KEEP_COLUMNS, LABELLED_TEXT, TABLES
from plume.sources.quoted_csv import read_quoted_csv
from plume.sources.versions import VersionedTable, conform


def read_posts_csv(spark: SparkSession, path: str, columns: list[str] = KEEP_COLUMNS,
                   position: bool = False) -> DataFrame:
    """Raw post export with a header row, read in file splits; quoted fields may hold line breaks (``quoted_csv``).

    Columns are bound by header name (no schema inference pass: every column is text) and the listed
    ones that exist are kept; typing happens in the cleaning step with null-on-error casts.  ``position`` adds
    ``read_at``, by which ``ingest_filter`` keeps the first row read of an id.
    """
    df = read_quoted_csv(spark, path, position=position)
    return df.select([c for c in columns if c in df.columns] + ["read_at"] * position)


def read_labelled_csv(spark: SparkSession, paths: str | list[str], name_pattern: str = r"([^/]+)$") -> DataFrame:
    """Headerless labelled text ``id, topic, sentiment, text`` (several files are one frame), plus ``source_file``.

    ``name_pattern`` picks the name from a file's path: the file's own, or that of its folder where an input is a
    folder of part files (``r"([^/]+)/[^/]+$"``).  Quoted fields may hold line breaks."""
    df = read_quoted_csv(spark, paths, LABELLED_TEXT, position=True)
    return df.withColumn("source_file", F.regexp_extract("read_at.file", name_pattern, 1)).drop("read_at")


def write_dataset(df: DataFrame, root: str, name: str, mode: str = "overwrite", fmt: str = "parquet",
                  partition_by: list[str] | None = None, **options) -> str:
    """Replace (or append to) a named dataset; returns its path.

    Parquet datasets are versioned tables (``versions``): a replace is one commit, and ``df`` may read the dataset
    itself.  Other formats go to their connector as they are.
    """
    path = f"{root.rstrip('/')}/{name}"
    if fmt == "parquet" and not options:
        to = VersionedTable(df.sparkSession, path)
        to.commit(to.write_files(df, partition_by), df.schema, mode == "overwrite")
        return path
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)
    return path


def read_dataset(spark: SparkSession, root: str, name: str, fmt: str = "parquet",
                 schema: StructType | None = None, **options) -> DataFrame:
    """Scan a named dataset; selects on the result prune columns at the scan.

    With ``schema`` the result has exactly its columns: a dataset that is missing is empty, missing columns are typed
    nulls, and a column of another type is refused (``versions.conform``)."""
    path = f"{root.rstrip('/')}/{name}"
    if fmt == "parquet" and not options:
        table = VersionedTable(spark, path)
        if table.exists():
            return table.read(schema)
    r = spark.read.format(fmt)
    for k, v in options.items():
        r = r.option(k, v)
    try:
        df = r.load(path)
    except AnalysisException as e:
        if schema is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return df if schema is None else conform(df, schema)


def read_declared(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A dataset of the catalogue (``schemas.TABLES``) in its declared columns."""
    return read_dataset(spark, root, name, schema=TABLES[name])


def read_optional(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame | None:
    """A dataset that may be missing: ``None`` if its path does not exist; any other failure is raised."""
    try:
        return read_dataset(spark, root, name, fmt)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def export_csv(df: DataFrame, path: str, columns: list[str], order: list | None = None) -> bool:
    """Write a small ranked report as one headered CSV in a fixed column order; nothing on an empty input.

    Only for bounded results (after a ``limit``): the single output file is one task.
    """
    out = (df.orderBy(*order) if order else df).select(*columns)
    if out.isEmpty():
        return False
    out.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return True
