"""Shared helpers: table access, row keys, checkpoints, size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plume.session import apply_defaults, scratch_path, work_dir

#: A side is broadcast only when it was counted and has at most this many (narrow) rows.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_defaults(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there (survives lost executors)."""
    work_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: like ``cut``, but compressed and by column, for wide tables."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a side of ``rows`` counted rows; beyond ``limit`` Spark shuffles (and splits skew)."""
    return F.broadcast(df) if rows <= limit else df


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Key of a row for joining a per-document result back: id (null-proof) and text hash.

    Rows that agree in both are the same document, so they share one result.
    """
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("__id"),
            F.xxhash64(F.col(text)).alias("__h")]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: What a Python task holds of its input at once; texts may be very long, so bytes count as well as rows.
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
               "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def map_arrow(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``df.mapInArrow(run, schema)`` in batches of ``ARROW_BATCH`` (set on the session)."""
    for k, v in ARROW_BATCH.items():
        df.sparkSession.conf.set(k, v)
    return df.mapInArrow(run, schema)


def append(df: DataFrame, col: str, add: str, make: Callable[[], Callable[[list], list[list]]],
           drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` without ``drop`` plus the columns ``add`` (DDL), computed from ``col`` batch by batch.

    ``make`` runs once a task and gives a function from the values of ``col`` to one list per new column.  The
    other columns stay Arrow columns, so their types and nulls are untouched.
    """
    new = StructType.fromDDL(add)
    keep = [c for c in df.columns if c not in drop and c not in new.names]
    schema = StructType([df.schema[c] for c in keep] + list(new))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        fn = make()
        for b in batches:
            got = fn(b.column(col).to_pylist())
            cols = [b.column(c) for c in keep] + [pa.array(v, to_arrow_type(f.dataType)) for f, v in zip(new, got)]
            yield pa.RecordBatch.from_arrays(cols, [*keep, *new.names])
    return map_arrow(df.select(*dict.fromkeys([*keep, col])), run, schema)
