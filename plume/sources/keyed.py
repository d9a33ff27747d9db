"""Tables laid out by a key: bucketed by its hash, sorted within a bucket.

A bucket is one file with its rows in order of the key, so an equality on the key reads one bucket of the table and,
by the file's statistics, one of its row groups; two tables with the same key and number of buckets join without a
shuffle.  A key that holds a large share of the rows makes a large bucket, which is read in splits all the same.  The
files lie in a new folder under the shared work folder (or where ``path`` says), and the name in the session's catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.session import scratch_path

ROWS_PER_BUCKET = 2_000_000


def buckets_for(rows: int, at_least: int = 8) -> int:
    """A power of two, so that tables of different sizes still share bucket borders."""
    n = at_least
    while n * ROWS_PER_BUCKET < rows:
        n *= 2
    return n


def write_keyed(df: DataFrame, name: str, key: str, buckets: int | None = None, path: str | None = None,
                then: list[str] | None = None) -> DataFrame:
    """Write ``df`` as table ``name``, bucketed by ``key`` and sorted by it (``then`` by more columns); the table.

    Null keys share a bucket; an empty frame is an empty table; an older table of the name gives way, its files stay.
    """
    spark = df.sparkSession
    n = buckets or buckets_for(df.count())
    order = [key, *(then or [])]
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    (df.repartition(n, key).sortWithinPartitions(*order).write.bucketBy(n, key).sortBy(*order)
     .option("path", path or scratch_path(spark, name)).saveAsTable(name))
    return spark.table(name)


def of_key(spark: SparkSession, name: str, key: str, value) -> DataFrame:
    """The rows of one key: one bucket, and of it the row groups whose statistics allow the key."""
    return spark.table(name).where(F.col(key) == F.lit(value))
