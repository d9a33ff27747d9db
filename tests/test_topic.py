"""The message log: every message once, over restarts, in bounded batches."""

import os

import pytest
from plume.sources.versions import VersionedTable
from plume.streaming.topic import publish, read_topic
from pyspark.sql import functions as F
from table_rows import rows


def _messages(spark, a, b):
    return spark.range(a, b).select(F.concat(F.lit("k"), F.col("id") % 7).alias("key"), F.col("id").cast("string").alias("value"))


def _run(spark, source, out, checkpoint, sizes=None, fail_at=None):
    """Start the query, take all there is, stop it."""
    def write(df, batch):
        if fail_at is not None and batch == fail_at:
            raise RuntimeError("cut off")
        n = VersionedTable(spark, out).append(df, "q", batch)
        if sizes is not None and n is not None:
            sizes.append(df.groupBy("partition").count().agg(F.max("count")).first()[0])
    q = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_restarts_read_each_message_once(spark, tmp_dir):
    topic, out, ck, prog = (os.path.join(tmp_dir, n) for n in ("topic", "out", "ck", "prog"))
    publish(_messages(spark, 0, 100), topic, 3)
    source = lambda: read_topic(spark, topic, max_messages=11, progress=prog)
    sizes = []
    _run(spark, source(), out, ck, sizes)
    assert max(sizes) <= 11 and len(sizes) > 3
    publish(_messages(spark, 100, 150), topic, 3)
    batches = len(sizes)
    with pytest.raises(Exception):  # noqa: B017 - the batch after next is cut off
        _run(spark, source(), out, ck, sizes, fail_at=batches + 1)
    _run(spark, source(), out, ck, sizes)
    publish(_messages(spark, 150, 151), topic, 3)
    _run(spark, source(), out, ck, sizes)
    _run(spark, source(), out, ck, sizes)
    got = VersionedTable(spark, out).read()
    assert max(sizes) <= 11
    assert sorted(int(r.value) for r in got.collect()) == list(range(151))
    for p in {r.partition for r in got.collect()}:  # offsets are gapless, a key keeps to one partition
        mine = got.where(F.col("partition") == p)
        assert sorted(r.offset for r in mine.collect()) == list(range(mine.count()))
    assert got.groupBy("key").agg(F.count_distinct("partition").alias("n")).where("n > 1").count() == 0


def test_latest_starts_behind_what_is_there(spark, tmp_dir):
    topic, out, ck = (os.path.join(tmp_dir, n) for n in ("topic", "out", "ck"))
    publish(_messages(spark, 0, 20), topic, 2)
    _run(spark, read_topic(spark, topic, "latest"), out, ck)
    publish(_messages(spark, 20, 30), topic, 2)
    _run(spark, read_topic(spark, topic, "latest"), out, ck)
    assert rows(VersionedTable(spark, out).read().selectExpr("CAST(value AS INT)")) == [(i,) for i in range(20, 30)]


def test_uncommitted_files_and_odd_messages(spark, tmp_dir):
    topic, out, ck = (os.path.join(tmp_dir, n) for n in ("topic", "out", "ck"))
    publish(spark.createDataFrame([(None, "no key"), ("k", None), ("", "é\n漢")], "key string, value string"), topic)
    publish(spark.createDataFrame([], "key string, value string"), topic)
    with pytest.raises(Exception):  # noqa: B017 - a job that fails commits nothing
        publish(_messages(spark, 0, 50).withColumn("value", F.when(F.col("value") == "33", F.raise_error(F.lit("stop"))).otherwise(F.col("value"))), topic)
    _run(spark, read_topic(spark, topic), out, ck)
    got = VersionedTable(spark, out).read()
    assert {(r.key, r.value) for r in got.collect()} == {(None, "no key"), ("k", None), ("", "é\n漢")}


def test_every_task_publishes_its_own_messages(spark, tmp_dir):
    from plume.streaming.topic import _Log
    df = spark.range(400).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value")).repartition(6)
    publish(df, f"{tmp_dir}/t", partitions=2)
    parts = _Log(f"{tmp_dir}/t").refresh().parts
    assert sum(n for files in parts.values() for _, n, _ in files) == 400
    assert [len(files) for _, files in sorted(parts.items())] == [6, 6]  # a task's share does not grow with the topic
    for files in parts.values():
        assert [a for a, _, _ in files] == [sum(n for _, n, _ in files[:i]) for i in range(len(files))]


def test_message_files_are_zstd(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq
    publish(_messages(spark, 0, 50), os.path.join(tmp_dir, "topic"), 2)
    files = glob.glob(os.path.join(tmp_dir, "topic", "data", "*.parquet"))
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(1).compression for f in files} == {"ZSTD"}
