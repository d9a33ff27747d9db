"""Structured Streaming ingest: message source -> parse -> typed posts -> idempotent micro-batch sink.

The stream is a stateless map (no watermark, window or state), so the only
delivery hazard is a replayed micro-batch.  The sink commits each batch to a
versioned table under its query id and batch id: readers see whole batches
only, and a replay adds nothing.  Duplicate posts across batches are removed
later by the batch cleaning step (dedup on id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from plume.sources.messages import parse_messages
from plume.sources.versions import VersionedTable


def read_message_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of JSON-lines message files (one JSON value per line)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def read_kafka(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
               **options) -> DataFrame:
    """Streaming scan of a Kafka topic from the earliest offset (needs the Kafka connector on the cluster)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().selectExpr("CAST(value AS STRING) AS value")


def batch_writer(out_path: str, query_id: str | None = None):
    """foreachBatch function: one commit per batch to the table at ``out_path``; a replayed batch changes nothing.

    The query id is the running query's, which its checkpoint keeps over restarts, unless given."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        q = query_id or batch_df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        VersionedTable(batch_df.sparkSession, out_path).append(batch_df, str(q), batch_id)
    return write


def start_ingest(source: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
                 processing_time: str | None = None) -> StreamingQuery:
    """Start the ingest query; the caller owns the handle (``awaitTermination`` / ``stop``)."""
    w = (parse_messages(source).writeStream.outputMode("append")
         .foreachBatch(batch_writer(out_path)).option("checkpointLocation", checkpoint))
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def read_sink(spark: SparkSession, out_path: str, schema: StructType | None = None) -> DataFrame:
    """All committed micro-batches as one batch frame; with ``schema``, empty before the first one."""
    return VersionedTable(spark, out_path).read(schema)
