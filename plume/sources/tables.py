"""Reading the driver tables and deriving the raw post view from them.

``posts_raw`` turns ``events`` (one post per event) and ``documents`` (the
post text, whole) into rows with the reference's raw post schema, including
the awkward inputs the cleaning step must survive: null and ``{}`` authors,
null text, null counters, replies, list / single-dict / empty / null mention
texts, repeated hashtags, several languages and exact duplicate posts.
Its size grows with ``events``; the text join is an equi-join that Catalyst
plans (broadcast only when AQE measures the side as small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


PART_POSTS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _name_dict(expr) -> F.Column:
    return F.concat(F.lit("{'username': 'u"), expr.cast("string"), F.lit("'}"))


def _quoted(expr) -> F.Column:
    return F.concat(F.lit("'"), expr, F.lit("'"))


def posts_raw(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The raw posts.  ``spread`` deals the events by their text into ``spark.sql.shuffle.partitions`` parts, or one for
    every ``PART_POSTS`` of them if these are more, whatever the tables' bytes: for queries that work on the texts where
    they are joined, which are larger than the tables, so that a task sorts its posts in memory at any size."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    n_docs = docs.select(F.count(F.lit(1))).scalar()  # scalar subquery, evaluated once
    ev = ev.withColumn("doc_key", F.col("event_id") % n_docs)
    if spread:
        ev = ev.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-ev.count() // PART_POSTS)), "doc_key")
        docs = docs.hint("merge")
    j = ev.join(docs, F.col("doc_key") == F.col("doc_id"), "left")  # an event without a document has no text
    # Posts of one event type arrive twice (at-least-once delivery upstream).
    twice = F.when(F.col("event_type") == "error", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    j = j.withColumn("_copy", F.explode(twice))
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    null_s = F.lit(None).cast("string")
    return j.select(
        eid.alias("id"),
        F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.when(eid % 97 == 0, null_s).otherwise(F.col("text")).alias("content"),
        F.when(eid % 89 == 0, null_s).when(eid % 83 == 0, F.lit("{}")).otherwise(_name_dict(uid)).alias("user"),
        F.when(eid % 11 == 0, F.lit(None).cast("int")).otherwise((eid % 5).cast("int")).alias("replyCount"),
        (eid % 7).cast("int").alias("retweetCount"),
        F.floor(F.col("value")).cast("int").alias("likeCount"),
        (eid % 3).cast("int").alias("quoteCount"),
        (eid - eid % 10).alias("conversationId"),
        F.when((eid % 3 == 0) & (eid > 40), eid - 1 - eid % 37).alias("inReplyToTweetId"),
        null_s.alias("inReplyToUser"),
        F.when(eid % 4 == 0, null_s)
         .when(eid % 4 == 3, F.lit("[]"))
         .when(eid % 4 == 1, F.concat(F.lit("["), _name_dict((uid * 7 + 3) % 160), F.lit(", "),
                                      _name_dict(eid % 13), F.lit("]")))
         .otherwise(_name_dict((uid + 1) % 160)).alias("mentionedUsers"),
        F.when(eid % 5 == 0, null_s)
         .when(eid % 5 == 1, F.lit("[]"))
         .when(eid % 5 == 2, F.concat(F.lit("["), _quoted(et), F.lit(", "), _quoted(et), F.lit("]")))
         .otherwise(F.concat(F.lit("["), _quoted(et), F.lit(", "), _quoted(F.concat(F.lit("k"), (eid % 23).cast("string"))),
                             F.lit("]"))).alias("hashtags"),
        F.col("lang"),
        F.concat(F.lit("https://example.org/t/"), eid.cast("string")).alias("url"),
    )


def labelled_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled training text ``(id, topic, sentiment, text)`` derived from ``labels`` and ``documents``.

    The class is ``quality + toxic`` (0..2) named Negative / Neutral / Positive;
    documents from source ``src0`` are tagged ``Irrelevant`` (a class the
    training step drops) and ``src1`` carries no label at all.
    """
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    j = lab.join(docs, "doc_id")
    k = F.col("quality") + F.col("toxic")
    sentiment = (F.when(F.col("source") == "src1", F.lit(None).cast("string"))
                 .when(F.col("source") == "src0", F.lit("Irrelevant"))
                 .when(k == 0, "Negative").when(k == 1, "Neutral").otherwise("Positive"))
    return j.select(F.col("doc_id").alias("id"), F.col("source").alias("topic"), sentiment.alias("sentiment"),
                    F.col("text"))
