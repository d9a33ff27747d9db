"""Keyed JSON messages: the wire format between the replay producer and the stream job.

``encode_messages`` builds ``(key, value)`` rows that any Spark sink can publish
(``format('kafka')`` on a cluster, JSON-lines files under test).
``parse_messages`` is the stream job's decode step and works on batch and
streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plume.functions.columns import COUNTERS, engagement_strict
from plume.schemas import MESSAGE


def iso_timestamp(c: Column) -> Column:
    """``datetime.isoformat()``: seconds, plus ``.ffffff`` only when there is a fraction."""
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.unix_micros(c) % 1_000_000
    return F.when(micros != 0, F.concat(base, F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(base)


def message_fields(df: DataFrame) -> list[Column]:
    """The 15 message fields with the producer's defaults: counters 0, ids null, date ISO text."""
    def col_or_null(name, t="string"):
        return F.col(name) if name in df.columns else F.lit(None).cast(t)

    out = [F.col("id").cast("long").alias("id"),
           iso_timestamp(F.col("date").try_cast("timestamp")).alias("date"),
           col_or_null("user").alias("user"),
           col_or_null("content").alias("content")]
    out += [F.coalesce(col_or_null(c, "int").try_cast("int"), F.lit(0)).alias(c) for c in COUNTERS]
    out += [col_or_null("conversationId", "long").try_cast("long").alias("conversationId"),
            col_or_null("inReplyToTweetId", "long").try_cast("long").alias("inReplyToTweetId")]
    out += [col_or_null(c).alias(c) for c in ["inReplyToUser", "mentionedUsers", "hashtags", "lang", "url"]]
    return out


def encode_messages(df: DataFrame) -> DataFrame:
    """``key`` = id as text, ``value`` = JSON object of the 15 fields, nulls written out."""
    s = F.struct(*message_fields(df))
    return df.select(F.col("id").cast("string").alias("key"),
                     F.to_json(s, {"ignoreNullFields": "false"}).alias("value"))


def parse_messages(values: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> typed post rows with the strict engagement (``posts_stream``).

    Malformed JSON gives all-null fields; a bad field gives null for that field.
    """
    data = values.select(F.from_json(F.col(value_col).cast("string"), MESSAGE).alias("data")).select("data.*")
    typed = data.select(
        "id",
        F.col("date").try_cast("timestamp").alias("date"),
        "user", "content",
        *[F.col(c).try_cast("int").alias(c) for c in COUNTERS],
        "conversationId", "inReplyToTweetId", "inReplyToUser", "mentionedUsers", "hashtags", "lang", "url",
    )
    return typed.withColumn("engagement", engagement_strict())
