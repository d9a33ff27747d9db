"""KPI tables: per day, per day and language, per hashtag, per user.

Each is one hash aggregate with a map-side partial step, so a hot day, language,
hashtag or user is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.operators.clean import hashtags_exploded


def _measures():
    return [F.count(F.lit(1)).alias("tweets_count"), F.sum("engagement").cast("long").alias("engagement_sum")]


def with_day(posts: DataFrame) -> DataFrame:
    """Calendar day (UTC) of each post; posts without a date are dropped."""
    return posts.withColumn("day", F.to_date("date")).filter(F.col("day").isNotNull())


def kpi_daily(posts: DataFrame) -> DataFrame:
    return with_day(posts).groupBy(F.col("day").alias("date")).agg(*_measures())


def kpi_daily_lang(posts: DataFrame) -> DataFrame:
    return with_day(posts).groupBy(F.col("day").alias("date"), "lang").agg(*_measures())


def kpi_hashtags(posts: DataFrame) -> DataFrame:
    return hashtags_exploded(with_day(posts)).groupBy("hashtag").agg(*_measures())


def kpi_users(posts: DataFrame) -> DataFrame:
    users = with_day(posts).filter(F.col("username").isNotNull() & (F.col("username") != ""))
    return users.groupBy("username").agg(*_measures())
