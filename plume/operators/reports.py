"""Dashboard reports over the KPI tables: totals, peak day, date range, series, pivot, top-k lists.

All of them aggregate already-aggregated KPI rows (one per day / language /
hashtag / user).  Global figures are single aggregates with partial combine;
ties are broken by the key, ascending, so every report is repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_range(df: DataFrame, start=None, end=None, col: str = "date") -> DataFrame:
    """Inclusive day range; a missing bound means the data's own min / max (no filter)."""
    if start is not None:
        df = df.filter(F.col(col) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(col) <= F.lit(end).cast("date"))
    return df


def totals(daily: DataFrame, start=None, end=None) -> DataFrame:
    """Posts, engagement, mean engagement per post (0 without posts) and days covered."""
    d = in_range(daily, start, end)
    agg = d.agg(F.coalesce(F.sum("tweets_count"), F.lit(0)).cast("long").alias("total_tweets"),
                F.coalesce(F.sum("engagement_sum"), F.lit(0)).cast("long").alias("total_engagement"),
                F.count_distinct("date").alias("days_covered"))
    avg = F.when(F.col("total_tweets") > 0, F.col("total_engagement") / F.col("total_tweets")).otherwise(F.lit(0.0))
    return agg.select("total_tweets", "total_engagement", F.round(avg, 6).alias("avg_engagement"), "days_covered")


def peak_day(daily: DataFrame, start=None, end=None) -> DataFrame:
    """Day with the most posts (earliest on ties) and its count; 0 and null on no data."""
    d = in_range(daily, start, end)
    best = F.max(F.struct(F.col("tweets_count"), (-F.unix_date("date")).alias("neg_day"), F.col("date")))
    agg = d.agg(best.alias("b"))
    return agg.select(F.col("b.date").alias("peak_date"),
                      F.coalesce(F.col("b.tweets_count"), F.lit(0)).cast("long").alias("peak_tweets"))


def date_range(daily: DataFrame) -> DataFrame:
    return daily.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def daily_series(daily: DataFrame, start=None, end=None) -> DataFrame:
    return in_range(daily, start, end).select("date", "tweets_count", "engagement_sum").orderBy("date")


def lang_pivot(daily_lang: DataFrame, start=None, end=None, langs: list[str] | None = None) -> DataFrame:
    """Day x language matrix of post counts, missing cells 0 (null language dropped).

    Without ``langs`` Spark finds the values itself (bounded by
    ``spark.sql.pivotMaxValues``); pass them to skip that extra job.
    """
    d = in_range(daily_lang, start, end).filter(F.col("lang").isNotNull())
    p = d.groupBy("date").pivot("lang", langs).agg(F.sum("tweets_count"))
    value_cols = [c for c in p.columns if c != "date"]
    return p.na.fill(0, subset=value_cols) if value_cols else p


def _top_key(measure: str, key: str) -> Column:
    """Struct whose minimum is the row with the largest measure, then the smallest key."""
    return F.min(F.struct((-F.col(measure)).alias("neg"), F.col(key).alias("key"), F.col(measure).alias("m")))


def hashtag_stats(posts: DataFrame) -> DataFrame:
    """Distinct hashtags, total uses (the reference's "posts with a hashtag"), true posts with
    a hashtag, most used hashtag and its count — one pass over the exploded uses."""
    uses = (posts.withColumn("day", F.to_date("date")).filter(F.col("day").isNotNull())
            .filter(F.size("hashtags_array") > 0)
            .select("id", F.posexplode("hashtags_array").alias("pos", "hashtag"),
                    (F.array_position("hashtags_array", F.array_min("hashtags_array")) - 1).alias("first_pos")))
    per_tag = uses.groupBy("hashtag").agg(F.count(F.lit(1)).alias("tweets_count"),
                                          F.count_if(F.col("pos") == F.col("first_pos")).alias("posts_first"))
    agg = per_tag.agg(F.count(F.lit(1)).alias("distinct_hashtags"),
                      F.coalesce(F.sum("tweets_count"), F.lit(0)).cast("long").alias("hashtag_uses"),
                      F.coalesce(F.sum("posts_first"), F.lit(0)).cast("long").alias("posts_with_hashtag"),
                      _top_key("tweets_count", "hashtag").alias("t"))
    return agg.select("distinct_hashtags", "hashtag_uses", "posts_with_hashtag",
                      F.col("t.key").alias("top_hashtag"),
                      F.coalesce(F.col("t.m"), F.lit(0)).cast("long").alias("top_hashtag_tweets"))


def top_user(users: DataFrame) -> DataFrame:
    """User with the highest engagement (smallest name on ties) and that engagement."""
    agg = users.agg(_top_key("engagement_sum", "username").alias("t"))
    return agg.select(F.col("t.key").alias("top_user"), F.col("t.m").cast("long").alias("top_user_engagement"))


def top_n(df: DataFrame, measure: str, key: str, n: int, with_rank: bool = True) -> DataFrame:
    """The ``n`` rows with the largest ``measure`` (key ascending on ties), numbered from 1.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each partition keeps
    its own top ``n``, so only ``n`` x partitions rows meet in the final task.
    """
    top = df.orderBy(F.col(measure).desc(), F.col(key).asc()).limit(n)
    if not with_rank:
        return top
    w = Window.orderBy(F.col(measure).desc(), F.col(key).asc())  # over at most n rows
    return top.withColumn("rank", F.row_number().over(w))
