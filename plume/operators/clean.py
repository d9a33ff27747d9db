"""Ingest filter, post cleaning, deduplication and the cleaning funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plume.functions.columns import (
    COUNTERS, engagement_safe, hashtags_array, mentions_array, py_strip, username_from_user,
)
from plume.schemas import KEEP_COLUMNS
from plume.session import work_dir


MARK_WORDS = 1 << 21  # at most so many words of 64 bits mark the keys which may repeat: 134 million slots, broadcast
KEYS_PER_WORD = 4


def _mark(key: str, words: int) -> tuple[Column, Column]:
    """Word and bit of a key's slot."""
    h = F.xxhash64(F.col(f"`{key}`"))
    return F.pmod(h, F.lit(words)).cast("int"), F.expr(f"shiftleft(1L, cast(pmod(shiftright(xxhash64(`{key}`), 32), 64) as int))")


def keep_best_per_key(df: DataFrame, key: str, order: list[str], reread: bool = False,
                      carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per key: the row with the largest ``order`` columns; a 64-bit hash of the row's other columns
    (null flags included) breaks the remaining ties, so the survivor is the same on every run.

    An aggregate, not a window: partial aggregation combines a key's rows map-side, so a key holding a third of
    all rows is reduced before the shuffle and never lands whole in one task.  One ``max_by`` carries the row as
    one struct and the order once; select the columns a query needs before calling, the rest never travels.

    ``reread`` is for wide rows that can be computed again: a first pass counts the keys alone and marks those that
    repeat in a bit table.  Rows of unmarked keys are the only ones of their key and stay where they are; only rows of
    marked keys are shuffled.  The table has a word for every ``KEYS_PER_WORD`` keys that repeat, up to ``MARK_WORDS``,
    so that at any size a few unrepeated keys in a hundred share a mark.

    ``carry`` names what a result's column holds in place of the column itself; the choice among copies is that of the
    whole rows, and what ``carry`` leaves out is not shuffled.
    """
    payload = [c for c in df.columns if c != key]
    cols = [F.col(f"`{c}`") for c in payload]
    kept = [(carry or {}).get(c, F.col(f"`{c}`")).alias(c) for c in payload]
    row_hash = F.xxhash64(*[x for c in cols for x in (c, c.isNull())])
    ordering = F.struct(*[F.col(f"`{c}`").alias(f"__o{i}") for i, c in enumerate(order)], row_hash.alias("__h"))

    def best(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key).agg(F.max_by(F.struct(*kept), ordering).alias("__row")).select(
            key, *[F.col(f"__row.`{c}`").alias(c) for c in payload])
    if not reread:
        return best(df)
    work_dir(df.sparkSession)
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(key).checkpoint(eager=True)
    word, bit = _mark(key, min(MARK_WORDS, 1 << (repeated.count() // KEYS_PER_WORD).bit_length()))
    marks = repeated.groupBy(word.alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    told = df.withColumn("__word", word).join(F.broadcast(marks), "__word", "left")
    marked = F.coalesce(F.col("__bits").bitwiseAND(bit), F.lit(0)) != 0
    return told.where(~marked).select(key, *kept).unionByName(best(told.where(marked).select(key, *payload)))


def keep_first_read(df: DataFrame, key: str, at: str = "read_at") -> DataFrame:
    """One row per key: the one read first, by the reading position ``at``; an aggregate, as ``keep_best_per_key``."""
    payload = [F.col(f"`{c}`") for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.min_by(F.struct(*payload), F.col(at)).alias("__row"))
    return best.select(key, *[F.col(f"__row.`{c}`").alias(c) for c in df.columns if c != key])


def keep_columns(df: DataFrame, columns=KEEP_COLUMNS) -> DataFrame:
    """Keep the listed columns that exist, in list order (P1)."""
    return df.select([c for c in columns if c in df.columns])


def ingest_filter(raw: DataFrame, lang: str | None = "en", reread: bool = False) -> DataFrame:
    """CSV-to-Parquet cleaning: keep columns, parse dates (bad -> null), language filter,
    strip text and keep length > 5 (null text counts as ``nan``), one row per id.

    Where ``raw`` has ``read_at`` (``read_posts_csv(position=True)``), the first row read of an id stays; else the
    latest date, then the greatest text; ``reread`` as in ``keep_best_per_key``."""
    df = raw.select([c for c in KEEP_COLUMNS if c in raw.columns] + [c for c in raw.columns if c == "read_at"])
    if "date" in df.columns:
        df = df.withColumn("date", F.col("date").try_cast("timestamp"))
    if lang is not None and "lang" in df.columns:
        df = df.filter(F.col("lang") == F.lit(lang))
    if "content" in df.columns:
        df = df.withColumn("content", F.coalesce(py_strip(F.col("content")), F.lit("nan")))
        df = df.filter(F.length("content") > 5)
    if "id" in df.columns:
        if "read_at" in df.columns:
            return keep_first_read(df, "id").drop("read_at")
        df = keep_best_per_key(df, "id", [c for c in ("date", "content") if c in df.columns], reread)
    return df.drop("read_at")


def ingest_funnel(raw: DataFrame, lang: str | None = "en") -> DataFrame:
    """Rows read, after the language filter, after the text filter and after dedup, in one pass."""
    text = F.coalesce(py_strip(F.col("content")), F.lit("nan"))
    lang_ok = F.lit(True) if lang is None else (F.col("lang") == F.lit(lang))
    both = lang_ok & (F.length(text) > 5)
    agg = raw.agg(
        F.count(F.lit(1)).alias("read"),
        F.count_if(lang_ok).alias("after_lang"),
        F.count_if(both).alias("after_text"),
        F.count_distinct(F.when(both, F.col("id"))).alias("after_dedup"),
    )
    return agg.select(F.expr("stack(4, 'read', read, 'after_lang', after_lang, 'after_text', after_text, "
                             "'after_dedup', after_dedup) AS (step, row_count)"))


def typed_posts(raw: DataFrame) -> DataFrame:
    """Fixed projection with null-on-error casts (P2, P4)."""
    return raw.select(
        F.col("id").try_cast("long").alias("id"),
        F.col("date").try_cast("timestamp").alias("date"),
        F.col("content"),
        F.col("lang"),
        *[F.col(c).try_cast("int").alias(c) for c in COUNTERS],
        F.col("conversationId").try_cast("long").alias("conversationId"),
        F.col("inReplyToTweetId").try_cast("long").alias("inReplyToTweetId"),
        F.col("user"),
        F.col("mentionedUsers"),
        F.col("hashtags"),
        F.col("url"),
    )


# What each column of ``posts_clean`` is made from.
DERIVED = {"username": "user", "hashtags_array": "hashtags", "mentions_array": "mentionedUsers"}
POST_COLUMNS = ["id", "date", "content", "lang", *COUNTERS, "conversationId", "inReplyToTweetId", "url", "engagement",
                *DERIVED]


def clean_posts(raw: DataFrame, columns: list[str] | None = None, reread: bool = False,
                lang: str | None = None) -> DataFrame:
    """``posts_clean``: typed, engagement (null-safe), one post per id (a copy with text wins, then the latest
    date, then the larger engagement), text not null, author name, hashtag and mention arrays.

    ``columns`` (with ``id``) limits the result: only what those columns are made from passes the dedup shuffle;
    ``reread`` as in ``keep_best_per_key``.  ``lang`` (among ``columns``) limits it to the posts that are of the language
    after the dedup; texts of others take part in the choice, but do not pass the shuffle.
    """
    columns = columns or POST_COLUMNS
    df = typed_posts(raw).withColumn("engagement", engagement_safe()).withColumn("has_content", F.col("content").isNotNull())
    needed = dict.fromkeys(["id", "has_content", "date", "engagement", *[DERIVED.get(c, c) for c in columns]])
    carry = {"content": F.when(F.col("lang") == lang, F.col("content"))} if lang and "content" in needed else None
    df = keep_best_per_key(df.select(*needed), "id", ["has_content", "date", "engagement"], reread, carry)
    if lang:
        df = df.filter(F.col("lang") == lang)
    made = {"username": username_from_user, "hashtags_array": hashtags_array, "mentions_array": mentions_array}
    return df.filter(F.col("has_content")).select(
        *[made[c](DERIVED[c]).alias(c) if c in made else F.col(c) for c in columns])


def hashtags_exploded(posts: DataFrame) -> DataFrame:
    """One row per hashtag use (duplicates inside a post kept)."""
    return (posts.filter(F.size("hashtags_array") > 0)
            .select("id", F.explode("hashtags_array").alias("hashtag"), "engagement"))


def mentions_exploded(posts: DataFrame) -> DataFrame:
    """One row per mention."""
    return posts.select("id", "username", F.explode("mentions_array").alias("mentioned"))
