"""Benchmark decontamination: which words of a document lie inside a benchmark window.

Prefix-filtered set join, in DataFrame functions only:

1. Items are cut into windows of ``WINDOW`` consecutive words (a shorter item is one window).
2. The words of the windows are ordered by rarity: their occurrences in all documents, ties by the word.
3. A document that holds a whole window holds each of its words, so a prefix of one token - the window's rarest
   word - is enough to meet it.  Documents' words are joined with that prefix.
4. The word's place in the window fixes where the window would start: places before the document's first word
   or whose window would pass its last word fall away (positional and length bounds).
5. What is left is verified: the document's words from there on, as many as the window has, must equal it.

Windows are broadcast when they are at most ``BROADCAST_WINDOWS`` (counted first); beyond that the join
shuffles the documents' words with the few words around each.  All counts are over whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, cut, row_key, small, table

WINDOW = 13
BROADCAST_WINDOWS = 200_000
#: What lies between words.  A-Z count as word characters here, since their lower case are.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _split(text: Column) -> Column:
    """Words of a text, not yet lower-cased; the first and the last element may be empty."""
    return F.coalesce(F.split(text, SEPARATORS, -1), F.array().cast("array<string>"))


def _count(words: Column) -> Column:
    """Number of real words in what ``_split`` gives."""
    n = F.size(words)
    return (n - F.when((n > 0) & (F.element_at(words, 1) == ""), 1).otherwise(0)
            - F.when((n > 1) & (F.element_at(words, -1) == ""), 1).otherwise(0)).cast("long")


def windows(items: DataFrame, window: int = WINDOW, key: str = "item_id", text: str = "text") -> DataFrame:
    """``(item, win, k)``: the distinct windows of each item, words space-joined, and their word count."""
    w = items.select(F.col(key).cast("string").alias("item"),
                     F.filter(_split(ascii_lower(F.col(text))), lambda x: x != "").alias("ws")).where("size(ws) > 0")
    k = F.least(F.lit(window), F.size("ws"))
    return (w.withColumn("k", k)
            .withColumn("at", F.explode(F.sequence(F.lit(1), F.size("ws") - F.col("k") + 1)))
            .select("item", F.array_join(F.slice("ws", F.col("at"), F.col("k")), " ").alias("win"), "k").distinct())


def prefixes(docs: DataFrame, wins: DataFrame, n_windows: int, text: str = "text") -> DataFrame:
    """``(win, k, token, offset)``: each window's rarest word (folded) and its place from 0."""
    words = (wins.select("win", "k", F.posexplode(F.split("win", " ")).alias("offset", "w"))
             .withColumn("token", F.lower("w")))
    vocabulary = words.select("token").distinct()
    found = docs.select(F.explode(_split(F.col(text))).alias("w")).select(F.lower("w").alias("token"))
    counts = (found.join(small(vocabulary, n_windows, BROADCAST_WINDOWS), "token", "left_semi")
              .groupBy("token").agg(F.count(F.lit(1)).alias("freq")))
    ranked = words.join(small(counts, n_windows, BROADCAST_WINDOWS), "token", "left")
    return (ranked.groupBy("win", "k")
            .agg(F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "token", "offset")).alias("rare"))
            .select("win", "k", "rare.token", "rare.offset"))


def occurrences(docs: DataFrame, prefix: DataFrame, n_windows: int, text: str = "text") -> DataFrame:
    """``(__id, __h, at, k, win)``: every verified occurrence of a window; ``at`` counts words from 0."""
    worded = docs.select(*row_key(text=text), _split(F.col(text)).alias("ws"))
    fits = (F.col("pos") >= F.col("offset")) & (F.col("pos") - F.col("offset") + F.col("k") <= F.col("n"))
    if n_windows <= BROADCAST_WINDOWS:
        each = worded.select("__id", "__h", "ws", F.size("ws").alias("n"), F.posexplode("ws").alias("pos", "w"))
        at = F.col("pos") - F.col("offset") + 1
        met = each.join(F.broadcast(prefix), (F.lower("w") == F.col("token")) & fits)
    else:  # the words around each word travel instead of the whole text
        each = (worded.select("__id", "__h", "ws", F.size("ws").alias("n"), F.posexplode("ws").alias("pos", "w"))
                .withColumn("from", F.greatest(F.col("pos") - (WINDOW - 1), F.lit(0)))
                .withColumn("ws", F.slice("ws", F.col("from") + 1, F.lit(2 * WINDOW - 1))))
        at = F.col("pos") - F.col("offset") - F.col("from") + 1
        met = each.join(prefix, (F.lower("w") == F.col("token")) & fits)
    same = ascii_lower(F.array_join(F.slice("ws", F.greatest(at, F.lit(1)), F.col("k")), " ")) == F.col("win")
    return met.where(same).select("__id", "__h", (F.col("pos") - F.col("offset")).alias("at"), "k", "win")


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  keyed: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Contaminated: some word is hit, and hit words are at least one in twenty.  Null, empty and word-less texts
    have no words and are clean; items without words (or a null text) match nothing; an item with a null id
    hits words but is not counted or named; repeated rows give repeated result rows; an empty benchmark makes
    every document clean; other columns are ignored.  ``keyed`` adds the row's key (see ``row_key``).
    """
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    wins = cut(windows(items))
    distinct = wins.select("win", "k").distinct()
    n = distinct.count()
    prefix = cut(prefixes(docs, distinct, n))
    occ = cut(occurrences(docs, prefix, n).distinct())
    row = ["__id", "__h"]
    # Covered words: sweep the occurrences of a document by their start, past what is covered already.
    sweep = Window.partitionBy(*row).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    spans = occ.groupBy(*row, "at").agg(F.max("k").alias("k")).withColumn("end", F.col("at") + F.col("k"))
    fresh = F.col("end") - F.greatest(F.col("at"), F.coalesce(F.max("end").over(sweep), F.lit(0)))
    hits = (spans.withColumn("new", F.greatest(fresh, F.lit(0)))
            .groupBy(*row).agg(F.sum("new").cast("long").alias("n_hit")))
    named = (occ.select(*row, "win").distinct()
             .join(small(wins.select("win", "item"), n, BROADCAST_WINDOWS), "win")
             .where("item IS NOT NULL").groupBy(*row).agg(F.sort_array(F.collect_set("item")).alias("items")))
    per_row = docs.select("doc_id", *row_key(), _count(_split(F.col("text"))).alias("n_words"))
    facts = hits.join(named, row, "left")
    none = F.array().cast("array<string>")
    keys = row if keyed else []
    out = per_row.join(facts, row, "left").select(
        *keys, "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", none).alias("items"))
    return out.select(
        *keys, "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    found = contamination(docs, items, key, text, keyed=True)
    bad = cut(found.where("contaminated").select(F.col("__id").alias("__bad_id"), F.col("__h").alias("__bad_h")).distinct())
    row_id, row_h = row_key(key, text)
    return docs.join(small(bad, bad.count()), (row_id == F.col("__bad_id")) & (row_h == F.col("__bad_h")), "left_anti")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words, items and verdict for every document."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The same in DuckDB, by plain string search at every word offset of the space-joined words.
SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
wins AS (SELECT DISTINCT item_id, ws[i : i + least(13, len(ws)) - 1] AS w
         FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT len(w) AS k FROM wins),
grams AS (SELECT doc_id, i, k, ws[i : i + k - 1] AS w
          FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, ks WHERE len(ws) >= k)),
occ AS (SELECT doc_id, i, k, item_id FROM grams JOIN wins USING (w)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM occ GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
