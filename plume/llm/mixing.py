"""Mixing sources to target weights by pivotal dependent rounding.

Sources in code point order (null last) weigh 3, 1, 2, repeating, and share ``SHARE`` times all words; no target
passes ``MOST`` times its source's size, what lies above is shared again by weight.  A document's fractional
number of copies is its source's target over its source's size.  The whole part is taken as it is; the rest is
rounded by the pivotal method: two documents with a fractional rest meet, words move from one to the other until
one rest becomes 0 or 1, and the other goes on.  The direction is drawn so that each rest keeps its expected
value, and a move takes from one document the words that it gives the other, so a source's words stay on
target but for its last document.

Rounding runs as a distributed reduction tree: buckets of about ``BUCKET`` documents of one source are rounded
each by itself and leave one fractional document, those are dealt into buckets again, until each source has one
left, which takes the nearer whole number.  Buckets and draws depend on hashes of the rows alone, so reruns agree
whatever the partitioning.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, small, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BUCKET = 4096
SEED = 20
EPS = 1e-9

ROW = "doc_id string, size long, src long, source_size long, target double, rest double, whole long, h long, b long, buckets long"


def sizes(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(doc_id, source, size)``: words of every text (null and empty: 0); ids as strings, since a null would
    turn pandas' whole numbers into floats."""
    return docs.select(
        F.col(key).cast("string").alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"))


def _numbered(per_source: DataFrame) -> DataFrame:
    """``per_source`` with ``src``, the place of each source in code point order from 0 (null last)."""
    n = max(1, int(per_source.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = cut(per_source.withColumn("last", F.col("source").isNull().cast("int"))
                 .repartitionByRange(n, "last", "source").withColumn("p", F.spark_partition_id()))
    # One row a partition: the offsets are bounded by the number of partitions.
    before = (ranged.groupBy("p").agg(F.count(F.lit(1)).alias("m"))
              .select("p", F.coalesce(F.sum("m").over(Window.orderBy("p").rowsBetween(
                  Window.unboundedPreceding, -1)), F.lit(0)).alias("off")))
    at = F.row_number().over(Window.partitionBy("p").orderBy("last", "source")) - 1
    return ranged.withColumn("at", at).join(F.broadcast(before), "p").select(
        "source", "source_size", "n_docs", (F.col("off") + F.col("at")).cast("long").alias("src"))


def targets(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, src, source_size, n_docs, target)`` by sharing by weight, the excess over ``most`` times anew.

    A source without words has target 0.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ws = F.array(*[F.lit(float(w)) for w in weights])
    src = cut(_numbered(per).withColumn("w", F.get(ws, (F.col("src") % len(weights)).cast("int"))))
    total = src.agg(F.sum("source_size")).first()[0] or 0
    level, ceiling = 0.0, F.col("source_size") * most
    while True:  # each pass only raises the level, until no further source passes its ceiling
        full = ceiling <= level * F.col("w")
        held, free = src.agg(F.sum(F.when(full, ceiling).otherwise(0.0)),
                             F.sum(F.when(full, 0.0).otherwise(F.col("w")))).first()
        if not free:
            break
        up = (share * total - held) / free
        if up <= level:
            break
        level = up
    return src.withColumn("target", F.least(ceiling, F.lit(float(level)) * F.col("w"))).drop("w")


def _round_bucket(pdf: pd.DataFrame, last: bool) -> pd.DataFrame:
    """Pivotal rounding within one bucket; at most one row keeps a fractional rest (none if ``last``)."""
    pdf = pdf.sort_values(["size", "h", "doc_id"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    rest, size = pdf["rest"].tolist(), pdf["size"].tolist()
    draw = random.Random(f"{SEED}:{pdf['src'].iat[0]}:{pdf['h'].iat[0]}:{len(pdf)}").random
    held = -1
    for j, r in enumerate(rest):
        if r < EPS or r > 1 - EPS or not size[j]:
            rest[j] = 1.0 if r > 1 - EPS else 0.0
            continue
        if held < 0:
            held = j
            continue
        i, a, b = held, rest[held], r
        up = min((1 - a) * size[i], b * size[j])      # words that i could take from j
        down = min(a * size[i], (1 - b) * size[j])    # words that i could give to j
        move = up if draw() * (up + down) < down else -down
        a, b = a + move / size[i], b - move / size[j]
        rest[i], rest[j] = (min(1.0, max(0.0, x)) for x in (a, b))
        open_ = [k for k in (i, j) if EPS < rest[k] < 1 - EPS]
        for k in (i, j):
            if k not in open_:
                rest[k] = float(round(rest[k]))
        held = open_[0] if open_ else -1
    if held >= 0 and last:
        rest[held] = float(rest[held] >= 0.5)
    pdf["rest"] = rest
    return pdf


def _rounding(last: bool):
    return lambda pdf: _round_bucket(pdf, last)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST, bucket: int = BUCKET) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken.

    Null and empty texts have size 0 and nothing taken; null sources are one source, the last; repeated rows are
    mixed each by itself; an empty table gives no rows; other columns are ignored.
    """
    sized = cut(sizes(docs, key, text, source))
    per = targets(sized, weights, share, most)
    per = cut(per)
    n = per.count()
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (sized.withColumnRenamed("source", "s").join(small(per, n), F.col("s").eqNullSafe(F.col("source")))
            .withColumn("whole", F.floor(copies + EPS).cast("long"))
            .withColumn("rest", F.greatest(copies - F.col("whole"), F.lit(0.0)))
            .withColumn("h", F.xxhash64("doc_id", "size", F.lit(SEED)))
            .withColumn("buckets", F.ceil(F.col("n_docs") / bucket)))
    names = ["doc_id", "size", "src", "source_size", "target", "rest", "whole", "h"]
    now = rows.select(*names, F.pmod("h", "buckets").alias("b"), "buckets")
    done, parts = None, per.agg(F.max(F.ceil(F.col("n_docs") / bucket))).first()[0] or 1
    while True:
        last = parts <= 1
        rounded = cut(now.groupBy("src", "b").applyInPandas(_rounding(last), ROW))
        whole = (F.col("rest") == 0) | (F.col("rest") == 1)
        out = rounded.where(whole).select(*names)
        done = out if done is None else done.unionByName(out)
        if last:
            break
        # What is left is one row a bucket: deal those of a source into fewer buckets.
        parts = -(-parts // bucket)
        now = (rounded.where(~whole).withColumn("buckets", F.ceil(F.col("buckets") / bucket))
               .withColumn("b", F.pmod(F.col("b"), F.col("buckets"))).select(*names, "b", "buckets"))
    return done.select(F.col("doc_id").cast(docs.schema[key].dataType).alias("doc_id"), "size", "source_size", "target",
                       ((F.col("whole") + F.col("rest").cast("long")) * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the mix takes, all columns, with size, source_size, target, taken and copies.

    Columns of these names are replaced.  Rows that share an id are told apart by text, source and number.
    """
    rows = docs.drop("size", "source_size", "target", "taken", "copies")
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    if docs.groupBy(key).count().where("count > 1").limit(1).count():
        same = [F.xxhash64(text), F.xxhash64(source)]
        name = F.concat_ws(":", name, *same, F.row_number().over(Window.partitionBy(key, *same).orderBy(key)))
    rows = rows.withColumn("__key", name)
    got = mix(rows, "__key", text, source).where("taken > 0").withColumnRenamed("doc_id", "__key")
    return rows.join(got.withColumn("copies", (F.col("taken") / F.col("size")).cast("int")), "__key").drop("__key")


def op6_mix_pivotal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: 150 % of their words over sources weighing 3, 1, 2."""
    return mix(table(spark, sf_dir, "documents"))
