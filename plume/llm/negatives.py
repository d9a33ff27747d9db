"""Hard-negative mining: exact integer scores by Strassen's recursion on tiles, then mergeable heaps.

Vectors become whole numbers, ``floor(SCALE * x)``.  Anchors and candidates are dealt into blocks by a hash of their
row number; each pair of an anchor block and a candidate block is one group, so a task holds ``TILE_A`` by ``TILE_C``
rows, however many rows there are and however many of them share a label.  A block pair is multiplied by Strassen's
recursion on int64, with zero padding to even sides.  Additions of whole numbers are exact (int64 wraps around, and
scores themselves fit), so the scores are those of the plain product.

Two passes keep heaps that merge: first the best ``POSITIVES`` rows of the anchor's label, from blocks of rows whose
labels share a bucket; then, for each positive, the best ``NEGATIVES`` rows of other labels whose score lies in the
positive's window.  A block pair leaves at most a heap for each anchor (and positive); heaps merge by rank, which Spark
limits before and after its shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small, table, written

SCALE = 256
ANCHORS = 50       # rows whose id is divisible by this are anchors
RELABEL = 7        # rows whose id is divisible by this get the next label of LABELS
LABELS = 10
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # a negative's score lies between these hundredths of its positive's
TILE_A, TILE_C = 512, 8192
STRIP = 128        # anchors of a block that are multiplied at once
LEAF = 32          # sides up to this are multiplied directly

LEAST = -(2**63)


def strassen(a: np.ndarray, bt: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ bt.T`` on int64 by Strassen's recursion; sides that are odd get a row or column of zeros."""
    (m, k), n = a.shape, bt.shape[0]
    if min(m, k, n) <= leaf:
        return a @ bt.T
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    bt = np.pad(bt, ((0, n % 2), (0, k % 2)))
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, bt.shape[0] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b21, b12, b22 = bt[:t, :s], bt[:t, s:], bt[t:, :s], bt[t:, s:]  # the transposes of B's quarters
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * r, 2 * t), np.int64)
    out[:r, :t] = m1 + m4 - m5 + m7
    out[:r, t:] = m3 + m5
    out[r:, :t] = m2 + m4
    out[r:, t:] = m1 - m2 + m3 + m6
    return out[:m, :n]


def _matrix(col: pa.ChunkedArray, width: int) -> np.ndarray:
    """List column as an int64 matrix; shorter lists end in zeros."""
    lists = col.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    lens, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lens) and (lens == width).all():
        return flat.reshape(len(lens), width)
    out = np.zeros((len(lens), width), np.int64)
    out[np.arange(width) < lens[:, None]] = flat
    return out


def _both(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    width = max(max((len(x) for x in t.column("q").to_pylist()), default=0) for t in (left, right))
    return _matrix(left.column("q"), width), _matrix(right.column("q"), width)


def _first(scores: np.ndarray, k: int) -> list[np.ndarray]:
    """Places of the ``k`` highest scores of each row, one array a rank; equal scores by place."""
    out = []
    rows = np.arange(len(scores))
    for _ in range(min(k, scores.shape[1])):
        at = scores.argmax(axis=1)
        out.append(np.where(scores[rows, at] == LEAST, -1, at))
        scores[rows, at] = LEAST
    return out


def _by_id(right: pa.Table) -> pa.Table:
    return right.sort_by([("vec_id", "ascending"), ("row", "ascending")])  # Arrow puts nulls last


def _positives(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """Heaps of one block pair: up to ``k`` rows of an anchor's own label."""
    right = _by_id(right)
    a, c = _both(left, right)
    la, lc = (t.column("label").to_numpy() for t in (left, right))
    ra, rc = (t.column("row").to_numpy() for t in (left, right))
    anchor, cand, score = [], [], []
    for s in range(0, len(a), STRIP):
        e = slice(s, s + STRIP)
        got = strassen(a[e], c)
        masked = np.where((la[e, None] == lc) & (ra[e, None] != rc), got, LEAST)
        for at in _first(masked, k):
            rows = np.flatnonzero(at >= 0)
            anchor.append(rows + s)
            cand.append(at[rows])
            score.append(got[rows, at[rows]])
    at = np.concatenate(cand).astype(np.int64) if cand else np.empty(0, np.int64)
    of = np.concatenate(anchor).astype(np.int64) if anchor else np.empty(0, np.int64)
    return pa.table({"anchor": pa.array(ra[of], pa.int64()), "vec_id": right.column("vec_id").take(pa.array(at)),
                     "row": pa.array(rc[at], pa.int64()),
                     "score": pa.array(np.concatenate(score) if score else [], pa.int64())})


def _negatives(left: pa.Table, right: pa.Table, k: int, low: int, high: int) -> pa.Table:
    """Heaps of one block pair: up to ``k`` rows of other labels for each positive of an anchor."""
    right = _by_id(right)
    a, c = _both(left, right)
    la, lc = (t.column("label").to_numpy() for t in (left, right))
    ra, rc = left.column("row").to_numpy(), right.column("row").to_numpy()
    wins = [[(p["place"], -(-low * p["score"] // 100), high * p["score"] // 100) for p in ps]
            for ps in left.column("positives").to_pylist()]
    anchor, place, cand, score = [], [], [], []
    for s in range(0, len(a), STRIP):
        got = strassen(a[s:s + STRIP], c)
        other = np.where(la[s:s + STRIP, None] != lc, got, LEAST)
        strip = wins[s:s + STRIP]
        for j in range(max(map(len, strip), default=0)):
            own = np.array([i for i, w in enumerate(strip) if len(w) > j])
            lo, hi = (np.array([strip[i][j][x] for i in own], np.int64)[:, None] for x in (1, 2))
            here = other[own]
            here[(here < lo) | (here > hi)] = LEAST
            for at in _first(here, k):
                rows = np.flatnonzero(at >= 0)
                anchor.append(ra[own[rows] + s])
                place.append([strip[i][j][0] for i in own[rows]])
                cand.append(at[rows])
                score.append(got[own[rows], at[rows]])
    flat = lambda x: np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64)
    at = flat(cand)
    return pa.table({"anchor": pa.array(flat(anchor)), "place": pa.array(flat(place).astype(np.int32)),
                     "vec_id": right.column("vec_id").take(pa.array(at)), "row": pa.array(rc[at], pa.int64()),
                     "score": pa.array(flat(score))})


def vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(row, vec_id, label, q)`` of the rows that take part, written once so that row numbers stay."""
    x = F.col(vector).cast("array<double>")
    ok = F.col(label).isNotNull() & x.isNotNull() & F.forall(
        x, lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False)))
    ident = F.col(key).cast("long")
    tag = F.col(label).cast("long")
    out = rows.where(ok).select(
        F.monotonically_increasing_id().alias("row"), ident.alias("vec_id"),
        F.when(ident % RELABEL == 0, (tag + 1) % LABELS).otherwise(tag).alias("label"),
        F.transform(x, lambda v: F.floor(v * float(SCALE))).alias("q"))
    length = F.aggregate("q", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    return written(out.where(length < 2.0**63), "vectors")


def _met(anchors: DataFrame, rows: DataFrame, work: Callable, schema: str, tile_a: int, tile_c: int) -> DataFrame:
    """``work`` over every pair of an anchor block and a candidate block of the same bucket ``g``."""
    of_rows = rows.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / tile_c).cast("int").alias("cs"))
    of_anchors = anchors.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / tile_a).cast("int").alias("as"))
    per = written(of_rows.join(of_anchors, "g"), "blocks")
    per = small(per, per.count())
    draw = F.xxhash64("row")
    left = (anchors.join(per, "g").withColumn("i", F.pmod(draw, F.col("as")).cast("int"))
            .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("cs") - 1))).drop("as", "cs"))
    right = (rows.join(per, "g").withColumn("j", F.pmod(draw, F.col("cs")).cast("int"))
             .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("as") - 1))).drop("as", "cs"))
    left = left.toDF(*left.columns)  # columns of its own: anchors and rows come from one table
    return left.groupBy("g", "i", "j").cogroup(right.groupBy("g", "i", "j")).applyInArrow(work, schema)


def _merged(heaps: DataFrame, by: list[str], k: int, place: str) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row")]
    return heaps.withColumn(place, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(place) <= k)


def _positive_work(k: int) -> Callable:
    return lambda left, right: _positives(left, right, k)


def _negative_work(k: int, low: int, high: int) -> Callable:
    return lambda left, right: _negatives(left, right, k, low, high)


def mine(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = ANCHORS,
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         tile_a: int = TILE_A, tile_c: int = TILE_C) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of every anchor and positive.

    Rows with a null label, a null vector or a null or non-finite component take no part, nor do rows whose whole
    numbers have a squared length of 2^63 or more, since their scores need not fit in a long.  Shorter vectors count as
    ended by zeros, empty ones score 0.  Rows of a null id are no anchors; as positives and negatives they come after
    all ids of the same score.  Rows of one id are rows of their own: each may be another's positive, and a repeated
    anchor gives its rows again.  Equal scores go by id, then by stored order.  Anchors without positives, positives
    without negatives and an empty table give no rows; other columns are ignored.
    """
    all_rows = vectors(rows, key, vector, label)
    n = all_rows.count()
    by_label = all_rows.withColumn("g", F.pmod(F.xxhash64("label"), F.lit(max(1, -(-n // tile_c)))).cast("int"))
    heaps = _met(by_label.where(F.col("vec_id") % every == 0), by_label, _positive_work(positives),
                 "anchor long, vec_id long, row long, score long", tile_a, tile_c)
    best = written(_merged(heaps, ["anchor"], positives, "place"), "positives")
    lists = best.groupBy("anchor").agg(F.collect_list(F.struct("place", "score")).alias("positives"))  # 5 at most
    one = F.pmod("row", F.lit(1)).cast("int")  # one bucket; a constant would make its joins ones without a key
    anchors = (all_rows.where(F.col("vec_id") % every == 0).join(lists, F.col("row") == F.col("anchor"))
               .drop("anchor").withColumn("g", one))
    found = _met(anchors, all_rows.withColumn("g", one), _negative_work(negatives, low, high),
                 "anchor long, place int, vec_id long, row long, score long", tile_a, tile_c)
    found = _merged(found, ["anchor", "place"], negatives, "rank")
    return (found.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).drop("row")
            .join(best.select("anchor", "place", F.col("vec_id").alias("positive_id"),
                              F.col("score").alias("positive_score")), ["anchor", "place"])
            .join(all_rows.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op13_strassen_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor of ``embeddings``, for each of its first five positives."""
    return mine(table(spark, sf_dir, "embeddings"))


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    list_inner_product(a.q, c.q)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
  s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY rank <= 3
"""
