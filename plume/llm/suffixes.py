"""Repeated passages by sparse suffix arrays.

1. Of each text's suffixes (one a word) only those at minimiser positions are kept: the smallest hash of
   ``GRAM`` words among ``MIN_WORDS - GRAM + 1`` in a row, so every passage of ``MIN_WORDS`` words holds one, chosen
   by its content alone.
2. The kept suffixes are sorted by the hash of their first ``GRAM`` words over the whole corpus (range partitions),
   and each is compared with its neighbours: one whose neighbours of other texts are equal is a seed.
3. Seeds are extended left and right: every stretch of ``MIN_WORDS`` words around a seed is hashed, the stretches
   are sorted likewise, and those that another text has too repeat.  Neighbouring stretches join to the longest
   passages.  Nothing is paired out: a passage in very many texts costs a row each.

Sorting ties by text and place spreads the rows of a very common passage over many partitions; rows at a
partition's edge, whose neighbour lies in another one, are decided by a table of the edges.  Texts that are equal as
a whole are one class: its stretches count once, and its members repeat as a whole.  What a text only repeats
within itself is left alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, partitions, table, written

MIN_WORDS = 50
GRAM = 10
_BASE = 0x9E3779B97F4A7C15  # odd, so its powers have inverses modulo 2^64


def _hashes(text: str | None) -> np.ndarray:
    """64-bit hash of every word of a whole text (runs without ASCII white space)."""
    h = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").split()
    return np.fromiter((h(w) for w in words), np.uint64, len(words))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _stretches(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words: a difference of polynomial prefix sums, shifted back, mixed."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    up, down = _powers(_BASE, len(h)), _powers(pow(_BASE, -1, 1 << 64), len(h))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up, dtype=np.uint64)))
    out = (total[n:] - total[:-n]) * down[:len(h) - n + 1]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def minimisers(h: np.ndarray, words: int = MIN_WORDS, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and gram hashes of the kept suffixes: the leftmost smallest of each ``words - gram + 1`` grams."""
    g = _stretches(h, gram)
    width = words - gram + 1
    if len(g) < width:
        return np.zeros(0, np.int64), g[:0]
    kept = []
    for at in range(0, len(g) - width + 1, 1 << 14):  # bounded memory on very long texts
        part = np.lib.stride_tricks.sliding_window_view(g[at:at + (1 << 14) + width - 1], width)
        kept.append(np.unique(part.argmin(1) + np.arange(len(part))) + at)
    places = np.unique(np.concatenate(kept))
    return places, g[places]


def _rows(keys, cls, pos) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(keys, np.uint64).view(np.int64)),
                                       pa.array(np.asarray(cls, np.int64)), pa.array(np.asarray(pos, np.int32))],
                                      ["key", "cls", "pos"])


ROW = "key long, cls long, pos int"


def _emit(per_doc, n_cols):
    """A task's function: ``per_doc(values of a row)`` gives (cls, keys, places); rows go out in large batches."""
    def run(batches):
        keys, cls, pos, size = [], [], [], 0
        for b in batches:
            for values in zip(*(b.column(i).to_pylist() for i in range(n_cols))):
                c, k, p = per_doc(*values)
                if len(p):
                    keys.append(k)
                    pos.append(p)
                    cls.append(np.full(len(p), c, np.int64))
                    size += len(p)
                if size > 200_000:
                    yield _rows(np.concatenate(keys), np.concatenate(cls), np.concatenate(pos))
                    keys, cls, pos, size = [], [], [], 0
        if size:
            yield _rows(np.concatenate(keys), np.concatenate(cls), np.concatenate(pos))
    return run


def repeated(rows: DataFrame, name: str) -> DataFrame:
    """``(cls, pos)`` of the rows whose key another ``cls`` has too: sort, then compare neighbours.

    Sorted by key and class, a run of one key has two classes exactly if its first and its last row differ.  A
    task streams over its runs; of a run that goes on it holds the rows of one class only (a text's own places).
    """
    n = partitions(rows.sparkSession)
    ranged = rows.repartitionByRange(n, "key", "cls", "pos").sortWithinPartitions("key", "cls", "pos")

    def run(batches):
        k, c, p = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)  # rows of the run that goes on
        many, first = False, True  # whether it has two classes already; whether it is the partition's first

        def out(take, twin, edge):
            return pa.RecordBatch.from_arrays([pa.array(k[take]), pa.array(c[take]), pa.array(p[take]),
                                               pa.array(twin[take]), pa.array(edge[take])],
                                              ["key", "cls", "pos", "twin", "edge"])
        for b in batches:
            if not b.num_rows:
                continue
            k, c, p = (np.concatenate((old, b.column(i).to_numpy(zero_copy_only=False)))
                       for i, old in enumerate((k, c, p)))
            starts = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
            ends = np.concatenate((starts[1:], [len(k)]))
            two = c[starts] != c[ends - 1]
            two[0] |= many
            twin, edge = np.repeat(two, ends - starts), np.zeros(len(k), bool)
            edge[:ends[0]] = first  # all of a partition's first run: the run before may end with its key
            last = starts[-1]
            done = np.zeros(len(k), bool)
            done[:len(k) - 1 if two[-1] else last] = True  # of a decided run only the last row stays behind
            take = np.flatnonzero(done & (twin | edge))
            if len(take):
                yield out(take, twin, edge)
            many, first = bool(two[-1]), first and len(starts) == 1
            k, c, p = k[~done], c[~done], p[~done]
        if len(k):
            yield out(np.arange(len(k)), np.full(len(k), many), np.ones(len(k), bool))
    found = written(map_arrow(ranged, run, ROW + ", twin boolean, edge boolean"), name)
    # Undecided rows at a partition's edge belong to one class; another one may have the key across the edge.
    across = (found.where("edge").groupBy("key").agg(
        (F.max("twin") | (F.min("cls") != F.max("cls"))).alias("two")).where("two").select("key"))
    late = found.where("edge AND NOT twin").join(across, "key", "left_semi")
    return found.where("twin").select("cls", "pos").unionByName(late.select("cls", "pos"))


def passages(docs: DataFrame, words: int = MIN_WORDS, gram: int = GRAM, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """``(doc_id, start, end, n_words)``: longest passages made of repeated stretches of ``words`` words, by row.

    Places count words from 0, the end is exclusive.  A passage repeats if each of its stretches occurs in
    another row.  Null, empty and shorter texts have none; repeated rows and
    equal texts each get theirs; null ids keep their rows; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("id"),
                       F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.md5(F.col(text).cast("binary")).alias("same")).where("text IS NOT NULL")
    cls = F.xxhash64("same").alias("cls")
    sizes = rows.select("id", "same", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("n"))
    classes = written(sizes.groupBy("same").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("members"),
                                                F.max("n").alias("n")).withColumn("cls", cls), "classes")

    def sampled(c, t):
        places, keys = minimisers(_hashes(t), words, gram)
        return c, keys, places
    kept = written(map_arrow(rows.select(cls, "text"), _emit(sampled, 2), ROW), "suffixes")  # sampled, then sorted
    seeds = repeated(kept, "seeds")
    per_class = seeds.groupBy("cls").agg(F.collect_set("pos").alias("seeds"))  # a text's own places only
    seeded = classes.join(per_class, "cls").select("id", "same", "cls", "seeds")

    def extended(c, t, at):
        s = _stretches(_hashes(t), words)
        near = np.zeros(len(s) + 1, np.int64)
        at = np.asarray(at, np.int64)
        np.add.at(near, np.clip(at + gram - words, 0, len(s)), 1)   # first stretch that holds the seed's gram
        np.add.at(near, np.clip(at + 1, 0, len(s)), -1)
        places = np.flatnonzero(np.cumsum(near[:-1]) > 0)
        return c, s[places], places
    around = rows.join(seeded, ["id", "same"]).select("cls", "text", "seeds")
    stretches = written(map_arrow(around, _emit(extended, 3), ROW), "stretches")
    starts = repeated(stretches, "repeats").groupBy("cls").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    # Runs of places that follow each other, or whose stretches touch or overlap, join to one passage.
    begins = F.filter("at", lambda x, i: (i == 0) | (x > F.get("at", i - 1) + words))
    ends = F.filter("at", lambda x, i: (i == F.size("at") - 1) | (F.get("at", i + 1) > x + words))
    whole = (F.col("members") > 1) & (F.col("n") >= words)
    joined = classes.join(starts, "cls", "left").select("same", F.when(whole, F.array(F.struct(
        F.lit(0).alias("start"), F.col("n").alias("end")))).otherwise(F.zip_with(
            begins, ends, lambda b, e: F.struct(b.alias("start"), (e + words).alias("end")))).alias("spans"))
    spans = written(joined.where("size(spans) > 0"), "spans")
    out = rows.select("doc_id", "same").join(spans, "same").select("doc_id", F.explode("spans").alias("x"))
    return out.select("doc_id", "x.start", "x.end", (F.col("x.end") - F.col("x.start")).alias("n_words"))


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat, over all documents."""
    return passages(table(spark, sf_dir, "documents"))
