"""SimHash near-duplicates, found with pivot distance tables.

1. Every text gets a 64-bit SimHash over its word shingles (XXH64, seed 42).
2. Distinct fingerprints get a pivot table row: their Hamming distances to ``PIVOTS`` fixed reference
   fingerprints, packed a byte each.  By the triangle inequality two fingerprints that differ in at most
   ``max_bits`` bits have coordinates that differ by at most ``max_bits`` for every pivot.
3. Pairs are met in buckets: the 64 bits are cut into ``max_bits + 2`` segments, and at least two segments
   of a linked pair are equal, so each pair of segments is a bucket key.  The pairs of a bucket are discarded
   by the maximum coordinate difference, survivors are verified on the fingerprints.
4. A bucket of more than ``BUCKET`` distinct fingerprints is not paired out.  Its members emit themselves and
   their one-bit neighbours as keys instead; two fingerprints share such a key if and only if they differ in at
   most two bits, and each key links its members to its smallest (exact, and linear in the members).  For
   ``max_bits`` over 2 that exact way does not exist, so such buckets are paired out after all.
5. Connected components over the links give the groups.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import append, cut, table
from .components import components

SHINGLE = 3
MAX_BITS = 2
PIVOTS = 16
BUCKET = 256


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    h64 = xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 16):
        hs = np.fromiter((h64(b" ".join(words[i:i + shingle]), 42) for i in range(at, min(n, at + (1 << 16)))),
                         np.uint64)
        ones += np.unpackbits(hs.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fp)``: signed SimHash of every row's whole text (null and word-less texts: 0)."""
    return append(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("t")),
                  "t", "fp long", lambda: lambda ts: [[_signed(fingerprint(t, shingle)) for t in ts]], drop=("t",))


def pivot_table(fps: DataFrame) -> DataFrame:
    """Distinct ``fp`` with its distances to the pivots, eight to a long (``t0``, ``t1``, ...)."""
    def packed(at: int) -> Column:
        c = F.lit(0).cast("long")
        for i in range(8):
            ref = _signed(xxhash.xxh64_intdigest(f"pivot-{at * 8 + i}", 42))
            d = F.bit_count(F.col("fp").bitwiseXOR(F.lit(ref).cast("long"))).cast("long")
            c = c.bitwiseOR(F.shiftleft(d, 8 * i))
        return c
    return fps.select("fp", *[packed(k).alias(f"t{k}") for k in range(PIVOTS // 8)])


def _segment_keys(max_bits: int) -> Column:
    """One bucket key for each pair of segments (pair number and both segments' bits)."""
    n = max_bits + 2
    edge = [round(i * 64 / n) for i in range(n + 1)]
    masks = [((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in range(n)]
    return F.array(*[F.struct(F.lit(k).alias("k"),
                              F.col("fp").bitwiseAND(F.lit(_signed(masks[i] | masks[j])).cast("long")).alias("bits"))
                     for k, (i, j) in enumerate(combinations(range(n), 2))])


def links(table_: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """``(a, b)``: linked distinct fingerprints; within over-full buckets a star per shared neighbour instead."""
    keyed = table_.withColumn("key", F.explode(_segment_keys(max_bits)))
    # One row a key before the shuffle of members: most buckets hold one fingerprint and end here.
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = cut(keyed.join(sizes, "key"))
    pairs = met if max_bits > 2 else met.where(F.col("n") <= bucket)
    coords = [f"t{k}" for k in range(PIVOTS // 8)]
    x = pairs.select("key", F.col("fp").alias("a"), *[F.col(c).alias(f"a_{c}") for c in coords])
    y = pairs.select("key", F.col("fp").alias("b"), *[F.col(c).alias(f"b_{c}") for c in coords])
    near = F.lit(True)
    for c in coords:
        for i in range(8):
            byte = [F.shiftright(F.col(f"{s}_{c}"), 8 * i).bitwiseAND(F.lit(255).cast("long")) for s in "ab"]
            near = near & (F.abs(byte[0] - byte[1]) <= max_bits)
    exact = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    found = x.join(y, (x["key"] == y["key"]) & (F.col("a") < F.col("b")) & near & exact).select("a", "b")
    if max_bits <= 2:
        crowd = met.where(F.col("n") > bucket).select("fp").distinct()
        # For max_bits 1 the own fingerprint meets the neighbours; for 0 there is nothing to link.
        flips = [F.lit(0)] if max_bits == 0 else [F.lit(0).cast("long")] + [
            F.lit(_signed(1 << i)).cast("long") for i in range(64)]
        mids = crowd.select("fp", F.explode(F.transform(F.array(*flips), lambda m: F.col("fp").bitwiseXOR(m)))
                            .alias("mid"))
        if max_bits == 2:
            low = mids.groupBy("mid").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
            found = found.unionByName(mids.join(low, "mid").where("fp != a").select("a", F.col("fp").alias("b")))
        elif max_bits == 1:
            own = crowd.select(F.col("fp").alias("mid"))
            found = found.unionByName(mids.join(own, "mid").where("fp < mid")
                                      .select(F.col("fp").alias("a"), F.col("mid").alias("b")))
    return found.distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row: its SimHash and the smallest id its group reaches.

    Groups are the connected components of "at most ``max_bits`` differing bits".  Null, empty and word-less
    texts have fingerprint 0 and link like any other; repeated rows give repeated result rows; null ids keep
    their row and never name a group unless all its ids are null; an empty table gives no rows; other columns
    are ignored.
    """
    fps = cut(fingerprints(docs, shingle, key, text))
    own = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))  # copies are one row from here on
    # Component ids are fingerprints here; the smallest document of the component names it.
    named = _named(own, max_bits)
    low = named.where("c != fp").groupBy("c").agg(F.min("least").alias("other"))
    comp = (named.join(low, "c", "left"))
    heads = (comp.where("fp = c").select("c", F.least("least", "other").alias("component_id")))
    ids = named.join(heads, "c").select("fp", "component_id")
    return fps.join(ids, "fp").select("doc_id", "fp", "component_id")


def _named(own: DataFrame, max_bits: int) -> DataFrame:
    """``own`` (one row a distinct ``fp``, with ``least``) plus ``c``, the smallest fingerprint of its component."""
    linked = components(links(pivot_table(own.select("fp")), max_bits))
    return own.join(linked, own["fp"] == linked["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("c"))


def one_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
             key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of ``docs``, all columns: the smallest id's, null ids last.

    Groups are told apart by their fingerprints, so null ids and ids of several texts lose no group.  Rows of one id
    go by the hash of the text, then by that of the other columns; of rows alike in all of these one stays.
    """
    rest = [c for c in docs.columns if c not in (key, text)]
    by = {"__id": F.col(key).cast("long"), "__h": F.xxhash64(F.col(text).cast("string")),
          "__r": F.xxhash64(F.to_json(F.struct(*rest))) if rest else F.lit(0).cast("long")}
    rows = docs.select(*[c.alias(n) for n, c in by.items()], F.col(text).cast("string").alias("t"))
    fps = cut(append(rows, "t", "fp long", lambda: lambda ts: [[_signed(fingerprint(t, shingle)) for t in ts]],
                     drop=("t",)))
    own = cut(fps.groupBy("fp").agg(F.min(F.struct(F.isnull("__id").alias("no_id"), *by)).alias("least")))
    heads = _named(own, max_bits).groupBy("c").agg(F.min("least").alias("x")).select(*[f"x.{n}" for n in by])
    same = [F.col(f"d.{n}").eqNullSafe(F.col(f"head.{n}")) for n in by]
    kept = docs.withColumns(by).alias("d").join(heads.alias("head"), same, "left_semi")
    if fps.groupBy(*by).count().where("count > 1").limit(1).count():  # rows alike in all of these
        kept = kept.dropDuplicates([*by])
    return kept.select(*docs.columns)


def op2_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents (3-word shingles, at most 2 differing bits)."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
