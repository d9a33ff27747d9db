"""SpotSigs document fingerprints: chains of content words that follow common-word anchors.

A spot is an anchor (a common word of ``ANCHORS``) with the next ``CHAIN`` content words after it (words that are
no anchors; fewer at the end of the text, at least one).  A text's fingerprint is the set of its spots, each
hashed to 48 bits, sorted and written as 12 hex digits apiece.  Where more than ``GAP`` content words follow
without an anchor (tables, lists, other languages), each further one is an anchor itself.  A text without any spot
takes a chain from each of its words, so that only word-less texts have the empty fingerprint.  Words are runs of letters
and digits, lower-cased, so layout, case and punctuation leave a fingerprint alone.

The likeness of two fingerprints is the Jaccard of their sets (1 for two empty ones).  ``near_duplicates``
compares sets partitioned by their length: a set meets only its own length class and the next, through the
prefix of its rarest spots, and a pair is verified when its lengths allow the threshold.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import append, cut, map_arrow, partitions, table
from .components import components

CHAIN = 2
GAP = 8
SIMILARITY = 0.8

# Common words of English, French, German and Spanish.
ANCHORS = frozenset("""
a an and are as at be but by for from had has have he her his i if in is it its not of on or our she that the their
there they this to was we were which will with you
au aux avec ce cette dans de des du elle en est et il ils la le les leur mais ne nous ou par pas plus pour qu que qui
sa se ses son sont sur un une vous
aber als am auch auf aus bei bin das dass dem den der des die ein eine einem einen einer er es für hat ich im ist mit
nach nicht noch nur oder sich sie sind so über um und von vor war was wenn wie wir zu zum zur
al como con cuando del el ella ellos entre era eso esta este fue ha hay la las lo los más me mi muy no o para pero
por qué se si sin sobre su sus también todo un una y ya
""".split())

_WORD = re.compile(r"[^\W_]+")


def spots(text: str | None, chain: int = CHAIN) -> list[str]:
    """Sorted distinct spots of a whole text, 12 hex digits each."""
    words = _WORD.findall((text or "").lower())
    content, found, gap = [], [], 0
    for w in words:
        if w in ANCHORS:
            found.append((w, len(content)))
            gap = 0
        else:
            content.append(w)
            gap += 1
            if gap > GAP:
                found.append((w, len(content)))
    h = xxhash.xxh64_hexdigest
    sigs = ({" ".join((w, *content[k:k + chain])) for w, k in found if k < len(content)}
            or {" ".join(words[k:k + chain + 1]) for k in range(len(words))})
    return sorted({h(s.encode("utf-8", "surrogatepass"))[:12] for s in sigs})


def likeness(a: list[str], b: list[str]) -> float:
    if not a and not b:
        return 1.0
    both = len(set(a) & set(b))
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", chain: int = CHAIN) -> DataFrame:
    """``(doc_id, spots)`` for every row; null and word-less texts have no spots."""
    return append(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("t")),
                  "t", "spots array<string>", lambda: lambda ts: [[spots(t, chain) for t in ts]], drop=("t",))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``(doc_id, class_id, n_links)``: groups of rows whose fingerprints are linked at ``similarity`` or more.

    ``class_id`` is the smallest id of the connected group, ``n_links`` the number of other distinct fingerprints
    that a row's own is linked to.  Equal fingerprints are one class member, copies are never paired; word-less
    texts share the empty fingerprint; repeated rows repeat; null ids keep their row; an empty table gives no rows.
    """
    sets = cut(fingerprints(docs, key, text).withColumn("sid", F.xxhash64("spots")))
    own = sets.groupBy("sid").agg(F.min("doc_id").alias("least"), F.first("spots").alias("spots"))
    own = cut(own.withColumn("n", F.size("spots")))
    freq = own.select(F.explode("spots").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    # A pair at the similarity shares one of the n - ceil(similarity * n) + 1 rarest spots of each.
    ranked = (own.select("sid", "n", F.explode("spots").alias("s")).join(freq, "s")
              .groupBy("sid", "n").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("r")))
    length = F.floor(F.log("n") / -math.log(similarity)).cast("int")
    prefix = ranked.select("sid", "n", length.alias("part"), F.explode(F.slice(
        F.transform("r", lambda x: x["s"]), F.lit(1), F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - 1e-9)
        .cast("int") + 1)).alias("s"))
    x = prefix.select(F.col("sid").alias("a"), F.col("n").alias("na"), "part", "s")
    y = prefix.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("part").alias("pb"), F.col("s").alias("sb"))
    y = y.withColumn("part", F.explode(F.array(F.col("pb"), F.col("pb") - 1)))  # the class below meets this one
    pairs = x.join(y, (x["part"] == y["part"]) & (x["s"] == y["sb"]) & (x["a"] != y["b"])
                   & ((F.col("nb") > F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("a") < F.col("b"))))
                   & (F.col("na") >= similarity * F.col("nb") - 1e-9)).select("a", "b").distinct()
    left = own.select(F.col("sid").alias("a"), F.col("spots").alias("sa"))
    right = own.select(F.col("sid").alias("b"), F.col("spots").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    links = cut(pairs.join(left, "a").join(right, "b")
                .where(both >= similarity * (F.size("sa") + F.size("sb") - both) - 1e-9).select("a", "b"))
    degree = (links.select(F.explode(F.array("a", "b")).alias("sid")).groupBy("sid")
              .agg(F.count(F.lit(1)).alias("n_links")))
    comp = components(links)
    named = own.join(comp, own["sid"] == comp["node"], "left").select(
        "sid", "least", F.coalesce("component", "sid").alias("c"))
    low = named.groupBy("c").agg(F.min("least").alias("class_id"))
    ids = named.join(low, "c").join(degree, "sid", "left").select(
        "sid", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return sets.join(ids, "sid").select("doc_id", "class_id", "n_links")


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(__id, doc_id, text, next)`` handed to ``compare``: blocks of ascending ids that end with the next block's first.

    Ids are cut at quantiles that are ids themselves, so the first row of a block is known by its id alone and
    is dealt to the block before as well (the very first one to the last block).  One shuffle of the texts.
    """
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("__id"),
                       F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    n = 2 * partitions(docs.sparkSession)
    cuts = rows.agg(F.percentile_approx("__id", [i / n for i in range(n)], 20 * n).alias("q"),
                    F.min("__id").alias("m")).first()
    bounds = np.unique(np.array([cuts["m"], *cuts["q"]] if cuts["q"] else [0], np.int64))

    def deal(batches):
        for b in batches:
            ids = b.column("__id").to_numpy(zero_copy_only=False)
            at = np.clip(np.searchsorted(bounds, ids, "right") - 1, 0, None)
            first = bounds[at] == ids
            take = pa.array(np.concatenate((np.arange(len(ids)), np.flatnonzero(first))))
            block = np.concatenate((at, (at[first] - 1) % len(bounds)))
            tail = np.concatenate((np.zeros(len(ids), bool), np.ones(int(first.sum()), bool)))
            yield pa.RecordBatch.from_arrays([*b.take(take).columns, pa.array(block, pa.int32()), pa.array(tail)],
                                             [*b.schema.names, "block", "tail"])
    dealt = map_arrow(rows, deal, "__id long, doc_id long, text string, block int, tail boolean")
    return dealt.repartition(partitions(docs.sparkSession), "block").sortWithinPartitions(
        "block", "tail", "__id", "text")


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double, n_spots long")


def compare(docs: DataFrame, key: str = "doc_id", text: str = "text", chain: int = CHAIN) -> DataFrame:
    """Per row: its fingerprint, its edited text's, and the likeness to that and to the next row's fingerprint.

    The edited text keeps all but the last half of the code points and goes on with as many of the next row's
    (all, if it has fewer).  Next is by ascending id, then text; null ids come first; after the last comes the
    first, so a single row is its own next.  Null texts count as empty; an empty table gives no rows.
    """
    def row(r, nxt):
        text_, after = r[1] or "", nxt or ""
        half = len(text_) // 2
        edited = text_[:len(text_) - half] + after[:half]
        own, other, foll = spots(text_, chain), spots(edited, chain), spots(after, chain)
        return (r[0], len(text_), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                "".join(own), "".join(other), likeness(own, other), likeness(own, foll), len(own))

    def run(batches):
        held, block = None, None
        for b in batches:
            out = []
            for doc_id, t, blk, tail in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "block", "tail"))):
                if blk == block and held is not None:
                    out.append(row(held, t))
                block, held = blk, None if tail else (doc_id, t)
            names = [f.split()[0] for f in OUT.split(", ")]
            kinds = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[f.split()[1]]
                     for f in OUT.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)
    return map_arrow(with_next(docs, key, text), run, OUT)


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts, and likeness to the edited and the next."""
    return compare(table(spark, sf_dir, "documents"))
