"""Text side: normalised text, tokens, stop words, n-grams, term statistics and vocabularies.

Term statistics are counted by batches of documents (term occurrences and
distinct-per-document occurrences in the same pass) and summed by term, so a
very common term is one row a batch.  Vocabularies are capped by their
``max_features`` parameter, which is also the proven bound on what is
collected to the driver to build the feature vectors.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, NGram, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plume.functions.columns import clean_text
from plume.functions.stopwords import ENGLISH
from plume.session import stored, work_dir


def stop_words() -> tuple[str, ...]:
    """English stop words of every token query."""
    return ENGLISH


def tokens(text: Column) -> Column:
    """Words of two or more characters of an already-normalised text (a-z and single spaces)."""
    return F.filter(F.split(text, " "), lambda t: F.length(t) >= 2)


def tokenized(df: DataFrame, text_col: str, out: str = "tokens", remove_stop_words: bool = True,
              bigrams: bool = False) -> DataFrame:
    """Add ``text_clean`` and ``out`` (tokens, stop words removed, optionally followed by their bigrams).

    Bigrams are formed over the tokens left after stop-word removal.
    """
    d = df.withColumn("text_clean", clean_text(F.col(text_col)))
    words = tokens(F.col("text_clean"))
    if remove_stop_words:
        words = F.filter(words, lambda t: ~t.isin(*stop_words()))
    d = d.withColumn("__tok", words)
    if bigrams:
        # NGram reads the finished token column once per row; a lambda over it would let the optimizer
        # inline the whole token expression into every array access.
        d = NGram(n=2, inputCol="__tok", outputCol="__bi").transform(d)
        d = d.withColumn(out, F.concat(F.col("__tok"), F.col("__bi"))).drop("__bi")
    else:
        d = d.withColumn(out, F.col("__tok"))
    return d.drop("__tok")


COUNTED = "stats array<struct<term: string, tf: bigint, df: bigint>>"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The term statistics of every batch of token lists, one row a batch."""
    for batch in batches:
        lists = batch.column(0)
        flat = lists.flatten().dictionary_encode()  # tokens of null lists are left out
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        term = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        m = len(flat.dictionary)
        once = np.unique(np.repeat(np.arange(len(sizes)), sizes) * m + term) % m if m else term
        stats = pa.StructArray.from_arrays(
            [flat.dictionary, pa.array(np.bincount(term, minlength=m)), pa.array(np.bincount(once, minlength=m))],
            ["term", "tf", "df"])
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, m], pa.int32()), stats)], ["stats"])


ROW_WORDS = 200_000     # words of a row of counted documents
BATCH_ROWS = 64         # of these rows


def _counted_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents ``(key, tokens)``, see ``counted_documents``."""
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, first = np.cumsum(sizes), 0
        while first < len(sizes):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] - sizes[first] + ROW_WORDS, side="right")))
            part, n = batch.slice(first, last - first), last - first
            flat = part.column(1).flatten().dictionary_encode()  # tokens of null lists are left out
            m = len(flat.dictionary)
            word = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            entry, counts = np.unique(np.repeat(np.arange(n), sizes[first:last]) * max(m, 1) + word, return_counts=True)
            doc, place = np.divmod(entry, max(m, 1))
            stats = pa.StructArray.from_arrays(
                [flat.dictionary, pa.array(np.bincount(word, minlength=m)), pa.array(np.bincount(place, minlength=m))],
                ["term", "tf", "df"])
            packed = [x.astype(np.int32).tobytes() for x in (np.bincount(doc, minlength=n), place, counts)]
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            yield pa.RecordBatch.from_arrays(
                [one(part.column(0)), *[pa.array([x], pa.binary()) for x in packed], one(stats)],
                ["keys", "sizes", "places", "counts", "stats"])
            first = last


def counted_documents(docs: DataFrame, key: str = "id", tokens_col: str = "tokens") -> DataFrame:
    """Documents of about ``ROW_WORDS`` words a row, written once: their ``keys``, how many different words each has
    (``sizes``), these as ``places`` in the row's words with their ``counts`` (32-bit numbers), and the row's words with
    their numbers of occurrences and documents (``stats``).  ``term_stats`` and ``count_vectors`` read them."""
    schema = f"keys array<{docs.schema[key].dataType.simpleString()}>, sizes binary, places binary, counts binary, {COUNTED}"
    return stored(docs.select(key, tokens_col).mapInArrow(_counted_documents, schema), "counted-documents")


def term_stats(docs: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """``(term, term_freq, doc_freq)`` over all documents: one tokenisation, counted by batches of documents, then
    one aggregate keyed by term."""
    counted = docs if "stats" in docs.columns else docs.select(tokens_col).mapInArrow(_counted, COUNTED)
    counted = counted.select(F.explode("stats").alias("x"))
    return counted.groupBy(F.col("x.term").alias("term")).agg(F.sum("x.tf").alias("term_freq"),
                                                              F.sum("x.df").alias("doc_freq"))


def select_vocabulary(stats: DataFrame, n_docs, max_features: int, min_df: int | None = None,
                      max_df: float | None = None) -> DataFrame:
    """Terms kept by document-frequency bounds, then the ``max_features`` most frequent (term ascending on ties).

    ``min_df`` is an absolute document count, ``max_df`` a share of ``n_docs``
    (a number or a scalar column).  Adds ``term_index`` (0-based, in vocabulary order).
    """
    s = stats
    if min_df is not None:
        s = s.filter(F.col("doc_freq") >= F.lit(min_df))
    if max_df is not None:
        n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
        s = s.filter(F.col("doc_freq") <= F.lit(max_df) * n)
    top = s.orderBy(F.col("term_freq").desc(), F.col("term").asc()).limit(max_features)
    from pyspark.sql import Window
    w = Window.orderBy(F.col("term_freq").desc(), F.col("term").asc())  # over at most max_features rows
    return top.withColumn("term_index", (F.row_number().over(w) - 1).cast("int"))


def smooth_idf(doc_freq: Column, n_docs) -> Column:
    """``ln((1 + n) / (1 + df)) + 1``: the smoothed inverse document frequency."""
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    return F.log((F.lit(1.0) + n) / (F.lit(1.0) + doc_freq)) + F.lit(1.0)


def collect_vocabulary(vocab: DataFrame, with_idf: bool = False):
    """Vocabulary (bounded by its ``max_features``) as a list, in ``term_index`` order; optional idf list."""
    cols = ["term_index", "term"] + (["idf"] if with_idf else [])
    rows = sorted(vocab.select(*cols).collect(), key=lambda r: r[0])
    terms = [r[1] for r in rows]
    return (terms, [float(r[2]) for r in rows]) if with_idf else terms


TOKENS_PER_PARTITION = 2_000_000


def balanced(docs: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """``docs`` without their tokens, written once for the passes of an iterative fit and dealt into partitions by the
    number of tokens: one for each core at least, and one for every ``TOKENS_PER_PARTITION`` tokens beyond."""
    spark = docs.sparkSession
    work_dir(spark)
    docs = docs.withColumn(tokens_col, F.size(tokens_col)).checkpoint(eager=True)
    tokens_ = docs.agg(F.sum(tokens_col)).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-tokens_ // TOKENS_PER_PARTITION))
    return docs.drop(tokens_col).repartition(parts).checkpoint(eager=True)


def count_vectors(counted: DataFrame, terms: list[str], key: str = "id") -> DataFrame:
    """``(key, terms, counts)`` of counted documents, written once: numbers of the known terms, ascending, and counts."""
    def vectors(batches):
        known = pa.array(terms, pa.string())
        for batch in batches:
            words = batch.column(4)
            for i in range(len(batch)):
                keys = batch.column(0).slice(i, 1).flatten()
                sizes, places, counts = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int32) for c in (1, 2, 3))
                number = pc.fill_null(pc.index_in(words.slice(i, 1).flatten(), value_set=known), -1).to_numpy()
                term, doc = number[places], np.repeat(np.arange(len(sizes)), sizes)
                order = np.lexsort((term, doc))
                order = order[term[order] >= 0]
                ends = np.r_[0, np.cumsum(np.bincount(doc[order], minlength=len(sizes)))].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.ListArray.from_arrays(ends, pa.array(term[order], pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(counts[order], pa.float64()))], [key, "terms", "counts"])
    rows = counted.select("keys", "sizes", "places", "counts", F.col("stats.term").alias("words"))
    of_key = counted.schema["keys"].dataType.elementType.simpleString()
    conf, name = counted.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, str(BATCH_ROWS))  # the rows are large
    try:
        return stored(rows.mapInArrow(vectors, f"{key} {of_key}, terms array<int>, counts array<double>"), "count-vectors")
    finally:
        conf.set(name, before)


def tfidf_stages(terms: list[str], idf: list[float], tokens_col: str = "tokens", out: str = "features"):
    """Pipeline stages: counts over ``terms`` -> scaled by ``idf`` -> L2-normalised."""
    cv = CountVectorizerModel.from_vocabulary(terms, inputCol=tokens_col, outputCol="__tf")
    scale = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="__tf", outputCol="__tfidf")
    norm = Normalizer(p=2.0, inputCol="__tfidf", outputCol=out)
    return [cv, scale, norm]


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module
