"""LDA topic model over English posts: vocabulary, fit, per-post mixture, topic words, topic share.

The model is batch variational Bayes (``variational``): one distributed pass over the corpus a round until the
variational bound stops growing; nothing but the bounded vocabulary (``max_features`` terms) and its topic matrix
passes through the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.functions.columns import argmax_index, percent
from plume.operators import variational
from plume.operators.text import (
    collect_vocabulary, count_vectors, counted_documents, select_vocabulary, term_stats, tokenized,
)
from plume.schemas import (
    BOW_MAX_DF, BOW_MAX_FEATURES, BOW_MIN_DF, LDA_GAIN, LDA_MAX_ITER, LDA_SEED, LDA_TOPICS, LDA_WORDS, TOPIC_LABELS,
    UNKNOWN_TOPIC,
)


def topic_corpus(posts: DataFrame, lang: str | None = "en") -> DataFrame:
    """Posts with text in the given language, tokenised (documents that end up empty are kept)."""
    d = posts.filter(F.col("content").isNotNull())
    if lang is not None:
        d = d.filter(F.col("lang") == F.lit(lang))
    return tokenized(d.select("id", "content"), "content")


def bow_vocabulary(corpus: DataFrame) -> DataFrame:
    """Of documents with tokens, or of counted ones: terms with ``min_df <= doc_freq <= max_df * n_docs``, top ``max_features`` by frequency."""
    one = F.size("keys") if "keys" in corpus.columns else F.lit(1)
    n_docs = corpus.select(F.coalesce(F.sum(one), F.lit(0))).scalar()
    return select_vocabulary(term_stats(corpus), n_docs, BOW_MAX_FEATURES, BOW_MIN_DF, BOW_MAX_DF)


def fit_lda(corpus: DataFrame, k: int = LDA_TOPICS, max_iter: int = LDA_MAX_ITER, seed: int = LDA_SEED,
            gain: float = LDA_GAIN):
    """Fit LDA; returns ``(model, terms, vectors)``: ``vectors`` holds ``(id, terms, counts)`` of every document.

    Rounds end when the bound per token grows by less than ``gain``; a fit that needs more than ``max_iter`` rounds
    raises.  Documents without known terms keep their row, with empty arrays.
    """
    # The words are counted once: the vocabulary pass and the vector pass read the counts, every round the vectors.
    counted = counted_documents(corpus)
    terms = collect_vocabulary(bow_vocabulary(counted))
    vecs = count_vectors(counted, terms)
    model = variational.fit(vecs, len(terms), k, seed, max_iter, gain)
    if not model.converged:
        raise RuntimeError(f"LDA has not converged in {max_iter} rounds; bound per token {model.bounds[-2:]}")
    return model, terms, vecs


def topic_assignments(model: variational.TopicModel, vecs: DataFrame) -> DataFrame:
    """``(id, dominant_topic, topic_distribution)``; a document without known terms gets the uniform mixture."""
    t = variational.mixtures(vecs, model)
    return t.select("id", argmax_index(F.col("mixture")).alias("dominant_topic"),
                    F.col("mixture").alias("topic_distribution"))


def topic_words(spark, model: variational.TopicModel, terms: list[str], n: int = LDA_WORDS) -> DataFrame:
    """``(topic, rank, word, weight)``: the ``n`` heaviest words of every topic, ties by vocabulary order."""
    share = model.topics / model.topics.sum(axis=1, keepdims=True)
    rows = [(t, r, terms[i], float(share[t, i])) for t in range(len(share))  # k x n rows
            for r, i in enumerate(np.argsort(-share[t], kind="stable")[:n].tolist(), 1)]
    return spark.createDataFrame(rows, "topic int, rank int, word string, weight double")


def topic_labels(spark) -> DataFrame:
    return spark.createDataFrame(list(TOPIC_LABELS.items()), "topic int, label string")


def topic_share(assignments: DataFrame, labels: DataFrame) -> DataFrame:
    """Posts per dominant topic with its label (fallback label for unknown ids) and percent of all posts, the most frequent first.

    The per-topic counts are a handful of rows; the total comes from a window
    over them, not from a second pass over the posts.
    """
    from pyspark.sql import Window
    counts = assignments.groupBy(F.col("dominant_topic").alias("topic")).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))  # over the per-topic rows only
    j = counts.join(F.broadcast(labels), "topic", "left")
    return j.select("topic", F.coalesce(F.col("label"), F.lit(UNKNOWN_TOPIC)).alias("label"), "count",
                    percent(F.col("count"), total).alias("percent")).orderBy(F.desc("count"), "topic")
