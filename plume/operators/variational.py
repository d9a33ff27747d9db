"""Batch variational Bayes for LDA: one Spark job a round, until the variational bound stops growing.

A round broadcasts the topic matrix (``k`` x vocabulary, bounded by the vocabulary's ``max_features``), every task
infers the mixtures of its documents and adds up expected word counts per topic, Spark sums these by (topic, term),
and the driver updates the matrix.  The bound on the log-likelihood of the corpus, per token, comes out of the same
job: it tells when the fit has converged, and ``TopicModel.bounds`` keeps it for every round.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.session import stored

BLOCK_TERMS = 200_000  # (document, term) entries inferred at once
TOTALS = -1            # "topic" of the row that carries a task's bound and number of tokens
SHIFT = 8              # arguments are moved above this before the asymptotic series


@dataclass
class TopicModel:
    """Fitted topics: ``topics`` is the Dirichlet parameter of each topic over the terms (``k`` x vocabulary)."""

    topics: np.ndarray
    alpha: float
    eta: float
    bounds: list[float] = field(default_factory=list)
    converged: bool = False
    fitted: tuple[DataFrame, DataFrame] | None = None  # the documents of the fit, and the different ones among them


def digamma(x: np.ndarray) -> np.ndarray:
    """d/dx ln gamma(x) for positive ``x``: upward recurrence, then the asymptotic series."""
    x = np.asarray(x, np.float64)
    down = sum(1.0 / (x + i) for i in range(SHIFT))
    y = x + SHIFT
    r = 1.0 / (y * y)
    return np.log(y) - 0.5 / y - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r / 132)))) - down


def gammaln(x: np.ndarray) -> np.ndarray:
    """ln gamma(x) for positive ``x``, by the same two steps."""
    x = np.asarray(x, np.float64)
    down = sum(np.log(x + i) for i in range(SHIFT))
    y = x + SHIFT
    r = 1.0 / (y * y)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - down


def expected_logs(dirichlet: np.ndarray) -> np.ndarray:
    """E[ln p] under each row's Dirichlet."""
    return digamma(dirichlet) - digamma(dirichlet.sum(axis=1, keepdims=True))


def infer(weights: np.ndarray, alpha: float, starts: np.ndarray, terms: np.ndarray, counts: np.ndarray,
          tolerance: float, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Dirichlet parameters of the documents' mixtures, and the likelihood of every (document, term) entry.

    ``weights`` is exp(E[ln topic]), a row a term.  Documents are runs of entries from ``starts``, none empty; each
    goes on until its parameters change by less than ``tolerance`` of their sum.
    """
    sizes = np.diff(np.append(starts, len(terms)))
    gamma, going = np.ones((len(starts), weights.shape[1])), np.ones(len(starts), bool)
    # Documents of like size are filled up to the largest with entries that count 0: one product for all of them.
    order, like, first = np.argsort(sizes, kind="stable"), [], 0
    while first < len(order):
        most = sizes[order[first]] * 5 // 4 + 4
        docs = order[first:np.searchsorted(sizes[order], most, side="right")]
        place = np.arange(sizes[docs[-1]])
        inside = place < sizes[docs, None]
        at = np.where(inside, starts[docs, None] + place, 0)
        like.append((docs, np.ascontiguousarray(weights[terms[at]].transpose(0, 2, 1)), np.where(inside, counts[at], 0.0)))
        first += len(docs)
    for _ in range(rounds):
        theta, new = np.exp(expected_logs(gamma)), gamma.copy()
        for docs, beta, n in like:
            own = theta[docs]
            share = n / np.matmul(own[:, None], beta)[:, 0]
            new[docs] = alpha + own * np.matmul(beta, share[:, :, None])[:, :, 0]
        new[~going] = gamma[~going]
        going &= np.abs(new - gamma).sum(axis=1) >= tolerance * new.sum(axis=1)
        gamma = new
        if not going.any():
            break
        left = [(part, going[part[0]]) for part in like]
        like = [part if some.mean() > 0.7 else tuple(x[some] for x in part) for part, some in left if some.any()]
    theta = np.exp(expected_logs(gamma))
    return gamma, np.einsum("ij,ij->i", np.repeat(theta, sizes, axis=0), weights[terms])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({f"h{i}": F.xxhash64(F.lit(i), "terms", "counts") for i in range(2)})


def _once(docs: DataFrame) -> DataFrame:
    """Different documents ``(n, terms, counts, h0, h1)``, ``n`` times each; 128 bits of hash name one."""
    return _keyed(docs).groupBy("h0", "h1").agg(
        F.count(F.lit(1)).alias("n"), F.first("terms").alias("terms"), F.first("counts").alias("counts")).select(
        "n", "terms", "counts", "h0", "h1")


def _blocks(batches):
    """Documents of Arrow batches ``(_, terms, counts, ...)`` by ``BLOCK_TERMS`` entries: batch slice, sizes, terms, counts."""
    for batch in batches:
        sizes = np.asarray(pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False), np.int64)
        ends, first = np.cumsum(sizes), 0
        while first < len(sizes):
            before = ends[first] - sizes[first]
            last = max(first + 1, int(np.searchsorted(ends, before + BLOCK_TERMS, side="right")))
            part = batch.slice(first, last - first)
            yield (part, sizes[first:last], part.column(1).flatten().to_numpy().astype(np.int64),
                   part.column(2).flatten().to_numpy())
            first = last


def _round(docs: DataFrame, model: TopicModel, tolerance: float, rounds: int) -> tuple[np.ndarray, float, float]:
    """Expected counts (``k`` x vocabulary), the documents' part of the bound, and the tokens."""
    k, v = model.topics.shape
    spark, alpha = docs.sparkSession, model.alpha
    sent = spark.sparkContext.broadcast(np.ascontiguousarray(np.exp(expected_logs(model.topics)).T))

    def run(batches):
        weights, stats, bound, tokens = sent.value, np.zeros((v, k)), 0.0, 0.0
        for part, sizes, terms, counts in _blocks(batches):
            n, sizes = part.column(0).to_numpy()[sizes > 0].astype(np.float64), sizes[sizes > 0]
            if not len(sizes):
                continue
            times = np.repeat(n, sizes)
            starts = np.cumsum(sizes) - sizes
            gamma, likelihood = infer(weights, alpha, starts, terms, counts, tolerance, rounds)
            logs = expected_logs(gamma)
            theta = np.repeat(np.exp(logs), sizes, axis=0)
            expected = theta * weights[terms] * (times * counts / likelihood)[:, None]
            for t in range(k):
                stats[:, t] += np.bincount(terms, expected[:, t], v)
            each = (((alpha - gamma) * logs + gammaln(gamma)).sum(axis=1) - gammaln(gamma.sum(axis=1))
                    + gammaln(k * alpha) - k * gammaln(alpha))
            bound += float((times * counts * np.log(likelihood)).sum() + (n * each).sum())
            tokens += float((times * counts).sum())
        term, topic = np.nonzero(stats)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(topic, [TOTALS, TOTALS]).astype(np.int32)),
             pa.array(np.append(term, [0, 1]).astype(np.int32)),
             pa.array(np.append(stats[term, topic], [bound, tokens]))], ["topic", "term", "value"])
    sums = (docs.mapInArrow(run, "topic int, term int, value double")
            .groupBy("topic", "term").agg(F.sum("value").alias("value")).toArrow())  # at most k x vocabulary rows + 2
    sent.unpersist()
    topic, term, value = (c.to_numpy() for c in sums.columns)
    stats, totals, own = np.zeros((k, v)), np.zeros(2), topic != TOTALS
    stats[topic[own], term[own]] = value[own]
    totals[term[~own]] = value[~own]
    return stats, float(totals[0]), float(totals[1])


def _topic_bound(model: TopicModel) -> float:
    lam, eta, v = model.topics, model.eta, model.topics.shape[1]
    return float(((eta - lam) * expected_logs(lam) + gammaln(lam) - gammaln(eta)).sum()
                 + (gammaln(v * eta) - gammaln(lam.sum(axis=1))).sum())


def fit(docs: DataFrame, vocabulary: int, k: int, seed: int, max_rounds: int, gain: float,
        tolerance: float = 1e-3, inner: int = 100) -> TopicModel:
    """Topics of ``docs`` ``(id, terms, counts)`` (term numbers and counts of each document).

    Equal documents are inferred once a round and count as often as they occur.

    Ends when a round raises the bound per token by less than ``gain``; ``converged`` is false if ``max_rounds`` came
    first.  Documents without terms take no part; without any token the prior is the model.
    """
    once = stored(_once(docs), "topic-documents")
    start = np.random.default_rng(seed).gamma(100.0, 0.01, (k, vocabulary))
    model = TopicModel(start, 1.0 / k, 1.0 / k, fitted=(docs, once))
    for _ in range(max_rounds):
        stats, bound, tokens = _round(once, model, tolerance, inner) if vocabulary else (start, 0.0, 0.0)
        if not tokens:
            model.topics, model.converged = np.full((k, vocabulary), model.eta), True
            return model
        model.bounds.append((bound + _topic_bound(model)) / tokens)
        if len(model.bounds) > 1 and model.bounds[-1] - model.bounds[-2] < gain:
            model.converged = True
            return model
        model.topics = model.eta + stats
    return model


def mixtures(docs: DataFrame, model: TopicModel, tolerance: float = 1e-6, inner: int = 1000) -> DataFrame:
    """``(id, mixture)`` of ``docs`` ``(id, terms, counts)``: expected topic shares; uniform without known terms.

    Equal documents are inferred once; those of the fit are not gathered again.
    """
    k = model.topics.shape[0]
    topics, alpha = model.topics, model.alpha
    sent = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(np.exp(expected_logs(topics)).T)
                                                    if topics.size else np.ones((1, k)))

    def run(batches):
        for part, sizes, terms, counts in _blocks(batches):
            gamma, some = np.ones((len(sizes), k)), sizes > 0
            if some.any():
                own = sizes[some]
                gamma[some] = infer(sent.value, alpha, np.cumsum(own) - own, terms, counts, tolerance, inner)[0]
            flat = (gamma / gamma.sum(axis=1, keepdims=True)).ravel()
            yield pa.RecordBatch.from_arrays(
                [part.column(3), part.column(4), pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, k, dtype=np.int32), flat)],
                ["h0", "h1", "mixture"])
    once = model.fitted[1] if model.fitted and model.fitted[0] is docs else _once(docs)
    found = once.mapInArrow(run, "h0 long, h1 long, mixture array<double>")
    return _keyed(docs).select("id", "h0", "h1").join(found, ["h0", "h1"]).select("id", "mixture")


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module
