"""URL filter: allow and block rules, and for the rest a ratio of two character language models.

The models are smoothed variable-order Markov models (orders 0 to ``ORDER``, each blended with the next shorter
context by its number of different successors) of host and path, one of URLs that a rule allows, one of those that
a rule blocks.  A URL's score is the difference of its log-likelihoods per character.  The threshold is calibrated
on a fifth of the rule-judged URLs, which the models have not seen: the middle of the scores that separate allowed
from blocked ones best (balanced accuracy).

Counts cover all rule-judged URLs and are exact: a table with one row for each gram, which grows with the URLs and
never leaves the executors.  What a byte adds to a score depends on the ``ORDER`` bytes before it only, so every
different window of ``ORDER + 1`` bytes is scored once, by joins with that table, and a URL's score is the sum over
its windows, in whole millionths so that reruns agree.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, cut, map_arrow, small, table, written

ORDER = 5
ALPHABET = 256  # bytes of the URL
UNIT = 1e-6
BIN = 0.01

# The rules of the query, verdict and host/path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """``pages`` (with ``host`` and ``path``) plus ``rule`` and ``judged``: the longest fitting rule and its verdict."""
    best = F.lit(None).cast("string")
    judged = F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith("/" + rest)
        best, judged = F.when(fits, rule).otherwise(best), F.when(fits, verdict).otherwise(judged)
    return pages.withColumns({"rule": best, "judged": judged})


def _windows(texts: DataFrame) -> DataFrame:
    """``(uid, judged, apart, n, w, times)``: the different windows of every text, its end included.

    A window ends at each byte of a text and holds up to ``ORDER`` bytes before it.
    """
    def run(batches):
        for b in batches:
            at, ws, times = [], [], []
            for i, text in enumerate(b.column(4).to_pylist()):
                t = text.encode("utf-8", "surrogatepass") + b"\n"
                for w, k in Counter(t[max(0, j - ORDER):j + 1] for j in range(len(t))).items():
                    at.append(i)
                    ws.append(w)
                    times.append(k)
                    if len(at) >= 100_000:
                        yield batch(b, at, ws, times)
                        at, ws, times = [], [], []
            yield batch(b, at, ws, times)

    def batch(b, at, ws, times):
        rows = pa.array(at, pa.int64())
        return pa.RecordBatch.from_arrays(
            [*[b.column(c).take(rows) for c in range(4)], pa.array(ws, pa.binary()), pa.array(times, pa.int64())],
            ["uid", "judged", "apart", "n", "w", "times"])
    return map_arrow(texts.select("uid", "judged", "apart", "n", "text"), run,
                     "uid binary, judged string, apart boolean, n long, w binary, times long")


def _cut_out(k: int) -> tuple[Column, Column]:
    """The last ``k`` bytes before a window's last byte, and the same with it."""
    at = F.length("w") - F.lit(k)
    return F.substr("w", at, F.lit(k)), F.substr("w", at, F.lit(k + 1))


def train(windows: DataFrame) -> DataFrame:
    """``(gram, step_*, total_*, kinds_*)`` for ``allow`` and ``block``: the exact counts of both models.

    ``step`` is how often the gram's last byte followed the rest, ``total`` how often the gram was a context and
    ``kinds`` the number of its different successors.  ``windows`` holds ``(judged, w, seen)``.
    """
    each = windows.groupBy("judged", "w").agg(F.sum("seen").alias("n"))
    steps = each.select("judged", "n", F.explode(F.filter(F.array(*[
        F.when(F.length("w") > k, F.struct(*(c.alias(a) for c, a in zip(_cut_out(k), ("ctx", "gram")))))
        for k in range(ORDER + 1)]), F.isnotnull)).alias("x"))
    by = {v: F.sum(F.when(F.col("judged") == v, F.col("n")).otherwise(0)) for v in ("allow", "block")}
    grams = steps.groupBy("x").agg(*[by[v].alias(v) for v in by])
    sides = F.array(
        F.struct(F.col("x.gram").alias("gram"), *[F.col(v).alias(f"step_{v}") for v in by],
                 *[F.lit(0).cast("long").alias(f"{c}_{v}") for v in by for c in ("total", "kinds")]),
        F.struct(F.col("x.ctx").alias("gram"), *[F.lit(0).cast("long").alias(f"step_{v}") for v in by],
                 *[c for v in by for c in (F.col(v).alias(f"total_{v}"),
                                           (F.col(v) > 0).cast("long").alias(f"kinds_{v}"))]))
    rows = grams.select(F.inline(sides))
    return rows.groupBy("gram").agg(*[F.sum(c).alias(c) for c in rows.columns[1:]])


def weigh(windows: DataFrame, model: DataFrame) -> DataFrame:
    """``(w, weight)`` of different windows ``(w)``: log-likelihood of the last byte if allowed minus if blocked."""
    keys = windows.select("w", F.explode(F.flatten(F.array(*[
        F.when(F.length("w") > k, F.array(*[
            F.struct(F.lit(k).alias("k"), F.lit(i).alias("i"), g.alias("gram")) for i, g in enumerate(_cut_out(k))]))
        .otherwise(F.array().cast("array<struct<k:int,i:int,gram:binary>>"))
        for k in range(ORDER + 1)]))).alias("x")).select("w", "x.*")
    # Short grams are the crowded keys; there are at most 1 + 256 + 256 ** 2 of them, a proven bound.
    short, long = F.length("gram") <= 2, F.length("gram") > 2
    found = (keys.where(short).join(F.broadcast(model.where(short)), "gram", "left")
             .unionByName(keys.where(long).join(model.where(long), "gram", "left")))
    counts = [F.max(F.when((F.col("k") == k) & (F.col("i") == int(c == "step")), F.col(f"{c}_{v}"))).alias(f"{c}_{v}_{k}")
              for k in range(ORDER + 1) for v in ("allow", "block") for c in ("step", "total", "kinds")]
    wide = found.groupBy("w").agg(*counts)

    def logp(v: str) -> Column:
        p = F.lit(1.0 / ALPHABET)
        for k in range(ORDER + 1):  # a context never met leaves p as it is: (0 + 1 * p) / (0 + 1)
            step, total, kinds = (F.coalesce(f"{c}_{v}_{k}", F.lit(0)) for c in ("step", "total", "kinds"))
            kinds = F.greatest(kinds, F.lit(1))
            p = (step + kinds * p) / (total + kinds)
        return F.log(p)
    return wide.select("w", F.round((logp("allow") - logp("block")) / UNIT).cast("long").alias("weight"))


def score(texts: DataFrame) -> DataFrame:
    """Different texts ``(uid, text, judged, apart, n)`` plus ``score``: per character, 0 for an empty text.

    Texts with a verdict that are not set apart teach the models, ``n`` times each.
    """
    windows = written(_windows(texts.where("text != ''")), "url-windows")
    model = cut(train(windows.where("judged IS NOT NULL AND NOT apart")
                      .select("judged", "w", (F.col("n") * F.col("times")).alias("seen"))))
    weights = cut(weigh(windows.select("w").distinct(), model))
    sums = (windows.select("uid", "w", "times").join(small(weights, weights.count()), "w")
            .groupBy("uid").agg(F.sum(F.col("times") * F.col("weight")).alias("sum")))
    value = F.when(F.length("text") > 0, F.col("sum") * UNIT / F.length("text")).otherwise(0.0)
    return texts.join(sums, "uid", "left").withColumn("score", value).drop("sum")


def calibrate(scored: DataFrame) -> float:
    """Threshold between ``judged`` allow and block rows from a histogram of their scores; 0 without either.

    Each order takes at most a factor of twice the count of all bytes from a probability, so a score lies within
    6 + 6 * 44 for any 64-bit count: the driver gets at most some 54,000 bins a verdict.
    """
    bins = {}
    for judged, at, n in (scored.groupBy("judged", F.floor(F.col("score") / BIN).alias("at"))
                          .agg(F.sum("n").alias("n")).collect()):
        bins.setdefault(at, {"allow": 0, "block": 0})[judged] += n
    allow, block = (sum(b[k] for b in bins.values()) for k in ("allow", "block"))
    if not allow or not block:
        return 0.0
    ats, below, best, span = sorted(bins), 0, -1.0, (0, 0)
    right = allow
    for i, at in enumerate([*ats, ats[-1] + 1]):  # everything under bin ``at`` is blocked
        value = right / allow + below / block
        low = ats[i - 1] + 1 if i else at
        if value > best + 1e-12:
            best, span = value, (low, at)
        if at in bins:
            right, below = right - bins[at]["allow"], below + bins[at]["block"]
    return (span[0] + span[1]) / 2 * BIN


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules: tuple = RULES) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, score.

    A fitting rule decides; otherwise a score of at least the threshold allows.  Null URLs and such without ``://``
    have an empty host and path and score 0; without rule-judged URLs of both kinds the threshold is 0; repeated
    rows repeat (and count as often); an empty table gives no rows; other columns are ignored.
    """
    rows = ruled(pages.select(F.col(key).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path")),
                 rules).withColumn("text", F.concat("host", "path"))
    rows = rows.withColumn("uid", F.unhex(F.md5("text")))  # 128 bits name a text
    texts = cut(rows.groupBy("uid", "text", "judged").agg(F.count(F.lit(1)).alias("n"))
                .withColumn("apart", F.pmod(F.xxhash64("text"), F.lit(5)) == 0))
    scored = cut(score(texts).select("uid", "judged", "apart", "n", "score"))
    line = calibrate(scored.where("judged IS NOT NULL AND apart"))
    verdict = F.coalesce("judged", F.when(F.col("score") >= line, "allow").otherwise("block"))
    return (rows.join(scored.select("uid", "score"), "uid")
            .select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score"))


def op4_url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return judge(table(spark, sf_dir, "pages"))
