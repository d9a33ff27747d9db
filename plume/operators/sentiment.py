"""Sentiment: label preparation, stratified split, TF-IDF + logistic regression, scoring, lexicon baseline, metrics."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, SQLTransformer, StopWordsRemover
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plume.functions.columns import clean_text, clean_text_sql, label_id, label_name, score_to_class
from plume.operators.text import (
    balanced, collect_vocabulary, select_vocabulary, smooth_idf, stop_words, term_stats, tfidf_stages, tokenized,
)
from plume.session import work_dir
from plume.schemas import LABEL_TO_ID, SENTIMENT_CLASSES, SPLIT_SEED, SPLIT_TEST_FRACTION, TFIDF_MAX_FEATURES


def label_prep(labelled: DataFrame) -> DataFrame:
    """Keep the three classes, add the class id and the normalised text; drop rows whose text becomes empty."""
    d = labelled.filter(F.col("sentiment").isin(*SENTIMENT_CLASSES))
    d = d.select("id", "topic", "sentiment", label_id("sentiment").alias("label"), "text",
                 clean_text(F.col("text")).alias("text_clean"))
    return d.filter(F.length("text_clean") > 0)


def label_audit(labelled: DataFrame, group_col: str | None = "topic") -> DataFrame:
    """Label frequencies (nulls dropped) overall (``group = '*'``) and per ``group_col``, the most frequent first.

    ``group_col="source_file"`` (see ``read_labelled_csv``) audits each input file by itself."""
    d = labelled.filter(F.col("sentiment").isNotNull())
    overall = d.groupBy(F.lit("*").alias("group"), "sentiment").agg(F.count(F.lit(1)).alias("count"))
    if group_col is None:
        return overall
    per = d.groupBy(F.col(group_col).cast("string").alias("group"), "sentiment").agg(F.count(F.lit(1)).alias("count"))
    return overall.unionByName(per).orderBy("group", F.desc("count"), "sentiment")


def stratified_split(df: DataFrame, label_col: str = "label", key_col: str = "id",
                     test_fraction: float = SPLIT_TEST_FRACTION, seed: int = SPLIT_SEED, buckets_hex: int = 3
                     ) -> DataFrame:
    """Add ``split`` (``train`` / ``test``): per class, the ``round(fraction * n_class)`` rows with the
    smallest ``md5('<seed>-<key>')`` are the test set.

    Exact without ranking a class (one may hold most rows): keys are bucketed by the hash prefix, and bucket
    sizes (classes x 16^k rows, a bounded table) tell for every bucket but one of a class on which side it lies.
    Only the keys of that one bucket, a 1/16^k slice, are ranked, to find the last test key; texts are never
    sorted or shuffled.  Only ids and hashes are written to the checkpoint folder in between.
    """
    work_dir(df.sparkSession)
    h = F.md5(F.concat(F.lit(f"{seed}-"), F.col(key_col).cast("string")))
    bucket = F.conv(F.substring(h, 1, buckets_hex), 16, 10).cast("int")
    keys = df.select(F.col(label_col).alias("__l"), F.col(key_col).alias("__k"), h.alias("__h"),
                     bucket.alias("__b")).checkpoint(eager=True)
    sizes = keys.groupBy("__l", "__b").agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.partitionBy("__l").orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    sizes = sizes.withColumn("__upto", F.sum("__n").over(upto)).withColumn(
        "__test", F.round(F.lit(test_fraction) * F.sum("__n").over(Window.partitionBy("__l"))))
    edge = (sizes.where((F.col("__upto") >= F.col("__test")) & (F.col("__upto") - F.col("__n") < F.col("__test")))
            .select("__l", "__b", (F.col("__test") - F.col("__upto") + F.col("__n")).alias("__left")))
    at = F.row_number().over(Window.partitionBy("__l").orderBy("__h", "__k"))
    last = (keys.join(F.broadcast(edge), ["__l", "__b"]).withColumn("__at", at).where(F.col("__at") == F.col("__left"))
            .select("__l", F.struct("__h", "__k").alias("__last")))
    mine = F.struct(h.alias("__h"), F.col(key_col).alias("__k"))
    return (df.join(F.broadcast(last), F.col(label_col) == F.col("__l"), "left")
            .withColumn("split", F.when(mine <= F.col("__last"), "test").otherwise("train")).drop("__l", "__last"))


# --- TF-IDF + logistic regression ------------------------------------------------------------------------------

def tfidf_vocabulary(train: DataFrame, text_col: str = "text_clean", max_features: int = TFIDF_MAX_FEATURES
                     ) -> DataFrame:
    """``(term, term_freq, doc_freq, idf, term_index)`` over unigrams + bigrams of the training texts."""
    docs = tokenized(train.select(text_col), text_col, bigrams=True)
    n_docs = train.select(F.count(F.lit(1))).scalar()
    vocab = select_vocabulary(term_stats(docs), n_docs, max_features)
    return vocab.withColumn("idf", smooth_idf(F.col("doc_freq"), n_docs))


def train_classifier(train: DataFrame, text_col: str = "text_clean", max_iter: int = 1000, tol: float = 1e-4
                     ) -> PipelineModel:
    """Fit tokens -> TF-IDF (smoothed idf, L2 norm) -> multinomial logistic regression (L2, C = 1).

    ``regParam = 1 / n`` is the same penalty as ``C = 1`` on a summed loss; ``tol`` is the usual
    library default of 1e-4 (Spark's own default, 1e-6, only adds rounds).
    """
    terms, idf = collect_vocabulary(tfidf_vocabulary(train, text_col), with_idf=True)
    stages = tfidf_stages(terms, idf)
    feats = tokenized(train, text_col, bigrams=True)
    for st in stages:
        feats = st.transform(feats)
    feats = balanced(feats.select("features", "label", "tokens"), "tokens")
    n = feats.count()
    lr = LogisticRegression(featuresCol="features", labelCol="label", family="multinomial", maxIter=max_iter,
                            regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False, tol=tol)
    return PipelineModel(stages=stages + [lr.fit(feats)])


def portable_model(model: PipelineModel, text_col: str = "text") -> PipelineModel:
    """A saved-and-loaded-anywhere form of a trained classifier: raw text in, class and class name out.

    Cleaning, tokens, stop words and bigrams become stages before the model's own, and the class names one after, so
    ``PipelineModel.load(path).transform(df)`` alone scores a frame with ``text_col``; it adds ``text_clean``,
    ``prediction`` and ``sentiment_label`` among the stages' columns.
    """
    words = SQLTransformer(statement=(
        f"SELECT *, filter(split(text_clean, ' '), t -> length(t) >= 2) AS raw_tokens FROM (SELECT *, {clean_text_sql(text_col)} "
        "AS text_clean FROM __THIS__)"))
    kept = StopWordsRemover(inputCol="raw_tokens", outputCol="unigrams", stopWords=list(stop_words()))
    pairs = NGram(n=2, inputCol="unigrams", outputCol="bigrams")
    both = SQLTransformer(statement="SELECT *, concat(unigrams, bigrams) AS tokens FROM __THIS__")
    names = " ".join(f"WHEN {v} THEN '{k}'" for k, v in LABEL_TO_ID.items())
    named = SQLTransformer(statement=f"SELECT *, CASE CAST(prediction AS INT) {names} END AS sentiment_label FROM __THIS__")
    return PipelineModel(stages=[words, kept, pairs, both, *model.stages, named])


def _scored(texts: pa.Array, words: pa.Array, first: np.ndarray, pairs: np.ndarray, of_pair: np.ndarray, idf: np.ndarray,
            coefficients: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
    """Class of every normalised text, see ``_class_of``."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
    flat = lists.flatten().dictionary_encode()
    token = flat.indices.to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    kept = pc.and_(pc.greater_equal(pc.utf8_length(flat.dictionary), 2),
                   pc.invert(pc.is_in(flat.dictionary, value_set=pa.array(stop_words(), pa.string()))))
    kept = kept.to_numpy(zero_copy_only=False)[token]
    token, doc = token[kept], doc[kept]
    word = pc.fill_null(pc.index_in(flat.dictionary, value_set=words), -1).to_numpy(zero_copy_only=False).astype(np.int64)[token]
    beside = (doc[1:] == doc[:-1]) & (word[1:] >= 0) & (word[:-1] >= 0)
    pair = (word[:-1] * len(words) + word[1:])[beside]
    at = np.minimum(np.searchsorted(pairs, pair), max(len(pairs) - 1, 0))
    hit = pairs[at] == pair if len(pairs) else np.zeros(len(pair), bool)
    single = np.where(word >= 0, first[word] if len(first) else -1, -1)
    entry = np.r_[(doc * len(idf) + single)[single >= 0], (doc[1:][beside] * len(idf))[hit] + of_pair[at[hit]]]
    entry, n = np.unique(entry, return_counts=True)
    doc, term = np.divmod(entry, max(len(idf), 1))
    value = n * idf[term]
    norm = np.sqrt(np.bincount(doc, value * value, len(texts)))
    value = value / norm[doc]
    margins = [np.bincount(doc, value * c[term], len(texts)) + b for c, b in zip(coefficients, intercepts)]
    return np.argmax(np.stack(margins, axis=1), axis=1).astype(np.int32)


def _class_of(model: PipelineModel):
    """A column function for the class of a normalised text by the stages of ``train_classifier``, or None for other models.

    Batches of texts are split and scored at once: a word is a number in the vocabulary's words, a bigram a pair of such
    numbers, and the counts, idf, norm and margins of all texts are sums over (text, term).  Stage by stage, every text's
    words and bigrams would be made and looked up as strings of their own."""
    cv, scale, norm, lr = model.stages if len(model.stages) == 4 else [None] * 4
    if not (isinstance(cv, CountVectorizerModel) and isinstance(scale, ElementwiseProduct) and isinstance(norm, Normalizer)
            and isinstance(lr, LogisticRegressionModel)) or lr.getFamily() != "multinomial" or lr.isSet("thresholds"):
        return None
    terms = [t.split(" ") for t in cv.vocabulary]
    words = sorted({w for t in terms for w in t})
    number = {w: i for i, w in enumerate(words)}
    first = np.full(len(words), -1)
    for i, t in enumerate(terms):
        if len(t) == 1:
            first[number[t[0]]] = i
    pairs = sorted((number[t[0]] * len(words) + number[t[1]], i) for i, t in enumerate(terms) if len(t) == 2)
    sent = SparkSession.active().sparkContext.broadcast((
        words, first, np.array([p for p, _ in pairs], np.int64), np.array([i for _, i in pairs], np.int64),
        scale.getScalingVec().toArray(), lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()))

    @F.arrow_udf("int")
    def classes(texts: pa.Array) -> pa.Array:
        words, *rest = sent.value
        return pa.array(_scored(texts, pa.array(words, pa.string()), *rest), pa.int32())
    return classes


def predict(model: PipelineModel, df: DataFrame, text_col: str = "text_clean", normalised: bool = False) -> DataFrame:
    """Add ``pred`` (class id) and ``pred_label`` (class name); ``normalised``: ``clean_text`` has been over the texts."""
    classes = _class_of(model)
    keep = [c for c in df.columns]
    if classes is None:
        out = model.transform(tokenized(df, text_col, bigrams=True)).select(*keep, F.col("prediction").cast("int").alias("pred"))
    else:
        out = df.select(*keep, classes(F.col(text_col) if normalised else clean_text(F.col(text_col))).alias("pred"))
    return out.withColumn("pred_label", label_name("pred"))


def score_posts(model: PipelineModel, posts: DataFrame, lang: str | None = "en") -> DataFrame:
    """``post_sentiment``: every post of the language with non-empty normalised text, scored in one pass."""
    d = posts.filter(F.col("content").isNotNull())
    if lang is not None:
        d = d.filter(F.col("lang") == F.lit(lang))
    # A filter on the normalised text would normalise it once more.
    some = F.explode(F.filter(F.array(clean_text(F.col("content"))), lambda t: F.length(t) > 0))
    p = predict(model, d.select("id", F.col("content").alias("text"), some.alias("text_clean")), normalised=True)
    return p.select("id", "text", F.col("pred_label").alias("sentiment_label"), F.col("pred").alias("sentiment_id"))


def sentiment_distribution(scored: DataFrame) -> DataFrame:
    return (scored.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("sentiment_label").asc()))


# --- lexicon baseline ------------------------------------------------------------------------------------------

def learn_lexicon(train: DataFrame, text_col: str = "text_clean", min_docs: int = 10) -> DataFrame:
    """``(word, score)``: mean of ``label - 1`` (so -1..1) over training documents holding the word, for
    words in at least ``min_docs`` documents, rounded half away from zero to 4 decimals in integer
    arithmetic (so every engine gets the same number)."""
    docs = tokenized(train.select("label", text_col), text_col)
    per_doc = docs.select("label", F.explode(F.array_distinct("tokens")).alias("word"))
    lex = per_doc.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("label") - 1).cast("long").alias("s"))
    e4 = F.signum("s").cast("long") * F.expr("(20000 * abs(s) + n) div (2 * n)")
    return lex.filter(F.col("n") >= min_docs).select("word", (e4 / F.lit(10000.0)).alias("score"))


BROADCAST_WORDS = 1_000_000


def _lexicon(lexicon: DataFrame) -> DataFrame:
    """``(word, e4)`` (score in ten-thousandths), written once; broadcast if it has at most ``BROADCAST_WORDS`` words.

    Beside a broadcast lexicon the occurrences of words stay where their texts are read; a shuffle by word would move
    every word of every text, and a frequent word's occurrences into one task.
    """
    work_dir(lexicon.sparkSession)
    lex = lexicon.select("word", F.round(F.col("score") * 10000).cast("long").alias("e4")).checkpoint(eager=True)
    return F.broadcast(lex) if lex.count() <= BROADCAST_WORDS else lex


def lexicon_sentiment(df: DataFrame, lexicon: DataFrame, text_col: str = "text_clean") -> DataFrame:
    """Mean lexicon score of a text's known word occurrences (0 without any), then three classes at +-0.05.

    Scores are summed as integers in ten-thousandths and the class test is an
    integer comparison, so the thresholds are exact.  A lexicon of bounded
    size is broadcast (``_lexicon``), a larger one joins by a shuffle.  A text
    without matches keeps one row of nulls, which counts 0 (no join back, and
    the texts are read once).
    """
    docs = tokenized(df.select("id", text_col), text_col)
    words = docs.select("id", F.explode_outer("tokens").alias("word"))
    hits = words.join(_lexicon(lexicon), "word", "left")
    agg = hits.groupBy("id").agg(F.coalesce(F.sum("e4"), F.lit(0).cast("long")).alias("e4"), F.count("e4").alias("n"))
    score = F.when(F.col("n") > 0, F.col("e4") / F.col("n") / F.lit(10000.0)).otherwise(F.lit(0.0))
    # score <= -0.05  <=>  20 * e4 <= -10000 * n  (and the same for >= 0.05); no words -> Neutral
    cls = (F.when((F.col("n") > 0) & (F.col("e4") * 20 <= -10000 * F.col("n")), "Negative")
           .when((F.col("n") > 0) & (F.col("e4") * 20 >= 10000 * F.col("n")), "Positive").otherwise("Neutral"))
    out = agg.select("id", score.alias("score"), cls.alias("pred_label"))
    return out.withColumn("pred", label_id("pred_label"))


#: Modifiers of English, in hundredths: what a lexicon word's score is multiplied by if one of these words stands within
#: ``SCOPE`` words before it.  A negation turns the sign and weakens; two of them nearly cancel out.
NEGATIONS = dict.fromkeys(("not", "no", "never", "nor", "neither", "nobody", "nothing", "without", "cannot", "hardly",
                           "don", "doesn", "didn", "isn", "wasn", "aren", "won", "wouldn", "can", "couldn"), -75)
INTENSIFIERS = {"very": 130, "really": 130, "extremely": 150, "so": 120, "most": 130, "more": 115, "too": 115,
                "quite": 90, "slightly": 70, "somewhat": 80, "barely": 60, "less": 70}
SCOPE, NORM = 3, 15.0


def valence_sentiment(df: DataFrame, lexicon: DataFrame, modifiers: dict[str, int] | None = None, scope: int = SCOPE,
                      norm: float = NORM, text_col: str = "text_clean") -> DataFrame:
    """Rule scores over ordered words: lexicon scores under negations and intensifiers, then three classes at +-0.05.

    Each known word counts its lexicon score times the ``modifiers`` (hundredths) among the ``scope`` words before it;
    a text's sum ``x`` is brought to -1..1 as ``x / sqrt(x * x + norm)``, so long texts do not run away.  Sums are whole
    numbers, so every engine gets the same.  Null and empty texts and texts without known words score 0 and are
    Neutral; ``lexicon`` is ``(word, score)``, its words as ``clean_text`` leaves them.
    """
    modifiers = {**NEGATIONS, **INTENSIFIERS} if modifiers is None else modifiers
    docs = tokenized(df.select("id", text_col), text_col, remove_stop_words=False)  # most modifiers are stop words
    factor = F.lit(100).cast("long")
    if modifiers:
        known = F.create_map(*[F.lit(x) for kv in modifiers.items() for x in kv])
        factors = F.transform("tokens", lambda t: F.coalesce(known[t].cast("long"), factor))
        docs = docs.withColumn("f", F.concat(F.array_repeat(factor, scope), factors))
    else:
        docs = docs.withColumn("f", F.array_repeat(factor, F.size("tokens") + scope))
    weight = F.slice("f", F.lit(1), F.size("tokens"))  # the words ``scope`` places before, then the nearer ones
    for k in range(1, scope):
        weight = F.zip_with(weight, F.slice("f", F.lit(k + 1), F.size("tokens")), lambda a, b: a * b)
    placed = docs.select("id", F.explode_outer(F.arrays_zip(F.col("tokens").alias("word"), weight.alias("m"))).alias("w"))
    hits = (placed.select("id", "w.word", "w.m").join(_lexicon(lexicon), "word", "left")
            .select("id", (F.col("e4") * F.col("m")).cast("decimal(38,0)").alias("x")))
    total = hits.groupBy("id").agg(F.coalesce(F.sum("x"), F.lit(0).cast("decimal(38,0)")).cast("double").alias("t"))
    x = F.col("t") / F.lit(10000.0 * 100.0 ** scope)
    score = x / F.sqrt(x * x + F.lit(float(norm)))
    out = total.select("id", score.alias("score")).withColumn("pred_label", score_to_class("score"))
    return out.withColumn("pred", label_id("pred_label"))


# --- metrics ---------------------------------------------------------------------------------------------------

def _classes(spark) -> DataFrame:
    return spark.createDataFrame([(v, k) for k, v in LABEL_TO_ID.items()], "cls int, class string")


def accuracy(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).alias("support"))


def confusion(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Full class x class grid: counts and shares of each true class (0 where a class has no rows).

    The grid (classes x classes, 9 rows) is written out from the class table, not derived from the data.
    """
    spark = df.sparkSession
    pairs = [(a, ka, b, kb) for ka, a in LABEL_TO_ID.items() for kb, b in LABEL_TO_ID.items()]
    grid = spark.createDataFrame(pairs, "label int, true_class string, pred int, pred_class string")
    counts = df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("count"))
    g = grid.join(counts, ["label", "pred"], "left").withColumn("count", F.coalesce(F.col("count"), F.lit(0)))
    tot = F.sum("count").over(Window.partitionBy("label"))  # 3 rows per partition
    share = F.when(tot > 0, F.col("count") / tot).otherwise(F.lit(0.0))
    return g.select("true_class", "pred_class", F.col("count").cast("long").alias("count"), share.alias("share"))


def report(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Per-class precision, recall, F1 and support, plus macro and weighted averages (0 on zero division)."""
    spark = df.sparkSession
    cls = _classes(spark)
    per = df.select(F.col(label).alias("l"), F.col(pred).alias("p"))
    stats = (per.select(F.col("l").alias("cls"), F.lit(1).alias("support"), (F.col("l") == F.col("p")).cast("int").alias("tp"),
                        F.lit(0).alias("predicted"))
             .unionByName(per.select(F.col("p").alias("cls"), F.lit(0).alias("support"), F.lit(0).alias("tp"),
                                     F.lit(1).alias("predicted")))
             .groupBy("cls").agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"),
                                 F.sum("predicted").alias("predicted")))
    s = cls.join(stats, "cls", "left").na.fill(0, ["support", "tp", "predicted"])
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    s = s.select("class", prec.alias("precision"), rec.alias("recall"), F.col("support").cast("long").alias("support"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    s = s.withColumn("f1", f1)
    total = F.sum("support").over(Window.partitionBy(F.lit(0)))  # 3 rows
    s = s.withColumn("__w", F.when(total > 0, F.col("support") / total).otherwise(F.lit(0.0)))
    macro = s.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                  F.avg("recall").alias("recall"), F.sum("support").cast("long").alias("support"), F.avg("f1").alias("f1"))
    weighted = s.agg(F.lit("weighted avg").alias("class"), F.sum(F.col("precision") * F.col("__w")).alias("precision"),
                     F.sum(F.col("recall") * F.col("__w")).alias("recall"), F.sum("support").cast("long").alias("support"),
                     F.sum(F.col("f1") * F.col("__w")).alias("f1"))
    out = s.drop("__w").unionByName(macro).unionByName(weighted)
    return out.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


def agreement(a: DataFrame, b: DataFrame, key: str = "id", pred: str = "pred") -> DataFrame:
    """Share of keys where two classifiers predict the same class."""
    j = a.select(key, F.col(pred).alias("__a")).join(b.select(key, F.col(pred).alias("__b")), key)
    return j.agg(F.avg((F.col("__a") == F.col("__b")).cast("double")).alias("agreement"),
                 F.count(F.lit(1)).alias("compared"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module
