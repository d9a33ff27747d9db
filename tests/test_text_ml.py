import hashlib
import math
import random
from collections import Counter

from pyspark.sql import functions as F

from table_rows import rows
from plume.functions.columns import clean_text
from plume.operators import sentiment as S
from plume.operators import text as T
from plume.operators import topics as TP


def test_clean_text_cases(spark):
    cases = [("Hello WORLD", "hello world"), ("see http://x.io/a?b=1 and www.site.org/p now", "see and now"),
             ("@alice_1 hi #Tag_2 there", "hi there"), ("d1g1ts 2024!", "d g ts"), ("café", "caf"),
             ("a b", "a b"), ("!!! ???", ""), (None, "")]
    df = spark.createDataFrame([(c,) for c, _ in cases], "t string")
    assert [r[0] for r in df.select(clean_text(F.col("t"))).collect()] == [e for _, e in cases]


def test_term_stats_brute_force(spark):
    texts = ["the cat sat on the mat", "cat cat dog", "", "a dog and a cat"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    tok = T.tokenized(df, "t")
    stops = set(T.stop_words())
    tf, dfc = Counter(), Counter()
    for t in texts:
        ws = [w for w in t.split(" ") if len(w) >= 2 and w not in stops]
        tf.update(ws)
        dfc.update(set(ws))
    got = {r["term"]: (r["term_freq"], r["doc_freq"]) for r in T.term_stats(tok).collect()}
    assert got == {w: (tf[w], dfc[w]) for w in tf}
    bi = T.tokenized(df, "t", bigrams=True).filter("id = 1").first()["tokens"]
    assert bi == ["cat", "cat", "dog", "cat cat", "cat dog"]


def test_stratified_split_exact(spark):
    data = [(i, i % 3 if i % 10 else 1) for i in range(1, 401)]
    df = spark.createDataFrame(data, "id long, label int")
    got = dict(rows(S.stratified_split(df, buckets_hex=1), "id", "split"))
    exp = {}
    for lab in {l for _, l in data}:
        ids = sorted((hashlib.md5(f"42-{i}".encode()).hexdigest(), i) for i, l in data if l == lab)
        k = int(0.2 * len(ids) + 0.5)
        exp.update({i: ("test" if n < k else "train") for n, (_, i) in enumerate(ids)})
    assert got == exp


def test_lexicon_thresholds(spark):
    lex = spark.createDataFrame([("good", 0.05), ("bad", -0.05), ("meh", 0.0), ("great", 0.5)], "word string, score double")
    docs = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "meh"), (4, "unknown words"), (5, "great bad bad")],
                                 "id long, text_clean string")
    got = {r["id"]: r["pred_label"] for r in S.lexicon_sentiment(docs, lex).collect()}
    assert got == {1: "Positive", 2: "Negative", 3: "Neutral", 4: "Neutral", 5: "Positive"}


def test_metrics_brute_force(spark):
    pairs = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 1), (2, 1), (1, 0)]  # class 2 never predicted
    df = spark.createDataFrame(pairs, "label int, pred int")
    assert abs(S.accuracy(df).first()["accuracy"] - 3 / 7) < 1e-12
    rep = {r["class"]: r for r in S.report(df).collect()}
    assert rep["Positive"]["precision"] == 0.0 and rep["Positive"]["support"] == 2
    assert abs(rep["Neutral"]["precision"] - 0.4) < 1e-9 and abs(rep["Neutral"]["recall"] - 2 / 3) < 1e-9
    conf = {(r["true_class"], r["pred_class"]): r["share"] for r in S.confusion(df).collect()}
    assert len(conf) == 9 and conf[("Positive", "Neutral")] == 1.0 and conf[("Positive", "Positive")] == 0.0


def test_lda_two_groups_and_empty_doc(spark):
    a = "apple banana cherry grape lemon mango"
    b = "engine piston turbo gearbox clutch brake"
    docs = [(i, a) for i in range(20)] + [(100 + i, b) for i in range(20)] + [(999, "12345")]
    corpus = TP.topic_corpus(spark.createDataFrame([(i, t, "en") for i, t in docs], "id long, content string, lang string"))
    import plume.operators.topics as mod
    old = (mod.BOW_MIN_DF,)
    mod.BOW_MIN_DF = 1
    try:
        model, terms, vecs = TP.fit_lda(corpus, k=2)
    finally:
        mod.BOW_MIN_DF = old[0]
    asg = {r["id"]: r for r in TP.topic_assignments(model, vecs).collect()}
    assert asg[999]["topic_distribution"] == [0.5, 0.5]
    assert all(abs(sum(r["topic_distribution"]) - 1) < 1e-6 for r in asg.values())
    assert asg[0]["dominant_topic"] != asg[100]["dominant_topic"]
    words = TP.topic_words(spark, model, terms, 3)
    assert words.count() == 6
    share = TP.topic_share(TP.topic_assignments(model, vecs), TP.topic_labels(spark))
    assert abs(sum(r["percent"] for r in share.collect()) - 100.0) < 0.2


def _mixture(topics, alpha, counts):
    """Mixture of one document by the textbook update, with derivatives of ``lgamma`` taken numerically."""
    def psi(x, h=1e-4):
        while x < 40:  # far from zero the difference quotient is exact enough
            return psi(x + 1, h) - 1 / x
        return (math.lgamma(x + h) - math.lgamma(x - h)) / (2 * h)
    k = len(topics)
    beta = [{w: math.exp(psi(t[w]) - psi(sum(t))) for w in counts} for t in topics]
    gamma = [1.0] * k
    for _ in range(400):
        theta = [math.exp(psi(g) - psi(sum(gamma))) for g in gamma]
        norm = {w: sum(theta[j] * beta[j][w] for j in range(k)) for w in counts}
        gamma = [alpha + theta[j] * sum(n * beta[j][w] / norm[w] for w, n in counts.items()) for j in range(k)]
    return [g / sum(gamma) for g in gamma]


def test_lda_converges_and_mixtures_match_plain_inference(spark):
    rng = random.Random(5)
    words = [[f"w{'abcdefghij'[t]}{'abcdefghijkl'[i]}" for i in range(12)] for t in range(3)]
    docs = []
    for i in range(120):
        docs.append((i, [rng.choice(words[rng.choice([i % 3] * 8 + [0, 1, 2])]) for _ in range(rng.randrange(3, 60))]))
    docs += [(500, []), (501, ["unknown"]), (502, words[0] * 300), (502, words[0] * 300)]
    corpus = spark.createDataFrame(docs, "id long, tokens array<string>").repartition(5)
    model, terms, vecs = TP.fit_lda(corpus, k=3)
    grown = [b - a for a, b in zip(model.bounds, model.bounds[1:])]
    assert model.converged and len(grown) > 3 and min(grown) > -1e-3 and grown[-1] < 1e-4
    got = TP.topic_assignments(model, vecs).collect()
    at = {r.id: r.topic_distribution for r in got}
    assert len(got) == len(docs) and at[500] == at[501] == [1 / 3] * 3
    topics = model.topics.tolist()
    for i, tokens in [*docs[:40], docs[-1]]:
        counts = {terms.index(w): tokens.count(w) for w in set(tokens) if w in terms}
        want = _mixture(topics, model.alpha, counts)
        assert max(abs(a - b) for a, b in zip(at[i], want)) < 1e-3
    heavy = {}
    for r in TP.topic_words(spark, model, terms, 12).collect():
        heavy.setdefault(r.topic, set()).add(r.word)
    assert {frozenset(h) for h in heavy.values()} == {frozenset(w) & set(terms) for w in words}
    # No documents, and documents without a term of the vocabulary.
    for none in (corpus.limit(0), corpus.where("id >= 500 AND id < 502")):
        model, terms, vecs = TP.fit_lda(none, k=3)
        assert terms == [] and TP.topic_assignments(model, vecs).count() == none.count()
        assert TP.topic_words(spark, model, terms).count() == 0


def test_gamma_functions():
    from plume.operators.variational import digamma, gammaln
    for x in (1e-3, 0.125, 0.9, 1.0, 3.3, 50.0, 1e5):
        assert abs(gammaln(x) - math.lgamma(x)) < 1e-9 * max(1, abs(math.lgamma(x)))
        assert abs(digamma(x + 1) - digamma(x) - 1 / x) < 1e-9 * max(1, 1 / x)
    assert abs(digamma(1.0) + 0.5772156649015329) < 1e-11


def test_classifier_learns_and_round_trips(spark, tmp_dir):
    words = {0: "terrible", 1: "average", 2: "wonderful"}
    data = [(i, "x", ["Negative", "Neutral", "Positive"][i % 3], f"{words[i % 3]} day number {i}") for i in range(60)]
    data += [(1000, "x", "Irrelevant", "whatever"), (1001, "x", None, "nothing")]
    labelled = spark.createDataFrame(data, "id long, topic string, sentiment string, text string")
    prep = S.label_prep(labelled)
    assert prep.count() == 60
    sp = S.stratified_split(prep)
    model = S.train_classifier(sp.filter("split = 'train'"))
    pred = S.predict(model, sp.filter("split = 'test'"))
    assert S.accuracy(pred).first()["accuracy"] > 0.9
    from pyspark.ml import PipelineModel
    model.write().overwrite().save(tmp_dir + "/m")
    again = S.predict(PipelineModel.load(tmp_dir + "/m"), sp.filter("split = 'test'"))
    assert rows(again, "id", "pred") == rows(pred, "id", "pred")


def test_saved_model_scores_raw_text_alone(spark, tmp_dir):
    words = {0: "terrible", 1: "average", 2: "wonderful"}
    data = [(i, "x", ["Negative", "Neutral", "Positive"][i % 3], f"{words[i % 3]} day number {i}") for i in range(60)]
    model = S.train_classifier(S.label_prep(spark.createDataFrame(data, "id long, topic string, sentiment string, text string")))
    raw = [(1, "A Wonderful, WONDERFUL day! http://x.y/terrible @terrible #terrible"), (2, "terrible   days"), (3, None),
           (4, ""), (5, "an average\n\naverage"), (6, "Üñ wonderful\u00a0day www.terrible.org")]
    df = spark.createDataFrame(raw, "id long, text string")
    from plume.functions.columns import clean_text
    want = S.predict(model, df.withColumn("text_clean", clean_text("text")))
    from pyspark.ml import PipelineModel
    S.portable_model(model).write().overwrite().save(tmp_dir + "/whole")
    got = PipelineModel.load(tmp_dir + "/whole").transform(df)  # nothing of this library is needed here
    assert rows(got, "id", "text_clean") == rows(df.withColumn("text_clean", clean_text("text")), "id", "text_clean")
    assert [(r.id, r.sentiment_label) for r in got.orderBy("id").collect()] == [
        (r.id, r.pred_label) for r in want.orderBy("id").collect()]
    assert {r.id: r.sentiment_label for r in got.collect()}[6] == "Positive"


def test_valence_rules_match_a_plain_loop(spark):
    import math
    import random
    lexicon = {"good": 1.9, "bad": -2.5, "fine": 0.8, "awful": -2.0}
    rnd = random.Random(4)
    pool = [*lexicon, "not", "never", "very", "slightly", "plain", "word", "a"]
    texts = [" ".join(rnd.choice(pool) for _ in range(rnd.randint(0, 12))) for _ in range(200)]
    texts += ["not good", "good", "not very good", "very not good", "not a plain word good", "a not good", "", "good " * 500, None]
    modifiers = {**S.NEGATIONS, **S.INTENSIFIERS}

    def score(text):
        toks, x = [t for t in (text or "").split() if len(t) >= 2], 0
        for i, t in enumerate(toks):
            if t in lexicon:
                x += round(lexicon[t] * 10000) * math.prod(modifiers.get(w, 100) for w in toks[max(0, i - 3):i]) * 100 ** (3 - len(toks[max(0, i - 3):i]))
        x /= 1e10
        return x / math.sqrt(x * x + 15)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text_clean string")
    lex = spark.createDataFrame(list(lexicon.items()), "word string, score double")
    got = {r.id: r for r in S.valence_sentiment(df, lex).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert abs(got[i].score - score(t)) < 1e-12, t
        assert got[i].pred == (0 if got[i].score <= -0.05 else 2 if got[i].score >= 0.05 else 1)
    at = {t: got[i].score for i, t in enumerate(texts)}
    assert at["not good"] < 0 < at["good"] < at["good " * 500] < 1 and at["not very good"] == at["very not good"] < at["not good"]
    assert at["not a plain word good"] < 0  # one-letter words are no words
    bare = {r.id: r.score for r in S.valence_sentiment(df, lex, {}).collect()}
    assert bare[texts.index("not good")] == at["good"]
    assert S.valence_sentiment(df.limit(0), lex).count() == 0


def test_stop_words_are_the_library_default(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert list(T.stop_words()) == StopWordsRemover.loadDefaultStopWords("english")


def test_term_stats_tokenise_once(spark):
    df = spark.createDataFrame([(1, "a cat and a dog")], "id long, t string")
    plan = T.term_stats(T.tokenized(df, "t"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") == 1 and "Union" not in plan


def test_term_stats_count_by_batches(spark):
    docs = [(["a", "b", "a"],), ([],), (None,), (["b"],), (["a"],)] * 9
    df = spark.createDataFrame(docs, "tokens array<string>").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        stats = T.term_stats(df)
        assert rows(stats, "term", "term_freq", "doc_freq") == [("a", 27, 18), ("b", 18, 18)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "MapInArrow" in stats._jdf.queryExecution().executedPlan().toString()  # no row for every word


def test_words_stay_beside_a_bounded_lexicon(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "good good bad"), (2, "meh"), (3, ""), (3, "good"), (None, "bad")],
                                 "id long, text_clean string")
    lex = spark.createDataFrame([("good", 0.5), ("bad", -0.25)], "word string, score double")
    for score in (S.lexicon_sentiment, lambda d, x: S.valence_sentiment(d, x, {})):
        found = {}
        for most, join in ((1_000_000, "BroadcastHashJoin"), (1, "SortMergeJoin")):
            monkeypatch.setattr(S, "BROADCAST_WORDS", most)
            out = score(docs, lex)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert join in plan
            found[most] = {r["id"]: (round(r["score"], 9), r["pred_label"]) for r in out.collect()}
        assert found[1] == found[1_000_000] and set(found[1]) == {1, 2, 3, None}
        assert found[1][2] == (0.0, "Neutral") and found[1][None][1] == "Negative"


def test_topic_fit_keeps_words_and_vectors_as_columns(spark):
    docs = spark.createDataFrame([(i, ["apple", "pear"] * (1 + i % 3)) for i in range(30)], "id long, tokens array<string>")
    _, terms, vecs = TP.fit_lda(docs, k=2)
    plan = vecs._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in plan.lower() and "ExistingRDD" not in plan  # a checkpoint's rows are many times larger
    assert len(terms) == 0 or vecs.count() == 30


def test_mixtures_of_the_fitted_documents_gather_them_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, ["a", "b"] if i % 2 else ["c", "d", "c"]) for i in range(40)],
                                 "id int, tokens array<string>")
    model, _, vecs = TP.fit_lda(docs, k=2)
    want = {r["id"]: r["topic_distribution"] for r in TP.topic_assignments(model, vecs.select("*")).collect()}

    def again(_):
        raise AssertionError("documents gathered again")
    monkeypatch.setattr(TP.variational, "_once", again)
    got = {r["id"]: r["topic_distribution"] for r in TP.topic_assignments(model, vecs).collect()}
    assert len(got) == 40 and got == want


def test_balanced_writes_no_tokens(spark):
    from plume.operators.text import balanced
    docs = spark.createDataFrame([(i, ["word"] * i) for i in range(30)], "label int, tokens array<string>")
    kept = balanced(docs)
    assert kept.columns == ["label"] and rows(kept) == [(i,) for i in range(30)]


def test_counted_documents_give_statistics_and_vectors(spark, monkeypatch):
    """Words are counted once, in rows of bounded size; statistics and vectors come from the counts."""
    monkeypatch.setattr(T, "ROW_WORDS", 5)
    monkeypatch.setattr(T, "BATCH_ROWS", 2)
    docs = [(1, ["b", "a", "b"]), (2, []), (3, None), (None, ["c", "x", "a"]), (1, ["b", "a", "b"]), (4, ["a"] * 9), (5, ["x"])]
    counted = T.counted_documents(spark.createDataFrame(docs, "id int, tokens array<string>").coalesce(1))
    assert counted.count() > 3
    assert rows(T.term_stats(counted), "term", "term_freq", "doc_freq") == [
        ("a", 12, 4), ("b", 4, 2), ("c", 1, 1), ("x", 2, 2)]
    terms = ["c", "a", "b"]
    vecs = T.count_vectors(counted, terms)
    assert vecs.dtypes == [("id", "int"), ("terms", "array<int>"), ("counts", "array<double>")]
    got = sorted((str(r.id), r.terms, r.counts) for r in vecs.collect())
    want = [(str(i), sorted(terms.index(w) for w in set(t or []) & set(terms))) for i, t in docs]
    assert got == sorted((i, n, [float((dict(docs)[int(i) if i != "None" else None]).count(terms[x])) for x in n]) for i, n in want)
    assert all(r.terms == [] for r in T.count_vectors(counted, []).collect())


def test_inference_of_documents_of_all_sizes():
    """Documents filled up to like sizes give what each gives alone, whatever stands beside them."""
    import numpy as np
    from plume.operators.variational import BLOCK_TERMS, expected_logs, infer
    assert BLOCK_TERMS >= 200_000  # few passes over small arrays
    rng = np.random.default_rng(3)
    weights = np.exp(expected_logs(rng.gamma(1.0, 1.0, (4, 60)))).T.copy()
    sizes = np.r_[rng.integers(1, 60, 40), 1, 60, 2]
    starts = np.cumsum(sizes) - sizes
    terms = np.concatenate([rng.choice(60, n, replace=False) for n in sizes])
    counts = rng.integers(1, 9, len(terms)).astype(float)
    gamma, likelihood = infer(weights, 0.25, starts, terms, counts, 1e-3, 100)
    for s, n, got in zip(starts, sizes, gamma):
        beta, c, want = weights[terms[s:s + n]], counts[s:s + n], np.ones((1, 4))
        for _ in range(100):
            theta = np.exp(expected_logs(want))
            new = 0.25 + theta * ((c / (beta @ theta[0])) @ beta)
            done, want = np.abs(new - want).sum() < 1e-3 * new.sum(), new
            if done:
                break
        assert np.allclose(got, want[0], rtol=1e-9)
        assert np.allclose(likelihood[s:s + n], beta @ np.exp(expected_logs(want))[0], rtol=1e-9)


def test_texts_are_scored_in_batches_as_stage_by_stage(spark):
    rng = random.Random(11)
    pool = ["good", "bad", "the", "not", "x", "day", "sun", "rain", "http", "of", "meh", "fine"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(1, 12))) for _ in range(150)]
    data = [(i, t, 2 if "day" in t else int("good" in t or "sun" in t)) for i, t in enumerate(texts)]
    train = spark.createDataFrame(data, "id long, text_clean string, label int")
    model = S.train_classifier(train)
    odd = ["", None, "x", "the of", "unknown words", "good", "Sun, RAIN & day!! http://a.b @good #bad", "good good  bad"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + odd)] + [(-1, "bad day")], "id long, text_clean string")
    staged = model.transform(T.tokenized(df, "text_clean", bigrams=True)).select("id", F.col("prediction").cast("int"))
    got = S.predict(model, df)
    assert got.columns == ["id", "text_clean", "pred", "pred_label"] and len(set(rows(got, "pred"))) == 3
    assert rows(got, "id", "pred") == rows(staged)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "UDF(" not in plan.replace("classes", "")  # no vectors, text by text
    posts = spark.createDataFrame([(i, t, "en" if i % 9 else "fr") for i, t in enumerate(texts + odd)],
                                  "id long, content string, lang string")
    scored = S.score_posts(model, posts)
    want = {i: p for i, p in staged.collect()}
    kept = [i for i, t in enumerate(texts + odd) if i % 9 and t]
    assert rows(scored, "id", "sentiment_id") == sorted((i, want[i]) for i in kept)
    # Models of another make go stage by stage.
    other = model.copy()
    other.stages[-1].set(other.stages[-1].thresholds, [0.2, 0.5, 0.3])
    assert S._class_of(other) is None and S.predict(other, df).count() == df.count()
