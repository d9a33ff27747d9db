"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query starts from the driver tables (``posts_raw`` is derived from
``events`` and ``documents``), so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.operators import clean as C
from plume.operators import kpis as K
from plume.session import apply_defaults
from plume.sources.tables import posts_raw

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def _clean(spark, sf_dir, columns: list[str] | None = None, lang: str | None = None) -> DataFrame:
    texts = columns is None or "content" in columns  # only rows with texts are wide
    return C.clean_posts(posts_raw(spark, sf_dir, spread=texts), columns, reread=texts, lang=lang)


def _english(spark, sf_dir) -> DataFrame:
    """Texts of the English posts."""
    return _clean(spark, sf_dir, TEXT_COLUMNS, lang="en")


def _ingested(spark, sf_dir) -> DataFrame:
    return C.ingest_filter(posts_raw(spark, sf_dir, spread=True), reread=True)


KPI_COLUMNS = ["id", "date", "engagement"]
LANG_COLUMNS, TAG_COLUMNS, USER_COLUMNS = ([*KPI_COLUMNS, c] for c in ("lang", "hashtags_array", "username"))
TEXT_COLUMNS = ["id", "content", "lang"]


@register("clean_posts")
def q_clean_posts(spark, sf_dir):
    return _clean(spark, sf_dir, [c for c in C.POST_COLUMNS if c not in ("hashtags_array", "mentions_array")])


@register("kpi_daily")
def q_kpi_daily(spark, sf_dir):
    return K.kpi_daily(_clean(spark, sf_dir, KPI_COLUMNS))


@register("kpi_daily_lang")
def q_kpi_daily_lang(spark, sf_dir):
    return K.kpi_daily_lang(_clean(spark, sf_dir, LANG_COLUMNS))


@register("kpi_hashtags")
def q_kpi_hashtags(spark, sf_dir):
    return K.kpi_hashtags(_clean(spark, sf_dir, TAG_COLUMNS))


@register("kpi_users")
def q_kpi_users(spark, sf_dir):
    return K.kpi_users(_clean(spark, sf_dir, USER_COLUMNS))


# --- ingest, messages, stream ----------------------------------------------------------------------------------

from plume.operators import reports as R  # noqa: E402
from plume.sources import messages as M  # noqa: E402
from plume.schemas import LABEL_TO_ID, TOP_DASHBOARD_N, TOP_USER_TABLE_N  # noqa: E402


@register("ingest_filter")
def q_ingest_filter(spark, sf_dir):
    """CSV-export cleaning: kept columns, parsed date, English only, stripped text longer than 5, one row per id."""
    return _ingested(spark, sf_dir)


@register("ingest_funnel")
def q_ingest_funnel(spark, sf_dir):
    return C.ingest_funnel(posts_raw(spark, sf_dir))


@register("encode_messages")
def q_encode_messages(spark, sf_dir):
    return M.encode_messages(_ingested(spark, sf_dir))


@register("parse_messages")
def q_parse_messages(spark, sf_dir):
    return M.parse_messages(M.encode_messages(_ingested(spark, sf_dir)))


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Messages written as JSON-lines files, consumed by the streaming job (availableNow), read back from the sink."""
    from plume.session import scratch_path
    from plume.streaming.ingest import read_message_files, read_sink, start_ingest
    src, out, ckpt = (scratch_path(spark, n) for n in ("stream-src", "stream-out", "stream-ckpt"))
    (M.encode_messages(_ingested(spark, sf_dir)).select("value").write.option("compression", "gzip")
     .option("maxRecordsPerFile", 50_000).text(src))  # every file is read as one split
    q = start_ingest(read_message_files(spark, src), out, ckpt, available_now=True)
    q.awaitTermination()
    return read_sink(spark, out)


@register("topic_ingest")
def q_topic_ingest(spark, sf_dir):
    """Messages published to a partitioned topic, consumed from its earliest offsets in bounded batches, read back."""
    from plume.session import scratch_path
    from plume.streaming.ingest import read_sink, start_ingest
    from plume.streaming.topic import publish, read_topic
    topic, out, ckpt, progress = (scratch_path(spark, f"topic-{n}") for n in ("log", "out", "ckpt", "progress"))
    publish(M.encode_messages(_ingested(spark, sf_dir)), topic)
    source = read_topic(spark, topic, max_messages=50_000, progress=progress)
    q = start_ingest(source, out, ckpt, processing_time="0 seconds")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return read_sink(spark, out)


# --- exploded arrays -------------------------------------------------------------------------------------------

@register("hashtags_exploded")
def q_hashtags_exploded(spark, sf_dir):
    return C.hashtags_exploded(_clean(spark, sf_dir, TAG_COLUMNS))


@register("mentions_exploded")
def q_mentions_exploded(spark, sf_dir):
    return C.mentions_exploded(_clean(spark, sf_dir, GRAPH_COLUMNS))


# --- reports ---------------------------------------------------------------------------------------------------

@register("report_totals")
def q_report_totals(spark, sf_dir):
    return R.totals(K.kpi_daily(_clean(spark, sf_dir, KPI_COLUMNS)))


RANGE = ("2024-01-08", "2024-01-21")  # both days included


@register("report_totals_range")
def q_report_totals_range(spark, sf_dir):
    return R.totals(K.kpi_daily(_clean(spark, sf_dir, KPI_COLUMNS)), *RANGE)


@register("report_daily_series_range")
def q_report_daily_series_range(spark, sf_dir):
    return R.daily_series(K.kpi_daily(_clean(spark, sf_dir, KPI_COLUMNS)), *RANGE)


@register("report_peak_day_range")
def q_report_peak_day_range(spark, sf_dir):
    return R.peak_day(K.kpi_daily(_clean(spark, sf_dir, KPI_COLUMNS)), *RANGE)


def _export(df: DataFrame, path: str) -> None:
    """A CSV export as compressed files of bounded size: every one is a split of its own."""
    (df.write.option("header", True).option("escape", '"').option("compression", "gzip")
     .option("maxRecordsPerFile", 50_000).csv(path))


@register("csv_scan")
def q_csv_scan(spark, sf_dir):
    """The raw posts as a CSV export with line breaks in its texts, read in splits and filtered."""
    from plume.session import scratch_path
    from plume.sources.files import read_posts_csv
    path = scratch_path(spark, "raw-csv")
    _export(posts_raw(spark, sf_dir, spread=True), path)
    return C.ingest_filter(read_posts_csv(spark, path)).select(F.col("id").cast("long").alias("id"), "date", "content",
                                                              "lang", "url")


@register("csv_first_read")
def q_csv_first_read(spark, sf_dir):
    """Differing copies of posts in a CSV export: of each id the row read first stays.

    The export holds every post three times, in order of id and a hash of copy and id; copies differ in text and url.
    """
    from plume.session import scratch_path
    from plume.sources.files import read_posts_csv
    path = scratch_path(spark, "copies-csv")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Posts are dealt by id and sorted before they are copied: one shuffle, and no copy is moved.
    raw = posts_raw(spark, sf_dir, spread=True).repartitionByRange(n, "id").dropDuplicates(["id"])
    drawn = F.array_sort(F.array(*[F.struct(F.md5(F.concat_ws(":", F.lit(k), "id")).alias("draw"), F.lit(k).alias("copy"))
                                   for k in range(3)]))
    copies = raw.sortWithinPartitions("id").select(*raw.columns, F.explode(drawn["copy"]).alias("copy"))
    _export(copies.withColumn("content", F.concat(F.lit("copy "), F.col("copy").cast("string"), F.lit("\n"),
                                                  F.col("content"))).drop("copy"), path)
    first = C.ingest_filter(read_posts_csv(spark, path, position=True))
    return first.select(F.col("id").cast("long").alias("id"), "date", "content", "lang", "url")


@register("report_peak_day")
def q_report_peak_day(spark, sf_dir):
    return R.peak_day(K.kpi_daily(_clean(spark, sf_dir, KPI_COLUMNS)))


@register("report_date_range")
def q_report_date_range(spark, sf_dir):
    return R.date_range(K.kpi_daily(_clean(spark, sf_dir, KPI_COLUMNS)))


@register("report_daily_series")
def q_report_daily_series(spark, sf_dir):
    return R.daily_series(K.kpi_daily(_clean(spark, sf_dir, KPI_COLUMNS)))


@register("report_lang_pivot")
def q_report_lang_pivot(spark, sf_dir):
    return R.lang_pivot(K.kpi_daily_lang(_clean(spark, sf_dir, LANG_COLUMNS)))


@register("report_hashtag_stats")
def q_report_hashtag_stats(spark, sf_dir):
    return R.hashtag_stats(_clean(spark, sf_dir, TAG_COLUMNS))


@register("report_top_user")
def q_report_top_user(spark, sf_dir):
    return R.top_user(K.kpi_users(_clean(spark, sf_dir, USER_COLUMNS)))


@register("top_hashtags_by_count")
def q_top_hashtags_by_count(spark, sf_dir):
    return R.top_n(K.kpi_hashtags(_clean(spark, sf_dir, TAG_COLUMNS)), "tweets_count", "hashtag", TOP_DASHBOARD_N)


@register("top_hashtags_by_engagement")
def q_top_hashtags_by_engagement(spark, sf_dir):
    return R.top_n(K.kpi_hashtags(_clean(spark, sf_dir, TAG_COLUMNS)), "engagement_sum", "hashtag", TOP_DASHBOARD_N)


@register("top_users_by_engagement")
def q_top_users_by_engagement(spark, sf_dir):
    return R.top_n(K.kpi_users(_clean(spark, sf_dir, USER_COLUMNS)), "engagement_sum", "username", TOP_DASHBOARD_N)


@register("top_users_table")
def q_top_users_table(spark, sf_dir):
    return R.top_n(K.kpi_users(_clean(spark, sf_dir, USER_COLUMNS)), "engagement_sum", "username", TOP_USER_TABLE_N)


# --- graph -----------------------------------------------------------------------------------------------------

from plume.operators import coloring as CO  # noqa: E402
from plume.operators import communities as LP  # noqa: E402
from plume.operators import graph as G  # noqa: E402
from plume.operators.pagerank import converged_pagerank  # noqa: E402
from plume.schemas import TOP_NODES_N, TOP_USERS_N  # noqa: E402

PR_DIGITS = 10
GRAPH_COLUMNS = ["id", "date", "username", "inReplyToTweetId", "mentions_array", "engagement"]


def _graph(spark, sf_dir):
    from plume.session import work_dir
    work_dir(spark)
    posts = _clean(spark, sf_dir, GRAPH_COLUMNS).checkpoint(eager=True)  # read by every edge and node step
    return posts, G.user_edges(posts), G.user_nodes(posts, K.kpi_users(posts))


def _graph_base(spark, sf_dir):
    """Collapsed edges and vertex table, checkpointed once for the iterative jobs that follow."""
    from plume.session import work_dir
    work_dir(spark)
    posts = _clean(spark, sf_dir, GRAPH_COLUMNS).checkpoint(eager=True)  # feeds both edges and nodes, without any text
    edges, nodes = G.user_edges(posts), G.user_nodes(posts, K.kpi_users(posts))
    ec = G.collapse_edges(edges).checkpoint(eager=True)
    verts = G.vertices(nodes, ec).checkpoint(eager=True)
    return edges, ec, verts


def _centrality(spark, sf_dir):
    _, ec, verts = _graph_base(spark, sf_dir)
    comms = LP.communities(verts, G.undirected_edges(ec))
    cent = G.centrality(verts, ec, converged_pagerank(verts, ec), comms).withColumn("pagerank", F.round("pagerank", PR_DIGITS))
    return ec, cent


@register("edges_mention")
def q_edges_mention(spark, sf_dir):
    return G.mention_edges(_clean(spark, sf_dir, GRAPH_COLUMNS))


@register("edges_reply")
def q_edges_reply(spark, sf_dir):
    return G.reply_edges(_clean(spark, sf_dir, GRAPH_COLUMNS))


@register("user_edges")
def q_user_edges(spark, sf_dir):
    return _graph(spark, sf_dir)[1]


@register("user_nodes")
def q_user_nodes(spark, sf_dir):
    return _graph(spark, sf_dir)[2]


@register("edges_with_author_kpis")
def q_edges_with_author_kpis(spark, sf_dir):
    """Edges and their author's KPIs from two tables laid out by the user: the join shuffles nothing."""
    from plume.sources.keyed import buckets_for, write_keyed
    _, edges, nodes = _graph(spark, sf_dir)
    edges = edges.checkpoint(eager=True)
    n = buckets_for(edges.count())
    write_keyed(edges, "edges_by_source", "source_user", n, then=["target_user"])
    write_keyed(nodes, "nodes_by_name", "username", n)
    e, u = spark.table("edges_by_source"), spark.table("nodes_by_name")
    return e.join(u, e["source_user"] == u["username"]).select(
        "source_user", "target_user", "type", "weight", "tweets_count", "engagement_sum")


@register("edges_collapsed")
def q_edges_collapsed(spark, sf_dir):
    return G.collapse_edges(_graph(spark, sf_dir)[1])


@register("degrees")
def q_degrees(spark, sf_dir):
    _, edges, nodes = _graph(spark, sf_dir)
    ec = G.collapse_edges(edges)
    return G.degrees(G.vertices(nodes, ec), ec)


@register("undirected_edges")
def q_undirected_edges(spark, sf_dir):
    return G.undirected_edges(G.collapse_edges(_graph(spark, sf_dir)[1]))


@register("pagerank")
def q_pagerank(spark, sf_dir):
    """PageRank run to convergence, rounded to 8 decimals."""
    _, ec, verts = _graph_base(spark, sf_dir)
    return converged_pagerank(verts, ec).select("username", F.round("pagerank", 8).alias("pagerank"))


@register("communities")
def q_communities(spark, sf_dir):
    """Label-propagation communities of the stable labelling."""
    _, ec, verts = _graph_base(spark, sf_dir)
    return LP.communities(verts, G.undirected_edges(ec))


@register("user_centrality")
def q_user_centrality(spark, sf_dir):
    return _centrality(spark, sf_dir)[1]


@register("top_users_by_degree")
def q_top_users_by_degree(spark, sf_dir):
    return G.top_users(_centrality(spark, sf_dir)[1], "degree", TOP_USERS_N, PR_DIGITS)


@register("top_users_by_in_degree")
def q_top_users_by_in_degree(spark, sf_dir):
    return G.top_users(_centrality(spark, sf_dir)[1], "in_degree", TOP_USERS_N, PR_DIGITS)


@register("top_users_by_pagerank")
def q_top_users_by_pagerank(spark, sf_dir):
    return G.top_users(_centrality(spark, sf_dir)[1], "pagerank", TOP_USERS_N, PR_DIGITS)


@register("community_sizes")
def q_community_sizes(spark, sf_dir):
    return G.community_sizes(_centrality(spark, sf_dir)[1])


@register("community_top_members")
def q_community_top_members(spark, sf_dir):
    return G.community_top_members(_centrality(spark, sf_dir)[1])


def _day_graph(spark, sf_dir):
    """Vertices and collapsed edges of every day's own users (``2024-01-05/u7``); replies tie one day to the next."""
    from plume.session import work_dir
    work_dir(spark)
    posts = _clean(spark, sf_dir, GRAPH_COLUMNS)
    of_day = lambda u: F.when(u != "", F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("/"), u))
    posts = posts.withColumns({"username": of_day(F.col("username")),
                               "mentions_array": F.transform("mentions_array", of_day)}).checkpoint(eager=True)
    ec = G.collapse_edges(G.user_edges(posts)).checkpoint(eager=True)
    return G.vertices(G.nodes(posts), ec).checkpoint(eager=True), ec


@register("day_user_colours")
def q_day_user_colours(spark, sf_dir):
    """A proper colouring of every day's users: neighbours in the interaction graph differ."""
    verts, ec = _day_graph(spark, sf_dir)
    return CO.colouring(verts, G.undirected_edges(ec))[0]


@register("day_communities")
def q_day_communities(spark, sf_dir):
    """Semi-synchronous label propagation, colour by colour, over every day's users."""
    verts, ec = _day_graph(spark, sf_dir)
    return CO.communities(verts, G.undirected_edges(ec))


def _day_centrality(spark, sf_dir):
    """Degrees and communities of every day's users (PageRank left out: 0)."""
    verts, ec = _day_graph(spark, sf_dir)
    found = CO.communities(verts, G.undirected_edges(ec)).checkpoint(eager=True)
    return G.centrality(verts, ec, verts.select("username", F.lit(0.0).alias("pagerank")), found)


@register("day_community_sizes")
def q_day_community_sizes(spark, sf_dir):
    return G.community_sizes(_day_centrality(spark, sf_dir))


@register("day_community_top_members")
def q_day_community_top_members(spark, sf_dir):
    return G.community_top_members(_day_centrality(spark, sf_dir))


@register("subgraph_nodes")
def q_subgraph_nodes(spark, sf_dir):
    return G.subgraph_nodes(_centrality(spark, sf_dir)[1], TOP_NODES_N)


@register("subgraph_edges")
def q_subgraph_edges(spark, sf_dir):
    # The filter is on the endpoints (the grouping keys), so the already-collapsed, checkpointed edge
    # table gives the same weights and types as collapsing the typed edges inside the node set.
    ec, cent = _centrality(spark, sf_dir)
    return G.subgraph_edges(ec, G.subgraph_nodes(cent, TOP_NODES_N))


@register("dataset_counts")
def q_dataset_counts(spark, sf_dir):
    """Row counts of the input view and every derived table, one row per dataset."""
    from plume.session import work_dir
    work_dir(spark)
    raw = posts_raw(spark, sf_dir)
    posts = C.clean_posts(raw, [*GRAPH_COLUMNS, "lang", "hashtags_array"]).checkpoint(eager=True)
    tables = {"posts_raw": raw, "posts_clean": posts, "kpi_daily": K.kpi_daily(posts),
              "kpi_daily_lang": K.kpi_daily_lang(posts), "kpi_hashtags": K.kpi_hashtags(posts),
              "kpi_users": K.kpi_users(posts), "user_edges": G.user_edges(posts),
              "user_nodes": G.user_nodes(posts, K.kpi_users(posts))}
    out = None
    for name, df in tables.items():
        c = df.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("row_count"))
        out = c if out is None else out.unionByName(c)
    return out


# --- text, topics, sentiment -----------------------------------------------------------------------------------

from plume.functions.columns import clean_text  # noqa: E402
from plume.operators import sentiment as S  # noqa: E402
from plume.operators import text as T  # noqa: E402
from plume.operators import topics as TP  # noqa: E402
from plume.sources.tables import labelled_text  # noqa: E402


@register("text_clean")
def q_text_clean(spark, sf_dir):
    """Normalised text of English posts; posts whose text normalises to '' are dropped."""
    return _english(spark, sf_dir).select("id", clean_text(F.col("content")).alias("text_clean")).filter(F.length("text_clean") > 0)


@register("term_counts")
def q_term_counts(spark, sf_dir):
    """Bag-of-words vocabulary of the topic model: df bounds, then the most frequent terms."""
    return TP.bow_vocabulary(TP.topic_corpus(_english(spark, sf_dir)))


def _split(spark, sf_dir):
    """The labelled split, written once: training and test sides read it again and again."""
    from plume.session import work_dir
    work_dir(spark)
    return S.stratified_split(S.label_prep(labelled_text(spark, sf_dir))).checkpoint(eager=True)


@register("tfidf_terms")
def q_tfidf_terms(spark, sf_dir):
    """TF-IDF vocabulary (unigrams + bigrams) of the training split with smoothed idf."""
    v = S.tfidf_vocabulary(_split(spark, sf_dir).filter(F.col("split") == "train"))
    return v.select("term", "term_freq", "doc_freq", "term_index", F.round("idf", 9).alias("idf"))


def _lda(spark, sf_dir):
    corpus = TP.topic_corpus(_english(spark, sf_dir))
    return TP.fit_lda(corpus)


@register("topic_assignments")
def q_topic_assignments(spark, sf_dir):
    model, _, vecs = _lda(spark, sf_dir)
    return TP.topic_assignments(model, vecs)


@register("topic_words")
def q_topic_words(spark, sf_dir):
    model, terms, _ = _lda(spark, sf_dir)
    return TP.topic_words(spark, model, terms)


@register("topic_share")
def q_topic_share(spark, sf_dir):
    model, _, vecs = _lda(spark, sf_dir)
    return TP.topic_share(TP.topic_assignments(model, vecs), TP.topic_labels(spark))


@register("label_audit")
def q_label_audit(spark, sf_dir):
    return S.label_audit(labelled_text(spark, sf_dir))


@register("label_audit_files")
def q_label_audit_files(spark, sf_dir):
    """Label frequencies per input file: the labelled texts as two CSV inputs, ``training`` and ``validation``."""
    from plume.session import scratch_path
    from plume.sources.files import read_labelled_csv
    root = scratch_path(spark, "labelled-csv")
    texts = labelled_text(spark, sf_dir)
    inputs = {"training": F.col("id") % 3 != 0, "validation": F.col("id") % 3 == 0}
    for name, part in inputs.items():
        texts.where(part).write.option("escape", '"').csv(f"{root}/{name}")
    back = read_labelled_csv(spark, [f"{root}/{n}" for n in inputs], name_pattern=r"([^/]+)/[^/]+$")
    return S.label_audit(back, "source_file")


# A lexicon as a caller would bring it: frequent words of the English documents with scores.
GIVEN_LEXICON = [("er", 0.5), ("es", -0.5), ("th", 0.05), ("en", -0.05), ("ed", 0.3), ("nt", -0.3), ("st", 0.8),
                 ("ti", -0.8), ("ha", 0.0), ("ly", 0.1)]


@register("lexicon_sentiment_given")
def q_lexicon_sentiment_given(spark, sf_dir):
    """Lexicon classes of every English post with a lexicon that the caller supplies."""
    posts = _english(spark, sf_dir)
    lexicon = spark.createDataFrame(GIVEN_LEXICON, "word string, score double")
    return S.lexicon_sentiment(posts.select("id", clean_text(F.col("content")).alias("text_clean")), lexicon)


# Modifiers as a caller would bring them: words that the test tables' English texts have, in hundredths.
GIVEN_MODIFIERS = {"only": -75, "than": -75, "from": -50, "that": 130, "this": 115, "as": 80}


@register("valence_sentiment")
def q_valence_sentiment(spark, sf_dir):
    """Rule scores of every English post: the lexicon of the training split under the caller's modifiers."""
    posts = _english(spark, sf_dir)
    lexicon = S.learn_lexicon(_split(spark, sf_dir).filter(F.col("split") == "train"))
    texts = posts.select("id", clean_text(F.col("content")).alias("text_clean"))
    return S.valence_sentiment(texts, lexicon, GIVEN_MODIFIERS)


@register("label_prep")
def q_label_prep(spark, sf_dir):
    return S.label_prep(labelled_text(spark, sf_dir)).drop("text")


@register("stratified_split")
def q_stratified_split(spark, sf_dir):
    return _split(spark, sf_dir).select("id", "sentiment", "label", "split")


def _lexicon_preds(spark, sf_dir):
    sp = _split(spark, sf_dir)
    lex = S.learn_lexicon(sp.filter(F.col("split") == "train"))
    test = sp.filter(F.col("split") == "test")
    return test.select("id", "label").join(S.lexicon_sentiment(test, lex), "id")


@register("lexicon_sentiment")
def q_lexicon_sentiment(spark, sf_dir):
    """Lexicon baseline (lexicon learned from the training split) on the test split."""
    return _lexicon_preds(spark, sf_dir)


@register("eval_accuracy")
def q_eval_accuracy(spark, sf_dir):
    return S.accuracy(_lexicon_preds(spark, sf_dir))


@register("eval_report")
def q_eval_report(spark, sf_dir):
    return S.report(_lexicon_preds(spark, sf_dir))


@register("eval_confusion")
def q_eval_confusion(spark, sf_dir):
    return S.confusion(_lexicon_preds(spark, sf_dir))


def _lr(spark, sf_dir):
    sp = _split(spark, sf_dir)
    model = S.train_classifier(sp.filter(F.col("split") == "train"))
    return model, sp


@register("sentiment_scores")
def q_sentiment_scores(spark, sf_dir):
    """Logistic-regression scoring of all English posts (model trained on the labelled split)."""
    model, _ = _lr(spark, sf_dir)
    return S.score_posts(model, _english(spark, sf_dir))


@register("sentiment_distribution")
def q_sentiment_distribution(spark, sf_dir):
    model, _ = _lr(spark, sf_dir)
    return S.sentiment_distribution(S.score_posts(model, _english(spark, sf_dir)))


@register("eval_lr_report")
def q_eval_lr_report(spark, sf_dir):
    """Hold-out report of the logistic regression."""
    model, sp = _lr(spark, sf_dir)
    return S.report(S.predict(model, sp.filter(F.col("split") == "test")))


@register("classifier_agreement")
def q_classifier_agreement(spark, sf_dir):
    """Share of test texts where logistic regression and the lexicon baseline agree."""
    model, sp = _lr(spark, sf_dir)
    lr = S.predict(model, sp.filter(F.col("split") == "test"))
    return S.agreement(lr, _lexicon_preds(spark, sf_dir))


# --- the reports of the models over columns that SQL derives too ------------------------------------------------

def _judged(spark, sf_dir, wrong_every: int):
    """``(id, label, pred)`` of the labelled documents; every ``wrong_every``-th prediction is one class off."""
    from plume.sources.tables import table
    label = F.col("quality") + F.col("toxic")
    off = F.when(F.col("doc_id") % wrong_every == 0, 1).otherwise(0)
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), label.alias("label"),
                                                 ((label + off) % 3).cast("int").alias("pred"))


@register("topic_share_by_id")
def q_topic_share_by_id(spark, sf_dir):
    """Topic report over ``doc_id % 9`` as the topic of each document (8 has no label)."""
    from plume.sources.tables import table
    topics = table(spark, sf_dir, "documents").select((F.col("doc_id") % 9).cast("int").alias("dominant_topic"))
    return TP.topic_share(topics, TP.topic_labels(spark))


@register("sentiment_distribution_by_id")
def q_sentiment_distribution_by_id(spark, sf_dir):
    names = F.create_map(*[F.lit(x) for k, v in LABEL_TO_ID.items() for x in (v, k)])
    return S.sentiment_distribution(_judged(spark, sf_dir, 5).select(names[F.col("pred")].alias("sentiment_label")))


@register("classifier_agreement_by_id")
def q_classifier_agreement_by_id(spark, sf_dir):
    return S.agreement(_judged(spark, sf_dir, 5), _judged(spark, sf_dir, 7))


@register("eval_report_by_id")
def q_eval_report_by_id(spark, sf_dir):
    return S.report(_judged(spark, sf_dir, 5))
