"""The batch pipeline in the reference's job order: clean -> KPIs -> graph -> graph analytics -> text models.

``run_batch`` reads the raw posts once, keeps ``posts_clean`` as a written
table (later stages read it back instead of re-deriving it, which also cuts
lineage), and writes every derived table under ``out_root`` as one commit, so
a failed stage leaves the table of the run before.  Iterative
stages checkpoint into the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.operators import clean as C
from plume.operators import communities as LP
from plume.operators import graph as G
from plume.operators import kpis as K
from plume.operators import sentiment as S
from plume.operators import topics as TP
from plume.operators.pagerank import pagerank
from plume.schemas import TOP_NODES_N, TOP_USER_COLUMNS, TOP_USERS_N
from plume.sources.files import export_csv, read_dataset, read_declared, write_dataset


def run_batch(spark: SparkSession, raw: DataFrame, out_root: str, labelled: DataFrame | None = None,
              with_text_models: bool = True) -> dict[str, object]:
    """Run every stage; returns a small summary (row counts, PageRank run info)."""
    summary: dict[str, object] = {}
    write_dataset(C.clean_posts(raw), out_root, "posts_clean")
    posts = read_declared(spark, out_root, "posts_clean")

    for name, fn in [("kpi_daily", K.kpi_daily), ("kpi_daily_lang", K.kpi_daily_lang),
                     ("kpi_hashtags", K.kpi_hashtags), ("kpi_users", K.kpi_users)]:
        write_dataset(fn(posts), out_root, name)
    kpi_users = read_declared(spark, out_root, "kpi_users")

    write_dataset(G.user_edges(posts), out_root, "user_edges")
    write_dataset(G.user_nodes(posts, kpi_users), out_root, "user_nodes")
    edges = read_declared(spark, out_root, "user_edges")
    ec = G.collapse_edges(edges)
    write_dataset(ec, out_root, "edges_collapsed")
    ec = read_declared(spark, out_root, "edges_collapsed")
    verts = G.vertices(read_declared(spark, out_root, "user_nodes"), ec)
    write_dataset(verts, out_root, "vertices")
    verts = read_declared(spark, out_root, "vertices")

    ranks, info = pagerank(verts, ec)
    summary["pagerank"] = info
    comms = LP.communities(verts, G.undirected_edges(ec))
    write_dataset(G.centrality(verts, ec, ranks, comms), out_root, "user_centrality")
    cent = read_declared(spark, out_root, "user_centrality")

    for metric in ("degree", "in_degree", "pagerank"):
        export_csv(G.top_users(cent, metric, TOP_USERS_N), f"{out_root}/top_users/top_{metric}",
                   TOP_USER_COLUMNS, order=["rank"])
    write_dataset(G.community_sizes(cent), out_root, "community_sizes")
    write_dataset(G.community_top_members(cent), out_root, "community_top_members")
    top = G.subgraph_nodes(cent, TOP_NODES_N)
    write_dataset(top, out_root, "subgraph_nodes")
    write_dataset(G.subgraph_edges(edges, read_dataset(spark, out_root, "subgraph_nodes")), out_root, "subgraph_edges")

    if with_text_models:
        model, terms, vecs = TP.fit_lda(TP.topic_corpus(posts))
        write_dataset(TP.topic_assignments(model, vecs), out_root, "post_topics")
        write_dataset(TP.topic_words(spark, model, terms), out_root, "topic_words")
        topics = read_dataset(spark, out_root, "post_topics")
        write_dataset(TP.topic_share(topics, TP.topic_labels(spark)), out_root, "topic_share")
        if labelled is not None:
            sp = S.stratified_split(S.label_prep(labelled))
            write_dataset(sp, out_root, "labelled_split")
            sp = read_dataset(spark, out_root, "labelled_split")
            clf = S.train_classifier(sp.filter(F.col("split") == "train"))
            S.portable_model(clf).write().overwrite().save(f"{out_root}/models/sentiment_lr")
            test = sp.filter(F.col("split") == "test")
            write_dataset(S.report(S.predict(clf, test)), out_root, "eval_lr_report")
            write_dataset(S.score_posts(clf, posts), out_root, "post_sentiment")
            write_dataset(S.sentiment_distribution(read_dataset(spark, out_root, "post_sentiment")), out_root,
                          "sentiment_distribution")
    for name in ("posts_clean", "kpi_daily", "user_edges", "user_nodes", "user_centrality"):
        summary[name] = read_dataset(spark, out_root, name).count()
    return summary
