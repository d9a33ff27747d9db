"""User interaction graph: typed weighted edges, nodes, degrees, centrality table and its reports.

Graphs are two DataFrames — edges ``(source_user, target_user, type, weight)``
and nodes ``(username, ...)`` — and every operator is a join / aggregate on
them.  Hub users (one user may hold a third of all edges) are handled by
map-side partial aggregation before each shuffle and by AQE's skew-join
splitting; only sets with a proven size bound (top-N node lists) are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plume.schemas import TOP_COMMUNITIES, TOP_NODES_N, TOP_PER_COMMUNITY, TOP_USER_COLUMNS


def _present(c: str):
    return F.col(c).isNotNull() & (F.col(c) != "")


def authored(posts: DataFrame) -> DataFrame:
    """Posts with a known author."""
    return posts.filter(_present("username"))


def mention_edges(posts: DataFrame) -> DataFrame:
    """Author -> each mentioned user, type ``mention``, weight 1 per mention."""
    e = authored(posts).select(F.col("username").alias("source_user"),
                               F.explode("mentions_array").alias("target_user"))
    return e.filter(_present("target_user")).select(
        "source_user", "target_user", F.lit("mention").alias("type"), F.lit(1).cast("long").alias("weight"))


def reply_edges(posts: DataFrame) -> DataFrame:
    """Reply author -> author of the replied post, type ``reply``; weight = number of replies on the pair.

    Replies are first counted per (replied post, author) — a post that draws a
    third of all replies collapses map-side before the self-join shuffle.
    Self-replies are kept; replies to unknown posts or authors drop out.
    """
    p = authored(posts)
    replies = (p.filter(F.col("inReplyToTweetId").isNotNull())
               .groupBy("inReplyToTweetId", F.col("username").alias("source_user"))
               .agg(F.count(F.lit(1)).alias("weight")))
    answered = p.select(F.col("id").alias("inReplyToTweetId"), F.col("username").alias("target_user"))
    j = replies.join(answered, "inReplyToTweetId")
    pairs = j.groupBy("source_user", "target_user").agg(F.sum("weight").cast("long").alias("weight"))
    return pairs.select("source_user", "target_user", F.lit("reply").alias("type"), "weight")


def user_edges(posts: DataFrame) -> DataFrame:
    """Mention and reply edges summed per (source, target, type)."""
    raw = mention_edges(posts).unionByName(reply_edges(posts))
    return raw.groupBy("source_user", "target_user", "type").agg(F.sum("weight").cast("long").alias("weight"))


def nodes(posts: DataFrame) -> DataFrame:
    """Distinct users: authors and mentioned users."""
    a = authored(posts).select("username")
    m = posts.select(F.explode("mentions_array").alias("username")).filter(_present("username"))
    return a.unionByName(m).distinct()


def user_nodes(posts: DataFrame, kpi_users: DataFrame | None = None) -> DataFrame:
    """Nodes with their post count and engagement; typed nulls when no KPI table is given."""
    n = nodes(posts)
    if kpi_users is None:
        return n.select("username", F.lit(None).cast("long").alias("tweets_count"),
                        F.lit(None).cast("long").alias("engagement_sum"))
    return n.join(kpi_users, "username", "left").select("username", "tweets_count", "engagement_sum")


def collapse_edges(edges: DataFrame) -> DataFrame:
    """One edge per (source, target): weights summed over types; ``type`` = smallest type name."""
    return edges.groupBy("source_user", "target_user").agg(
        F.sum("weight").cast("long").alias("weight"), F.min("type").alias("type"))


def vertices(nodes_df: DataFrame, edges: DataFrame) -> DataFrame:
    """Node table plus any edge endpoint missing from it."""
    return (nodes_df.select("username")
            .unionByName(edges.select(F.col("source_user").alias("username")))
            .unionByName(edges.select(F.col("target_user").alias("username")))
            .distinct())


def degrees(verts: DataFrame, edges: DataFrame) -> DataFrame:
    """Weighted in-, out- and total degree per vertex (a self-loop counts on both sides); 0.0 when none.

    One aggregate over edge endpoints and vertices together — no join.
    """
    w = F.col("weight").cast("double")
    parts = (edges.select(F.col("target_user").alias("username"), w.alias("i"), F.lit(0.0).alias("o"))
             .unionByName(edges.select(F.col("source_user").alias("username"), F.lit(0.0).alias("i"), w.alias("o")))
             .unionByName(verts.select("username", F.lit(0.0).alias("i"), F.lit(0.0).alias("o"))))
    d = parts.groupBy("username").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
    return d.withColumn("degree", F.col("in_degree") + F.col("out_degree"))


def undirected_edges(edges: DataFrame) -> DataFrame:
    """Distinct unordered pairs ``(a <= b)`` of the directed graph (self-loops kept)."""
    return edges.select(F.least("source_user", "target_user").alias("a"),
                        F.greatest("source_user", "target_user").alias("b")).distinct()


def centrality(verts: DataFrame, edges: DataFrame, ranks: DataFrame, communities: DataFrame) -> DataFrame:
    """``user_centrality``: one row per vertex with degrees, PageRank and community id (-1 if none)."""
    d = degrees(verts, edges)
    return (d.join(ranks.select("username", "pagerank"), "username", "left")
            .join(communities.select("username", "community_id"), "username", "left")
            .select("username", "in_degree", "out_degree", "degree",
                    F.coalesce(F.col("pagerank"), F.lit(0.0)).alias("pagerank"),
                    F.coalesce(F.col("community_id"), F.lit(-1)).cast("int").alias("community_id")))


def top_users(cent: DataFrame, metric: str, n: int = 20, round_digits: int | None = None) -> DataFrame:
    """Top ``n`` users by ``metric`` (name ascending on ties), numbered 1..n, in the export column order.

    ``round_digits`` ranks by the rounded value so that float noise cannot
    reorder users whose values are mathematically equal.
    """
    key = F.round(F.col(metric), round_digits) if round_digits is not None else F.col(metric)
    top = cent.withColumn("__k", key).orderBy(F.col("__k").desc(), F.col("username").asc()).limit(n)
    w = Window.orderBy(F.col("__k").desc(), F.col("username").asc())  # over at most n rows
    return top.withColumn("rank", F.row_number().over(w)).select("rank", *TOP_USER_COLUMNS)


def community_sizes(cent: DataFrame) -> DataFrame:
    return cent.groupBy("community_id").agg(F.count(F.lit(1)).alias("size"))


def top_communities(cent: DataFrame, k: int = TOP_COMMUNITIES) -> DataFrame:
    """The ``k`` largest communities (smallest id on ties), numbered."""
    s = community_sizes(cent).orderBy(F.col("size").desc(), F.col("community_id").asc()).limit(k)
    w = Window.orderBy(F.col("size").desc(), F.col("community_id").asc())
    return s.withColumn("community_rank", F.row_number().over(w))


def community_top_members(cent: DataFrame, k: int = TOP_COMMUNITIES, n: int = TOP_PER_COMMUNITY) -> DataFrame:
    """Top ``n`` members by degree inside each of the ``k`` largest communities.

    The ``k``-row community list is broadcast; ``row_number() <= n`` plans as a
    window group limit that trims every partition before the shuffle, so a
    giant community never reaches one task whole.
    """
    top = top_communities(cent, k)
    members = cent.join(F.broadcast(top), "community_id", "left_semi")
    w = Window.partitionBy("community_id").orderBy(F.col("degree").desc(), F.col("username").asc())
    ranked = members.withColumn("member_rank", F.row_number().over(w)).filter(F.col("member_rank") <= n)
    return ranked.join(F.broadcast(top), "community_id").select(
        "community_rank", "community_id", "size", "member_rank", "username", "degree", "in_degree", "out_degree",
        "pagerank")


def subgraph_nodes(cent: DataFrame, n: int = TOP_NODES_N) -> DataFrame:
    """Top ``n`` users by degree with their attributes."""
    return (cent.orderBy(F.col("degree").desc(), F.col("username").asc()).limit(n)
            .select("username", "degree", "in_degree", "out_degree", "pagerank",
                    F.col("community_id").cast("long").alias("community_id")))


def subgraph_edges(edges: DataFrame, top_nodes: DataFrame) -> DataFrame:
    """Edges with both ends in ``top_nodes`` (a bounded top-N set, broadcast), collapsed per pair."""
    s = F.broadcast(top_nodes.select(F.col("username").alias("__u")))
    inside = (edges.join(s, F.col("source_user") == F.col("__u"), "left_semi")
              .join(s, F.col("target_user") == F.col("__u"), "left_semi"))
    return inside.groupBy(F.col("source_user").alias("source"), F.col("target_user").alias("target")).agg(
        F.sum("weight").cast("double").alias("weight"), F.min("type").alias("type"))
