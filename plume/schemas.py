"""Declared schemas of every dataset, and the fixed values results depend on."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DataType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

# --- fixed values (must equal the reference's for identical results) -----------------------------------------
# Columns kept by the ingest step, in this order.
KEEP_COLUMNS = [
    "id", "date", "content", "user", "replyCount", "retweetCount", "likeCount", "quoteCount",
    "conversationId", "inReplyToTweetId", "inReplyToUser", "mentionedUsers", "hashtags", "lang", "url",
]
# Sentiment classes and their ids.
LABEL_TO_ID = {"Negative": 0, "Neutral": 1, "Positive": 2}
# Topic id -> display label, and the label used for any other id.
TOPIC_LABELS = {
    0: "OTAN / UE / élargissement",
    1: "Politique US (Biden / Trump)",
    2: "Armement / puissance militaire",
    3: "Crise diplomatique / négociations",
    4: "Opinions générales sur Russie / USA",
    5: "Troupes aux frontières / invasion",
    6: "Russie–Chine / Taiwan / Syrie",
    7: "Risque nucléaire / OTAN / USA",
}
UNKNOWN_TOPIC = "Topic inconnu"
# Regular expressions of the cleaning step.
USERNAME_PATTERN = r"'username': '([^']+)'"
HASHTAG_NOISE = r"[\[\]'`\s]"
# Score thresholds of the three-class mapping (<= NEG Negative, >= POS Positive).
SENTIMENT_NEG, SENTIMENT_POS = -0.05, 0.05
# Text-model parameters.
LDA_TOPICS, LDA_WORDS, LDA_MAX_ITER, LDA_SEED, LDA_GAIN = 8, 15, 500, 0, 1e-4
BOW_MAX_DF, BOW_MIN_DF, BOW_MAX_FEATURES = 0.9, 10, 5000
TFIDF_MAX_FEATURES = 20000
SPLIT_TEST_FRACTION, SPLIT_SEED = 0.2, 42
# PageRank library defaults.
PAGERANK_ALPHA, PAGERANK_MAX_ITER, PAGERANK_TOL = 0.85, 100, 1.0e-6
# Report sizes.
TOP_USERS_N, TOP_NODES_N, TOP_COMMUNITIES, TOP_PER_COMMUNITY = 20, 100, 5, 10
TOP_DASHBOARD_N, TOP_USER_TABLE_N = 20, 100
# ---------------------------------------------------------------------------------------------------------------

SENTIMENT_CLASSES = sorted(LABEL_TO_ID, key=LABEL_TO_ID.get)

_COUNTERS = ("replyCount", "retweetCount", "likeCount", "quoteCount")
_TYPES = {**dict.fromkeys(("id", "conversationId", "inReplyToTweetId"), LongType()),
          **dict.fromkeys(_COUNTERS, IntegerType())}


def _typed(names: list[str], **others: DataType) -> StructType:
    """Columns by name: the type above or given here, else text."""
    return StructType([StructField(n, others.get(n) or _TYPES.get(n) or StringType()) for n in names])


# Raw post as read from a CSV export or the driver-derived view.
POSTS_RAW = _typed(KEEP_COLUMNS)

# JSON value of one stream message (same fields; ``date`` stays text until typed).
MESSAGE = POSTS_RAW

_PARSED = {"user": "username", "hashtags": "hashtags_array", "mentionedUsers": "mentions_array"}  # raw -> clean column
POSTS_CLEAN = _typed(
    ["id", "date", "content", "lang", *_COUNTERS, *[c for c in KEEP_COLUMNS if c.startswith(("conv", "inReplyToTw"))],
     "url", "engagement", *_PARSED.values()],
    date=TimestampType(), engagement=LongType(), hashtags_array=ArrayType(StringType()),
    mentions_array=ArrayType(StringType()))

LABELLED_TEXT = StructType([
    StructField("id", LongType()),
    StructField("topic", StringType()),
    StructField("sentiment", StringType()),
    StructField("text", StringType()),
])



def _kpi(*keys: StructField) -> StructType:
    return StructType([*keys, StructField("tweets_count", LongType()), StructField("engagement_sum", LongType())])


_DAY, _USER = StructField("date", DateType()), StructField("username", StringType())
KPI_DAILY = _kpi(_DAY)
USER_EDGES = StructType([StructField(c, StringType()) for c in ("source_user", "target_user", "type")]
                        + [StructField("weight", LongType())])
USER_CENTRALITY = StructType(
    [_USER, *[StructField(c, DoubleType()) for c in ("in_degree", "out_degree", "degree", "pagerank")],
     StructField("community_id", IntegerType())])

# Columns of the top-user reports: the centrality table's, the total degree first.
TOP_USER_COLUMNS = sorted(USER_CENTRALITY.names, key=lambda c: {"username": 0, "degree": 1}.get(c, 2))

# The catalogue: declared columns of the stored tables that later stages read.
TABLES = {
    "posts_clean": POSTS_CLEAN, "kpi_daily": KPI_DAILY, "kpi_daily_lang": _kpi(_DAY, StructField("lang", StringType())),
    "kpi_hashtags": _kpi(StructField("hashtag", StringType())), "kpi_users": _kpi(_USER), "user_nodes": _kpi(_USER),
    "user_edges": USER_EDGES, "edges_collapsed": USER_EDGES, "vertices": StructType([_USER]),
    "user_centrality": USER_CENTRALITY,
}
