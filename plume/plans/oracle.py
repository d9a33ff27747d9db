"""Oracle SQL (DuckDB dialect) for every registered query.

Each string re-derives ``posts_raw`` from the pre-registered driver views and
computes the same result as the Spark plan, column names included.  Notes on
dialect: backslashes are literal in SQL strings; DuckDB regex needs the ``'g'``
flag to replace all matches; ``sum`` of bigint is widened, so it is cast back.
"""

from __future__ import annotations

from plume.schemas import TOPIC_LABELS, UNKNOWN_TOPIC, USERNAME_PATTERN

_Q_USERNAME = USERNAME_PATTERN.replace("'", "''")

CTE: dict[str, str] = {}

CTE["posts_raw"] = r"""
ev AS (SELECT e.*, e.event_id % (SELECT count(*) FROM documents) AS doc_key FROM events e),
base AS (
  SELECT e.event_id AS id,
    strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS date,
    CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE d.text END AS content,
    CASE WHEN e.event_id % 89 = 0 THEN NULL WHEN e.event_id % 83 = 0 THEN '{}'
         ELSE '{''username'': ''u' || CAST(e.user_id AS VARCHAR) || '''}' END AS "user",
    CASE WHEN e.event_id % 11 = 0 THEN NULL ELSE CAST(e.event_id % 5 AS INTEGER) END AS replyCount,
    CAST(e.event_id % 7 AS INTEGER) AS retweetCount,
    CAST(floor(e.value) AS INTEGER) AS likeCount,
    CAST(e.event_id % 3 AS INTEGER) AS quoteCount,
    e.event_id - e.event_id % 10 AS conversationId,
    CASE WHEN e.event_id % 3 = 0 AND e.event_id > 40 THEN e.event_id - 1 - e.event_id % 37 END AS inReplyToTweetId,
    CAST(NULL AS VARCHAR) AS inReplyToUser,
    CASE e.event_id % 4 WHEN 0 THEN NULL WHEN 3 THEN '[]'
      WHEN 1 THEN '[{''username'': ''u' || CAST((e.user_id * 7 + 3) % 160 AS VARCHAR) || '''}, {''username'': ''u'
                  || CAST(e.event_id % 13 AS VARCHAR) || '''}]'
      ELSE '{''username'': ''u' || CAST((e.user_id + 1) % 160 AS VARCHAR) || '''}' END AS mentionedUsers,
    CASE e.event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '[]'
      WHEN 2 THEN '[''' || e.event_type || ''', ''' || e.event_type || ''']'
      ELSE '[''' || e.event_type || ''', ''k' || CAST(e.event_id % 23 AS VARCHAR) || ''']' END AS hashtags,
    d.lang AS lang,
    'https://example.org/t/' || CAST(e.event_id AS VARCHAR) AS url,
    e.event_type AS _event_type
  FROM ev e LEFT JOIN documents d ON d.doc_id = e.doc_key),
posts_raw AS (
  SELECT * EXCLUDE (_event_type) FROM base
  UNION ALL SELECT * EXCLUDE (_event_type) FROM base WHERE _event_type = 'error')"""

CTE["posts_clean"] = r"""
typed AS (
  SELECT TRY_CAST(id AS BIGINT) AS id, TRY_CAST(date AS TIMESTAMP) AS date, content, lang,
    TRY_CAST(replyCount AS INTEGER) AS replyCount, TRY_CAST(retweetCount AS INTEGER) AS retweetCount,
    TRY_CAST(likeCount AS INTEGER) AS likeCount, TRY_CAST(quoteCount AS INTEGER) AS quoteCount,
    TRY_CAST(conversationId AS BIGINT) AS conversationId, TRY_CAST(inReplyToTweetId AS BIGINT) AS inReplyToTweetId,
    "user", mentionedUsers, hashtags, url
  FROM posts_raw),
typed_e AS (
  SELECT *, COALESCE(CAST(replyCount AS BIGINT), 0) + COALESCE(CAST(retweetCount AS BIGINT), 0)
          + COALESCE(CAST(likeCount AS BIGINT), 0) + COALESCE(CAST(quoteCount AS BIGINT), 0) AS engagement
  FROM typed),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY (content IS NOT NULL) DESC, date DESC NULLS LAST,
                                 engagement DESC) AS rn FROM typed_e) WHERE rn = 1),
posts_clean AS (
  SELECT id, date, content, lang, replyCount, retweetCount, likeCount, quoteCount, conversationId,
    inReplyToTweetId, url, engagement,
    regexp_extract("user", '__USERNAME__', 1) AS username,
    list_filter(string_split(trim(regexp_replace(regexp_replace(coalesce(hashtags, ''), '[\[\]''`]', '', 'g'),
                                                 '\s+', '', 'g')), ','), lambda x: x <> '') AS hashtags_array,
    CASE WHEN mentionedUsers IS NULL THEN CAST([] AS VARCHAR[])
         ELSE regexp_extract_all(mentionedUsers, '__USERNAME__', 1) END AS mentions_array
  FROM dedup WHERE content IS NOT NULL)""".replace("__USERNAME__", _Q_USERNAME)

CTE["days"] = r"""
days AS (SELECT CAST(date AS DATE) AS day, * FROM posts_clean WHERE date IS NOT NULL)"""

CTE["hashtag_uses"] = r"""
hashtag_uses AS (SELECT id, unnest(hashtags_array) AS hashtag, engagement FROM days WHERE len(hashtags_array) > 0)"""

CTE["kpi_daily"] = r"""
kpi_daily AS (SELECT day AS date, count(*) AS tweets_count, CAST(sum(engagement) AS BIGINT) AS engagement_sum
              FROM days GROUP BY day)"""

CTE["kpi_daily_lang"] = r"""
kpi_daily_lang AS (SELECT day AS date, lang, count(*) AS tweets_count,
                          CAST(sum(engagement) AS BIGINT) AS engagement_sum FROM days GROUP BY day, lang)"""

CTE["kpi_hashtags"] = r"""
kpi_hashtags AS (SELECT hashtag, count(*) AS tweets_count, CAST(sum(engagement) AS BIGINT) AS engagement_sum
                 FROM hashtag_uses GROUP BY hashtag)"""

CTE["kpi_users"] = r"""
kpi_users AS (SELECT username, count(*) AS tweets_count, CAST(sum(engagement) AS BIGINT) AS engagement_sum
              FROM days WHERE username IS NOT NULL AND username <> '' GROUP BY username)"""

# Which CTEs each CTE needs (in order).
DEPS: dict[str, list[str]] = {
    "posts_raw": [],
    "posts_clean": ["posts_raw"],
    "days": ["posts_clean"],
    "hashtag_uses": ["days"],
    "kpi_daily": ["days"],
    "kpi_daily_lang": ["days"],
    "kpi_hashtags": ["hashtag_uses"],
    "kpi_users": ["days"],
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(needs: list[str], final: str) -> str:
    parts = [CTE[n].strip() for n in _closure(needs)]
    return "WITH " + ",\n".join(parts) + "\n" + final.strip()


SQL: dict[str, str] = {}

SQL["clean_posts"] = with_ctes(["posts_clean"], """
SELECT id, date, content, lang, replyCount, retweetCount, likeCount, quoteCount, conversationId, inReplyToTweetId,
       url, engagement, username FROM posts_clean""")

SQL["kpi_daily"] = with_ctes(["kpi_daily"], "SELECT * FROM kpi_daily")
SQL["kpi_daily_lang"] = with_ctes(["kpi_daily_lang"], "SELECT * FROM kpi_daily_lang")
SQL["kpi_hashtags"] = with_ctes(["kpi_hashtags"], "SELECT * FROM kpi_hashtags")
SQL["kpi_users"] = with_ctes(["kpi_users"], "SELECT * FROM kpi_users")


# --- ingest, messages, stream ----------------------------------------------------------------------------------

def _py_space_sql() -> str:
    from plume.functions.columns import PY_SPACE_CHARS
    return " || ".join(f"chr({ord(ch)})" for ch in PY_SPACE_CHARS)


_STRIP = f"trim(content, {_py_space_sql()})"

CTE["ingest"] = rf"""
ingest_typed AS (
  SELECT id, TRY_CAST(date AS TIMESTAMP) AS date, coalesce({_STRIP}, 'nan') AS content, "user",
    replyCount, retweetCount, likeCount, quoteCount, conversationId, inReplyToTweetId, inReplyToUser,
    mentionedUsers, hashtags, lang, url
  FROM posts_raw WHERE lang = 'en'),
ingest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY date DESC NULLS LAST, content DESC) AS rn
    FROM ingest_typed WHERE length(content) > 5) WHERE rn = 1)"""
DEPS["ingest"] = ["posts_raw"]

_ISO = ("CASE WHEN epoch_us(date) % 1000000 <> 0 THEN strftime(date, '%Y-%m-%dT%H:%M:%S') || '.' || "
        "lpad(CAST(epoch_us(date) % 1000000 AS VARCHAR), 6, '0') ELSE strftime(date, '%Y-%m-%dT%H:%M:%S') END")

CTE["messages"] = rf"""
messages AS (
  SELECT CAST(id AS VARCHAR) AS key,
    CAST(json_object('id', id, 'date', {_ISO}, 'user', "user", 'content', content,
      'replyCount', coalesce(replyCount, 0), 'retweetCount', coalesce(retweetCount, 0),
      'likeCount', coalesce(likeCount, 0), 'quoteCount', coalesce(quoteCount, 0),
      'conversationId', conversationId, 'inReplyToTweetId', inReplyToTweetId, 'inReplyToUser', inReplyToUser,
      'mentionedUsers', mentionedUsers, 'hashtags', hashtags, 'lang', lang, 'url', url) AS VARCHAR) AS value
  FROM ingest)"""
DEPS["messages"] = ["ingest"]

# Decoding the messages gives back the ingest rows with defaulted counters and the strict engagement.
CTE["posts_stream"] = r"""
posts_stream AS (
  SELECT id, CAST(date AS TIMESTAMP) AS date, "user", content,
    CAST(coalesce(replyCount, 0) AS INTEGER) AS replyCount, CAST(coalesce(retweetCount, 0) AS INTEGER) AS retweetCount,
    CAST(coalesce(likeCount, 0) AS INTEGER) AS likeCount, CAST(coalesce(quoteCount, 0) AS INTEGER) AS quoteCount,
    conversationId, inReplyToTweetId, inReplyToUser, mentionedUsers, hashtags, lang, url,
    CAST(coalesce(replyCount, 0) AS BIGINT) + CAST(coalesce(retweetCount, 0) AS BIGINT)
      + CAST(coalesce(likeCount, 0) AS BIGINT) + CAST(coalesce(quoteCount, 0) AS BIGINT) AS engagement
  FROM ingest)"""
DEPS["posts_stream"] = ["ingest"]

SQL["ingest_filter"] = with_ctes(["ingest"], "SELECT * FROM ingest")

_TEXT_OK = f"length(coalesce({_STRIP}, 'nan')) > 5"
SQL["ingest_funnel"] = with_ctes(["posts_raw"], f"""
, f AS (SELECT count(*) AS r0, count(*) FILTER (WHERE lang = 'en') AS r1,
               count(*) FILTER (WHERE lang = 'en' AND {_TEXT_OK}) AS r2,
               count(DISTINCT CASE WHEN lang = 'en' AND {_TEXT_OK} THEN id END) AS r3 FROM posts_raw)
SELECT 'read' AS step, r0 AS row_count FROM f UNION ALL SELECT 'after_lang', r1 FROM f
UNION ALL SELECT 'after_text', r2 FROM f UNION ALL SELECT 'after_dedup', r3 FROM f""")

SQL["encode_messages"] = with_ctes(["messages"], "SELECT key, value FROM messages")
SQL["parse_messages"] = with_ctes(["posts_stream"], "SELECT * FROM posts_stream")
SQL["stream_ingest"] = SQL["parse_messages"]
SQL["topic_ingest"] = SQL["parse_messages"]

# --- exploded arrays -------------------------------------------------------------------------------------------

SQL["hashtags_exploded"] = with_ctes(["posts_clean"], """
SELECT id, unnest(hashtags_array) AS hashtag, engagement FROM posts_clean WHERE len(hashtags_array) > 0""")
SQL["mentions_exploded"] = with_ctes(["posts_clean"], """
SELECT id, username, unnest(mentions_array) AS mentioned FROM posts_clean""")

# --- reports ---------------------------------------------------------------------------------------------------

SQL["report_totals"] = with_ctes(["kpi_daily"], """
SELECT CAST(coalesce(sum(tweets_count), 0) AS BIGINT) AS total_tweets,
       CAST(coalesce(sum(engagement_sum), 0) AS BIGINT) AS total_engagement,
       round(CASE WHEN coalesce(sum(tweets_count), 0) > 0 THEN sum(engagement_sum) / sum(tweets_count)
                  ELSE 0.0 END, 6) AS avg_engagement,
       count(DISTINCT date) AS days_covered
FROM kpi_daily""")

SQL["report_peak_day"] = with_ctes(["kpi_daily"], """
SELECT (SELECT date FROM kpi_daily ORDER BY tweets_count DESC, date ASC LIMIT 1) AS peak_date,
       CAST(coalesce((SELECT max(tweets_count) FROM kpi_daily), 0) AS BIGINT) AS peak_tweets""")

_RANGE = "kpi_range AS (SELECT * FROM kpi_daily WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21')"
CTE["kpi_range"] = _RANGE
DEPS["kpi_range"] = ["kpi_daily"]
for _name in ("report_totals", "report_peak_day"):
    SQL[f"{_name}_range"] = with_ctes(["kpi_range"], SQL[_name].rsplit("FROM days GROUP BY day)", 1)[1].replace(
        "kpi_daily", "kpi_range"))
SQL["report_daily_series_range"] = with_ctes(["kpi_range"], """
SELECT date, tweets_count, engagement_sum FROM kpi_range ORDER BY date""")
SQL["csv_scan"] = with_ctes(["ingest"], "SELECT id, date, content, lang, url FROM ingest")
SQL["csv_first_read"] = with_ctes(["posts_raw"], rf"""
, once AS (SELECT DISTINCT id, date, content, lang, url FROM posts_raw WHERE lang = 'en'),
copies AS (SELECT id, TRY_CAST(date AS TIMESTAMP) AS date, 'copy ' || k || chr(10) || content AS content, lang, url,
                  md5(k || ':' || id) AS draw FROM once, range(3) r(k)),
filtered AS (SELECT * REPLACE (coalesce({_STRIP}, 'nan') AS content) FROM copies WHERE {_STRIP} IS NULL OR length({_STRIP}) > 5)
SELECT id, date, CASE WHEN length(content) > 5 THEN content END AS content, lang, url FROM filtered
WHERE length(content) > 5 QUALIFY row_number() OVER (PARTITION BY id ORDER BY draw) = 1""")
SQL["report_date_range"] = with_ctes(["kpi_daily"], "SELECT min(date) AS min_date, max(date) AS max_date FROM kpi_daily")

SQL["report_daily_series"] = with_ctes(["kpi_daily"], """
SELECT date, tweets_count, engagement_sum FROM kpi_daily ORDER BY date""")

# The test tables hold four languages; the Spark side discovers them from the data.
SQL["report_lang_pivot"] = with_ctes(["kpi_daily_lang"], """
SELECT date, """ + ", ".join(
    f"CAST(sum(CASE WHEN lang = '{lg}' THEN tweets_count ELSE 0 END) AS BIGINT) AS {lg}" for lg in ("de", "en", "es", "fr"))
    + """
FROM kpi_daily_lang WHERE lang IS NOT NULL GROUP BY date""")

SQL["report_hashtag_stats"] = with_ctes(["hashtag_uses"], """
, per_tag AS (SELECT hashtag, count(*) AS tweets_count FROM hashtag_uses GROUP BY hashtag)
SELECT (SELECT count(*) FROM per_tag) AS distinct_hashtags,
       (SELECT CAST(coalesce(sum(tweets_count), 0) AS BIGINT) FROM per_tag) AS hashtag_uses,
       (SELECT count(DISTINCT id) FROM hashtag_uses) AS posts_with_hashtag,
       (SELECT hashtag FROM per_tag ORDER BY tweets_count DESC, hashtag LIMIT 1) AS top_hashtag,
       CAST(coalesce((SELECT max(tweets_count) FROM per_tag), 0) AS BIGINT) AS top_hashtag_tweets""")

SQL["report_top_user"] = with_ctes(["kpi_users"], """
SELECT (SELECT username FROM kpi_users ORDER BY engagement_sum DESC, username LIMIT 1) AS top_user,
       (SELECT engagement_sum FROM kpi_users ORDER BY engagement_sum DESC, username LIMIT 1) AS top_user_engagement""")


def _top(table: str, measure: str, key: str, n: int) -> str:
    return with_ctes([table], f"""
SELECT *, CAST(row_number() OVER (ORDER BY {measure} DESC, {key}) AS INTEGER) AS rank
FROM {table} ORDER BY {measure} DESC, {key} LIMIT {n}""")


SQL["top_hashtags_by_count"] = _top("kpi_hashtags", "tweets_count", "hashtag", 20)
SQL["top_hashtags_by_engagement"] = _top("kpi_hashtags", "engagement_sum", "hashtag", 20)
SQL["top_users_by_engagement"] = _top("kpi_users", "engagement_sum", "username", 20)
SQL["top_users_table"] = _top("kpi_users", "engagement_sum", "username", 100)


# --- graph -----------------------------------------------------------------------------------------------------

CTE["graph"] = r"""
authored AS (SELECT * FROM posts_clean WHERE username IS NOT NULL AND username <> ''),
edges_mention AS (
  SELECT source_user, target_user, 'mention' AS type, CAST(1 AS BIGINT) AS weight
  FROM (SELECT username AS source_user, unnest(mentions_array) AS target_user FROM authored)
  WHERE target_user IS NOT NULL AND target_user <> ''),
edges_reply AS (
  SELECT r.username AS source_user, o.username AS target_user, 'reply' AS type, count(*) AS weight
  FROM authored r JOIN authored o ON r.inReplyToTweetId = o.id GROUP BY r.username, o.username),
user_edges AS (
  SELECT source_user, target_user, type, CAST(sum(weight) AS BIGINT) AS weight
  FROM (SELECT * FROM edges_mention UNION ALL SELECT * FROM edges_reply) GROUP BY source_user, target_user, type),
graph_nodes AS (
  SELECT username FROM authored
  UNION SELECT m FROM (SELECT unnest(mentions_array) AS m FROM posts_clean) WHERE m IS NOT NULL AND m <> ''),
user_nodes AS (
  SELECT n.username, k.tweets_count, k.engagement_sum FROM graph_nodes n LEFT JOIN kpi_users k USING (username)),
ec AS (
  SELECT source_user, target_user, CAST(sum(weight) AS BIGINT) AS weight, min(type) AS type
  FROM user_edges GROUP BY source_user, target_user),
verts AS (SELECT username FROM user_nodes UNION SELECT source_user FROM ec UNION SELECT target_user FROM ec),
degrees AS (
  SELECT v.username, coalesce(i.w, 0.0) AS in_degree, coalesce(o.w, 0.0) AS out_degree,
         coalesce(i.w, 0.0) + coalesce(o.w, 0.0) AS degree
  FROM verts v
  LEFT JOIN (SELECT target_user AS u, CAST(sum(weight) AS DOUBLE) AS w FROM ec GROUP BY target_user) i ON v.username = i.u
  LEFT JOIN (SELECT source_user AS u, CAST(sum(weight) AS DOUBLE) AS w FROM ec GROUP BY source_user) o ON v.username = o.u),
ud AS (SELECT DISTINCT least(source_user, target_user) AS a, greatest(source_user, target_user) AS b FROM ec)"""
DEPS["graph"] = ["posts_clean", "kpi_users"]


def _pagerank_ctes(rounds: int, alpha: float = 0.85) -> str:
    """PageRank unrolled into ``rounds`` materialised CTEs ``pr0 .. pr<rounds>``."""
    parts = [r"""ow AS (SELECT source_user AS src, CAST(sum(weight) AS DOUBLE) AS w FROM ec GROUP BY source_user),
ne AS (SELECT e.source_user AS src, e.target_user AS dst, CAST(e.weight AS DOUBLE) / ow.w AS p
       FROM ec e JOIN ow ON e.source_user = ow.src),
vd AS (SELECT v.username, ow.src IS NULL AS dangling FROM verts v LEFT JOIN ow ON v.username = ow.src),
nv AS (SELECT count(*) AS n FROM vd),
pr0 AS MATERIALIZED (SELECT username, dangling, CAST(1.0 AS DOUBLE) / (SELECT n FROM nv) AS rank FROM vd)"""]
    a, t = repr(float(alpha)), repr(float(1.0 - alpha))
    for k in range(1, rounds + 1):
        parts.append(f"""pr{k} AS MATERIALIZED (
  SELECT vd.username, vd.dangling,
    CAST({a} AS DOUBLE) * (coalesce(c.c, 0.0)
      + (SELECT coalesce(sum(rank), 0.0) FROM pr{k - 1} WHERE dangling) / (SELECT n FROM nv))
    + CAST({t} AS DOUBLE) / (SELECT n FROM nv) AS rank
  FROM vd LEFT JOIN (SELECT ne.dst, sum(p.rank * ne.p) AS c FROM ne JOIN pr{k - 1} p ON ne.src = p.username
                     GROUP BY ne.dst) c ON vd.username = c.dst)""")
    return ",\n".join(parts)


def _lp_ctes(rounds: int) -> str:
    """Label propagation unrolled into ``lp0 .. lp<rounds>``, then dense community ids in ``comm``.

    A stable labelling stays as it is, so rounds beyond the last change are no-ops; were ``rounds`` too few, the
    result would differ from the plan's, which runs until nothing changes.
    """
    parts = ["""nb AS (SELECT a AS node, b AS nbr FROM ud UNION ALL SELECT b, a FROM ud WHERE a <> b),
lp0 AS MATERIALIZED (SELECT username, username AS label FROM verts)"""]
    for k in range(rounds):
        parts.append(f"""want{k} AS MATERIALIZED (
  SELECT w.node, l.label AS own, w.label AS target, md5('{k}:' || w.label) || w.label AS wish FROM (
    SELECT node, label, row_number() OVER (PARTITION BY node ORDER BY cnt DESC, is_own DESC, label DESC) AS rn
    FROM (SELECT node, label, sum(c) AS cnt, max(is_own) AS is_own FROM (
            SELECT nb.node, l.label, 1 AS c, false AS is_own FROM nb JOIN lp{k} l ON nb.nbr = l.username
            UNION ALL SELECT username, label, 0, true FROM lp{k}) GROUP BY node, label)) w
  JOIN lp{k} l ON w.node = l.username WHERE w.rn = 1),
go{k} AS MATERIALIZED (
  SELECT m.node, m.target FROM want{k} m
  LEFT JOIN (SELECT nb.node, max(o.wish) AS wish FROM nb JOIN want{k} o ON nb.nbr = o.node WHERE o.target <> o.own
             GROUP BY nb.node) x ON m.node = x.node
  WHERE m.target <> m.own AND (x.wish IS NULL OR m.wish >= x.wish)),
lp{k + 1} AS MATERIALIZED (
  SELECT l.username, coalesce(g.target, l.label) AS label FROM lp{k} l LEFT JOIN go{k} g ON l.username = g.node)""")
    parts.append(f"""lp_first AS (SELECT label, min(username) AS first_member FROM lp{rounds} GROUP BY label),
comm AS (SELECT l.username, CAST(dense_rank() OVER (ORDER BY f.first_member) - 1 AS INTEGER) AS community_id
         FROM lp{rounds} l JOIN lp_first f USING (label))""")
    return ",\n".join(parts)


def _pagerank_converged_ctes(max_rounds: int = 40, tol: float = 1.0e-6) -> str:
    """Unrolled rounds plus ``pr_final``: the first round whose L1 change is below ``N * tol``."""
    errs = "\n  UNION ALL ".join(
        f"SELECT {k} AS k, sum(abs(a.rank - b.rank)) AS err FROM pr{k} a JOIN pr{k - 1} b USING (username)"
        for k in range(1, max_rounds + 1))
    finals = "\n  UNION ALL ".join(f"SELECT {k} AS k, username, rank FROM pr{k}" for k in range(1, max_rounds + 1))
    return _pagerank_ctes(max_rounds) + f""",
pr_err AS ({errs}),
pr_stop AS (SELECT coalesce(min(k), {max_rounds}) AS k FROM pr_err WHERE err < (SELECT n FROM nv) * {tol!r}),
pr_final AS (SELECT username, rank FROM ({finals}) WHERE k = (SELECT k FROM pr_stop))"""


CTE["pagerank_conv"] = _pagerank_converged_ctes()
DEPS["pagerank_conv"] = ["graph"]
CTE["lp"] = _lp_ctes(12)
DEPS["lp"] = ["graph"]
CTE["centrality"] = """cent AS (
  SELECT d.username, d.in_degree, d.out_degree, d.degree, round(coalesce(pr.rank, 0.0), 10) AS pagerank,
         coalesce(c.community_id, -1) AS community_id
  FROM degrees d LEFT JOIN pr_final pr USING (username) LEFT JOIN comm c USING (username))"""
DEPS["centrality"] = ["pagerank_conv", "lp"]

SQL["edges_mention"] = with_ctes(["graph"], "SELECT * FROM edges_mention")
SQL["edges_reply"] = with_ctes(["graph"], "SELECT * FROM edges_reply")
SQL["user_edges"] = with_ctes(["graph"], "SELECT * FROM user_edges")
SQL["user_nodes"] = with_ctes(["graph"], "SELECT * FROM user_nodes")
SQL["edges_collapsed"] = with_ctes(["graph"], "SELECT source_user, target_user, weight, type FROM ec")
SQL["degrees"] = with_ctes(["graph"], "SELECT * FROM degrees")
SQL["edges_with_author_kpis"] = with_ctes(["graph"], """
SELECT source_user, target_user, type, weight, tweets_count, engagement_sum
FROM user_edges JOIN user_nodes ON source_user = username""")
SQL["undirected_edges"] = with_ctes(["graph"], "SELECT a, b FROM ud")
SQL["pagerank"] = with_ctes(["pagerank_conv"], "SELECT username, round(rank, 8) AS pagerank FROM pr_final")
SQL["communities"] = with_ctes(["lp"], "SELECT username, community_id FROM comm")
SQL["user_centrality"] = with_ctes(["centrality"], "SELECT * FROM cent")


def _top_users(metric: str) -> str:
    return with_ctes(["centrality"], f"""
SELECT CAST(row_number() OVER (ORDER BY round({metric}, 10) DESC, username) AS INTEGER) AS rank,
       username, degree, in_degree, out_degree, pagerank, community_id
FROM cent ORDER BY round({metric}, 10) DESC, username LIMIT 20""")


SQL["top_users_by_degree"] = _top_users("degree")
SQL["top_users_by_in_degree"] = _top_users("in_degree")
SQL["top_users_by_pagerank"] = _top_users("pagerank")
SIZES_SQL = """
SELECT community_id, count(*) AS size FROM cent GROUP BY community_id"""
MEMBERS_SQL = """
, sizes AS (SELECT community_id, count(*) AS size FROM cent GROUP BY community_id),
tc AS (SELECT community_id, size, CAST(row_number() OVER (ORDER BY size DESC, community_id) AS INTEGER) AS community_rank
       FROM sizes ORDER BY size DESC, community_id LIMIT 5),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY community_id ORDER BY degree DESC, username) AS INTEGER)
                     AS member_rank FROM cent WHERE community_id IN (SELECT community_id FROM tc))
SELECT tc.community_rank, ranked.community_id, tc.size, ranked.member_rank, ranked.username, ranked.degree,
       ranked.in_degree, ranked.out_degree, ranked.pagerank
FROM ranked JOIN tc ON ranked.community_id = tc.community_id WHERE ranked.member_rank <= 10"""
SQL["community_sizes"] = with_ctes(["centrality"], SIZES_SQL)
SQL["community_top_members"] = with_ctes(["centrality"], MEMBERS_SQL)
#: The graph of every day's own users, its greedy colouring by independent sets, and label propagation colour by colour.
#: Both recursions carry the whole state from round to round and end by themselves.
CTE["day_graph"] = r"""
dp AS (
  SELECT id, inReplyToTweetId, CASE WHEN username <> '' THEN strftime(date, '%Y-%m-%d') || '/' || username END AS username,
         [CASE WHEN m <> '' THEN strftime(date, '%Y-%m-%d') || '/' || m END FOR m IN mentions_array] AS mentions
  FROM posts_clean),
da AS (SELECT * FROM dp WHERE username IS NOT NULL),
dm AS (SELECT DISTINCT m FROM (SELECT unnest(mentions) AS m FROM dp) WHERE m IS NOT NULL),
de AS (
  SELECT s, t, sum(w) AS w FROM (
    SELECT s, t, 1 AS w FROM (SELECT username AS s, unnest(mentions) AS t FROM da) WHERE t IS NOT NULL
    UNION ALL SELECT r.username, o.username, 1 FROM da r JOIN da o ON r.inReplyToTweetId = o.id) GROUP BY s, t),
dv AS MATERIALIZED (SELECT username FROM da UNION SELECT m FROM dm),
dnb AS MATERIALIZED (SELECT DISTINCT s AS node, t AS nbr FROM de UNION SELECT t, s FROM de),
drank AS MATERIALIZED (
  SELECT v.username, row_number() OVER (ORDER BY coalesce(n, 0) DESC, md5(v.username) DESC, v.username DESC) AS r
  FROM dv v LEFT JOIN (SELECT node, count(*) AS n FROM dnb WHERE node <> nbr GROUP BY node) d ON v.username = d.node),
jp AS (
  SELECT 0 AS round, username, r, CAST(NULL AS INTEGER) AS colour FROM drank
  UNION ALL
  SELECT j.round + 1, j.username, j.r,
    CASE WHEN j.colour IS NOT NULL THEN j.colour
         WHEN coalesce(x.ahead, 0) = 0 THEN
           [c FOR c IN range(0, len(coalesce(x.used, [])) + 1) IF NOT list_contains(coalesce(x.used, []), c)][1] END
  FROM jp j LEFT JOIN (
    SELECT nb.node, count(*) FILTER (o.colour IS NULL AND o.r < m.r) AS ahead, list(DISTINCT o.colour) AS used
    FROM dnb nb JOIN jp o ON nb.nbr = o.username JOIN jp m ON nb.node = m.username
    WHERE nb.node <> nb.nbr GROUP BY nb.node) x ON j.username = x.node
  WHERE (SELECT count(*) FROM jp WHERE colour IS NULL) > 0),
coloured AS MATERIALIZED (
  SELECT username, CAST(colour AS INTEGER) AS colour FROM jp WHERE round = (SELECT max(round) FROM jp)),
nc AS (SELECT max(colour) + 1 AS n FROM coloured)"""
DEPS["day_graph"] = ["posts_clean"]
CTE["day_comm"] = r"""
slp AS (
  SELECT 0 AS step, 0 AS quiet, username, colour, username AS label FROM coloured
  UNION ALL
  SELECT step + 1, CASE WHEN max(CASE WHEN new <> label THEN 1 ELSE 0 END) OVER () = 1 THEN 0 ELSE quiet + 1 END,
         username, colour, new
  FROM (
    SELECT l.*, coalesce(w.label, l.label) AS new FROM slp l LEFT JOIN (
      SELECT node, label FROM (
        SELECT node, label, sum(c) AS c, max(own) AS own FROM (
          SELECT nb.node, o.label, 1 AS c, 0 AS own FROM dnb nb JOIN slp o ON nb.nbr = o.username
          UNION ALL SELECT username, label, 0, 1 FROM slp) GROUP BY node, label)
      QUALIFY row_number() OVER (PARTITION BY node ORDER BY c DESC, own DESC, label DESC) = 1) w
    ON l.username = w.node AND l.colour = l.step % (SELECT n FROM nc))
  WHERE quiet < (SELECT n FROM nc)),
day_labels AS MATERIALIZED (SELECT username, label FROM slp WHERE step = (SELECT max(step) FROM slp)),
day_comm AS MATERIALIZED (
  SELECT username, CAST(dense_rank() OVER (ORDER BY f.first_member) - 1 AS INTEGER) AS community_id
  FROM day_labels JOIN (SELECT label, min(username) AS first_member FROM day_labels GROUP BY label) f USING (label)),
cent AS (
  SELECT c.username, coalesce(i.w, 0.0) AS in_degree, coalesce(o.w, 0.0) AS out_degree,
         coalesce(i.w, 0.0) + coalesce(o.w, 0.0) AS degree, CAST(0.0 AS DOUBLE) AS pagerank, community_id
  FROM day_comm c LEFT JOIN (SELECT t, CAST(sum(w) AS DOUBLE) AS w FROM de GROUP BY t) i ON c.username = i.t
  LEFT JOIN (SELECT s, CAST(sum(w) AS DOUBLE) AS w FROM de GROUP BY s) o ON c.username = o.s)"""
DEPS["day_comm"] = ["day_graph"]


def _recursive(needs: list[str], final: str) -> str:
    return with_ctes(needs, final).replace("WITH ", "WITH RECURSIVE ", 1)


SQL["day_user_colours"] = _recursive(["day_graph"], "SELECT username, colour FROM coloured")
SQL["day_communities"] = _recursive(["day_comm"], "SELECT username, community_id FROM day_comm")
SQL["day_community_sizes"] = _recursive(["day_comm"], SIZES_SQL)
SQL["day_community_top_members"] = _recursive(["day_comm"], MEMBERS_SQL)
CTE["subgraph"] = """sub_nodes AS (
  SELECT username, degree, in_degree, out_degree, pagerank, CAST(community_id AS BIGINT) AS community_id
  FROM cent ORDER BY degree DESC, username LIMIT 100)"""
DEPS["subgraph"] = ["centrality"]
SQL["subgraph_nodes"] = with_ctes(["subgraph"], "SELECT * FROM sub_nodes")
SQL["subgraph_edges"] = with_ctes(["subgraph"], """
SELECT source_user AS source, target_user AS target, CAST(sum(weight) AS DOUBLE) AS weight, min(type) AS type
FROM user_edges WHERE source_user IN (SELECT username FROM sub_nodes) AND target_user IN (SELECT username FROM sub_nodes)
GROUP BY source_user, target_user""")
SQL["dataset_counts"] = with_ctes(["graph", "kpi_daily", "kpi_daily_lang", "kpi_hashtags"], """
SELECT 'posts_raw' AS dataset, count(*) AS row_count FROM posts_raw
UNION ALL SELECT 'posts_clean', count(*) FROM posts_clean
UNION ALL SELECT 'kpi_daily', count(*) FROM kpi_daily
UNION ALL SELECT 'kpi_daily_lang', count(*) FROM kpi_daily_lang
UNION ALL SELECT 'kpi_hashtags', count(*) FROM kpi_hashtags
UNION ALL SELECT 'kpi_users', count(*) FROM kpi_users
UNION ALL SELECT 'user_edges', count(*) FROM user_edges
UNION ALL SELECT 'user_nodes', count(*) FROM user_nodes""")


# --- text, topics, sentiment -----------------------------------------------------------------------------------

def _stop_words_sql() -> str:
    from plume.operators.text import stop_words
    return ", ".join("'" + w.replace("'", "''") + "'" for w in stop_words())


def _clean_sql(x: str) -> str:
    t = f"lower(coalesce({x}, ''))"
    t = f"regexp_replace({t}, 'http\\S+|www\\.\\S+', ' ', 'g')"
    t = f"regexp_replace({t}, '@[a-z0-9_]+', ' ', 'g')"
    t = f"regexp_replace({t}, '#[a-z0-9_]+', ' ', 'g')"
    t = f"regexp_replace({t}, '[^a-z\\s]', ' ', 'g')"
    t = f"regexp_replace({t}, '\\s+', ' ', 'g')"
    return f"trim({t})"


def _tokens_sql(text: str) -> str:
    """Tokens of a normalised text: words of 2+ characters that are not stop words."""
    return (f"list_filter(string_split({text}, ' '), lambda w: length(w) >= 2 "
            f"AND NOT list_contains(stop_list, w))")


def _bigrams_sql(toks: str) -> str:
    return f"list_transform(range(1, len({toks})), lambda i: {toks}[i] || ' ' || {toks}[i + 1])"


CTE["stop"] = f"stop AS (SELECT [{_stop_words_sql()}] AS stop_list)"
DEPS["stop"] = []

CTE["topic_corpus"] = f"""
topic_corpus AS (
  SELECT id, {_tokens_sql('tc')} AS tokens
  FROM (SELECT id, {_clean_sql('content')} AS tc FROM posts_clean WHERE content IS NOT NULL AND lang = 'en'), stop)"""
DEPS["topic_corpus"] = ["posts_clean", "stop"]

CTE["labelled"] = f"""
labelled AS (
  SELECT l.doc_id AS id, d.source AS topic,
    CASE WHEN d.source = 'src1' THEN NULL WHEN d.source = 'src0' THEN 'Irrelevant'
         WHEN l.quality + l.toxic = 0 THEN 'Negative' WHEN l.quality + l.toxic = 1 THEN 'Neutral'
         ELSE 'Positive' END AS sentiment, d.text
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
prep AS (
  SELECT * FROM (
    SELECT id, topic, sentiment,
      CAST(CASE sentiment WHEN 'Negative' THEN 0 WHEN 'Neutral' THEN 1 WHEN 'Positive' THEN 2 END AS INTEGER) AS label,
      text, {_clean_sql('text')} AS text_clean
    FROM labelled WHERE sentiment IN ('Negative', 'Neutral', 'Positive')) WHERE length(text_clean) > 0),
split AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5('42-' || CAST(id AS VARCHAR)), id)
                      <= round(0.2 * count(*) OVER (PARTITION BY label)) THEN 'test' ELSE 'train' END AS split
  FROM prep)"""
DEPS["labelled"] = []

CTE["lexicon"] = f"""
lex_docs AS (SELECT id, label, list_distinct({_tokens_sql('text_clean')}) AS toks FROM split, stop WHERE split = 'train'),
lex_n AS (SELECT word, count(*) AS n, CAST(sum(label - 1) AS BIGINT) AS s
          FROM (SELECT id, label, unnest(toks) AS word FROM lex_docs) GROUP BY word),
lexicon AS (SELECT word, sign(s) * ((20000 * abs(s) + n) // (2 * n)) AS e4 FROM lex_n WHERE n >= 10),
test_docs AS (SELECT id, label, {_tokens_sql('text_clean')} AS toks FROM split, stop WHERE split = 'test'),
lex_hits AS (SELECT t.id, sum(x.e4) AS e4, count(*) AS n
             FROM (SELECT id, unnest(toks) AS word FROM test_docs) t JOIN lexicon x ON t.word = x.word GROUP BY t.id),
lex_pred AS (
  SELECT d.id, d.label,
    CASE WHEN coalesce(h.n, 0) > 0 THEN CAST(h.e4 AS DOUBLE) / h.n / 10000.0 ELSE 0.0 END AS score,
    CASE WHEN coalesce(h.n, 0) > 0 AND h.e4 * 20 <= -10000 * h.n THEN 'Negative'
         WHEN coalesce(h.n, 0) > 0 AND h.e4 * 20 >= 10000 * h.n THEN 'Positive' ELSE 'Neutral' END AS pred_label
  FROM test_docs d LEFT JOIN lex_hits h ON d.id = h.id),
preds AS (SELECT *, CAST(CASE pred_label WHEN 'Negative' THEN 0 WHEN 'Neutral' THEN 1 WHEN 'Positive' THEN 2 END
                         AS INTEGER) AS pred FROM lex_pred),
classes AS (SELECT * FROM (VALUES (0, 'Negative'), (1, 'Neutral'), (2, 'Positive')) v(cls, class))"""
DEPS["lexicon"] = ["labelled", "stop"]

SQL["text_clean"] = with_ctes(["posts_clean"], f"""
SELECT id, text_clean FROM (SELECT id, {_clean_sql('content')} AS text_clean FROM posts_clean WHERE lang = 'en')
WHERE length(text_clean) > 0""")


def _term_stats_sql(docs: str, toks: str) -> str:
    return f"""(SELECT term, CAST(sum(tf) AS BIGINT) AS term_freq, CAST(sum(df) AS BIGINT) AS doc_freq FROM (
      SELECT unnest({toks}) AS term, 1 AS tf, 0 AS df FROM {docs}
      UNION ALL SELECT unnest(list_distinct({toks})), 0, 1 FROM {docs}) GROUP BY term)"""


SQL["term_counts"] = with_ctes(["topic_corpus"], f"""
, stats AS {_term_stats_sql('topic_corpus', 'tokens')},
kept AS (SELECT * FROM stats WHERE doc_freq >= 10
         AND doc_freq <= CAST(0.9 AS DOUBLE) * (SELECT count(*) FROM topic_corpus)
         ORDER BY term_freq DESC, term LIMIT 5000)
SELECT term, term_freq, doc_freq,
       CAST(row_number() OVER (ORDER BY term_freq DESC, term) - 1 AS INTEGER) AS term_index FROM kept""")

SQL["tfidf_terms"] = with_ctes(["labelled", "stop"], f"""
, tr AS (SELECT {_tokens_sql('text_clean')} AS t1 FROM split, stop WHERE split = 'train'),
tr2 AS (SELECT list_concat(t1, {_bigrams_sql('t1')}) AS toks FROM tr),
stats AS {_term_stats_sql('tr2', 'toks')},
kept AS (SELECT * FROM stats ORDER BY term_freq DESC, term LIMIT 20000)
SELECT term, term_freq, doc_freq,
       CAST(row_number() OVER (ORDER BY term_freq DESC, term) - 1 AS INTEGER) AS term_index,
       round(ln((1.0 + (SELECT count(*) FROM tr)) / (1.0 + doc_freq)) + 1.0, 9) AS idf FROM kept""")

SQL["label_audit"] = with_ctes(["labelled"], """
SELECT '*' AS "group", sentiment, count(*) AS count FROM labelled WHERE sentiment IS NOT NULL GROUP BY sentiment
UNION ALL SELECT topic, sentiment, count(*) FROM labelled WHERE sentiment IS NOT NULL GROUP BY topic, sentiment""")
SQL["label_prep"] = with_ctes(["labelled"], "SELECT id, topic, sentiment, label, text_clean FROM prep")
SQL["stratified_split"] = with_ctes(["labelled"], "SELECT id, sentiment, label, split FROM split")
SQL["lexicon_sentiment"] = with_ctes(["lexicon"], "SELECT id, label, score, pred_label, pred FROM preds")
_FACTOR = ("CASE {0} WHEN 'only' THEN -75 WHEN 'than' THEN -75 WHEN 'from' THEN -50 WHEN 'that' THEN 130 "
           "WHEN 'this' THEN 115 WHEN 'as' THEN 80 ELSE 100 END")
_FACTORS = " * ".join(f"CASE WHEN i > {k} THEN {_FACTOR.format(f'toks[i - {k}]')} ELSE 100 END" for k in (1, 2, 3))
SQL["valence_sentiment"] = with_ctes(["lexicon", "posts_clean"], f"""
, vt AS (SELECT id, [t FOR t IN string_split({_clean_sql('content')}, ' ') IF length(t) >= 2] AS toks
         FROM posts_clean WHERE lang = 'en'),
vh AS (SELECT p.id, sum(x.e4 * p.m) AS t
       FROM (SELECT id, toks[i] AS word, {_FACTORS} AS m
             FROM (SELECT id, toks, unnest(generate_series(1, len(toks))) AS i FROM vt)) p
       JOIN lexicon x ON p.word = x.word GROUP BY p.id),
vs AS (SELECT vt.id, CAST(coalesce(vh.t, 0) AS DOUBLE) / 10000000000.0 AS x FROM vt LEFT JOIN vh ON vt.id = vh.id),
vc AS (SELECT id, x / sqrt(x * x + 15.0) AS score FROM vs)
SELECT id, score, CASE WHEN score <= -0.05 THEN 'Negative' WHEN score >= 0.05 THEN 'Positive' ELSE 'Neutral' END AS pred_label,
  CAST(CASE WHEN score <= -0.05 THEN 0 WHEN score >= 0.05 THEN 2 ELSE 1 END AS INTEGER) AS pred FROM vc""")
SQL["eval_accuracy"] = with_ctes(["lexicon"], """
SELECT avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS support FROM preds""")
SQL["eval_confusion"] = with_ctes(["lexicon"], """
, counts AS (SELECT label, pred, count(*) AS c FROM preds GROUP BY label, pred),
grid AS (SELECT a.cls AS label, a.class AS true_class, b.cls AS pred, b.class AS pred_class
         FROM classes a JOIN classes b ON true),
g AS (SELECT grid.*, coalesce(counts.c, 0) AS count FROM grid LEFT JOIN counts USING (label, pred))
SELECT true_class, pred_class, CAST(count AS BIGINT) AS count,
       CASE WHEN sum(count) OVER (PARTITION BY label) > 0
            THEN CAST(count AS DOUBLE) / sum(count) OVER (PARTITION BY label) ELSE 0.0 END AS share
FROM g""")
SQL["eval_report"] = with_ctes(["lexicon"], """
, st AS (SELECT c.class, coalesce(s.support, 0) AS support, coalesce(s.tp, 0) AS tp, coalesce(p.predicted, 0) AS predicted
         FROM classes c
         LEFT JOIN (SELECT label AS cls, count(*) AS support, sum(CASE WHEN label = pred THEN 1 ELSE 0 END) AS tp
                    FROM preds GROUP BY label) s ON c.cls = s.cls
         LEFT JOIN (SELECT pred AS cls, count(*) AS predicted FROM preds GROUP BY pred) p ON c.cls = p.cls),
pr AS (SELECT class, CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0 END AS recall, support FROM st),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
             CASE WHEN sum(support) OVER () > 0 THEN CAST(support AS DOUBLE) / sum(support) OVER () ELSE 0.0 END AS w
      FROM pr)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
       CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9),
                 CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * w), 9), round(sum(recall * w), 9), round(sum(f1 * w), 9),
                 CAST(sum(support) AS BIGINT) FROM f""")


# --- the reports of the models over derived columns ------------------------------------------------------------

def _judged_sql(wrong_every: int) -> str:
    return (f"(SELECT doc_id AS id, quality + toxic AS label, CAST((quality + toxic + CASE WHEN doc_id % {wrong_every} = 0 "
            "THEN 1 ELSE 0 END) % 3 AS INTEGER) AS pred FROM labels)")


_LABELS = ", ".join(f"({k}, '{v}')" for k, v in TOPIC_LABELS.items())
SQL["topic_share_by_id"] = f"""
WITH c AS (SELECT CAST(doc_id % 9 AS INTEGER) AS topic, count(*) AS count FROM documents GROUP BY 1)
SELECT topic, coalesce(l.label, '{UNKNOWN_TOPIC}') AS label, count,
       round(100.0 * count / (SELECT sum(count) FROM c), 1) AS percent
FROM c LEFT JOIN (VALUES {_LABELS}) l(id, label) ON c.topic = l.id ORDER BY count DESC, topic"""
SQL["sentiment_distribution_by_id"] = f"""
SELECT CASE pred WHEN 0 THEN 'Negative' WHEN 1 THEN 'Neutral' ELSE 'Positive' END AS sentiment_label, count(*) AS count
FROM {_judged_sql(5)} GROUP BY 1 ORDER BY 2 DESC, 1"""
SQL["classifier_agreement_by_id"] = f"""
SELECT avg(CASE WHEN a.pred = b.pred THEN 1.0 ELSE 0.0 END) AS agreement, count(*) AS compared
FROM {_judged_sql(5)} a JOIN {_judged_sql(7)} b USING (id)"""
SQL["eval_report_by_id"] = (f"WITH preds AS {_judged_sql(5)}, classes AS (SELECT * FROM (VALUES (0, 'Negative'), "
                            "(1, 'Neutral'), (2, 'Positive')) v(cls, class))\n"
                            + SQL["eval_report"][SQL["eval_report"].rindex(", st AS ("):])

SQL["label_audit_files"] = with_ctes(["labelled"], """
, f AS (SELECT CASE WHEN id % 3 = 0 THEN 'validation' ELSE 'training' END AS file, sentiment FROM labelled
        WHERE sentiment IS NOT NULL)
SELECT '*' AS "group", sentiment, count(*) AS count FROM f GROUP BY sentiment
UNION ALL SELECT file, sentiment, count(*) FROM f GROUP BY file, sentiment""")
SQL["lexicon_sentiment_given"] = with_ctes(["topic_corpus"], """
, lex AS (SELECT * FROM (VALUES ('er', 5000), ('es', -5000), ('th', 500), ('en', -500), ('ed', 3000), ('nt', -3000),
                                ('st', 8000), ('ti', -8000), ('ha', 0), ('ly', 1000)) v(word, e4)),
h AS (SELECT t.id, sum(x.e4) AS e4, count(*) AS n FROM (SELECT id, unnest(tokens) AS word FROM topic_corpus) t
      JOIN lex x ON t.word = x.word GROUP BY t.id),
p AS (SELECT d.id, CASE WHEN coalesce(h.n, 0) > 0 THEN CAST(h.e4 AS DOUBLE) / h.n / 10000.0 ELSE 0.0 END AS score,
        CASE WHEN coalesce(h.n, 0) > 0 AND h.e4 * 20 <= -10000 * h.n THEN 'Negative'
             WHEN coalesce(h.n, 0) > 0 AND h.e4 * 20 >= 10000 * h.n THEN 'Positive' ELSE 'Neutral' END AS pred_label
      FROM topic_corpus d LEFT JOIN h ON d.id = h.id)
SELECT *, CAST(CASE pred_label WHEN 'Negative' THEN 0 WHEN 'Neutral' THEN 1 ELSE 2 END AS INTEGER) AS pred FROM p""")
