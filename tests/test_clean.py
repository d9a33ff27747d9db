import json

from pyspark.sql import functions as F

from table_rows import rows
from plume.functions.columns import hashtags_array, mentions_array, username_from_user
from plume.operators import clean as C
from plume.schemas import POSTS_RAW
from plume.sources.messages import encode_messages, parse_messages


def raw_post(**kw):
    base = {c.name: None for c in POSTS_RAW.fields}
    base.update(kw)
    return base


def raw_df(spark, posts):
    return spark.createDataFrame([tuple(p[c.name] for c in POSTS_RAW.fields) for p in posts], POSTS_RAW)


def test_casts_become_null_not_errors(spark):
    df = spark.createDataFrame([("1", "2024-01-02 03:04:05", "x"), ("abc", "not a date", "99999999999")],
                               "id string, date string, replyCount string")
    df = df.select("id", "date", "replyCount", *[F.lit(None).cast("string").alias(c) for c in
                   ["content", "lang", "retweetCount", "likeCount", "quoteCount", "conversationId", "inReplyToTweetId",
                    "user", "mentionedUsers", "hashtags", "url"]])
    out = {r["id"]: r for r in C.typed_posts(df).collect()}
    assert out[1]["date"] is not None and out[1]["replyCount"] is None
    assert out[None]["date"] is None and out[None]["replyCount"] is None  # int overflow -> null


def test_username_extraction(spark):
    df = spark.createDataFrame([(None,), ("",), ("{'name': 'x'}",), ("{'username': 'a', 'x': {'username': 'b'}}",)],
                               "user string")
    got = [r[0] for r in df.select(username_from_user("user")).collect()]
    assert got == [None, "", "", "a"]


def test_hashtags_array(spark):
    cases = [(None, []), ("", []), ("[]", []), ("['a']", ["a"]), ("['a', 'A']", ["a", "A"]),
             ("['a', 'a']", ["a", "a"]), (" [ 'x y' ,`z`] ", ["xy", "z"])]
    df = spark.createDataFrame([(c,) for c, _ in cases], "h string")
    got = [r[0] for r in df.select(hashtags_array("h")).collect()]
    assert got == [e for _, e in cases]


MENTION_CASES = [
    (None, []), ("", []), ("[]", []),
    ("{'username': 'solo'}", ["solo"]),
    ("[{'username': 'a', 'id': 1}, {'username': 'b'}]", ["a", "b"]),
    ("[{'username': ''}, {'username': None}, {'id': 3}, {'username': 'c'}]", ["c"]),
    ("[User(username='a'), {'username': 'b'}]", []),
    ("free text 'username': 'x'", []),
    ("[{'username': 'a'}", []),
    ("{'username': 'doc', 'displayname': 'Dr(PhD)'}", ["doc"]),
    ('{"username": "bob"}', ["bob"]),
    ("{'username':'bob'}", ["bob"]),
    ("""[{'username': 'a', 'bio': "'username': 'eve'"}]""", ["a"]),
    (r"""[{'bio': 'it\'s [odd] {text}', 'username': 'o\'neil'}]""", ["o'neil"]),
    ("[{'user': {'username': 'inner'}, 'username': 'outer'}]", ["outer"]),
    ("[{'tags': [{'username': 'inner'}], 'username': 'x', 'n': 1.5, 'ok': True}]", ["x"]),
    ("[{'username': 'a'}, User('b')]", []),
    ("[{'username': 'a', 'text': '" + "x" * 50_000 + "'}]", ["a"]),
]


def test_mentions(spark):
    df = spark.createDataFrame([(c,) for c, _ in MENTION_CASES], "m string")
    assert [r[0] for r in df.select(mentions_array("m")).collect()] == [e for _, e in MENTION_CASES]


def test_ingest_keeps_the_latest_of_differing_copies(spark):
    posts = [raw_post(id=1, content="first text", lang="en", date="2024-01-01 00:00:00"),
             raw_post(id=1, content="later text", lang="en", date="2024-01-02 00:00:00"),
             raw_post(id=2, content="text aaaa", lang="en", date="2024-01-01 00:00:00"),
             raw_post(id=2, content="text bbbb", lang="en", date="2024-01-01 00:00:00"),
             raw_post(id=2, content="text cccc", lang="en", date=None)]
    got = {r["id"]: r["content"] for r in C.ingest_filter(raw_df(spark, posts)).collect()}
    assert got == {1: "later text", 2: "text bbbb"}


def test_dedup_prefers_text_then_latest(spark):
    posts = [raw_post(id=1, date="2024-01-01 00:00:00", content=None, user="{'username': 'u'}"),
             raw_post(id=1, date="2024-01-02 00:00:00", content="older text", user="{'username': 'u'}"),
             raw_post(id=2, date="2024-01-01 00:00:00", content="a", replyCount=1),
             raw_post(id=2, date="2024-01-03 00:00:00", content="b", replyCount=2),
             raw_post(id=3, date="2024-01-01 00:00:00", content="same"),
             raw_post(id=3, date="2024-01-01 00:00:00", content="same")]
    out = {r["id"]: r for r in C.clean_posts(raw_df(spark, posts)).collect()}
    assert out[1]["content"] == "older text"
    assert out[2]["content"] == "b" and out[2]["engagement"] == 2
    assert len(out) == 3


def test_engagement_null_safe(spark):
    posts = [raw_post(id=1, content="x", replyCount=1, retweetCount=None, likeCount=3, quoteCount=None)]
    assert C.clean_posts(raw_df(spark, posts)).first()["engagement"] == 4


def test_ingest_filter(spark):
    posts = [raw_post(id=1, content="12345", lang="en"), raw_post(id=2, content="123456", lang="en"),
             raw_post(id=3, content="   123456\t ", lang="en"), raw_post(id=4, content=None, lang="en"),
             raw_post(id=5, content="long enough", lang="fr"), raw_post(id=6, content="long enough", lang="en",
                                                                        date="garbage")]
    out = {r["id"]: r for r in C.ingest_filter(raw_df(spark, posts)).collect()}
    assert sorted(out) == [2, 3, 6]
    assert out[3]["content"] == "123456" and out[6]["date"] is None
    funnel = dict((r["step"], r["row_count"]) for r in C.ingest_funnel(raw_df(spark, posts)).collect())
    assert funnel == {"read": 6, "after_lang": 5, "after_text": 3, "after_dedup": 3}


def test_message_round_trip_and_bad_input(spark):
    posts = [raw_post(id=7, date="2024-01-01 10:00:00", content='he said "hi"\nbye', replyCount=None, likeCount=2,
                      mentionedUsers="[]", lang="en")]
    typed = C.ingest_filter(raw_df(spark, posts), lang=None)
    msgs = encode_messages(typed)
    m = msgs.first()
    assert m["key"] == "7" and json.loads(m["value"])["replyCount"] == 0
    assert json.loads(m["value"])["date"] == "2024-01-01T10:00:00"
    back = parse_messages(msgs).first()
    assert back["content"] == 'he said "hi"\nbye' and back["engagement"] == 2
    bad = spark.createDataFrame([("not json",), ('{"id": 1, "replyCount": "x", "likeCount": 1.5, "user": {"a": 1}}',)],
                                "value string")
    got = parse_messages(bad).collect()
    assert all(v is None for v in got[0].asDict().values())
    assert got[1]["id"] == 1 and got[1]["replyCount"] is None and got[1]["likeCount"] is None
    assert got[1]["user"] == '{"a":1}' and got[1]["engagement"] is None


def test_rows_of_keys_that_repeat_nowhere_stay_where_they_are(spark, monkeypatch):
    rows_ = [(i if i % 7 else i % 3, i % 5 or None, f"text {i % 4}" if i % 6 else None) for i in range(300)]
    rows_ += [(None, 1, "x"), (None, 2, "y"), (None, 2, "y")]
    df = spark.createDataFrame(rows_, "id long, date int, content string").repartition(6)
    want = sorted(map(str, C.keep_best_per_key(df, "id", ["date", "content"]).collect()))
    best = {}
    for i, d, c in rows_:
        at = (d is not None, d or 0, c is not None, c or "")
        best[i] = max(best.get(i, at), at)
    assert len(want) == len(best)
    for words in (C.MARK_WORDS, 1):  # with one word of marks many keys share theirs
        monkeypatch.setattr(C, "MARK_WORDS", words)
        found = C.keep_best_per_key(df, "id", ["date", "content"], reread=True)
        assert sorted(map(str, found.collect())) == want
        got = {r["id"]: (r["date"] is not None, r["date"] or 0, r["content"] is not None, r["content"] or "")
               for r in found.collect()}
        assert got == best
    single = spark.range(40).select("id", F.lit(1).alias("date"), F.spark_partition_id().alias("at"))
    found = C.keep_best_per_key(single, "id", ["date"], reread=True).select("at", F.spark_partition_id().alias("now"))
    assert found.where("at != now").count() == 0  # unmarked rows keep the partition they were read in


def test_posts_of_one_language_are_those_of_all_posts(spark):
    posts = [raw_post(id=i % 40, date=f"2024-01-0{1 + i % 3} 00:00:00", lang=[None, "en", "fr", "en"][i % 4],
                      content=None if i % 9 == 0 else f"text {i % 6}", likeCount=i % 2) for i in range(150)]
    posts += [raw_post(id=None, content="x", lang="en"), raw_post(id=99, content="only", lang="en")]
    raw = raw_df(spark, posts + posts[:30]).repartition(5)
    cols = ["id", "content", "lang"]
    want = sorted(map(str, C.clean_posts(raw, cols).where("lang = 'en'").collect()))
    assert 10 < len(want) < 42
    for reread in (False, True):
        assert sorted(map(str, C.clean_posts(raw, cols, reread, lang="en").collect())) == want


def test_marks_grow_with_the_keys_that_repeat(spark, monkeypatch):
    monkeypatch.setattr(C, "KEYS_PER_WORD", 1)
    twice = spark.range(2000).select(F.col("id"), F.lit(1).alias("date"), F.lit(0).alias("at"))
    once = spark.range(10_000, 14_000).select("id", F.lit(1).alias("date"), F.lit(0).alias("at"))
    words = []
    mark = C._mark
    monkeypatch.setattr(C, "_mark", lambda key, n: words.append(n) or mark(key, n))
    for df in (once, twice.unionByName(twice).unionByName(once)):
        assert C.keep_best_per_key(df, "id", ["date"], reread=True).count() == df.distinct().count()
    assert words[0] <= 2 and words[1] >= 2000


def test_spread_posts_have_parts_of_bounded_size(spark, monkeypatch):
    from plume.sources import tables
    sf = "/root/testdata/sf0.001"
    n = tables.table(spark, sf, "events").count()
    monkeypatch.setattr(tables, "PART_POSTS", 50)
    plan = tables.posts_raw(spark, sf, spread=True)
    assert plan.where("false").count() == 0 and f"{-(-n // 50)}), REPARTITION_BY_NUM" in plan._jdf.queryExecution().toString().replace("\n", "")
