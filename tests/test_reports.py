import datetime as dt

from table_rows import rows
from plume.operators import kpis as K
from plume.operators import reports as R

D = dt.date


def daily(spark, data):
    return spark.createDataFrame(data, "date date, tweets_count long, engagement_sum long")


def test_totals_peak_and_range(spark):
    d = daily(spark, [(D(2024, 1, 3), 5, 10), (D(2024, 1, 1), 5, 7), (D(2024, 1, 2), 1, 0)])
    t = R.totals(d).first()
    assert (t["total_tweets"], t["total_engagement"], t["days_covered"]) == (11, 17, 3)
    assert abs(t["avg_engagement"] - round(17 / 11, 6)) < 1e-12
    p = R.peak_day(d).first()
    assert p["peak_date"] == D(2024, 1, 1) and p["peak_tweets"] == 5  # earliest day on ties
    assert R.totals(d, "2024-01-02", "2024-01-02").first()["total_tweets"] == 1
    r = R.date_range(d).first()
    assert (r["min_date"], r["max_date"]) == (D(2024, 1, 1), D(2024, 1, 3))


def test_empty_inputs_keep_schema(spark):
    d = daily(spark, [])
    t = R.totals(d).first()
    assert (t["total_tweets"], t["avg_engagement"], t["days_covered"]) == (0, 0.0, 0)
    p = R.peak_day(d).first()
    assert p["peak_date"] is None and p["peak_tweets"] == 0
    assert R.daily_series(d).columns == ["date", "tweets_count", "engagement_sum"]


def test_top_n_ties_and_rank(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), ("c", 5), ("d", 1)], "hashtag string, tweets_count long")
    got = [(r["rank"], r["hashtag"]) for r in R.top_n(df, "tweets_count", "hashtag", 3).collect()]
    assert got == [(1, "c"), (2, "a"), (3, "b")]


def test_hashtag_stats_both_counts(spark):
    posts = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1), ["x", "y"], 1), (2, dt.datetime(2024, 1, 1), ["x", "x"], 1),
         (3, dt.datetime(2024, 1, 2), [], 1)],
        "id long, date timestamp, hashtags_array array<string>, engagement long")
    s = R.hashtag_stats(posts).first()
    assert (s["distinct_hashtags"], s["hashtag_uses"], s["posts_with_hashtag"]) == (2, 4, 2)
    assert (s["top_hashtag"], s["top_hashtag_tweets"]) == ("x", 3)
    assert rows(K.kpi_hashtags(posts)) == [("x", 3, 3), ("y", 1, 1)]  # engagement counted per use


def test_lang_pivot_fills_zero(spark):
    dl = spark.createDataFrame([(D(2024, 1, 1), "en", 2, 0), (D(2024, 1, 2), "fr", 1, 0), (D(2024, 1, 2), None, 9, 0)],
                               "date date, lang string, tweets_count long, engagement_sum long")
    p = R.lang_pivot(dl)
    assert p.columns == ["date", "en", "fr"]
    assert rows(p) == [(D(2024, 1, 1), 2, 0), (D(2024, 1, 2), 0, 1)]


def test_kpi_sums_agree(spark):
    posts = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 23, 59), "en", 3, "u"), (2, dt.datetime(2024, 1, 2), None, 4, ""),
         (3, None, "en", 5, "u")], "id long, date timestamp, lang string, engagement long, username string")
    kd, kl = K.kpi_daily(posts), K.kpi_daily_lang(posts)
    assert rows(kd) == [(D(2024, 1, 1), 1, 3), (D(2024, 1, 2), 1, 4)]
    assert sum(r["tweets_count"] for r in kl.collect()) == 2
    assert rows(K.kpi_users(posts)) == [("u", 1, 3)]
