"""Driver contract: entry smoke, every query runs, and SQL-checked queries equal their DuckDB oracle (sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import __spark_entry__ as E  # noqa: E402
from oracle_check import digest, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
MODEL_SIDE = {"topic_assignments", "topic_words", "topic_share", "sentiment_scores", "sentiment_distribution",
              "eval_lr_report", "classifier_agreement"}
LIBRARY = sorted(set(E.oracle_sql()) - set(E._optional()[1]))  # the optional subpackage has tests of its own


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "tweets_count", "engagement_sum"] and df.count() > 0


def test_every_query_has_oracle_or_is_model_side():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert set(q) - set(s) - set(E._optional()[0]) <= MODEL_SIDE


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", LIBRARY)
def test_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.sql(E.oracle_sql()[name])
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows) == digest(res.columns, orows)
