"""Every dealt operator is registered once."""

from plume.llm.queries import QUERIES, SQL


def test_every_number_is_registered_once():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14)) and set(SQL) <= set(QUERIES)
