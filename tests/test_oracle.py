"""Every query with SQL against DuckDB; the others must give rows."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from folkmeter.operators import relational

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    frame = entry.entry(spark)
    assert len(frame.columns) == 21
    assert frame.count() > 0


def test_column_counts(spark, sf_dir):
    assert len(QUERIES["post_features"](spark, sf_dir).columns) == 25
    assert len(QUERIES["comment_features"](spark, sf_dir).columns) == 27


SALTED = [
    "comment_features",
    "comments_denorm",
    "memberships",
    "new_first_limit",
    "post_features",
    "posts_denorm",
    "posts_with_comment_stats",
    "resolve_authors",
    "resolve_communities",
    "upsert_memberships",
    "user_features",
    "users_activity_left",
]


@pytest.mark.parametrize("name", SALTED)
def test_salted_joins_match_sql(spark, sf_dir, con, monkeypatch, name):
    """The same queries with nothing small enough for a broadcast and nearly every key heavy."""
    monkeypatch.setattr(relational, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(relational, "HOT_ROWS", 3)
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None
