"""Registry of runnable queries with the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folkmeter.functions.scalars import WHITE_SPACE
from folkmeter.operators import cleaning, evaluation, features
from folkmeter.session import step_folder
from folkmeter.sources import proxies

DIGITS = 6  # doubles are rounded on both sides: sums depend on the order of rows


class Layer(dict):
    """Entity tables by name, each planned when it is first asked for."""

    def __init__(self, make: Callable[[str], DataFrame]):
        super().__init__()
        self.make = make

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.make(name)
        return self[name]


class Tables:
    """The given tables and the entity tables read out of them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return proxies.table(self.spark, self.sf_dir, name)

    def folder(self) -> str:
        """A new folder for tables written by one query."""
        return step_folder(self.spark)

    @cached_property
    def raw(self) -> Layer:
        return Layer(lambda n: getattr(proxies, n)(self.spark, self.sf_dir))

    @cached_property
    def silver(self) -> Layer:
        return Layer(lambda n: cleaning.clean(self.raw[n], n))

    users = property(lambda self: self.silver["users"])
    posts = property(lambda self: self.silver["posts"])
    comments = property(lambda self: self.silver["comments"])
    communities = property(lambda self: self.silver["communities"])

    @cached_property
    def user_features(self) -> DataFrame:
        return features.user_features(self.users, self.posts, self.comments)

    @cached_property
    def enriched(self) -> DataFrame:
        return features.users_enriched(self.users, self.posts, self.comments)

    @cached_property
    def predictions(self) -> DataFrame:
        return evaluation.line_predictions(self.users)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.round(c, DIGITS).alias(f.name) if isinstance(f.dataType, T.DoubleType) else c
            for f, c in ((f, F.col(f"`{f.name}`")) for f in df.schema)
        ]
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: str = ""):
    """Register a function of ``Tables`` under ``name``, with its SQL if there is one."""

    def register(function: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: rounded(function(Tables(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = with_tables(sql, ctes)
        return function

    return register


# --- the same tables in SQL ---------------------------------------------------------

WS_SQL = "||".join(f"chr({ord(c)})" for c in WHITE_SPACE)


def _last(source: str, key: str, columns: str, name_filter: bool = False) -> str:
    """Keep-last in SQL; ``columns`` are the cleaned ones in table order."""
    names = [c.split()[-1] for c in columns.split(";")]
    rest = [c for c in names if c not in (key, "scraped_at")]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["scraped_at", *rest])
    cleaned = ", ".join(columns.split(";"))
    blank = " AND length(name) > 0" if name_filter else ""
    return (
        f"SELECT {', '.join(names)} FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
        f"ORDER BY {order}) AS rn FROM (SELECT {cleaned} FROM {source}) c) r WHERE rn = 1{blank}"
    )


def _trim(column: str, fill: bool) -> str:
    bare = f"trim({column}, {WS_SQL})"
    return f"coalesce({bare}, '') AS {column}" if fill else f"{bare} AS {column}"


def _zero(column: str) -> str:
    return f"coalesce({column}, 0) AS {column}"


BASE = {
    "raw_users": """
        SELECT CAST(c_custkey AS VARCHAR) AS id_user, c_name AS name,
               CAST(floor(c_acctbal) AS BIGINT) AS karma,
               CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN ''
                    ELSE c_mktsegment END AS description,
               CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS human_owner,
               CAST(NULL AS VARCHAR) AS joined,
               c_custkey % 97 AS followers, c_custkey % 13 AS following,
               '2024-01-01T00:00:00' AS scraped_at
        FROM customer""",
    "raw_posts": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id_post, CAST(o_custkey AS VARCHAR) AS id_user,
               CAST(o_custkey % 30 AS VARCHAR) AS id_community, o_orderpriority AS title,
               CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS description,
               CAST(floor(o_totalprice / 1000) AS BIGINT) AS rating,
               strftime(o_orderdate, '%Y-%m-%d') AS date,
               strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00' AS scraped_at
        FROM orders""",
    "raw_comments": """
        SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id_comment,
               CAST(l_partkey AS VARCHAR) AS id_user, CAST(l_orderkey AS VARCHAR) AS id_post,
               l_returnflag || ' ' || l_linestatus AS description,
               CAST(floor(l_quantity) AS BIGINT) AS rating,
               strftime(l_shipdate, '%Y-%m-%d') AS date,
               strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00' AS scraped_at
        FROM lineitem""",
    "raw_communities": """
        SELECT CAST(n_nationkey AS VARCHAR) AS id_community, n_name AS name,
               CAST(NULL AS VARCHAR) AS description, '2024-01-01T00:00:00' AS scraped_at
        FROM nation""",
    "users": _last(
        "raw_users",
        "id_user",
        ";".join(
            [
                "id_user",
                _trim("name", False),
                _zero("karma"),
                _trim("description", True),
                _trim("human_owner", False),
                _trim("joined", False),
                _zero("followers"),
                _zero("following"),
                "scraped_at",
            ]
        ),
        True,
    ),
    "posts": _last(
        "raw_posts",
        "id_post",
        ";".join(
            [
                "id_post",
                "id_user",
                "id_community",
                _trim("title", True),
                _trim("description", True),
                _zero("rating"),
                "date",
                "scraped_at",
            ]
        ),
    ),
    "comments": _last(
        "raw_comments",
        "id_comment",
        ";".join(
            [
                "id_comment",
                "id_user",
                "id_post",
                _trim("description", True),
                _zero("rating"),
                "date",
                "scraped_at",
            ]
        ),
    ),
    "communities": _last(
        "raw_communities",
        "id_community",
        ";".join(["id_community", _trim("name", False), _trim("description", True), "scraped_at"]),
        True,
    ),
    "post_stats": """
        SELECT id_user, count(*) AS post_count, CAST(sum(rating) AS BIGINT) AS total_post_rating,
               avg(rating) AS avg_post_rating, max(rating) AS max_post_rating,
               avg(length(title)) AS avg_title_length,
               avg(length(description)) AS avg_post_desc_length
        FROM posts GROUP BY id_user""",
    "comment_stats": """
        SELECT id_user, count(*) AS comment_count,
               CAST(sum(rating) AS BIGINT) AS total_comment_rating,
               avg(rating) AS avg_comment_rating, avg(length(description)) AS avg_comment_length
        FROM comments GROUP BY id_user""",
    "post_talk": """
        SELECT id_post, count(*) AS post_total_comments, avg(rating) AS post_avg_comment_rating,
               max(rating) AS post_max_comment_rating,
               avg(length(description)) AS post_avg_comment_length
        FROM comments GROUP BY id_post""",
    "user_features": """
        SELECT u.id_user, name, karma, followers, following,
               followers / nullif(following + 1, 0) AS follower_ratio,
               CAST(length(description) > 0 AS INTEGER) AS has_description,
               CAST(human_owner IS NOT NULL AS INTEGER) AS has_human_owner,
               CAST(length(description) AS INTEGER) AS description_length,
               coalesce(post_count, 0) AS post_count,
               coalesce(total_post_rating, 0) AS total_post_rating,
               coalesce(avg_post_rating, 0) AS avg_post_rating,
               coalesce(max_post_rating, 0) AS max_post_rating,
               coalesce(avg_title_length, 0) AS avg_title_length,
               coalesce(avg_post_desc_length, 0) AS avg_post_desc_length,
               coalesce(comment_count, 0) AS comment_count,
               coalesce(total_comment_rating, 0) AS total_comment_rating,
               coalesce(avg_comment_rating, 0) AS avg_comment_rating,
               coalesce(avg_comment_length, 0) AS avg_comment_length,
               coalesce(post_count, 0) + coalesce(comment_count, 0) AS total_activity,
               coalesce(total_post_rating, 0) + coalesce(total_comment_rating, 0) AS total_rating
        FROM users u LEFT JOIN post_stats p ON u.id_user = p.id_user
                     LEFT JOIN comment_stats c ON u.id_user = c.id_user""",
    "enriched": """
        SELECT u.*, coalesce(post_count, 0) AS post_count,
               coalesce(avg_post_rating, 0) AS avg_post_rating,
               coalesce(total_post_rating, 0) AS total_post_rating,
               coalesce(comment_count, 0) AS comment_count,
               coalesce(avg_comment_rating, 0) AS avg_comment_rating,
               coalesce(followers / nullif(following + 1, 0), 0) AS follower_ratio,
               coalesce(post_count, 0) + coalesce(comment_count, 0) AS total_activity,
               coalesce(total_post_rating, 0) AS total_rating
        FROM users u LEFT JOIN post_stats p ON u.id_user = p.id_user
                     LEFT JOIN comment_stats c ON u.id_user = c.id_user""",
    "predictions": """
        SELECT u.*, greatest(f.intercept + f.slope * followers, 0.0) AS karma_predicted
        FROM users u, (SELECT regr_slope(karma, followers) AS slope,
                              regr_intercept(karma, followers) AS intercept
                       FROM users WHERE karma >= 0) f
        WHERE karma >= 0""",
    "active_users": """
        SELECT * FROM user_features WHERE karma >= 0 AND (post_count > 0 OR comment_count > 0)""",
    "training": """
        SELECT *, ln(1 + karma) AS log_karma FROM active_users WHERE karma <= (
            SELECT karma FROM (SELECT karma, row_number() OVER (ORDER BY karma) - 1 AS rn,
                                      count(*) OVER () AS n FROM active_users) q
            WHERE rn = CAST(floor((n - 1) * 0.99 + 0.5) AS BIGINT))""",
}


def with_tables(body: str, ctes: str = "") -> str:
    """``body`` with the base tables it names (and those behind them) in front."""
    needed: list[str] = []

    def words(text: str) -> set[str]:
        for mark in "(),;.\n":
            text = text.replace(mark, " ")
        return set(text.split())

    def need(text: str) -> None:
        for name in BASE:
            if name in words(text) and name not in needed:
                need(BASE[name])
                needed.append(name)

    need(body + " " + ctes)
    parts = [f"{name} AS ({BASE[name]})" for name in needed]
    if ctes:
        parts.append(ctes)
    return f"WITH RECURSIVE {', '.join(parts)} {body}" if parts else body


def r(expression: str, alias: str | None = None) -> str:
    """Rounded SQL expression."""
    return f"round({expression}, {DIGITS}) AS {alias or expression.split('.')[-1]}"


def rs(columns: str) -> str:
    return ", ".join(r(c) for c in columns.split())
