"""Declared schemas, keys and parent links of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(strings: str, longs: str = "", required: str = "") -> T.StructType:
    needed = set(required.split())
    fields = [T.StructField(c, T.StringType(), c not in needed) for c in strings.split()]
    fields += [T.StructField(c, T.LongType(), c not in needed) for c in longs.split()]
    return T.StructType(fields)


USERS = _schema(
    "id_user name description human_owner joined scraped_at",
    "karma followers following",
    required="id_user name scraped_at",
)
COMMUNITIES = _schema(
    "id_community name description scraped_at", required="id_community name scraped_at"
)
POSTS = _schema(
    "id_post id_user id_community title description date scraped_at",
    "rating",
    required="id_post id_user scraped_at",
)
COMMENTS = _schema(
    "id_comment id_user id_post description date scraped_at",
    "rating",
    required="id_comment id_user id_post scraped_at",
)
MEMBERSHIPS = _schema("id_user id_community", required="id_user id_community")

TABLES = {
    "users": USERS,
    "communities": COMMUNITIES,
    "memberships": MEMBERSHIPS,
    "posts": POSTS,
    "comments": COMMENTS,
}

PRIMARY_KEYS = {
    "users": ["id_user"],
    "communities": ["id_community"],
    "memberships": ["id_user", "id_community"],
    "posts": ["id_post"],
    "comments": ["id_comment"],
}

UNIQUE_COLUMNS = {"communities": ["name"]}

# child table -> [(child column, parent table, parent column)]
FOREIGN_KEYS = {
    "posts": [("id_user", "users", "id_user"), ("id_community", "communities", "id_community")],
    "comments": [("id_user", "users", "id_user"), ("id_post", "posts", "id_post")],
    "memberships": [
        ("id_user", "users", "id_user"),
        ("id_community", "communities", "id_community"),
    ],
}

# Parents come before children, so that a reader never sees a child without its parent.
WRITE_ORDER = ["users", "communities", "memberships", "posts", "comments"]


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A frame that the optimizer knows to be empty, so that joins with it are left out."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(0).filter(F.lit(False)).select(*columns)


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return no_rows(spark, TABLES[name])


def required_columns(name: str) -> list[str]:
    return [f.name for f in TABLES[name] if not f.nullable]
