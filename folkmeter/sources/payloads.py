"""Entity rows out of landed API payloads (one JSON text per row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folkmeter.functions import keys as K
from folkmeter.functions import scalars as S
from folkmeter.operators.relational import (
    cap_per_group,
    refs_union,
    resolve_authors,
    resolve_communities,
)
from folkmeter.sources import trees

POST = (
    "struct<id:string,title:string,content:string,url:string,upvotes:bigint,"
    "downvotes:bigint,created_at:string,author:struct<name:string>>"
)
AGENT = (
    "struct<karma:bigint,description:string,follower_count:bigint,following_count:bigint,"
    "created_at:string,owner:struct<x_handle:string>>"
)


def _present(column: Column) -> Column:
    return column.isNotNull() & (column != "")


def listing_names(
    payloads: DataFrame, field: str = "communities", body: str = "body", offset: str = "offset"
) -> DataFrame:
    """Rows (pos, name) of paged listings; ``field`` is the name of the listed array."""
    schema = f"struct<{field}:array<struct<name:string>>,count:bigint>"
    parsed = payloads.select(F.col(offset), F.from_json(body, schema)[field].alias("listed"))
    rows = parsed.select(offset, F.posexplode("listed").alias("i", "item"))
    return rows.filter(_present(F.col("item.name"))).select(
        (F.col(offset) + F.col("i")).alias("pos"), F.col("item.name").alias("name")
    )


def _community_payloads(payloads: DataFrame, field: str, body: str) -> DataFrame:
    schema = f"struct<success:boolean,{field}:struct<description:string>,posts:array<{POST}>>"
    return payloads.withColumn("_p", F.from_json(body, schema)).filter("_p.success")


def community_rows(
    payloads: DataFrame, scraped_at: Column, field: str = "community", body: str = "body"
) -> DataFrame:
    """One community per successful payload (name, body)."""
    parsed = _community_payloads(payloads, field, body)
    return parsed.select(
        K.community_id(F.col("name")).alias("id_community"),
        "name",
        F.col(f"_p.{field}.description").alias("description"),
        scraped_at.alias("scraped_at"),
    )


def posts_in_payloads(
    payloads: DataFrame, max_posts: int | None = None, field: str = "community", body: str = "body"
) -> DataFrame:
    """Listed posts with a named author, the first ``max_posts`` of each payload."""
    parsed = _community_payloads(payloads, field, body)
    listed = F.col("_p.posts") if max_posts is None else F.slice("_p.posts", 1, max_posts)
    rows = parsed.select(F.col("name").alias("community"), F.posexplode(listed).alias("pos", "post"))
    fields = ["id", "title", "content", "url", "upvotes", "downvotes", "created_at"]
    return rows.select(
        "community",
        "pos",
        F.col("post.author.name").alias("author"),
        *[F.col(f"post.{c}").alias(c) for c in fields],
    ).filter(_present(F.col("author")))


def post_rows(
    listed: DataFrame,
    users: DataFrame,
    scraped_at: Column,
    communities: DataFrame | None = None,
) -> DataFrame:
    """Post entities of ``posts_in_payloads`` rows; authors and communities that are stored keep
    their stored ids."""
    resolved = resolve_authors(listed, users)
    if communities is None:
        resolved = resolved.withColumn("id_community", K.community_id(F.col("community")))
    else:
        resolved = resolve_communities(resolved, communities, "community")
    key = K.post_id(F.col("id"), F.col("url"), F.col("title"), F.col("id_user"))
    return resolved.select(
        key.alias("id_post"),
        "id_user",
        "id_community",
        "title",
        F.col("content").alias("description"),
        S.iso_prefix_date(F.col("created_at")).alias("date"),
        scraped_at.alias("scraped_at"),
        S.net_votes(F.col("upvotes"), F.col("downvotes")).alias("rating"),
    )


def new_rows_only(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not stored; nothing is inserted twice."""
    return rows.join(stored.select(key), key, "left_anti")


def profile_rows(payloads: DataFrame, scraped_at: Column, body: str = "body") -> DataFrame:
    """User entities of successful profile payloads (name, body)."""
    parsed = payloads.withColumn("_p", F.from_json(body, f"struct<success:boolean,agent:{AGENT}>"))
    agent = F.col("_p.agent")
    zero = F.lit(0).cast("bigint")
    return parsed.filter(F.col("_p.success") & agent.isNotNull()).select(
        K.user_id(F.col("name")).alias("id_user"),
        "name",
        agent["description"].alias("description"),
        F.nullif(agent["owner"]["x_handle"], F.lit("")).alias("human_owner"),
        S.iso_prefix_date(agent["created_at"]).alias("joined"),
        scraped_at.alias("scraped_at"),
        F.coalesce(agent["karma"], zero).alias("karma"),
        F.coalesce(agent["follower_count"], zero).alias("followers"),
        F.coalesce(agent["following_count"], zero).alias("following"),
    )


def flatten_replies(payloads: DataFrame, key: str = "id_post", body: str = "body") -> DataFrame:
    """Comment trees as rows; ordering by ``path`` gives the depth-first pre-order.

    A payload row carries its own tree, so nothing is shuffled, and its text is parsed once: no
    level is read again for the levels above it. Trees may have any depth. A text that is not
    JSON gives no rows.
    """
    kind = payloads.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, path array<int>, depth int, author string, content string,"
        " upvotes bigint, downvotes bigint, created_at string"
    )
    return payloads.select(key, body).mapInArrow(
        lambda batches: trees.flatten(batches, "comments", "replies"), schema
    )


def comment_rows(
    payloads: DataFrame,
    users: DataFrame,
    scraped_at: Column,
    max_comments: int | None = None,
    body: str = "body",
) -> DataFrame:
    """Comment entities of post payloads (id_post, body), cut per post in tree order."""
    flat = flatten_replies(payloads, "id_post", body)
    if max_comments is not None:
        flat = cap_per_group(flat, ["id_post"], ["path"], max_comments)
    named = resolve_authors(flat.filter(_present(F.col("author"))), users)
    key = K.comment_id(F.col("id_user"), F.col("id_post"), F.col("content"))
    return named.select(
        key.alias("id_comment"),
        "id_user",
        "id_post",
        F.col("content").alias("description"),
        S.iso_prefix_date(F.col("created_at")).alias("date"),
        scraped_at.alias("scraped_at"),
        S.net_votes(F.col("upvotes"), F.col("downvotes")).alias("rating"),
        "author",
        "path",
    )


def discovered_authors(*parts: DataFrame) -> DataFrame:
    """Distinct author names over posts and comments."""
    return refs_union(*[p.select("author") for p in parts])
