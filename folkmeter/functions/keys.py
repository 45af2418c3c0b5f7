"""Deterministic ids and URL keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of stores with old ids: digests of 12 digits, comments known by 50 characters.
# Only for such stores: short ids of many rows collide, and comments that open alike become one.
ID_SEPARATOR = "|"
OLD_ID_LENGTH = 12
OLD_COMMENT_SAMPLE = 50


def _present(column: Column) -> Column:
    return F.nullif(column.cast("string"), F.lit(""))


def generate_id(prefix: str, *parts: Column, length: int | None = None) -> Column:
    """``prefix_`` plus the SHA-256 of the non-empty parts, or its first ``length`` digits."""
    joined = F.concat_ws(ID_SEPARATOR, *[_present(p) for p in parts])
    digest = F.sha2(joined, 256)
    return F.concat(F.lit(f"{prefix}_"), digest if length is None else F.substring(digest, 1, length))


def user_id(name: Column, length: int | None = None) -> Column:
    return generate_id("user", F.lower(name), length=length)


def community_id(name: Column, prefix: str = "community", length: int | None = None) -> Column:
    """``prefix`` lets a store with other historic ids keep them."""
    return generate_id(prefix, F.lower(name), length=length)


def post_id(
    given: Column, url: Column, title: Column, id_user: Column, length: int | None = None
) -> Column:
    source = F.coalesce(
        _present(url), F.concat(F.coalesce(title, F.lit("")), F.lit("-"), id_user)
    )
    return F.coalesce(_present(given), generate_id("post", source, length=length))


def comment_id(
    id_user: Column,
    id_post: Column,
    text: Column,
    sample: int | None = None,
    length: int | None = None,
) -> Column:
    """Same author, post and text (or its first ``sample`` characters) give the same id."""
    whole = F.coalesce(text, F.lit(""))
    known = whole if sample is None else F.substring(whole, 1, sample)
    return generate_id("comment", id_user, id_post, known, length=length)


def url_last_segment(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def url_entity(url: Column, kind: str) -> Column:
    """Name behind ``/<kind>/`` in a URL, null when the URL is of another kind."""
    return F.nullif(F.regexp_extract(url, f"/{kind}/([^/?#]+)", 1), F.lit(""))


def username_from_url(url: Column) -> Column:
    return url_entity(url, "u")


def community_from_url(url: Column) -> Column:
    return url_entity(url, "m")


def page_post(url: Column) -> Column:
    return url_entity(url, "post")


def build_url(base: str, kind: str, name: Column, encode: bool = False) -> Column:
    return F.concat(F.lit(f"{base}/{kind}/"), F.url_encode(name) if encode else name)


def url_path(url: Column) -> Column:
    """Path part of an absolute or relative URL."""
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
    return F.regexp_extract(url, pattern, 1)


def page_cache_key(url: Column) -> Column:
    """File-name key of a stored page: flattened path plus a short URL digest."""
    flat = F.trim(F.replace(url_path(url), F.lit("/"), F.lit("_")), F.lit("_"))
    stem = F.coalesce(F.nullif(flat, F.lit("")), F.lit("index"))
    return F.concat(stem, F.lit("_"), F.substring(F.md5(url), 1, 8), F.lit(".html"))


def load_timestamp(at: str | None = None) -> Column:
    """UTC load time as ISO text; pass ``at`` for a repeatable run."""
    if at is not None:
        return F.lit(at)
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
