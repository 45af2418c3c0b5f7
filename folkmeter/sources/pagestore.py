"""Stored raw pages: which wanted URLs are at hand and which are still to fetch.

Pages are matched by their whole URL; the file-name key is carried along for the store.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folkmeter.functions.keys import page_cache_key
from folkmeter.operators.relational import fits_broadcast
from folkmeter.session import stored_once


def with_key(urls: DataFrame) -> DataFrame:
    return urls.withColumn("cache_key", page_cache_key(F.col("url")))


BIT_PAGES = 256  # at most so many bitmaps of 32,768 bits: 1 MB on each executor
BITS = 32_768


def write_pages(pages: DataFrame, folder: str, mode: str = "append") -> None:
    """Store pages with a Bloom filter on the URL in every file: a lookup skips the others."""
    options = {"parquet.bloom.filter.enabled#url": "true", "parquet.bloom.filter.adaptive.enabled#url": "true"}
    pages.write.mode(mode).options(**options).parquet(folder)


def _bit(url: Column) -> Column:
    """The bit that stands for a URL, from 0; the least number that the bitmap functions take is
    0 as well."""
    return F.pmod(F.xxhash64(url), F.lit(BIT_PAGES * BITS))


def url_bitmaps(urls: DataFrame) -> DataFrame:
    """(page, bits): a filter of URLs with one bit each, in at most ``BIT_PAGES`` rows whatever
    the number of URLs. The filters of several loads are merged by ``merge_bitmaps``."""
    bit = _bit(F.col("url"))
    placed = urls.filter(F.col("url").isNotNull()).select(
        F.bitmap_bucket_number(bit).alias("page"), F.bitmap_bit_position(bit).alias("position")
    )
    return placed.groupBy("page").agg(F.bitmap_construct_agg("position").alias("bits"))


def merge_bitmaps(*filters: DataFrame) -> DataFrame:
    united = filters[0]
    for part in filters[1:]:
        united = united.unionByName(part)
    return united.groupBy("page").agg(F.bitmap_or_agg("bits").alias("bits"))


def may_hold(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The rows whose URL may be among those of the filter: all that are, and few others."""
    bit = _bit(F.col("url"))
    position = F.bitmap_bit_position(bit)
    byte = F.substring("bits", (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    on = F.getbit(value, F.pmod(position, F.lit(8)).cast("int")) == 1
    held = F.broadcast(bitmaps.withColumnRenamed("page", "_page"))
    joined = rows.join(held, F.bitmap_bucket_number(bit) == F.col("_page")).filter(on)
    return joined.select(*rows.columns)


def _stored_among(urls: DataFrame, store: DataFrame) -> DataFrame:
    """The stored URLs that are wanted. The store, which may be far larger, is not shuffled: it
    meets a broadcast of the wanted URLs if these fit, else only what their filter lets through
    is dealt out for the comparison."""
    wanted = stored_once(urls.select("url").distinct())
    if fits_broadcast(wanted):
        return store.select("url").join(F.broadcast(wanted), "url", "left_semi").distinct()
    likely = may_hold(store.select("url"), url_bitmaps(wanted))
    return likely.distinct().join(wanted, "url", "left_semi")


def cached(urls: DataFrame, store: DataFrame, force_refresh: bool = False) -> DataFrame:
    """Wanted URLs whose page is stored; none when everything is to be fetched again."""
    keyed = with_key(urls)
    if force_refresh:
        return keyed.limit(0)
    return keyed.join(_stored_among(urls, store), "url", "left_semi")


def to_fetch(urls: DataFrame, store: DataFrame, force_refresh: bool = False) -> DataFrame:
    """Wanted URLs that are not stored; all of them on a forced refresh."""
    keyed = with_key(urls)
    if force_refresh:
        return keyed
    return keyed.join(_stored_among(urls, store), "url", "left_anti")
