"""Paged listings put together from their landed pages, by the rules of a walk over offsets.

A walk asks for offset 0, then for the offset behind the items it got, and ends at the first page
that is missing, empty, or shorter than a full one. Here the pages have landed already, in any
order and also more than once, so the walk is a question of gaps and islands: in the order of
offsets, a page belongs to the listing if the pages before it cover everything up to its offset
and none of them ended the listing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folkmeter.operators.relational import keep_last

ACCEPTED, AFTER_END, AFTER_GAP, REPEATED = "accepted", "after_end", "after_gap", "repeated"


def listing_pages(
    payloads: DataFrame,
    page_size: int,
    listing: str = "listing",
    offset: str = "offset",
    body: str = "body",
    landed: str = "landed_at",
    field: str = "communities",
) -> DataFrame:
    """Pages with their verdict: (listing, offset, items, covered, status).

    ``items`` is the number of listed items, ``covered`` the offset up to which the pages before
    cover the listing without a gap. Of pages of one offset the one that landed last counts. A
    page that adds nothing to what is covered is ``repeated``; one that overlaps adds what lies
    behind. A body that cannot be read is a missing page. The windows hold numbers only.
    """
    schema = f"struct<{field}:array<struct<name:string>>>"
    pages = payloads.select(
        F.col(listing).alias("listing"),
        F.col(offset).cast("bigint").alias("offset"),
        F.col(landed).alias("landed"),
        F.size(F.from_json(body, schema)[field]).alias("items"),
    )
    pages = keep_last(pages.filter("items >= 0"), ["listing", "offset"], ["landed", "items"])
    in_order = Window.partitionBy("listing").orderBy("offset")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    covered = F.coalesce(F.max(F.col("offset") + F.col("items")).over(before), F.lit(0).cast("bigint"))
    pages = pages.withColumn("covered", covered)
    pages = pages.withColumns(
        {"short": F.col("items") < page_size, "gap": F.col("offset") > F.col("covered")}
    )
    whole = Window.partitionBy("listing")
    pages = pages.withColumns(
        {f"first_{c}": F.min(F.when(F.col(c), F.col("offset"))).over(whole) for c in ("short", "gap")}
    )
    # Behind a short page there is always a gap: the first of the two says how the listing ended.
    ended = F.col("first_short") < F.coalesce("first_gap", F.lit(1 << 62))
    adds = F.col("offset") + F.col("items") > F.col("covered")
    status = (
        F.when(ended & (F.col("offset") > F.col("first_short")), AFTER_END)
        .when(~F.coalesce(ended, F.lit(False)) & (F.col("offset") >= F.col("first_gap")), AFTER_GAP)
        .when(~adds & (F.col("items") > 0), REPEATED)
        .otherwise(ACCEPTED)
    )
    return pages.select(
        "listing", "offset", F.col("items").cast("bigint").alias("items"), "covered", status.alias("status"), "landed"
    )


def listing_gaps(pages: DataFrame) -> DataFrame:
    """(listing, gap_from, gap_to, pages_refused): where a listing breaks off for want of a page."""
    refused = pages.filter(F.col("status") == AFTER_GAP)
    first = F.min_by(F.struct("covered", "offset"), "offset").alias("first")
    return refused.groupBy("listing").agg(first, F.count("*").alias("pages_refused")).select(
        "listing", F.col("first.covered").alias("gap_from"), F.col("first.offset").alias("gap_to"), "pages_refused"
    )


def listed_names(
    payloads: DataFrame,
    pages: DataFrame,
    listing: str = "listing",
    offset: str = "offset",
    body: str = "body",
    landed: str = "landed_at",
    field: str = "communities",
) -> DataFrame:
    """(listing, pos, name): the named items of the accepted pages, each place once.

    ``pages`` are those of ``listing_pages`` over the same payloads.
    """
    schema = f"struct<{field}:array<struct<name:string>>>"
    taken = pages.filter(F.col("status") == ACCEPTED).select(
        F.col("listing").alias(listing), F.col("offset").alias("_offset"), F.col("landed").alias("_landed"), "covered", "items"
    )
    read = payloads.select(
        F.col(listing), F.col(offset).cast("bigint").alias("_offset"), F.col(landed).alias("_landed"),
        F.from_json(body, schema)[field].alias("listed"),
    )
    # One copy of each accepted page: equal offsets that landed together differ in their items.
    read = read.filter("listed is not null").withColumn("items", F.size("listed").cast("bigint"))
    whole = read.join(taken, [listing, "_offset", "_landed", "items"])
    whole = whole.groupBy(listing, "_offset", "covered").agg(F.max("listed").alias("listed"))
    rows = whole.select(listing, "_offset", "covered", F.posexplode("listed").alias("i", "item"))
    pos = F.col("_offset") + F.col("i")
    named = rows.filter((pos >= F.col("covered")) & F.col("item.name").isNotNull() & (F.col("item.name") != ""))
    return named.select(F.col(listing).alias("listing"), pos.alias("pos"), F.col("item.name").alias("name"))
