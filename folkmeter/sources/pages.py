"""Entity rows out of landed web pages (url, html)."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folkmeter.functions import keys as K
from folkmeter.functions import scalars as S
from folkmeter.sources import dom

# The page layout these rules read.
OWNER_HOSTS = ("twitter.com", "x.com")
OWNER_PATTERN = r"(?:twitter\.com|x\.com)/(@?\w+)"
NUMBER = r"(\d+(?:\.\d+)?[KkMm]?)"
PROFILE_BLOCK = "div.flex-1"
PROFILE_PARENT = "div.flex.items-start.gap-4"
COMMENT_BOX = "div.mt-6 div.py-2"
COMMENT_HEAD = "div.flex.items-center.gap-2.text-xs"
REF_PATTERN = r"/m/([A-Za-z0-9_-]+)"
NOT_A_NAME = ["undefined", "null", "create"]
SITE_PHRASE = "social network"
JOINED_DAY = r"(?i)joined\s+(\d{1,2}/\d{1,2}/\d{4})"
JOINED_DAY_EXACT = r"Joined\s+(\d{1,2}/\d{1,2}/\d{4})"
JOINED_LATE = r"Joined\s+(.+?)(?:\s+Online|\s*$)"
KARMA = rf"(?i){NUMBER}\s*karma"
KARMA_AFTER = rf"(?i)karma[:\s]*{NUMBER}"
FOLLOWERS = rf"(?i){NUMBER}\s*followers?"
FOLLOWING = rf"(?i){NUMBER}\s*following"

# Rows and characters that a task holds before it hands them on.
BLOCK_ROWS = 1_000
BLOCK_CHARS = 4 << 20


# --- flat rules: native expressions -------------------------------------------------


def visible_text(html: Column) -> Column:
    """Text between tags; like a parser's text, nothing is put between the pieces."""
    bare = F.regexp_replace(html, r"(?is)<(?:script|style)\b.*?</(?:script|style)\s*>", "")
    bare = F.regexp_replace(bare, r"(?s)<!--.*?-->", "")
    bare = F.regexp_replace(bare, r"(?s)<[!/A-Za-z][^>]*>", "")
    for mark, char in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "'"),
        ("&nbsp;", "\xa0"),
        ("&amp;", "&"),
    ):
        bare = F.replace(bare, F.lit(mark), F.lit(char))
    return bare


def tag_with_class(tag: str, name: str) -> str:
    """Pattern of the content of the first ``tag`` that carries the class ``name``."""
    value = rf"(?:[^\"']*\s)?{name}(?:\s[^\"']*)?"
    return rf"(?is)<{tag}\s(?:[^>]*\s)?class\s*=\s*[\"']{value}[\"'][^>]*>(.*?)</{tag}\s*>"


META_DESCRIPTION = (
    r"(?is)<meta\s(?:[^>]*\s)?name\s*=\s*[\"']description[\"'][^>]*\scontent\s*=\s*\"([^\"]*)\""
)


def page_description(html: Column) -> Column:
    """Meta description, overridden by the first description element of the page."""
    patterns = [
        tag_with_class("p", "description"),
        tag_with_class("div", "about"),
        tag_with_class("p", "text-gray-400"),
    ]
    found = F.lit(None).cast("string")
    for pattern in reversed(patterns):
        inner = S.trim_ws(visible_text(F.regexp_extract(html, pattern, 1)))
        found = F.when(html.rlike(pattern), inner).otherwise(found)
    meta = visible_text(F.regexp_extract(html, META_DESCRIPTION, 1))
    return F.coalesce(found, F.when(html.rlike(META_DESCRIPTION), meta))


def page_links(pages: DataFrame, key: str = "page_id", prefix: str = "/") -> DataFrame:
    """First occurrence of each link name per page: (key, name, pos).

    The names of a page stay in its row until they are distinct: no shuffle.
    """
    pattern = rf'<a\s[^>]*href="{prefix}([^"/?#]+)'
    found = pages.select(key, S.all_matches(F.col("html"), pattern).alias("_all"))
    names = found.select(key, "_all", F.explode(F.array_distinct("_all")).alias("name"))
    first = F.array_position("_all", F.col("name")) - 1
    return names.select(key, "name", first.cast("int").alias("pos"))


def page_refs(pages: DataFrame) -> DataFrame:
    """Distinct community names referenced anywhere in the pages."""
    names = pages.select(F.explode(S.all_matches(F.col("html"), REF_PATTERN)).alias("name"))
    usable = (F.length("name") > 1) & ~F.col("name").isin(NOT_A_NAME)
    return names.filter(usable).distinct()


# --- rules scoped by containment: one parse per page inside the task ----------------


def _is_owner_link(href: str) -> bool:
    return any(host in href for host in OWNER_HOSTS)


def _named_links(root: dom.Element, prefix: str):
    return root.links(lambda href: href.startswith(prefix))


def _first_links(root: dom.Element, kind: str) -> Iterator[tuple[str, dom.Element]]:
    """First link of each name behind ``/<kind>/``."""
    seen = set()
    for link in _named_links(root, f"/{kind}/"):
        name = re.split("[/?#]", link.attrs["href"][len(kind) + 2 :], maxsplit=1)[0]
        if name and name not in seen:
            seen.add(name)
            yield name, link


def _user_links(root: dom.Element) -> Iterator[dict]:
    for name, link in _first_links(root, "u"):
        box = link.up("div")
        strings = box.strings() if box is not None else ()
        holder = next((h for h, s in strings if "karma" in s.lower()), None)
        karma = None if holder is None else holder.text(strip=False)
        yield {"name": name, "href": link.attrs["href"], "karma_text": karma}


def _community_links(root: dom.Element) -> Iterator[dict]:
    for name, link in _first_links(root, "m"):
        box = link.up("div")
        text = dom.text_of(box.find("p")) if box is not None else None
        yield {"name": name, "href": link.attrs["href"], "description": text}


def _profile(root: dom.Element) -> Iterator[dict]:
    order = list(root.walk())
    head = next((i for i, n in enumerate(order) if n.tag == "h1"), None)
    after = order[head:] if head is not None else []
    owner = next(root.links(_is_owner_link), None)
    yield {
        "bio": dom.text_of(next((n for n in after if n.tag == "p"), None)),
        "other_bio": dom.text_of(root.find("p.bio") or root.find("div.description")),
        "owner_href": owner.attrs["href"] if owner else None,
        "body": root.text(strip=False),
    }


def _profile_blocks(root: dom.Element) -> Iterator[dict]:
    blocks = root.find_all(PROFILE_BLOCK)
    block = next((b for b in blocks if b.parent and b.parent.matches(PROFILE_PARENT)), None)
    scope = block or root
    bios = [block.find("p.mt-1") if block else None, root.find("p.mt-1"), root.find("p.text-gray-400")]
    row = block.find("div.mt-3") if block else root.find("div.flex.flex-wrap.items-center.mt-3")
    stats = list(row.find_all("div.text-sm")) if row else []
    section = scope.find("div.mt-4.pt-4.border-t")
    link = next(section.links(_is_owner_link), None) if section else None
    labels = (n for n in section.walk() if n.matches("span.font-bold") or n.matches("span.text-white")) if section else iter(())
    yield {
        "bios": [dom.text_of(b) for b in bios],
        "stats": [
            {"line": s.text(" ").lower(), "number": dom.text_of(s.find("span.font-bold"))}
            for s in stats
        ],
        "has_section": section is not None,
        "owner_href": link.attrs["href"] if link else None,
        "owner_label": dom.text_of(next(labels, None)),
        "other_hrefs": [a.attrs["href"] for a in root.links(_is_owner_link)],
        "block": dom.text_of(block, " "),
        "body": root.text(" "),
    }


def _author(text: str | None) -> str | None:
    return None if text is None else text.replace("u/", "")


def _post_cards(root: dom.Element) -> Iterator[dict]:
    for card in _named_links(root, "/post/"):
        yield {
            "href": card.attrs["href"],
            "title": dom.text_of(card.find("h3")),
            "description": dom.text_of(card.find("p.line-clamp-3")),
            "author": _author(dom.text_of(card.find("span.hover:underline"))),
            "rating_text": dom.text_of(card.find("span.text-white.font-bold")),
            "age_text": dom.text_of(card.find("div.text-xs"), " "),
        }


def _comment_boxes(root: dom.Element) -> Iterator[dict]:
    for box in root.find_all(COMMENT_BOX):
        yield {
            "author": _author(dom.text_of(next(_named_links(box, "/u/"), None))),
            "description": dom.text_of(box.find("div.prose-invert p")),
            "rating_text": dom.text_of(box.find("span.flex.items-center.gap-1 span")),
            "age_text": dom.text_of(box.find(COMMENT_HEAD), " "),
        }


RULES: dict[str, tuple[Callable, str]] = {
    "user_links": (_user_links, "name string, href string, karma_text string"),
    "community_links": (_community_links, "name string, href string, description string"),
    "profile": (_profile, "bio string, other_bio string, owner_href string, body string"),
    "profile_blocks": (
        _profile_blocks,
        "bios array<string>, stats array<struct<line:string,number:string>>, has_section boolean,"
        " owner_href string, owner_label string, other_hrefs array<string>, block string, body string",
    ),
    "post_cards": (
        _post_cards,
        "href string, title string, description string, author string, rating_text string,"
        " age_text string",
    ),
    "comment_boxes": (
        _comment_boxes,
        "author string, description string, rating_text string, age_text string",
    ),
}


_FLAT = {T.StringType(): pa.string(), T.IntegerType(): pa.int32(), T.BooleanType(): pa.bool_()}


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow_type(f.dataType)) for f in kind])
    return _FLAT[kind]


def _chars(value) -> int:
    """Characters of all texts in a value of a row."""
    if isinstance(value, str):
        return len(value)
    if isinstance(value, dict):
        value = value.values()
    elif not isinstance(value, list):
        return 0
    return sum(map(_chars, value))


def spread(pages: DataFrame) -> DataFrame:
    """Pages dealt over all cores, if they lie in fewer partitions: parsing is bound by CPU."""
    cores = pages.sparkSession.sparkContext.defaultParallelism
    return pages.repartition(cores) if pages.rdd.getNumPartitions() < cores else pages


def extract(
    pages: DataFrame, rule: str, required: tuple[str, ...] = (), limit: int | None = None
) -> DataFrame:
    """Rows (url, pos, raw texts) of one rule; Arrow batches in, one page of a batch as text at a
    time. Pages are only shuffled if there are fewer partitions than cores.

    ``required`` texts must not be empty; of the rows that are left, the first
    ``limit`` of a page are kept. A page is one row, so the cut is exact without
    bringing the rows of a page together again.
    """
    find, columns = RULES[rule]

    def rows_of(html: str | None) -> Iterator[tuple[int, dict]]:
        numbered = enumerate(find(dom.parse(html)))
        full = (row for row in numbered if all(row[1][c] for c in required))
        return islice(full, limit)

    schema = f"url string, pos int, {columns}"
    layout = pa.schema(list(_arrow_type(pages.sparkSession.createDataFrame([], schema).schema)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for url, html in zip(batch.column("url"), batch.column("html")):
                address = url.as_py()
                for pos, found in rows_of(html.as_py()):
                    rows.append({"url": address, "pos": pos, **found})
                    size += _chars(found)
                    if len(rows) >= BLOCK_ROWS or size >= BLOCK_CHARS:
                        yield pa.RecordBatch.from_pylist(rows, layout)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, layout)

    return spread(pages.select("url", "html")).mapInArrow(run, schema)


def user_listing(pages: DataFrame) -> DataFrame:
    """Users of listing pages: (url, pos, name, karma, profile_url), first link per name."""
    return extract(pages, "user_links").select(
        "url",
        "pos",
        "name",
        S.parse_human_number(F.coalesce("karma_text", F.lit(""))).alias("karma"),
        F.col("href").alias("profile_url"),
    )


def community_listing(pages: DataFrame) -> DataFrame:
    """Communities of listing pages: (url, pos, name, description, page_url)."""
    return extract(pages, "community_links").select(
        "url",
        "pos",
        "name",
        F.nullif("description", F.lit("")).alias("description"),
        F.col("href").alias("page_url"),
    )


def _count(text: Column, *patterns: str) -> Column:
    return S.parse_human_number(F.coalesce(S.first_match(text, list(patterns)), F.lit("")))


def _own_bio(text: Column) -> Column:
    """The text unless it is empty or the general phrase of the site."""
    return F.when((text != "") & ~F.lower(text).contains(SITE_PHRASE), text)


def profiles(pages: DataFrame) -> DataFrame:
    """Profile fields by text patterns over the page: one row per profile page."""
    rows = extract(pages, "profile")
    body = F.col("body")
    return rows.select(
        "url",
        K.username_from_url(F.col("url")).alias("name"),
        F.coalesce(_own_bio(F.col("bio")), F.col("other_bio")).alias("description"),
        S.first_match(F.col("owner_href"), [OWNER_PATTERN]).alias("human_owner"),
        S.first_match(body, [JOINED_DAY]).alias("joined"),
        _count(body, KARMA, KARMA_AFTER).alias("karma"),
        _count(body, FOLLOWERS).alias("followers"),
        _count(body, FOLLOWING).alias("following"),
    )


def profiles_by_block(pages: DataFrame, site_handles: tuple[str, ...] = ()) -> DataFrame:
    """Profile fields by page structure first, text patterns second.

    ``site_handles`` are accounts of the site's own owner, linked on every page,
    that must not be taken for the owner of a profile.
    """
    rows = extract(pages, "profile_blocks")
    words = {"karma": "karma", "followers": "follower", "following": "following", "joined": "joined"}

    def stat(kind: str) -> Column:
        """Last line of this kind; a line belongs to the first word it contains."""
        before = list(words.values())[: list(words).index(kind)]

        def own(s: Column) -> Column:
            test = s["line"].contains(words[kind])
            for word in before:
                test = test & ~s["line"].contains(word)
            return test

        return F.filter("stats", own)

    def number(kind: str) -> Column:
        given = F.filter(stat(kind), lambda s: s["number"].isNotNull())
        return S.parse_human_number(F.coalesce(F.get(F.reverse(given), 0)["number"], F.lit("")))

    block, body = F.col("block"), F.col("body")
    joined_lines = F.transform(
        stat("joined"), lambda s: F.nullif(F.regexp_extract(s["line"], r"joined\s+(\S+)", 1), F.lit(""))
    )
    joined = F.get(F.reverse(F.filter(joined_lines, lambda j: j.isNotNull())), 0)
    late = S.trim_ws(S.first_match(body, [JOINED_LATE]))
    others = F.filter(
        "other_hrefs",
        lambda h: h.rlike(OWNER_PATTERN)
        & ~F.exists(F.lit(list(site_handles)).cast("array<string>"), lambda s: h.contains(s)),
    )
    outside = S.first_match(F.get(others, 0), [OWNER_PATTERN])
    inside = F.coalesce(S.first_match(F.col("owner_href"), [OWNER_PATTERN]), F.col("owner_label"))
    karma = number("karma")
    followers, following = number("followers"), number("following")
    bios = F.col("bios")
    return rows.select(
        "url",
        K.username_from_url(F.col("url")).alias("name"),
        F.coalesce(F.nullif(bios[0], F.lit("")), _own_bio(bios[1]), _own_bio(bios[2])).alias(
            "description"
        ),
        F.when(F.col("has_section"), inside).otherwise(outside).alias("human_owner"),
        F.coalesce(
            joined,
            S.first_match(body, [JOINED_DAY_EXACT]),
            late,
        ).alias("joined"),
        F.when(karma != 0, karma).otherwise(_count(body, KARMA)).alias("karma"),
        F.when(followers != 0, followers)
        .otherwise(_count(block, FOLLOWERS))
        .alias("followers"),
        F.when(following != 0, following)
        .otherwise(_count(block, FOLLOWING))
        .alias("following"),
    )


def user_entities(profile_rows: DataFrame, scraped_at: Column) -> DataFrame:
    return profile_rows.select(
        K.user_id(F.col("name")).alias("id_user"),
        "name",
        "description",
        "human_owner",
        "joined",
        scraped_at.alias("scraped_at"),
        "karma",
        "followers",
        "following",
    )


def _age_date(age: Column, now: Column) -> Column:
    """Date of an age line; the part before the first ``ago`` counts."""
    return S.relative_date(F.concat(S.trim_ws(F.substring_index(age, "ago", 1)), F.lit(" ago")), now)


def community_pages(pages: DataFrame, scraped_at: Column) -> DataFrame:
    """Community entities of community pages."""
    name = K.community_from_url(F.col("url"))
    return pages.select(
        K.community_id(name).alias("id_community"),
        name.alias("name"),
        page_description(F.col("html")).alias("description"),
        scraped_at.alias("scraped_at"),
    )


def posts_on_pages(
    pages: DataFrame, now: Column, max_posts: int | None = None, site: str = ""
) -> DataFrame:
    """Post cards with a title, all or the first ``max_posts`` of each page.

    The community is the one of the page address; the date of a card without an
    age is the day of ``now``.
    """
    cards = extract(pages, "post_cards", ("title",), max_posts)
    age = F.col("age_text")
    return cards.select(
        "url",
        "pos",
        "title",
        "description",
        "author",
        K.community_from_url(F.col("url")).alias("community"),
        S.safe_int(F.coalesce("rating_text", F.lit(""))).alias("rating"),
        F.when(age.contains("ago"), _age_date(age, now))
        .when(age.isNotNull(), F.date_format(now, "yyyy-MM-dd"))
        .alias("date"),
        F.concat(F.lit(site), F.col("href")).alias("post_url"),
    )


def comments_on_pages(pages: DataFrame, now: Column, max_comments: int | None = None) -> DataFrame:
    """Comment boxes with author and text, all or the first ``max_comments`` of each page."""
    kept = extract(pages, "comment_boxes", ("author", "description"), max_comments)
    age = F.col("age_text")
    return kept.select(
        "url",
        "pos",
        "author",
        "description",
        S.safe_int(F.coalesce("rating_text", F.lit(""))).alias("rating"),
        F.when(age.contains("ago"), _age_date(age, now)).alias("date"),
    )
