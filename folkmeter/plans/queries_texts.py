"""Queries for ids, URLs, scalar rules, payloads and pages.

Payloads and pages in the site's format are derived by Spark from the given texts,
row by row and from the whole text, so the extraction jobs run at full table size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folkmeter.functions import keys as K
from folkmeter.functions import scalars as S
from folkmeter.plans.registry import WS_SQL, Tables, query, r
from folkmeter.session import cut_lineage, scratch
from folkmeter.sources import listings, pagestore, store
from folkmeter.sources import pages as P
from folkmeter.sources import payloads as J
from folkmeter.streaming import incremental

BASE_URL = "https://community.example.org"


def _id_sql(prefix: str, expression: str) -> str:
    return f"'{prefix}_' || sha256({expression})"


def _old_id_sql(prefix: str, expression: str) -> str:
    return f"'{prefix}_' || substr(sha256({expression}), 1, 12)"


# --- ids and URLs -------------------------------------------------------------------


@query("gen_id", f"""
    SELECT doc_id, {_id_sql('doc', "concat_ws('|', nullif(text, ''), nullif(lang, ''), nullif(CASE WHEN n_chars > 500 THEN source ELSE '' END, ''))")} AS id
    FROM documents""")
def gen_id(t: Tables):
    maybe = F.when(F.col("n_chars") > 500, F.col("source")).otherwise("")
    return t.read("documents").select(
        "doc_id", K.generate_id("doc", F.col("text"), F.col("lang"), maybe).alias("id")
    )


@query("user_id", f"SELECT c_custkey, {_id_sql('user', 'lower(c_name)')} AS id_user FROM customer")
def user_id(t: Tables):
    return t.read("customer").select("c_custkey", K.user_id(F.col("c_name")).alias("id_user"))


@query("community_id", f"""
    SELECT n_nationkey, {_id_sql('community', 'lower(n_name)')} AS id_community FROM nation""")
def community_id(t: Tables):
    return t.read("nation").select(
        "n_nationkey", K.community_id(F.col("n_name")).alias("id_community")
    )


@query("post_id", f"""
    SELECT id_post AS key, coalesce(nullif(given, ''), {_id_sql('post', "coalesce(nullif(url, ''), coalesce(title, '') || '-' || id_user)")}) AS id_post
    FROM (SELECT *, CASE WHEN rating > 400 THEN id_post ELSE '' END AS given,
                 CASE WHEN rating > 200 THEN '/post/' || id_post END AS url FROM posts) q""")
def post_id(t: Tables):
    rating = F.col("rating")
    given = F.when(rating > 400, F.col("id_post")).otherwise("")
    url = F.when(rating > 200, F.concat(F.lit("/post/"), "id_post"))
    made = K.post_id(given, url, F.col("title"), F.col("id_user"))
    return t.posts.select(F.col("id_post").alias("key"), made.alias("id_post"))


@query("comment_id", f"""
    SELECT conv_id, turn, {_id_sql('comment', "concat_ws('|', role, CAST(conv_id AS VARCHAR), nullif(text, ''))")} AS id_comment
    FROM conversations""")
def comment_id(t: Tables):
    made = K.comment_id(F.col("role"), F.col("conv_id"), F.col("text"))
    return t.read("conversations").select("conv_id", "turn", made.alias("id_comment"))


@query("old_ids", f"""
    SELECT conv_id, turn, {_old_id_sql('user', "lower(role)")} AS id_user,
           {_old_id_sql('comment', "concat_ws('|', role, CAST(conv_id AS VARCHAR), nullif(substr(coalesce(text, ''), 1, 50), ''))")} AS id_comment
    FROM conversations""")
def old_ids(t: Tables):
    """The form that stores with old ids need."""
    known = {"length": K.OLD_ID_LENGTH}
    made = K.comment_id(F.col("role"), F.col("conv_id"), F.col("text"), K.OLD_COMMENT_SAMPLE, **known)
    return t.read("conversations").select(
        "conv_id", "turn", K.user_id(F.col("role"), **known).alias("id_user"), made.alias("id_comment")
    )


@query("url_last_segment", "SELECT page_id, split_part(url, '/', -1) AS segment FROM pages")
def url_last_segment(t: Tables):
    return t.read("pages").select("page_id", K.url_last_segment(F.col("url")).alias("segment"))


@query("url_entity", """
    SELECT page_id, nullif(regexp_extract(url, '/u/([^/?#]+)', 1), '') AS username,
           nullif(regexp_extract(url, '/m/([^/?#]+)', 1), '') AS community
    FROM (SELECT page_id, replace(replace(url, '/fr/', '/u/'), '/en/', '/m/') AS url FROM pages) q""")
def url_entity(t: Tables):
    url = F.replace(F.replace("url", F.lit("/fr/"), F.lit("/u/")), F.lit("/en/"), F.lit("/m/"))
    return t.read("pages").select(
        "page_id", K.username_from_url(url).alias("username"), K.community_from_url(url).alias("community")
    )


@query("build_url", f"""
    SELECT c_custkey, '{BASE_URL}/u/' || c_name AS url,
           '{BASE_URL}/u/' || replace(c_name, '#', '%23') AS encoded FROM customer""")
def build_url(t: Tables):
    name = F.col("c_name")
    return t.read("customer").select(
        "c_custkey",
        K.build_url(BASE_URL, "u", name).alias("url"),
        K.build_url(BASE_URL, "u", name, encode=True).alias("encoded"),
    )


KEY_SQL = r"""coalesce(nullif(trim(replace(regexp_extract(url,
    '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '/', '_'), '_'), ''), 'index')
    || '_' || substr(md5(url), 1, 8) || '.html'"""


@query("page_cache_key", f"SELECT page_id, {KEY_SQL} AS cache_key FROM pages")
def page_cache_key(t: Tables):
    return t.read("pages").select("page_id", K.page_cache_key(F.col("url")).alias("cache_key"))


WANTED_SQL = f"""wanted AS (
    SELECT url FROM pages UNION ALL SELECT '{BASE_URL}/u/' || c_name FROM customer)"""


def _wanted(t: Tables) -> DataFrame:
    profiles = t.read("customer").select(K.build_url(BASE_URL, "u", F.col("c_name")).alias("url"))
    return t.read("pages").select("url").unionByName(profiles)


@query("pages_cached", f"SELECT url, {KEY_SQL} AS cache_key FROM wanted WHERE url IN (SELECT url FROM pages)", WANTED_SQL)
def pages_cached(t: Tables):
    return pagestore.cached(_wanted(t), t.read("pages").select("url"))


@query("pages_to_fetch", f"SELECT url, {KEY_SQL} AS cache_key FROM wanted WHERE url NOT IN (SELECT url FROM pages)", WANTED_SQL)
def pages_to_fetch(t: Tables):
    return pagestore.to_fetch(_wanted(t), t.read("pages").select("url"))


# --- scalar rules -------------------------------------------------------------------


@query("trim_ws", f"""
    SELECT doc_id, trim(chr(160) || chr(9) || text || chr(12288) || chr(10), {WS_SQL}) AS text FROM documents""")
def trim_ws(t: Tables):
    padded = F.concat(F.lit("\xa0\t"), F.col("text"), F.lit("　\n"))
    return t.read("documents").select("doc_id", S.trim_ws(padded).alias("text"))


@query("cast_default", """
    SELECT doc_id, coalesce(try_cast(CASE WHEN lang = 'en' THEN CAST(n_chars AS VARCHAR)
           WHEN lang = 'fr' THEN text END AS BIGINT), 0) AS n FROM documents""")
def cast_default(t: Tables):
    mixed = F.when(F.col("lang") == "en", F.col("n_chars").cast("string")).when(
        F.col("lang") == "fr", F.col("text")
    )
    return t.read("documents").select("doc_id", S.cast_default(mixed, lenient=True).alias("n"))


NUMBER_TEXT_SQL = """number_texts AS (
    SELECT c_custkey, CASE c_custkey % 8
        WHEN 0 THEN CAST(c_custkey AS VARCHAR) || ' karma'
        WHEN 1 THEN CAST(c_custkey // 10 AS VARCHAR) || '.' || CAST(c_custkey % 10 AS VARCHAR) || 'K'
        WHEN 2 THEN ' ' || CAST(c_custkey // 10 AS VARCHAR) || '.5m Followers '
        WHEN 3 THEN '1,' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0')
        WHEN 4 THEN CAST(c_custkey AS VARCHAR) || '_000'
        WHEN 5 THEN 'inf' WHEN 6 THEN c_name
        ELSE '-' || CAST(c_custkey AS VARCHAR) || '.75 points' END AS text FROM customer)"""


def _number_texts(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    text, tens, ones = key.cast("string"), (key / 10).cast("bigint").cast("string"), (key % 10).cast("string")
    kind = key % 8
    return t.read("customer").select(
        "c_custkey",
        F.when(kind == 0, F.concat(text, F.lit(" karma")))
        .when(kind == 1, F.concat(tens, F.lit("."), ones, F.lit("K")))
        .when(kind == 2, F.concat(F.lit(" "), tens, F.lit(".5m Followers ")))
        .when(kind == 3, F.concat(F.lit("1,"), F.lpad((key % 1000).cast("string"), 3, "0")))
        .when(kind == 4, F.concat(text, F.lit("_000")))
        .when(kind == 5, "inf")
        .when(kind == 6, F.col("c_name"))
        .otherwise(F.concat(F.lit("-"), text, F.lit(".75 points")))
        .alias("text"),
    )


WORDS_OUT = "lower(trim(text))"
for _word in S.NUMBER_WORDS:
    WORDS_OUT = f"trim(replace({WORDS_OUT}, '{_word}', ''))"


@query("parse_human_number", f"""
    SELECT c_custkey, CASE WHEN regexp_full_match(num, '{S.DECIMAL_PATTERN[1:-1]}')
           THEN CAST(trunc(CAST(replace(num, '_', '') AS DOUBLE) * factor) AS BIGINT) ELSE 0 END AS n
    FROM (SELECT c_custkey, CASE WHEN bare LIKE '%k' THEN 1e3 WHEN bare LIKE '%m' THEN 1e6 ELSE 1e0 END AS factor,
                 trim(regexp_replace(bare, '[km]$', '')) AS num
          FROM (SELECT c_custkey, {WORDS_OUT} AS bare FROM number_texts) a) b""", NUMBER_TEXT_SQL)
def parse_human_number(t: Tables):
    return _number_texts(t).select("c_custkey", S.parse_human_number(F.col("text")).alias("n"))


@query("safe_int", """
    SELECT c_custkey, CASE WHEN regexp_full_match(trim(text), '[+-]?[0-9]+(_[0-9]+)*')
           THEN CAST(replace(trim(text), '_', '') AS BIGINT) ELSE 0 END AS n
    FROM (SELECT c_custkey, replace(replace(text, ' karma', ''), 'Customer#', '+') AS text FROM number_texts) q""",
    NUMBER_TEXT_SQL)
def safe_int(t: Tables):
    text = F.replace(F.replace("text", F.lit(" karma"), F.lit("")), F.lit("Customer#"), F.lit("+"))
    return _number_texts(t).select("c_custkey", S.safe_int(text).alias("n"))


@query("relative_date", """
    SELECT event_id, strftime(ts - CASE event_type WHEN 'click' THEN to_days(CAST(user_id AS INTEGER))
             WHEN 'view' THEN to_hours(user_id) WHEN 'error' THEN to_minutes(user_id)
             WHEN 'purchase' THEN to_weeks(CAST(user_id AS INTEGER)) ELSE to_days(0) END, '%Y-%m-%d') AS day
    FROM events""")
def relative_date(t: Tables):
    kind = F.col("event_type")
    unit = (
        F.when(kind == "click", "d ago")
        .when(kind == "view", "h ago")
        .when(kind == "error", "mo ago")  # read as minutes: the first unit contained wins
        .when(kind == "purchase", "w ago")
        .otherwise("y ago")
    )
    age = F.concat(F.lit("u/somebody • "), F.col("user_id").cast("string"), unit)
    return t.read("events").select(
        "event_id", S.relative_date(age, F.col("ts")).alias("day")
    )


@query("log_transforms", f"""
    SELECT id_user, CASE WHEN karma > -1 THEN {r('ln(1 + karma)', 'x')[:-5]} END AS log_karma,
           round(greatest(exp(ln(1 + greatest(karma, 0)) / 2) - 1, 0), 6) AS back,
           CAST(greatest(karma, 0) AS DOUBLE) AS clipped FROM users""")
def log_transforms(t: Tables):
    karma = F.col("karma")
    half = F.log1p(S.clip_low(karma)) / 2
    return t.users.select(
        "id_user",
        S.log_target(karma).alias("log_karma"),
        S.back_transform(half).alias("back"),
        S.clip_low(karma).alias("clipped"),
    )


@query("string_fns", """
    SELECT conv_id, turn, replace(trim('u/' || role), 'u/', '') AS author, lower(text) AS low,
           substr(text, 1, 50) AS head, contains(text, ' de ') AS has_word, starts_with(text, 'E') AS starts
    FROM conversations""")
def string_fns(t: Tables):
    text = F.col("text")
    return t.read("conversations").select(
        "conv_id",
        "turn",
        S.author_name(F.concat(F.lit("u/"), "role")).alias("author"),
        F.lower(text).alias("low"),
        F.substring(text, 1, 50).alias("head"),
        text.contains(" de ").alias("has_word"),
        text.startswith("E").alias("starts"),
    )


@query("regex_first", """
    SELECT page_id, coalesce(nullif(regexp_extract(html, '<h2>([^<]*)', 1), ''),
                             nullif(regexp_extract(html, '<title>([^<]*)', 1), '')) AS heading FROM pages""")
def regex_first(t: Tables):
    patterns = ["<h2>([^<]*)", "<title>([^<]*)"]
    return t.read("pages").select("page_id", S.first_match(F.col("html"), patterns).alias("heading"))


@query("regex_all", """
    SELECT page_id, array_to_string(regexp_extract_all(html, 'href="/([^"]*)"', 1), '|') AS targets FROM pages""")
def regex_all(t: Tables):
    found = S.all_matches(F.col("html"), 'href="/([^"]*)"')
    return t.read("pages").select("page_id", F.array_join(found, "|").alias("targets"))


@query("net_votes", """
    SELECT s.s_suppkey, coalesce(n.up, 0) - coalesce(s.s_nationkey, 0) AS votes
    FROM supplier s LEFT JOIN (SELECT l_suppkey, count(*) AS up FROM lineitem GROUP BY 1) n
         ON s.s_suppkey = n.l_suppkey""")
def net_votes(t: Tables):
    ups = t.read("lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("up"))
    joined = t.read("supplier").join(ups, "s_suppkey", "left")
    return joined.select(
        "s_suppkey", S.net_votes(F.col("up"), F.col("s_nationkey").cast("bigint")).alias("votes")
    )


@query("iso_prefix_date", """
    SELECT id_post, nullif(substr(CASE WHEN description = '' THEN '' ELSE scraped_at END, 1, 10), '') AS day
    FROM posts""")
def iso_prefix_date(t: Tables):
    text = F.when(F.col("description") == "", "").otherwise(F.col("scraped_at"))
    return t.posts.select("id_post", S.iso_prefix_date(text).alias("day"))


# --- payloads -----------------------------------------------------------------------


def _lines(text: str = "text") -> Column:
    return F.split(text, "\n")


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields))


LINES_SQL = """lines AS (
    SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)"""


@query("json_listing", """
    SELECT doc_id * 100000 + pos AS pos, line AS name FROM lines WHERE line <> ''""", LINES_SQL)
def json_listing(t: Tables):
    listed = F.transform(_lines(), lambda x: F.struct(x.alias("name")))
    payloads = t.read("documents").select(
        (F.col("doc_id") * 100000).alias("offset"), _json(listed.alias("communities")).alias("body")
    )
    return J.listing_names(payloads)


LISTING_SIZE = 4
# The walk of a reader: from offset 0 to the offset behind the items, until a page is
# missing, empty or short. Pages of one offset: the one that landed last.
LISTING_SQL = LINES_SQL + """,
  cut AS (SELECT doc_id, pos // 4 AS k, list({'line': line, 'pos': pos} ORDER BY pos) AS items
    FROM lines GROUP BY doc_id, pos // 4),
  shortened AS (SELECT doc_id, k, CASE WHEN (doc_id + k) % 5 = 4 THEN items[:-2] ELSE items END AS items
    FROM cut WHERE (doc_id + k) % 7 <> 3),
  landed AS (SELECT doc_id, k * 4 AS start, items FROM shortened),
  walk(doc_id, start, items, done) AS (
    SELECT doc_id, start, items, len(items) < 4 FROM landed WHERE start = 0
    UNION ALL SELECT n.doc_id, n.start, n.items, len(n.items) < 4
    FROM walk w JOIN landed n ON n.doc_id = w.doc_id AND n.start = w.start + len(w.items) WHERE NOT w.done),
  reached AS (SELECT doc_id, max(start + len(items)) AS upto, bool_or(done) AS done FROM walk GROUP BY doc_id)"""


def _listing_pages(t: Tables) -> DataFrame:
    """A listing per document, four lines a page: some pages are missing, some are short, and some
    landed twice, first with other items."""
    cut = F.transform(
        F.sequence(F.lit(0), F.expr(f"(size(lines) - 1) div {LISTING_SIZE}")),
        lambda k: F.struct(k.alias("k"), F.slice("lines", k * LISTING_SIZE + 1, F.lit(LISTING_SIZE)).alias("lines")),
    )
    pages = t.read("documents").filter("text is not null").select("doc_id", _lines().alias("lines"))
    pages = pages.select("doc_id", F.inline(cut)).filter("(doc_id + k) % 7 <> 3")
    kept = F.when((F.col("doc_id") + F.col("k")) % 5 == 4, F.expr("slice(lines, 1, size(lines) - 1)")).otherwise(F.col("lines"))
    items = F.transform(kept, lambda x: F.struct(x.alias("name")))
    stale = F.transform("lines", lambda x: F.struct(F.upper(x).alias("name")))
    versions = F.array(
        F.struct(F.lit("2024-06-02").alias("landed_at"), items.alias("communities")),
        *[F.struct(F.lit("2024-06-01").alias("landed_at"), F.when(F.col("k") % 2 == 0, stale).otherwise(items).alias("communities"))],
    )
    rows = pages.select("doc_id", (F.col("k") * LISTING_SIZE).alias("offset"), F.inline(versions))
    return rows.select(F.col("doc_id").alias("listing"), "offset", "landed_at", _json("communities").alias("body"))


@query("listing_names", """
    SELECT doc_id AS listing, start + i - 1 AS pos, items[i].line AS name
    FROM walk, unnest(range(1, len(items) + 1)) AS r(i) WHERE items[i].line <> ''""", LISTING_SQL)
def listing_names(t: Tables):
    payloads = _listing_pages(t)
    pages = cut_lineage(listings.listing_pages(payloads, LISTING_SIZE))
    return listings.listed_names(payloads, pages)


@query("listing_gaps", """
    SELECT l.doc_id AS listing, coalesce(any_value(upto), 0) AS gap_from, min(start) AS gap_to,
           count(*) AS pages_refused
    FROM landed l LEFT JOIN reached r ON r.doc_id = l.doc_id
    WHERE start > coalesce(upto, 0) AND NOT coalesce(done, false) GROUP BY l.doc_id""", LISTING_SQL)
def listing_gaps(t: Tables):
    return listings.listing_gaps(listings.listing_pages(_listing_pages(t), LISTING_SIZE))


def _community_payloads(t: Tables) -> DataFrame:
    """One community payload per document, one post per line, some unsuccessful."""
    post = F.transform(
        _lines(),
        lambda line, i: F.struct(
            line.alias("title"),
            F.when(i % 2 == 0, line).alias("content"),
            F.length(line).cast("bigint").alias("upvotes"),
            F.when(i % 3 == 0, i).alias("downvotes"),
            F.lit("2024-03-05T10:11:12Z").alias("created_at"),
            F.struct(F.concat(F.col("lang"), F.lit("-"), i.cast("string")).alias("name")).alias("author"),
            F.when(i % 4 == 0, F.concat(F.lit("/post/"), F.col("doc_id"), F.lit("-"), i)).alias("url"),
        ),
    )
    body = _json(
        (F.col("source") != "src0").alias("success"),
        F.struct(F.col("source").alias("description")).alias("community"),
        post.alias("posts"),
    )
    return t.read("documents").select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("name"), body.alias("body")
    )


JSON_POSTS_SQL = LINES_SQL + f""", listed AS (
    SELECT 'c' || doc_id AS community, line AS title, CASE WHEN pos % 2 = 0 THEN line END AS content,
           length(line) - CASE WHEN pos % 3 = 0 THEN pos ELSE 0 END AS rating,
           {_id_sql('user', "lang || '-' || pos")} AS id_user,
           CASE WHEN pos % 4 = 0 THEN '/post/' || doc_id || '-' || pos END AS url
    FROM lines JOIN documents USING (doc_id, lang) WHERE source <> 'src0'),
  made AS (SELECT {_id_sql('post', "coalesce(url, title || '-' || id_user)")} AS id_post, id_user,
           {_id_sql('community', 'lower(community)')} AS id_community, title, content AS description,
           '2024-03-05' AS date, '2024-06-01' AS scraped_at, rating FROM listed)"""


@query("json_posts", "SELECT * FROM made", JSON_POSTS_SQL)
def json_posts(t: Tables):
    listed = J.posts_in_payloads(_community_payloads(t))
    return J.post_rows(listed, t.users, F.lit("2024-06-01"))


@query("stream_posts", """
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id_post ORDER BY scraped_at DESC NULLS LAST,
      id_user DESC NULLS LAST, id_community DESC NULLS LAST, title DESC NULLS LAST, description DESC NULLS LAST,
      date DESC NULLS LAST, rating DESC NULLS LAST) AS rn FROM made) q WHERE rn = 1""", JSON_POSTS_SQL)
def stream_posts(t: Tables):
    """The community payloads land as files and stream into all the tables that they fill."""
    root, nothing = t.folder(), F.lit(None).cast("string")
    rows = _community_payloads(t).select(F.lit("community").alias("kind"), "name", nothing.alias("id_post"), "body")
    with scratch(t.spark):  # the landed files go when their rows are in the tables
        landed = t.folder()
        rows.write.json(landed, compression="gzip")
        source = incremental.landed_files(t.spark, landed, incremental.LANDED)
        incremental.payload_stream(source, root, f"{root}/_progress", F.lit("2024-06-01")).awaitTermination()
    return store.read_current(t.spark, root, "posts")


@query("json_communities", f"""
    SELECT {_id_sql('community', "'c' || doc_id")} AS id_community, 'c' || doc_id AS name,
           source AS description, '2024-06-01' AS scraped_at FROM documents WHERE source <> 'src0'""")
def json_communities(t: Tables):
    return J.community_rows(_community_payloads(t), F.lit("2024-06-01"))


@query("new_posts_only", """
    SELECT * FROM posts WHERE id_post NOT IN (SELECT id_post FROM comments WHERE rating > 40)""")
def new_posts_only(t: Tables):
    stored = t.comments.filter("rating > 40")
    return J.new_rows_only(t.posts, stored, "id_post")


@query("json_profile", f"""
    SELECT {_id_sql('user', 'lower(name)')} AS id_user, name, description,
           nullif(human_owner, '') AS human_owner, '2024-01-01' AS joined, '2024-06-01' AS scraped_at,
           karma, followers, following FROM raw_users""")
def json_profile(t: Tables):
    agent = F.struct(
        "karma",
        "description",
        F.col("followers").alias("follower_count"),
        F.col("following").alias("following_count"),
        F.col("scraped_at").alias("created_at"),
        F.struct(F.col("human_owner").alias("x_handle")).alias("owner"),
    )
    payloads = t.raw["users"].select("name", _json(F.lit(True).alias("success"), agent.alias("agent")).alias("body"))
    return J.profile_rows(payloads, F.lit("2024-06-01"))


@query("json_scalar", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_scalar(t: Tables):
    value = F.get_json_object("props", "$.k").try_cast("bigint")
    return t.read("events").select("event_id", value.alias("k"))


def _post_payloads(t: Tables) -> DataFrame:
    """One comment tree per turn: lines, under them sentences, under them clauses."""

    def node(text: Column, depth: int, replies: Column | None) -> Column:
        fields = [
            F.struct(F.concat(F.col("role"), F.lit(str(depth))).alias("name")).alias("author"),
            text.alias("content"),
            F.length(text).cast("bigint").alias("upvotes"),
            F.lit(depth).cast("bigint").alias("downvotes"),
            F.lit("2024-03-05T10:11:12Z").alias("created_at"),
        ]
        return F.struct(*fields, *([replies.alias("replies")] if replies is not None else []))

    def clauses(sentence: Column) -> Column:
        return F.transform(F.split(sentence, ", "), lambda c: node(c, 3, None))

    def sentences(line: Column) -> Column:
        return F.transform(F.split(line, r"\. "), lambda s: node(s, 2, clauses(s)))

    tree = F.transform(_lines(), lambda line: node(line, 1, sentences(line)))
    key = F.concat_ws("-", F.lit("p"), "conv_id", "turn")
    return t.read("conversations").select(key.alias("id_post"), _json(tree.alias("comments")).alias("body"))


TREE_SQL = """level1 AS (
    SELECT 'p-' || conv_id || '-' || turn AS id_post, role, unnest(string_split(text, chr(10))) AS content,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM conversations),
  level2 AS (SELECT id_post, role, i, unnest(string_split(content, '. ')) AS content,
           generate_subscripts(string_split(content, '. '), 1) - 1 AS j FROM level1),
  level3 AS (SELECT id_post, role, i, j, unnest(string_split(content, ', ')) AS content,
           generate_subscripts(string_split(content, ', '), 1) - 1 AS k FROM level2),
  tree AS (SELECT id_post, role, content, 1 AS depth, i, -1 AS j, -1 AS k FROM level1
    UNION ALL SELECT id_post, role, content, 2, i, j, -1 FROM level2
    UNION ALL SELECT id_post, role, content, 3, i, j, k FROM level3),
  ordered AS (SELECT *, row_number() OVER (PARTITION BY id_post ORDER BY i, j, k) AS place FROM tree)"""


@query("flatten_replies", """
    SELECT id_post, CAST(depth AS INTEGER) AS depth, role || depth AS author, content,
           CAST(length(content) AS BIGINT) AS upvotes, CAST(depth AS BIGINT) AS downvotes,
           '2024-03-05T10:11:12Z' AS created_at,
           CASE depth WHEN 1 THEN CAST(i AS VARCHAR) WHEN 2 THEN i || '.' || j ELSE i || '.' || j || '.' || k END AS path
    FROM tree""", TREE_SQL)
def flatten_replies(t: Tables):
    flat = J.flatten_replies(_post_payloads(t))
    return flat.withColumn("path", F.array_join(F.col("path").cast("array<string>"), "."))


@query("json_comments", f"""
    SELECT {_id_sql('comment', "concat_ws('|', id_user, id_post, nullif(description, ''))")} AS id_comment,
           id_user, id_post, description, '2024-03-05' AS date, '2024-06-01' AS scraped_at, rating
    FROM (SELECT {_id_sql('user', 'role || depth')} AS id_user, id_post, content AS description,
                 CAST(length(content) - depth AS BIGINT) AS rating FROM ordered) q""", TREE_SQL)
def json_comments(t: Tables):
    rows = J.comment_rows(_post_payloads(t), t.users, F.lit("2024-06-01"))
    return rows.drop("author", "path")


# --- pages --------------------------------------------------------------------------


def _escape(text: Column) -> Column:
    for char, mark in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(mark))
    return text


def _c(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


@query("page_links", """
    SELECT page_id, name, min(pos) AS pos FROM (
      SELECT page_id, unnest(found) AS name, CAST(generate_subscripts(found, 1) - 1 AS INTEGER) AS pos
      FROM (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*href="/([^"/?#]+)', 1) AS found FROM pages) a) b
    GROUP BY page_id, name""")
def page_links(t: Tables):
    return P.page_links(t.read("pages"))


@query("page_refs", """
    SELECT DISTINCT name FROM (SELECT unnest(regexp_extract_all(replace(html, 'href="/', 'href="/m/'),
           '/m/([A-Za-z0-9_-]+)', 1)) AS name FROM pages) q
    WHERE length(name) > 1 AND name NOT IN ('undefined', 'null', 'create')""")
def page_refs(t: Tables):
    linked = F.replace("html", F.lit('href="/'), F.lit('href="/m/'))
    return P.page_refs(t.read("pages").withColumn("html", linked))


def _text_sql(html: str) -> str:
    bare = f"regexp_replace({html}, '(?is)<(?:script|style)\\b.*?</(?:script|style)\\s*>', '', 'g')"
    bare = f"regexp_replace({bare}, '(?s)<!--.*?-->', '', 'g')"
    bare = f"regexp_replace({bare}, '(?s)<[!/A-Za-z][^>]*>', '', 'g')"
    for mark, char in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "chr(34)"), ("&#39;", "chr(39)"), ("&nbsp;", "chr(160)"), ("&amp;", "'&'")):
        bare = f"replace({bare}, '{mark}', {char})"
    return bare


@query("page_text_length", f"""
    SELECT page_id, text, CAST(length(text) AS INTEGER) AS n FROM (SELECT page_id, {_text_sql('html')} AS text FROM pages) q""")
def page_text_length(t: Tables):
    text = P.visible_text(F.col("html"))
    return t.read("pages").select("page_id", text.alias("text"), F.length(text).alias("n"))


HEADING, PARAGRAPH = r"(?s)<h1[^>]*>(.*?)</h1>", r"(?s)<h1[^>]*>.*?<p[^>]*>(.*?)</p>"


@query("page_heading_paragraph", f"""
    SELECT page_id, {_text_sql(f"regexp_extract(html, '{HEADING}', 1)")} AS heading,
           {_text_sql(f"regexp_extract(html, '{PARAGRAPH}', 1)")} AS paragraph FROM pages""")
def page_heading_paragraph(t: Tables):
    html = F.col("html")
    return t.read("pages").select(
        "page_id",
        P.visible_text(F.regexp_extract(html, HEADING, 1)).alias("heading"),
        P.visible_text(F.regexp_extract(html, PARAGRAPH, 1)).alias("paragraph"),
    )


@query("page_description", f"""
    SELECT doc_id, CASE WHEN lang = 'en' THEN text WHEN lang = 'fr' THEN trim(text, {WS_SQL})
           WHEN lang = 'de' THEN trim(source, {WS_SQL}) END AS description
    FROM documents""")
def page_description(t: Tables):
    lang, text, source = F.col("lang"), _escape(F.col("text")), _escape(F.col("source"))
    meta = _c('<html><head><meta name="description" content="', text, '"></head>')
    html = (
        F.when(lang == "en", _c(meta, "<body><p class='other'>no</p></body></html>"))
        .when(lang == "fr", _c(meta, '<body><p class="lead description">', text, "</p></body></html>"))
        .when(lang == "de", _c('<body><div class="about">', source, "</div></body>"))
        .otherwise("<body><p>none</p></body>")
    )
    return t.read("documents").select("doc_id", P.page_description(html).alias("description"))


def _joined(lines: Column, make) -> Column:
    return F.array_join(F.transform(lines, make), "")


def _now() -> Column:
    return F.lit("2024-06-30 12:00:00").cast("timestamp")


@query("html_comments", f"""
    SELECT 'https://x.org/post/' || conv_id || '-' || turn AS url, CAST(pos AS INTEGER) AS pos, role AS author,
           trim(line, {WS_SQL}) AS description, pos AS rating,
           strftime(DATE '2024-06-30' - CAST(pos % 40 AS INTEGER), '%Y-%m-%d') AS date
    FROM (SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM conversations) q
    WHERE trim(line, {WS_SQL}) <> ''""")
def html_comments(t: Tables):
    box = _joined(
        _lines(),
        lambda line, i: _c(
            '<div class="py-2 border"><div class="flex items-center gap-2 text-xs"><a href="/u/',
            F.col("role"), '">u/', F.col("role"), "</a> <span>", (i % 40).cast("string"), "d ago</span></div>",
            '<div class="prose prose-invert"><p>', _escape(line), "</p></div>",
            '<span class="flex items-center gap-1"><span>', i.cast("string"), "</span></span></div>",
        ),
    )
    pages = t.read("conversations").select(
        F.concat_ws("", F.lit("https://x.org/post/"), "conv_id", F.lit("-"), "turn").alias("url"),
        _c('<html><body><div class="mt-6">', box, "</div></body></html>").alias("html"),
    )
    return P.comments_on_pages(pages, _now(), max_comments=None)


@query("html_posts", f"""
    SELECT 'https://x.org/m/c' || doc_id AS url, pos, title, description, author, community, rating, date, post_url
    FROM (SELECT doc_id, CAST(pos AS INTEGER) AS pos, trim(line, {WS_SQL}) AS title, trim(line, {WS_SQL}) AS description,
                 lang AS author, 'c' || doc_id AS community, pos AS rating,
                 strftime(TIMESTAMP '2024-06-30 12:00:00' - to_hours(pos), '%Y-%m-%d') AS date,
                 'https://x.org/post/' || doc_id || '-' || pos AS post_url
          FROM lines WHERE trim(line, {WS_SQL}) <> '') q""", LINES_SQL)
def html_posts(t: Tables):
    card = _joined(
        _lines(),
        lambda line, i: _c(
            '<a class="block" href="/post/', F.col("doc_id").cast("string"), "-", i.cast("string"), '"><h3>', _escape(line),
            '</h3><p class="text-sm line-clamp-3">', _escape(line), '</p><div class="text-xs"><span class="hover:underline">u/',
            F.col("lang"), "</span> <span>", i.cast("string"), 'h ago</span></div><span class="text-white font-bold">',
            i.cast("string"), "</span></a>",
        ),
    )
    pages = t.read("documents").select(
        _c("https://x.org/m/c", F.col("doc_id").cast("string")).alias("url"),
        _c("<html><body><main>", card, "</main></body></html>").alias("html"),
    )
    return P.posts_on_pages(pages, _now(), site="https://x.org")


@query("html_listing", """
    SELECT 'https://x.org/u?page=' || id_user AS url, CAST(0 AS INTEGER) AS pos, replace(name, '#', '-') AS name,
           abs(karma) AS karma, '/u/' || replace(name, '#', '-') || '?tab=posts' AS profile_url FROM raw_users""")
def html_listing(t: Tables):
    name = F.replace("name", F.lit("#"), F.lit("-"))
    link = _c('<a href="/u/', name, '?tab=posts"><span>', name, "</span></a>")
    html = _c(
        "<html><body><nav>karma board</nav><div><p>", link, '<span class="s">', F.abs("karma").cast("string"),
        " Karma</span></p>", link, "</div></body></html>",
    )
    pages = t.raw["users"].select(_c("https://x.org/u?page=", F.col("id_user")).alias("url"), html.alias("html"))
    return P.user_listing(pages)


@query("html_community_listing", f"""
    SELECT 'https://x.org/m?page=' || doc_id AS url, CAST(0 AS INTEGER) AS pos, 'c' || doc_id AS name,
           nullif(trim(text, {WS_SQL}), '') AS description, '/m/c' || doc_id AS page_url FROM documents""")
def html_community_listing(t: Tables):
    key = F.col("doc_id").cast("string")
    html = _c('<body><div><h3><a href="/m/c', key, '">m/c', key, "</a></h3><p>", _escape(F.col("text")), "</p></div></body>")
    pages = t.read("documents").select(_c("https://x.org/m?page=", key).alias("url"), html.alias("html"))
    return P.community_listing(pages)


def _profile_pages(t: Tables) -> DataFrame:
    """A profile page per document: the text is the bio, the length the karma."""
    n = F.col("n_chars").cast("string")
    html = _c(
        '<html><body><div class="flex items-start gap-4"><div class="flex-1"><h1>name</h1><p class="mt-1">',
        _escape(F.col("text")), '</p><span>|</span><div class="mt-3 flex flex-wrap items-center"><div class="text-sm"><span class="font-bold">',
        n, '</span> karma</div><div class="text-sm"><span class="font-bold">1.5K</span> followers</div>',
        '<div class="text-sm"><span class="font-bold">', F.col("doc_id").cast("string"), "</span> following</div>",
        '<div class="text-sm">Joined 2/3/2024</div></div><div class="mt-4 pt-4 border-t"><a href="https://x.com/own_',
        F.col("lang"), '">owner</a></div></div></div></body></html>',
    )
    url = _c("https://x.org/u/d", F.col("doc_id").cast("string"))
    return t.read("documents").select(url.alias("url"), html.alias("html"))


@query("html_profiles_by_block", f"""
    SELECT 'https://x.org/u/d' || doc_id AS url, 'd' || doc_id AS name, nullif(trim(text, {WS_SQL}), '') AS description,
           'own_' || lang AS human_owner, '2/3/2024' AS joined, n_chars AS karma, CAST(1500 AS BIGINT) AS followers,
           doc_id AS following FROM documents""")
def html_profiles_by_block(t: Tables):
    return P.profiles_by_block(_profile_pages(t), site_handles=("site_team",))


@query("html_profiles", f"""
    SELECT 'https://x.org/u/d' || doc_id AS url, 'd' || doc_id AS name, trim(text, {WS_SQL}) AS description,
           'own_' || lang AS human_owner, '2/3/2024' AS joined, n_chars AS karma, CAST(1500 AS BIGINT) AS followers,
           doc_id AS following FROM documents""")
def html_profiles(t: Tables):
    return P.profiles(_profile_pages(t))
