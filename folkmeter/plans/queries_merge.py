"""Upsert, discovery, run summary and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from folkmeter import schemas
from folkmeter.functions import scalars as S
from folkmeter.operators import frontier, relational, upsert
from folkmeter.plans import jobs
from folkmeter.plans.registry import Tables, query
from folkmeter.session import cut_lineage
from folkmeter.sources import store
from folkmeter.streaming.incremental import upsert_stream

USER_COLUMNS = "id_user name karma description human_owner joined followers following scraped_at".split()

# Every comment brings a reading of its author: many rows per key, some keys not stored.
READINGS_SQL = """readings AS (
    SELECT id_user, CASE WHEN rating < 48 THEN 'u' || id_user END AS name, rating AS karma, description,
           CAST(NULL AS VARCHAR) AS human_owner, date AS joined, CAST(0 AS BIGINT) AS followers,
           CAST(0 AS BIGINT) AS following, scraped_at FROM comments),
  good AS (SELECT * FROM readings WHERE name IS NOT NULL),
  latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id_user
      ORDER BY scraped_at DESC NULLS LAST, name DESC NULLS LAST, karma DESC NULLS LAST,
               description DESC NULLS LAST, human_owner DESC NULLS LAST, joined DESC NULLS LAST) AS rn
      FROM good) q WHERE rn = 1),
  merged AS (SELECT * FROM raw_users WHERE id_user NOT IN (SELECT id_user FROM latest)
             UNION ALL BY NAME SELECT * FROM latest)"""


def _readings(t: Tables):
    zero = F.lit(0).cast("bigint")
    return t.comments.select(
        "id_user",
        F.when(F.col("rating") < 48, F.concat(F.lit("u"), "id_user")).alias("name"),
        F.col("rating").alias("karma"),
        "description",
        F.lit(None).cast("string").alias("human_owner"),
        F.col("date").alias("joined"),
        zero.alias("followers"),
        zero.alias("following"),
        "scraped_at",
    )


@query("upsert_users", "SELECT * FROM merged", READINGS_SQL)
def upsert_users(t: Tables):
    good, _ = upsert.split_valid(_readings(t), "users")
    return upsert.upsert(t.raw["users"], good, ["id_user"])


@query("upsert_valid_invalid", """
    SELECT 'merged' AS part, id_user, karma, CAST(NULL AS VARCHAR) AS missing FROM merged
    UNION ALL SELECT 'quarantine', id_user, karma, 'name' FROM readings WHERE name IS NULL""", READINGS_SQL)
def upsert_valid_invalid(t: Tables):
    merged, bad = upsert.upsert_checked(t.raw["users"], _readings(t), "users")
    nothing = F.lit(None).cast("string").alias("missing")
    return merged.select(F.lit("merged").alias("part"), "id_user", "karma", nothing).unionByName(
        bad.select(F.lit("quarantine").alias("part"), "id_user", "karma", "missing")
    )


@query("upsert_memberships", """
    SELECT DISTINCT id_user, id_community FROM posts
    UNION SELECT c.id_user, p.id_community FROM comments c JOIN posts p ON c.id_post = p.id_post""")
def upsert_memberships(t: Tables):
    target = t.posts.select("id_user", "id_community").distinct()
    pairs = relational.memberships(t.posts, t.comments)
    return upsert.insert_ignore(target, pairs, ["id_user", "id_community"])


FRESH_SQL = """fresh AS (
    SELECT 'fresh-' || p_partkey AS id_user, 'CUSTOMER#' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS name,
           CAST(p_size AS BIGINT) AS karma, p_name AS description, p_brand AS human_owner,
           CAST(NULL AS VARCHAR) AS joined, CAST(p_size AS BIGINT) AS followers,
           CAST(p_size AS BIGINT) AS following, '2024-06-01' AS scraped_at FROM part),
  wanted AS (SELECT fresh.* REPLACE (u.id_user AS id_user) FROM fresh JOIN raw_users u ON lower(u.name) = lower(fresh.name)
      WHERE u.name IS NOT NULL AND (u.description IS NULL OR u.karma = 0 OR u.karma IS NULL))"""


@query("enrich_incomplete", """
    SELECT * FROM raw_users WHERE id_user NOT IN (SELECT id_user FROM wanted)
    UNION ALL BY NAME SELECT * FROM wanted""", FRESH_SQL)
def enrich_incomplete(t: Tables):
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("bigint")
    fresh = t.read("part").select(
        F.concat(F.lit("fresh-"), key).alias("id_user"),
        F.concat(F.lit("CUSTOMER#"), F.lpad(key, 9, "0")).alias("name"),
        size.alias("karma"),
        F.col("p_name").alias("description"),
        F.col("p_brand").alias("human_owner"),
        F.lit(None).cast("string").alias("joined"),
        size.alias("followers"),
        size.alias("following"),
        F.lit("2024-06-01").alias("scraped_at"),
    )
    return upsert.enrich_incomplete(t.raw["users"], fresh)


@query("run_summary", """
    SELECT entity, CAST(sum(new_rows) AS BIGINT) AS new_rows, CAST(sum(total_rows) AS BIGINT) AS total_rows FROM (
      SELECT unnest([entity, 'total']) AS entity, new_rows, old_rows + new_rows AS total_rows FROM lines) q
    GROUP BY entity""",
    """lines AS (SELECT 'users' AS entity, (SELECT count(*) FROM users) AS old_rows,
             (SELECT count(DISTINCT id_user) FROM comments WHERE id_user NOT IN (SELECT id_user FROM users)) AS new_rows
       UNION ALL SELECT 'posts', (SELECT count(*) FROM posts),
             (SELECT count(DISTINCT id_user) FROM comments WHERE id_user NOT IN (SELECT id_post FROM posts)))""")
def run_summary(t: Tables):
    stored = {"users": t.users, "posts": t.posts}
    authors = t.comments.select("id_user")
    batch = {"users": authors, "posts": authors.select(F.col("id_user").alias("id_post"))}
    return upsert.run_summary(stored, batch)


EDGES_SQL = """found AS (SELECT regexp_extract_all(html, '<a\\s[^>]*href="/([^"/?#]+)', 1) AS refs FROM pages),
  edges AS (SELECT DISTINCT refs[1] AS src, unnest(refs) AS dst FROM found),
  seeds AS (SELECT DISTINCT regexp_extract(text, '^[^ \\n]+') AS name FROM documents WHERE text <> ''),
  walk(name, depth) AS (
    SELECT name, 0 FROM seeds
    UNION SELECT e.dst, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.name WHERE w.depth < 50)"""  # beyond any shortest path here


def _pages_and_seeds(t: Tables):
    """Pages under the name that they mention first, and the first words of all documents."""
    refs = S.all_matches(F.col("html"), '<a\\s[^>]*href="/([^"/?#]+)')
    pages = t.read("pages").select(refs.alias("refs")).withColumn("name", F.get("refs", F.lit(0)))
    words = t.read("documents").filter("text <> ''")
    return pages, words.select(F.regexp_extract("text", "^[^ \\n]+", 0).alias("name"))


@query("frontier_bfs", "SELECT name, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY name", EDGES_SQL)
def frontier_bfs(t: Tables):
    pages, seeds = _pages_and_seeds(t)
    return frontier.frontier_bfs(frontier.references(pages, "name", F.col("refs")), seeds)


@query("discovered_names", """
    SELECT name, CAST(min(depth) AS INTEGER) AS depth, name IN (SELECT src FROM edges WHERE src IS NOT NULL) AS landed
    FROM walk GROUP BY name""", EDGES_SQL)
def discovered_names(t: Tables):
    pages, seeds = _pages_and_seeds(t)
    return frontier.discover(pages, "name", F.col("refs"), seeds)


EVENT_USERS_SQL = """event_users AS (
    SELECT id_user, name, karma, scraped_at FROM (
      SELECT CAST(user_id AS VARCHAR) AS id_user, event_type AS name, CAST(floor(value) AS BIGINT) AS karma,
             strftime(ts, '%Y-%m-%dT%H:%M:%S') AS scraped_at,
             row_number() OVER (PARTITION BY user_id ORDER BY strftime(ts, '%Y-%m-%dT%H:%M:%S') DESC,
                                event_type DESC, CAST(floor(value) AS BIGINT) DESC) AS rn FROM events) q
    WHERE rn = 1)"""


def _stream_events(t: Tables, root: str, progress: str) -> None:
    source = (
        t.spark.readStream.schema(t.read("events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(t.sf_dir)
    )
    nothing, zero = F.lit(None).cast("string"), F.lit(0).cast("bigint")

    def to_rows(batch):
        return batch.select(
            F.col("user_id").cast("string").alias("id_user"),
            F.col("event_type").alias("name"),
            F.floor("value").cast("bigint").alias("karma"),
            nothing.alias("description"),
            nothing.alias("human_owner"),
            nothing.alias("joined"),
            zero.alias("followers"),
            zero.alias("following"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("scraped_at"),
        )

    upsert_stream(source, root, "users", f"{root}/{progress}", to_rows).awaitTermination()


@query("stream_upsert_users", "SELECT * FROM event_users", EVENT_USERS_SQL)
def stream_upsert_users(t: Tables):
    root = t.folder()
    _stream_events(t, root, "progress")
    return store.read_current(t.spark, root, "users").select("id_user", "name", "karma", "scraped_at")


@query("stream_and_batch_upsert", """
    SELECT * FROM event_users
    UNION ALL SELECT * FROM parts WHERE id_user NOT IN (SELECT id_user FROM event_users)
    UNION ALL SELECT id_user, name, karma, scraped_at FROM raw_users
    WHERE id_user NOT IN (SELECT id_user FROM event_users) AND id_user NOT IN (SELECT id_user FROM parts)""",
    EVENT_USERS_SQL + """,
  parts AS (SELECT CAST(p_partkey AS VARCHAR) AS id_user, p_name AS name, CAST(p_size AS BIGINT) AS karma,
                   '2024-06-01' AS scraped_at FROM part)""")
def stream_and_batch_upsert(t: Tables):
    """Two batch writers that number their loads alike, and a stream that starts again from a new
    checkpoint: the times of the loads decide."""
    root = t.folder()
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("bigint")
    nothing, zero = F.lit(None).cast("string"), F.lit(0).cast("bigint")
    parts = t.read("part").select(
        key.alias("id_user"),
        F.col("p_name").alias("name"),
        size.alias("karma"),
        nothing.alias("description"),
        nothing.alias("human_owner"),
        nothing.alias("joined"),
        zero.alias("followers"),
        zero.alias("following"),
        F.lit("2024-06-01").alias("scraped_at"),
    )
    store.append_batch(t.raw["users"], root, "users", 1, "customers")
    _stream_events(t, root, "first")
    store.append_batch(parts, root, "users", 1, "parts")
    _stream_events(t, root, "second")
    return store.read_current(t.spark, root, "users").select("id_user", "name", "karma", "scraped_at")


@query("orphan_loads", """
    SELECT step, 'posts' AS table_name, count(*) FILTER (ok) AS stored, count(*) FILTER (NOT ok) AS waiting
    FROM checked_posts GROUP BY step
    UNION ALL SELECT step, 'comments', count(*) FILTER (ok), count(*) FILTER (NOT ok) FROM checked_comments GROUP BY step""",
    """steps AS (SELECT unnest([1, 2]) AS step),
  known AS (SELECT step, id_user FROM steps, users WHERE step = 2 OR CAST(id_user AS BIGINT) % 3 <> 0),
  checked_posts AS (SELECT step, id_post, (step, id_user) IN (SELECT (step, id_user) FROM known)
      AND (id_community IS NULL OR id_community IN (SELECT id_community FROM communities)) AS ok FROM steps, posts),
  checked_comments AS (SELECT step, (step, id_user) IN (SELECT (step, id_user) FROM known)
      AND (step, id_post) IN (SELECT (step, id_post) FROM checked_posts WHERE ok) AS ok FROM steps, comments)""")
def orphan_loads(t: Tables):
    """A load of all posts and comments with two thirds of the users, then one of the other users
    alone: what has waited for them is taken up."""
    root = t.folder()
    third = F.col("id_user").cast("bigint") % 3 == 0
    tables = {"users": t.users.filter(~third), "communities": t.communities, "posts": t.posts, "comments": t.comments}
    lines = []
    for step, rows in ((1, tables), (2, {"users": t.users.filter(third)})):
        jobs.load_batch(rows, root, step)
        for name in ("posts", "comments"):
            # Read before the next load: a plan would find the state after it.
            stored = cut_lineage(store.read_current(t.spark, root, name).select(*schemas.PRIMARY_KEYS[name]))
            waits = store.waiting(t.spark, root, name, stored).count()
            lines.append((step, name, stored.count(), waits))
    return t.spark.createDataFrame(lines, "step int, table_name string, stored bigint, waiting bigint")
