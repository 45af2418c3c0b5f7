"""Queries over the cleaned tables, their joins, aggregates and the feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from folkmeter.functions import scalars as S
from folkmeter.operators import cleaning, features, relational
from folkmeter.operators.quantiles import cap_at_quantile
from folkmeter.plans import jobs
from folkmeter.plans.registry import Tables, query, r, rs
from folkmeter.sources import tables as sources

# --- cleaned tables -----------------------------------------------------------------


@query("clean_users", "SELECT * FROM users")
def clean_users(t: Tables):
    return t.users


@query("clean_posts", "SELECT * FROM posts")
def clean_posts(t: Tables):
    return t.posts


@query("clean_comments", "SELECT * FROM comments")
def clean_comments(t: Tables):
    return t.comments


@query("clean_communities", "SELECT * FROM communities")
def clean_communities(t: Tables):
    return t.communities


@query(
    "dedupe_keep_last",
    """SELECT event_id, ts, user_id, event_type, value, props FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type
           ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM events) q
       WHERE rn = 1""",
)
def dedupe_keep_last(t: Tables):
    return relational.keep_last(t.read("events"), ["user_id", "event_type"], ["ts", "event_id"])


@query("silver_counts", """
    SELECT 'users' AS table_name, count(*) AS row_count FROM users
    UNION ALL SELECT 'posts', count(*) FROM posts
    UNION ALL SELECT 'comments', count(*) FROM comments
    UNION ALL SELECT 'communities', count(*) FROM communities""")
def silver_counts(t: Tables):
    counts = jobs.build_silver(t.raw, t.folder())
    rows = [(n, c["rows"]) for n, c in counts.items()]
    return t.spark.createDataFrame(rows, "table_name string, row_count bigint")


@query("scan_silver", "SELECT * FROM posts")
def scan_silver(t: Tables):
    folder = t.folder()
    sources.write_counted(t.posts, f"{folder}/posts")
    return sources.read_silver(t.spark, folder)["posts"].select(*t.posts.columns)


@query("gold_counts", """
    SELECT 'user_features' AS table_name, (SELECT count(*) FROM users) AS row_count,
           CAST(21 AS BIGINT) AS column_count
    UNION ALL SELECT 'post_features', (SELECT count(*) FROM posts), 25
    UNION ALL SELECT 'comment_features', (SELECT count(*) FROM comments), 27""")
def gold_counts(t: Tables):
    folder = t.folder()
    counts = jobs.build(t.spark, t.raw, f"{folder}/silver", f"{folder}/gold")["gold"]
    rows = [(n, c["rows"], c["columns"]) for n, c in counts.items()]
    return t.spark.createDataFrame(rows, "table_name string, row_count bigint, column_count bigint")


@query("status_counts", """
    SELECT 'customer' AS table_name, count(*) AS rows, CAST(1 AS BIGINT) AS files FROM customer
    UNION ALL SELECT 'orders', count(*), 1 FROM orders
    UNION ALL SELECT 'lineitem', count(*), 1 FROM lineitem
    UNION ALL SELECT 'nation', count(*), 1 FROM nation""")
def status_counts(t: Tables):
    names = ("customer", "orders", "lineitem", "nation")
    return sources.layer_status(t.spark, {n: f"{t.sf_dir}/{n}.parquet" for n in names})


@query("fill_all_zero", f"""
    SELECT u.id_user, description, human_owner, coalesce(post_count, 0) AS post_count,
           {r('coalesce(avg_post_rating, 0)', 'avg_post_rating')}
    FROM users u LEFT JOIN post_stats p ON u.id_user = p.id_user""")
def fill_all_zero(t: Tables):
    joined = t.users.join(features.user_post_stats(t.posts), "id_user", "left")
    return cleaning.fill_zero(joined).select(
        "id_user", "description", "human_owner", "post_count", "avg_post_rating"
    )


@query("constraint_violations", """
    SELECT 'users' AS table_name, 'primary_key' AS rule, 'id_user' AS column_name,
           (SELECT count(*) FROM (SELECT id_user FROM raw_users GROUP BY 1 HAVING count(*) > 1) q) AS violations
    UNION ALL SELECT 'users', 'not_null', 'id_user', count(*) FILTER (id_user IS NULL) FROM raw_users
    UNION ALL SELECT 'users', 'not_null', 'name', count(*) FILTER (name IS NULL) FROM raw_users
    UNION ALL SELECT 'users', 'not_null', 'scraped_at', count(*) FILTER (scraped_at IS NULL) FROM raw_users
    UNION ALL SELECT 'communities', 'primary_key', 'id_community',
           (SELECT count(*) FROM (SELECT id_community FROM raw_communities GROUP BY 1 HAVING count(*) > 1) q)
    UNION ALL SELECT 'communities', 'unique', 'name',
           (SELECT count(*) FROM (SELECT name FROM raw_communities GROUP BY 1 HAVING count(*) > 1) q)
    UNION ALL SELECT 'communities', 'not_null', 'id_community', count(*) FILTER (id_community IS NULL) FROM raw_communities
    UNION ALL SELECT 'communities', 'not_null', 'name', count(*) FILTER (name IS NULL) FROM raw_communities
    UNION ALL SELECT 'communities', 'not_null', 'scraped_at', count(*) FILTER (scraped_at IS NULL) FROM raw_communities
    UNION ALL SELECT 'posts', 'primary_key', 'id_post',
           (SELECT count(*) FROM (SELECT id_post FROM raw_posts GROUP BY 1 HAVING count(*) > 1) q)
    UNION ALL SELECT 'posts', 'not_null', 'id_post', count(*) FILTER (id_post IS NULL) FROM raw_posts
    UNION ALL SELECT 'posts', 'not_null', 'id_user', count(*) FILTER (id_user IS NULL) FROM raw_posts
    UNION ALL SELECT 'posts', 'not_null', 'scraped_at', count(*) FILTER (scraped_at IS NULL) FROM raw_posts
    UNION ALL SELECT 'posts', 'foreign_key', 'id_user', count(*) FROM raw_posts
           WHERE id_user IS NOT NULL AND id_user NOT IN (SELECT id_user FROM raw_users)
    UNION ALL SELECT 'posts', 'foreign_key', 'id_community', count(*) FROM raw_posts
           WHERE id_community IS NOT NULL AND id_community NOT IN (SELECT id_community FROM raw_communities)
    UNION ALL SELECT 'comments', 'primary_key', 'id_comment',
           (SELECT count(*) FROM (SELECT id_comment FROM raw_comments GROUP BY 1 HAVING count(*) > 1) q)
    UNION ALL SELECT 'comments', 'not_null', 'id_comment', count(*) FILTER (id_comment IS NULL) FROM raw_comments
    UNION ALL SELECT 'comments', 'not_null', 'id_user', count(*) FILTER (id_user IS NULL) FROM raw_comments
    UNION ALL SELECT 'comments', 'not_null', 'id_post', count(*) FILTER (id_post IS NULL) FROM raw_comments
    UNION ALL SELECT 'comments', 'not_null', 'scraped_at', count(*) FILTER (scraped_at IS NULL) FROM raw_comments
    UNION ALL SELECT 'comments', 'foreign_key', 'id_user', count(*) FROM raw_comments
           WHERE id_user IS NOT NULL AND id_user NOT IN (SELECT id_user FROM raw_users)
    UNION ALL SELECT 'comments', 'foreign_key', 'id_post', count(*) FROM raw_comments
           WHERE id_post IS NOT NULL AND id_post NOT IN (SELECT id_post FROM raw_posts)""")
def constraint_violations(t: Tables):
    order = ("users", "communities", "posts", "comments")
    return cleaning.constraint_violations({n: t.raw[n] for n in order})


# --- filters ------------------------------------------------------------------------


@query("filter_nonneg", "SELECT id_user, karma FROM users WHERE karma >= 0")
def filter_nonneg(t: Tables):
    return cleaning.non_negative(t.users).select("id_user", "karma")


@query("filter_active", """
    SELECT id_user, post_count, comment_count FROM user_features
    WHERE post_count > 0 OR comment_count > 0""")
def filter_active(t: Tables):
    return cleaning.active(t.user_features).select("id_user", "post_count", "comment_count")


@query("cap_p99", "SELECT id_user, karma FROM training")
def cap_p99(t: Tables):
    rows = cleaning.active(cleaning.non_negative(t.user_features))
    return cap_at_quantile(rows, "karma", 0.99).select("id_user", "karma")


@query("incomplete_users", """
    SELECT id_user, name FROM raw_users
    WHERE name IS NOT NULL AND (description IS NULL OR karma = 0 OR karma IS NULL)""")
def incomplete_users(t: Tables):
    return cleaning.incomplete_profiles(t.raw["users"]).select("id_user", "name")


@query("enriched_users", """
    SELECT id_user, name FROM raw_users WHERE karma > 0 OR description IS NOT NULL""")
def enriched_users(t: Tables):
    return cleaning.enriched_profiles(t.raw["users"]).select("id_user", "name")


@query("pages_usable", """
    SELECT page_id, url, html FROM (
      SELECT page_id, url, html FROM pages
      UNION ALL SELECT doc_id, source, 'Rate limit exceeded ' || text FROM documents)
    WHERE html IS NOT NULL AND NOT contains(html, 'Rate limit exceeded')""")
def pages_usable(t: Tables):
    refused = t.read("documents").select(
        F.col("doc_id").alias("page_id"),
        F.col("source").alias("url"),
        F.concat(F.lit("Rate limit exceeded "), "text").alias("html"),
    )
    return cleaning.usable_pages(t.read("pages").unionByName(refused))


@query("zero_split", """
    SELECT count(*) FILTER (karma = 0) AS zero, count(*) FILTER (karma > 0) AS positive FROM users""")
def zero_split(t: Tables):
    return cleaning.zero_split(t.users)


# --- aggregates ---------------------------------------------------------------------


@query("user_post_stats", f"""
    SELECT id_user, post_count, total_post_rating, max_post_rating,
           {rs('avg_post_rating avg_title_length avg_post_desc_length')} FROM post_stats""")
def user_post_stats(t: Tables):
    return features.user_post_stats(t.posts)


@query("user_comment_stats", f"""
    SELECT id_user, comment_count, total_comment_rating,
           {rs('avg_comment_rating avg_comment_length')} FROM comment_stats""")
def user_comment_stats(t: Tables):
    return features.user_comment_stats(t.comments)


@query("user_totals", f"""
    SELECT coalesce(p.id_user, c.id_user) AS id_user, coalesce(post_count, 0) AS user_total_posts,
           {r('coalesce(avg_post_rating, 0)', 'user_avg_rating')},
           coalesce(comment_count, 0) AS user_comment_count
    FROM post_stats p FULL JOIN comment_stats c ON p.id_user = c.id_user""")
def user_totals(t: Tables):
    return features.user_totals(t.posts, t.comments)


@query("post_comment_stats", f"""
    SELECT id_post, post_total_comments, post_max_comment_rating,
           {rs('post_avg_comment_rating post_avg_comment_length')} FROM post_talk""")
def post_comment_stats(t: Tables):
    return features.post_comment_stats(t.comments)


# --- joins and feature tables -------------------------------------------------------


@query("users_activity_left", f"""
    SELECT u.*, post_count, total_post_rating, max_post_rating, comment_count, total_comment_rating,
           {rs('avg_post_rating avg_title_length avg_post_desc_length avg_comment_rating avg_comment_length')}
    FROM users u LEFT JOIN post_stats p ON u.id_user = p.id_user
                 LEFT JOIN comment_stats c ON u.id_user = c.id_user""")
def users_activity_left(t: Tables):
    return features.users_activity(t.users, t.posts, t.comments)


AUTHOR_SQL = """
    u.name AS user_name, u.karma AS user_karma, u.followers AS user_followers,
    u.following AS user_following, round(u.follower_ratio, 6) AS user_follower_ratio,
    u.has_description AS user_has_description, u.has_human_owner AS user_has_human_owner,
    u.description_length AS user_description_length, u.post_count AS user_total_posts,
    round(u.avg_post_rating, 6) AS user_avg_rating, u.comment_count AS user_comment_count"""


@query("posts_denorm", f"""
    SELECT p.*, {AUTHOR_SQL}, c.name AS community_name,
           CAST(length(c.description) AS INTEGER) AS community_description_length
    FROM posts p LEFT JOIN user_features u ON p.id_user = u.id_user
                 LEFT JOIN communities c ON p.id_community = c.id_community""")
def posts_denorm(t: Tables):
    return features.posts_denorm(t.posts, t.user_features, t.communities, t.users)


WITH_STATS_SQL = f"""
    SELECT p.id_post, p.id_user AS post_author_id, title AS post_title, rating AS post_rating,
           date AS post_date, p.id_community, coalesce(c.name, 'unknown') AS community_name,
           coalesce(post_total_comments, 0) AS post_total_comments,
           {r('coalesce(post_avg_comment_rating, 0)', 'post_avg_comment_rating')},
           coalesce(post_max_comment_rating, 0) AS post_max_comment_rating,
           {r('coalesce(post_avg_comment_length, 0)', 'post_avg_comment_length')},
           CAST(length(title) AS INTEGER) AS post_title_length,
           CAST(length(p.description) AS INTEGER) AS post_description_length
    FROM posts p LEFT JOIN post_talk s ON p.id_post = s.id_post
                 LEFT JOIN communities c ON p.id_community = c.id_community"""


@query("posts_with_comment_stats", WITH_STATS_SQL)
def posts_with_comment_stats(t: Tables):
    return features.posts_with_comment_stats(t.posts, t.comments, t.communities)


CONTEXT_SQL = f"context AS ({WITH_STATS_SQL})"


@query("comments_denorm", f"""
    SELECT c.*, x.post_title, x.post_rating, x.post_date, x.id_community, x.community_name,
           x.post_total_comments, x.post_avg_comment_rating, x.post_max_comment_rating,
           x.post_title_length, x.post_description_length,
           w.name AS post_author_name, w.karma AS post_author_karma,
           a.name AS comment_author_name, a.karma AS comment_author_karma,
           a.followers AS comment_author_followers, a.following AS comment_author_following,
           {r('a.followers / nullif(a.following + 1, 0)', 'comment_author_follower_ratio')},
           CASE WHEN a.id_user IS NOT NULL THEN CAST(length(a.description) AS INTEGER) END
               AS comment_author_desc_length,
           CASE WHEN a.id_user IS NOT NULL THEN CAST(a.human_owner IS NOT NULL AS INTEGER) END
               AS comment_author_has_human_owner
    FROM comments c LEFT JOIN context x ON c.id_post = x.id_post
                    LEFT JOIN users a ON c.id_user = a.id_user
                    LEFT JOIN users w ON x.post_author_id = w.id_user""", CONTEXT_SQL)
def comments_denorm(t: Tables):
    return features.comments_denorm(t.comments, t.posts, t.users, t.communities)


@query("user_features", f"""
    SELECT id_user, name, karma, followers, following, has_description, has_human_owner,
           description_length, post_count, total_post_rating, max_post_rating, comment_count,
           total_comment_rating, total_activity, total_rating,
           {rs('follower_ratio avg_post_rating avg_title_length avg_post_desc_length avg_comment_rating avg_comment_length')}
    FROM user_features""")
def user_features(t: Tables):
    return t.user_features


@query("post_features", f"""
    SELECT p.id_post, p.title, p.description, p.rating, p.date, p.scraped_at, p.id_user,
           p.id_community, coalesce(u.name, 'unknown') AS user_name,
           coalesce(u.karma, 0) AS user_karma, coalesce(u.followers, 0) AS user_followers,
           coalesce(u.following, 0) AS user_following,
           {r('coalesce(u.follower_ratio, 0)', 'user_follower_ratio')},
           coalesce(u.has_description, 0) AS user_has_description,
           coalesce(u.has_human_owner, 0) AS user_has_human_owner,
           coalesce(u.description_length, 0) AS user_description_length,
           coalesce(u.post_count, 0) AS user_total_posts,
           {r('coalesce(u.avg_post_rating, 0)', 'user_avg_rating')},
           coalesce(u.comment_count, 0) AS user_comment_count,
           coalesce(c.name, 'unknown') AS community_name,
           CAST(coalesce(length(c.description), 0) AS INTEGER) AS community_description_length,
           CAST(length(p.title) AS INTEGER) AS title_length,
           CAST(length(p.description) AS INTEGER) AS description_length,
           CAST(len(string_split(p.title, ' ')) AS INTEGER) AS title_word_count,
           CAST(length(p.description) > 0 AS INTEGER) AS has_description
    FROM posts p LEFT JOIN user_features u ON p.id_user = u.id_user
                 LEFT JOIN communities c ON p.id_community = c.id_community""")
def post_features(t: Tables):
    return features.post_features(t.posts, t.users, t.comments, t.communities, t.user_features)


@query("comment_features", f"""
    SELECT c.id_comment, c.id_user, c.id_post, c.rating, c.date,
           CAST(length(c.description) AS INTEGER) AS comment_length,
           CAST(len(string_split(c.description, ' ')) AS INTEGER) AS comment_word_count,
           CAST(length(c.description) > 0 AS INTEGER) AS has_comment_text,
           coalesce(a.name, 'unknown') AS comment_author_name,
           coalesce(a.karma, 0) AS comment_author_karma,
           coalesce(a.followers, 0) AS comment_author_followers,
           coalesce(a.following, 0) AS comment_author_following,
           {r('coalesce(a.followers / nullif(a.following + 1, 0), 0)', 'comment_author_follower_ratio')},
           CAST(coalesce(length(a.description), 0) AS INTEGER) AS comment_author_desc_length,
           CAST(a.human_owner IS NOT NULL AS INTEGER) AS comment_author_has_human_owner,
           coalesce(x.post_title, '') AS post_title, coalesce(x.post_rating, 0) AS post_rating,
           x.post_date, x.post_title_length, x.post_description_length, x.post_total_comments,
           x.post_avg_comment_rating, x.post_max_comment_rating,
           coalesce(w.name, 'unknown') AS post_author_name,
           coalesce(w.karma, 0) AS post_author_karma, x.id_community,
           coalesce(x.community_name, 'unknown') AS community_name
    FROM comments c LEFT JOIN context x ON c.id_post = x.id_post
                    LEFT JOIN users a ON c.id_user = a.id_user
                    LEFT JOIN users w ON x.post_author_id = w.id_user""", CONTEXT_SQL)
def comment_features(t: Tables):
    return features.comment_features(t.comments, t.posts, t.users, t.communities)


@query("users_enriched", f"""
    SELECT * REPLACE ({r('avg_post_rating')}, {r('avg_comment_rating')}, {r('follower_ratio')})
    FROM enriched""")
def users_enriched(t: Tables):
    return t.enriched


# --- keyed joins, sets, caps --------------------------------------------------------

NAMES_SQL = "names AS (SELECT DISTINCT 'NATION_' || id_community AS name FROM posts)"


def _named_communities(t: Tables):
    """Community names as the posts refer to them; some are not stored."""
    return t.posts.select(F.concat(F.lit("NATION_"), "id_community").alias("name")).distinct()


@query("new_names_anti", "SELECT name FROM names WHERE name NOT IN (SELECT name FROM communities)", NAMES_SQL)
def new_names_anti(t: Tables):
    return relational.not_known(_named_communities(t), t.communities, "name")


@query("exists_semi", """
    SELECT id_comment, id_user FROM comments WHERE id_user IN (SELECT id_user FROM users)""")
def exists_semi(t: Tables):
    return relational.known_only(t.comments.select("id_comment", "id_user"), t.users, "id_user")


TALK_SQL = """talk AS (
    SELECT id_comment, upper('Customer#' || lpad(id_user, 9, '0')) AS author FROM comments)"""


def _talk(t: Tables):
    """Comments that name their author, in another case than the stored profile."""
    name = F.upper(F.concat(F.lit("Customer#"), F.lpad("id_user", 9, "0")))
    return t.comments.select("id_comment", name.alias("author"))


@query("resolve_authors", """
    SELECT id_comment, author,
           coalesce(k.id, 'user_' || sha256(lower(author))) AS id_user
    FROM talk LEFT JOIN (SELECT lower(name) AS n, min(id_user) AS id FROM users GROUP BY 1) k
         ON lower(author) = k.n""", TALK_SQL)
def resolve_authors(t: Tables):
    return relational.resolve_authors(_talk(t), t.users)


@query("new_minimal_users", """
    SELECT DISTINCT 'user_' || sha256(lower(author)) AS id_user, author AS name,
           CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS human_owner,
           CAST(NULL AS VARCHAR) AS joined, '2024-06-01' AS scraped_at, CAST(0 AS BIGINT) AS karma,
           CAST(0 AS BIGINT) AS followers, CAST(0 AS BIGINT) AS following
    FROM talk WHERE lower(author) NOT IN (SELECT lower(name) FROM users)""", TALK_SQL)
def new_minimal_users(t: Tables):
    return relational.new_minimal_users(_talk(t), t.users, F.lit("2024-06-01"))


@query("resolve_communities", """
    SELECT n.name, c.id_community IS NULL AS is_new,
           coalesce(c.id_community, 'community_' || sha256(lower(n.name))) AS id_community
    FROM names n LEFT JOIN communities c ON n.name = c.name""", NAMES_SQL)
def resolve_communities(t: Tables):
    return relational.resolve_communities(_named_communities(t), t.communities)


POSITION_SQL = """listed AS (
    SELECT CAST(id_community AS BIGINT) AS pos, 'NATION_' || id_community AS name
    FROM (SELECT DISTINCT id_community FROM posts) q)"""


def _listed(t: Tables):
    rows = t.posts.select("id_community").distinct()
    return rows.select(
        F.col("id_community").cast("bigint").alias("pos"),
        F.concat(F.lit("NATION_"), "id_community").alias("name"),
    )


@query("new_first_limit", """
    SELECT l.name, l.pos, c.name IS NOT NULL AS is_known FROM listed l
    LEFT JOIN communities c ON l.name = c.name ORDER BY is_known, pos, l.name LIMIT 10""", POSITION_SQL)
def new_first_limit(t: Tables):
    return relational.new_first(_listed(t), t.communities, 10)


@query("seed_union", """
    SELECT 0 AS part, pos, name FROM listed
    UNION ALL SELECT 1, CAST(n_nationkey AS BIGINT), n_name FROM nation
    WHERE n_name NOT IN (SELECT name FROM listed)
    UNION ALL SELECT 1, CAST(r_regionkey AS BIGINT), r_name FROM region
    WHERE r_name NOT IN (SELECT name FROM listed)""", POSITION_SQL)
def seed_union(t: Tables):
    nations = t.read("nation").select(F.col("n_nationkey").cast("bigint").alias("pos"), F.col("n_name").alias("name"))
    regions = t.read("region").select(F.col("r_regionkey").cast("bigint").alias("pos"), F.col("r_name").alias("name"))
    return relational.union_seed(_listed(t), nations.unionByName(regions))


@query("cap_names", "SELECT name FROM names ORDER BY name LIMIT 20", NAMES_SQL)
def cap_names(t: Tables):
    return _named_communities(t).orderBy("name").limit(20)


@query("cap_per_group", """
    SELECT id_comment, id_post, rating FROM (
      SELECT *, row_number() OVER (PARTITION BY id_post ORDER BY rating DESC, id_comment) AS rn
      FROM comments) q WHERE rn <= 3""")
def cap_per_group(t: Tables):
    rows = t.comments.select("id_comment", "id_post", "rating")
    return relational.cap_per_group(rows, ["id_post"], [F.desc("rating"), "id_comment"], 3)


@query("memberships", """
    SELECT id_user, id_community FROM posts WHERE id_user IS NOT NULL AND id_community IS NOT NULL
    UNION SELECT c.id_user, p.id_community FROM comments c JOIN posts p ON c.id_post = p.id_post
    WHERE c.id_user IS NOT NULL AND p.id_community IS NOT NULL""")
def memberships(t: Tables):
    return relational.memberships(t.posts, t.comments)


@query("frontier_minus_seen", """
    SELECT DISTINCT id_user AS name FROM comments WHERE id_user NOT IN (SELECT id_user FROM posts)""")
def frontier_minus_seen(t: Tables):
    found = t.comments.select(F.col("id_user").alias("name"))
    return relational.frontier_minus_seen(found, t.posts.select(F.col("id_user").alias("name")))


@query("refs_union", "SELECT id_user FROM posts UNION SELECT id_user FROM comments")
def refs_union(t: Tables):
    return relational.refs_union(t.posts.select("id_user"), t.comments.select("id_user"))


@query("page_of_rows", "SELECT * FROM users ORDER BY id_user LIMIT 50 OFFSET 20")
def page_of_rows(t: Tables):
    return relational.page_of_rows(t.users, "id_user", 50, 20)


@query("lookup_by_id", "SELECT * FROM posts WHERE id_user = '5' AND id_community = '5'")
def lookup_by_id(t: Tables):
    return relational.lookup(t.posts, id_user="5", id_community="5")


@query("word_count", """
    SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS words FROM documents""")
def word_count(t: Tables):
    return t.read("documents").select("doc_id", S.word_count(F.col("text")).alias("words"))
