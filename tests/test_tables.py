"""Cleaning, joins, caps, resolution, merges and constraint checks on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from folkmeter import schemas
from folkmeter.operators import cleaning, features, frontier, profiling, relational, upsert
from folkmeter.sources import pagestore

STAMP = "2024-01-01"


def users(spark, *rows):
    """Rows as (id, name, karma, description, owner, followers, following, stamp)."""
    full = [(i, n, d, o, None, s, k, f, g) for i, n, k, d, o, f, g, s in rows]
    return spark.createDataFrame(full, schemas.nullable(schemas.USERS))


def user(key, name="Ann", karma=1, description="d", owner=None, followers=1, following=1, stamp=STAMP):
    return key, name, karma, description, owner, followers, following, stamp


def post(spark, *rows):
    """Rows as (id, user, community, title, description, rating)."""
    full = [(i, u, c, t, d, STAMP, STAMP, r) for i, u, c, t, d, r in rows]
    return spark.createDataFrame(full, schemas.nullable(schemas.POSTS))


def comment(spark, *rows):
    """Rows as (id, user, post, text, rating)."""
    full = [(i, u, p, d, STAMP, STAMP, r) for i, u, p, d, r in rows]
    return spark.createDataFrame(full, schemas.nullable(schemas.COMMENTS))


def community(spark, *rows):
    return spark.createDataFrame([(i, n, d, STAMP) for i, n, d in rows], schemas.nullable(schemas.COMMUNITIES))


def test_clean_users(spark):
    frame = users(
        spark,
        user("a", " Ann\t", None, None, " x ", None, None),
        user("b", "Bob", 5),
        user("b", "\xa0 ", 9, stamp="2024-02-01"),  # the blank latest name removes the user
        user("c", "Old", 1, stamp="2024-01-01"),
        user("c", "New", 2, stamp="2024-03-01"),
        user("d", None),
    )
    got = {r.id_user: r for r in cleaning.clean(frame, "users").collect()}
    assert set(got) == {"a", "c"}
    assert got["c"].name == "New"
    a = got["a"]
    assert (a.name, a.karma, a.description, a.human_owner, a.followers) == ("Ann", 0, "", "x", 0)


def test_keep_last_does_not_depend_on_partitions(spark):
    rows = [("k" if i % 3 else f"k{i}", i % 5, i) for i in range(600)]
    frame = spark.createDataFrame(rows, "k string, t int, v int")
    one = relational.keep_last(frame.coalesce(1), ["k"], ["t"]).orderBy("k").collect()
    many = relational.keep_last(frame.repartition(16), ["k"], ["t"]).orderBy("k").collect()
    assert one == many
    best = max(((t, v) for k, t, v in rows if k == "k"))
    assert [(r.t, r.v) for r in one if r.k == "k"] == [best]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_keep_last_limits_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"))
    text = plan(relational.keep_last(frame, ["k"], ["t"]))
    assert text.count("WindowGroupLimit") == 2


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_left_join_with_hot_and_missing_keys(spark, no_broadcast):
    rows = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 11}") for i in range(900)]
    left = spark.createDataFrame(rows, "i int, k string")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("other", 4)], "k string, v int")
    salted = relational.left_join(left, right, "k", hot_rows=50)
    assert "_salt" in plan(salted)
    assert salted.columns == ["i", "k", "v"]
    want = left.join(right, "k", "left").select("i", "k", "v")
    assert sorted(salted.collect(), key=str) == sorted(want.collect(), key=str)


def test_left_join_of_small_side_is_plain(spark):
    left = spark.range(10).withColumnRenamed("id", "k")
    right = spark.range(2).selectExpr("id as k", "'x' as v")
    joined = relational.left_join(left, right, "k")
    assert "_salt" not in plan(joined) and joined.count() == 10


def test_cap_per_group_with_a_hot_group(spark):
    rows = [("hot", i) for i in range(700)] + [(f"g{i % 9}", i) for i in range(60)]
    frame = spark.createDataFrame(rows, "g string, pos int").repartition(8)
    got = relational.cap_per_group(frame, ["g"], ["pos"], 5).collect()
    for g in {g for g, _ in rows}:
        want = sorted(p for h, p in rows if h == g)[:5]
        assert sorted(r.pos for r in got if r.g == g) == want


def test_user_features_edges(spark):
    people = users(
        spark, user("a", following=-1, followers=3), user("b", description="", owner=""), user("c")
    )
    posts = post(spark, ("p", "a", "x", "abc", "", 4), ("q", "a", "x", "a", "de", 6))
    talk = comment(spark, ("m", "b", "p", "hey", 2))
    got = {r.id_user: r for r in features.user_features(people, posts, talk).collect()}
    assert got["a"].follower_ratio is None
    assert (got["a"].post_count, got["a"].avg_title_length, got["a"].max_post_rating) == (2, 2.0, 6)
    assert (got["b"].has_description, got["b"].has_human_owner, got["b"].total_activity) == (0, 1, 1)
    assert (got["c"].post_count, got["c"].avg_comment_rating, got["c"].total_rating) == (0, 0.0, 0)


def feature_inputs(spark):
    people = users(spark, user("a", karma=7), user("b"))
    posts = post(spark, ("p", "a", "x", "two words", "", 4), ("q", "zz", "none", "", None, 6))
    talk = comment(spark, ("1", "b", "p", "a  b ", 2), ("2", "nobody", "lost", "", 3), ("3", "b", "q", None, 1))
    return people, posts, talk, community(spark, ("x", "town", None))


def check_features(spark):
    people, posts, talk, places = feature_inputs(spark)
    got = {r.id_post: r for r in features.post_features(posts, people, talk, places).collect()}
    p, q = got["p"], got["q"]
    assert (p.user_name, p.community_name, p.title_word_count, p.has_description) == ("Ann", "town", 2, 0)
    assert (q.user_name, q.community_name, q.user_karma, q.has_description) == ("unknown", "unknown", 0, None)
    assert (q.title_word_count, q.description_length) == (1, 0)
    got = {r.id_comment: r for r in features.comment_features(talk, posts, people, places).collect()}
    one, lost, late = got["1"], got["2"], got["3"]
    assert (one.post_author_name, one.post_author_karma, one.comment_word_count) == ("Ann", 7, 4)
    assert (lost.post_title, lost.post_rating, lost.community_name) == ("", 0, "unknown")
    assert (lost.post_date, lost.post_total_comments, lost.post_title_length) == (None, None, None)
    assert (lost.comment_author_name, lost.comment_author_desc_length) == ("unknown", 0)
    assert (late.comment_length, late.comment_word_count, late.has_comment_text) == (0, 0, None)
    assert late.post_author_name == "unknown" and late.post_total_comments == 1


def test_feature_tables(spark):
    check_features(spark)


def test_feature_tables_by_salted_joins(spark, no_broadcast):
    check_features(spark)


def test_feature_scan_reads_only_its_columns(spark, sf_dir):
    from folkmeter.plans.catalog import QUERIES

    text = QUERIES["user_post_stats"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "BatchEvalPython" not in text
    stats = features.user_comment_stats(spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "l_partkey as id_user", "l_quantity as rating", "l_returnflag as description", "l_tax"))
    assert "l_tax" not in plan(stats)


def test_filters_reach_the_scan(spark, sf_dir):
    frame = relational.lookup(spark.read.parquet(f"{sf_dir}/orders.parquet"), o_custkey=5)
    assert "EqualTo(o_custkey,5)" in plan(frame)


def test_resolution(spark):
    stored = users(spark, user("id-1", "Ann"), user("id-2", "ann"))
    rows = spark.createDataFrame([("ANN",), ("Zed",), ("zed",), (None,)], "author string")
    got = relational.resolve_authors(rows, stored).collect()
    ids = {r.author: r.id_user for r in got}
    assert ids["ANN"] == "id-1" and ids["Zed"] == ids["zed"] != "id-1"
    fresh = relational.new_minimal_users(rows, stored, F.lit(STAMP)).collect()
    assert [(r.id_user, r.name, r.karma) for r in fresh] == [(ids["Zed"], "Zed", 0)]


def test_new_first_and_seed(spark):
    names = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos int, name string")
    known = spark.createDataFrame([("a",)], "name string")
    assert [r.name for r in relational.new_first(names, known, 2).collect()] == ["b", "c"]
    seed = spark.createDataFrame([(0, "c"), (1, "d")], "pos int, name string")
    united = relational.union_seed(names, seed).orderBy("part", "pos")
    assert [r.name for r in united.collect()] == ["a", "b", "c", "d"]


def test_not_known(spark):
    names = spark.createDataFrame([("a",), ("b",)], "name string")
    known = spark.createDataFrame([("a",)], "name string")
    assert [r.name for r in relational.not_known(names, known, "name").collect()] == ["b"]
    assert relational.not_known(names, known, "name", force=True).count() == 2
    assert relational.exists(names, name="a") and not relational.exists(names, name="z")


def test_upsert(spark):
    target = users(spark, user("a", karma=100), user("b", karma=1))
    batch = users(spark, user("a", karma=150), user("a", karma=200, stamp="2024-02-01"), user("c", karma=3))
    once = upsert.upsert(target, batch, ["id_user"])
    twice = upsert.upsert(once, batch, ["id_user"])
    want = {"a": 200, "b": 1, "c": 3}
    for frame in (once, twice):
        assert {r.id_user: r.karma for r in frame.collect()} == want


def test_bad_rows_are_set_aside(spark):
    target = users(spark, user("a"))
    batch = users(spark, user("b"), user(None, None), user("d", None))
    merged, bad = upsert.upsert_checked(target, batch, "users")
    assert {r.id_user for r in merged.collect()} == {"a", "b"}
    assert sorted(r.missing for r in bad.collect()) == ["id_user,name", "name"]


def test_insert_ignore(spark):
    target = spark.createDataFrame([("a", "x")], schemas.nullable(schemas.MEMBERSHIPS))
    batch = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "x")], schemas.nullable(schemas.MEMBERSHIPS))
    got = upsert.insert_ignore(target, batch, ["id_user", "id_community"]).collect()
    assert sorted(map(tuple, got)) == [("a", "x"), ("b", "x")]


def test_constraints(spark):
    tables = {
        "users": users(spark, user("a"), user("a"), user("b", None)),
        "communities": community(spark, ("x", "n", None), ("y", "n", None)),
        "posts": post(spark, ("p", "a", "x", "", "", 1), ("q", "ghost", "zz", "", "", 1)),
        "comments": comment(spark, ("1", "a", "p", "", 1), ("2", None, "gone", "", 1)),
    }
    got = cleaning.constraint_violations(tables).filter("violations > 0").collect()
    assert {(r.table_name, r.rule, r.column_name, r.violations) for r in got} == {
        ("users", "primary_key", "id_user", 1),
        ("users", "not_null", "name", 1),
        ("communities", "unique", "name", 1),
        ("posts", "foreign_key", "id_user", 1),
        ("posts", "foreign_key", "id_community", 1),
        ("comments", "foreign_key", "id_post", 1),
        ("comments", "not_null", "id_user", 1),
    }


@pytest.mark.parametrize("offset", [0, 3, 150, 299, 310, 400])
def test_page_of_rows_by_rank(spark, monkeypatch, offset):
    """Nulls, repeated keys and names beyond ASCII, against the sorted list."""
    monkeypatch.setattr(relational, "RANK_RANGES", 8)
    names = [None] * 4 + ["same"] * 60 + [f"é{i:03}" for i in range(100)] + [f"n{i:03}" for i in range(146)]
    frame = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, i int").repartition(5)
    want = sorted(names, key=lambda n: (n is not None, (n or "").encode()))
    assert [r.name for r in relational.page_of_rows(frame, "name", 20, offset).collect()] == want[offset : offset + 20]
    index = relational.rank_index(frame, "name")
    assert sum(n for _, n, _ in index) == len(names) and len(index) <= 10


def test_page_of_rows_sorts_only_its_ranges(spark):
    frame = spark.range(20_000).withColumnRenamed("id", "k")
    page = relational.page_of_rows(frame, "k", 10, 10_000)
    assert [r.k for r in page.collect()] == list(range(10_000, 10_010))
    plan = page._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(">=") >= 1 and "<" in plan  # both ends of a range of about a 64th
    assert relational.page_of_rows(frame.limit(0), "k", 10).count() == 0


def test_bitmaps_of_urls(spark):
    urls = spark.range(500).select(F.concat(F.lit("https://a.org/"), "id").alias("url"))
    store = spark.range(250, 50_000).select(F.concat(F.lit("https://a.org/"), "id").alias("url"))
    filters = [pagestore.url_bitmaps(part) for part in (urls.limit(100), urls)]
    merged = pagestore.merge_bitmaps(*filters)
    likely = pagestore.may_hold(store, merged)
    assert likely.join(urls, "url", "left_semi").count() == 250
    assert likely.count() < 250 + 30  # a fraction of 500 / 8,388,608 of the others
    assert merged.count() <= pagestore.BIT_PAGES


def test_a_large_store_is_filtered_before_it_is_dealt_out(spark, monkeypatch):
    urls = spark.range(500).select(F.concat(F.lit("https://a.org/"), "id").alias("url"))
    store = spark.range(250, 5_000).select(F.concat(F.lit("https://a.org/"), "id").alias("url"))
    want = {f"https://a.org/{i}" for i in range(250)}
    assert {r.url for r in pagestore.to_fetch(urls, store).collect()} == want
    monkeypatch.setattr(pagestore, "fits_broadcast", lambda df: False)
    away, here = pagestore.to_fetch(urls, store), pagestore.cached(urls, store)
    assert {r.url for r in away.collect()} == want and here.count() == 250
    plan = pagestore._stored_among(urls, store)._jdf.queryExecution().executedPlan().toString()
    leaf = plan.index("Range (250, 5000")
    above = plan[plan.rindex("BroadcastHashJoin", 0, leaf) : leaf]  # from the filter to the store
    assert "Exchange" not in above and "Exchange hashpartitioning" in plan[: plan.index("BroadcastHashJoin")]


def test_stored_pages_have_a_filter_on_the_url(spark, tmp_path):
    rows = spark.range(2_000).select(F.concat(F.lit("https://a.org/"), "id").alias("url"), F.lit("x").alias("html"))
    pagestore.write_pages(rows.coalesce(1), str(tmp_path / "pages"))
    read = spark.read.parquet(str(tmp_path / "pages"))
    assert read.filter("url = 'https://a.org/77'").count() == 1


def test_box_stats_count_repeats(spark):
    rows = [(float(v),) for v in [1, 2, 2, 2, 3, 3, 4, 100, 100]] + [(None,)]
    frame = spark.createDataFrame(rows, "v double")
    one = profiling.box_stats(frame, ["v"]).first()
    assert (one.q1, one.median, one.q3, one.whisker_low, one.whisker_high, one.outliers) == (2, 3, 4, 1, 4, 2)


def test_frontier(spark):
    edges = [("a", "b"), ("a", "c"), ("b", "d"), ("d", "a"), ("d", "e"), ("x", "y"), (None, "a")]
    frame = spark.createDataFrame(edges, "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "name string")
    walk = frontier.frontier_bfs(frame, seeds)
    assert {r.name: r.depth for r in walk.collect()} == {"a": 0, "b": 1, "c": 1, "d": 2, "e": 3}
    with pytest.warns(UserWarning, match="1 rounds"):
        short = frontier.frontier_bfs(frame, seeds, max_rounds=1)
    assert {r.name for r in short.collect()} == {"a", "b", "c"}
    with pytest.warns(UserWarning, match="2 names"):
        few = frontier.frontier_bfs(frame, seeds, max_names=2)
    assert {r.name for r in few.collect()} == {"a", "b"}


def test_frontier_from_many_seeds(spark, monkeypatch):
    """Against a plain walk, with names in all buckets, a name that most pages mention, and nulls."""
    draw = random.Random(2)
    names = [f"n{i}" for i in range(120)]
    pages = [(draw.choice(names[:90]), [*draw.choices(names, k=draw.randint(0, 4)), "n7", None]) for _ in range(150)]
    seeds = ["n1", "n2", "n1", None, "alone"]
    frame = spark.createDataFrame(pages + [(None, ["n5"]), ("n3", None)], "name string, refs array<string>")
    start = spark.createDataFrame([(s,) for s in seeds], "name string")
    depths, latest = {s: 0 for s in seeds if s}, {s for s in seeds if s}
    while latest:
        found = {x for p, refs in pages if p in latest for x in refs if x} - depths.keys()
        depths |= {x: max(depths.values()) + 1 for x in found}
        latest = found
    have = {p for p, _ in pages} | {"n3"}
    rows = frontier.discover(frame, "name", F.col("refs"), start).collect()
    assert {(r.name, r.depth, r.landed) for r in rows} == {(n, d, n in have) for n, d in depths.items()}
    assert len(rows) == len(depths)
    assert frontier.frontier_bfs(frontier.references(frame, "name", F.col("refs")), start.limit(0)).count() == 0


def test_a_round_reads_only_the_buckets_it_meets(spark):
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(50)], "src string, dst string")
    walk = frontier.frontier_bfs(edges, spark.createDataFrame([("n47",)], "name string"))
    assert {r.name: r.depth for r in walk.collect()} == {"n47": 0, "n48": 1, "n49": 2, "n50": 3}
    part = frontier._in_buckets(walk.withColumn("bucket", F.lit(1)), [1, 2])
    assert part.count() == 4
    plan = walk._jdf.queryExecution().executedPlan().toString()
    assert "seen" in plan and "Exchange" not in plan


def test_empty_inputs(spark):
    silver = cleaning.empty_silver(spark)
    frame = features.user_features(silver["users"], silver["posts"], silver["comments"])
    assert frame.count() == 0 and len(frame.columns) == 21
    lone = features.user_features(users(spark, user("a")), silver["posts"], silver["comments"])
    assert lone.first().total_activity == 0
    empty = features.comment_features(
        silver["comments"], silver["posts"], silver["users"], silver["communities"]
    )
    assert empty.count() == 0 and len(empty.columns) == 27


NATIVE = [
    "clean_comments", "user_features", "post_features", "comment_features", "corr_matrix", "box_stats",
    "karma_stats", "quartile_report", "json_posts", "page_links", "page_text_length", "page_description",
    "resolve_authors", "memberships", "upsert_users", "parse_human_number", "relative_date",
]


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_in_the_plan(spark, sf_dir, name):
    from folkmeter.plans.catalog import QUERIES

    text = plan(QUERIES[name](spark, sf_dir))
    assert "EvalPython" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_comments_meet_their_author_before_their_post(spark):
    def comment(key, author, parent):
        return key, author, parent, "text", STAMP, STAMP, 1

    rows = [comment("c1", "u1", "p1"), comment("c2", "u9", "p1"), comment("c3", "u1", None)]
    comments = spark.createDataFrame(rows, schemas.nullable(schemas.COMMENTS))
    places = spark.createDataFrame([("m1", "place", "d", STAMP)], schemas.nullable(schemas.COMMUNITIES))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = features.comments_denorm(
            comments, post(spark, ("p1", "u1", "m1", "T", "d", 3)), users(spark, user("u1")), places
        )
        last = next(line for line in _optimized(got).splitlines() if "Join" in line)
        found = {r.id_comment: (r.post_title, r.comment_author_name) for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "id_post" in last and "id_user" not in last
    assert found == {"c1": ("T", "Ann"), "c2": ("T", None), "c3": (None, "Ann")}


def test_only_keys_of_full_buckets_are_counted(spark):
    rows = [("a",)] * 50 + [("b",)] * 21 + [(f"k{i}",) for i in range(500)] + [(None,)] * 99
    heavy = relational.heavy_keys(spark.createDataFrame(rows, "k string"), "k", 20)
    assert {tuple(r) for r in heavy.collect()} == {("a", 3), ("b", 2)}
    assert "LeftSemi" in _optimized(heavy)


def test_joins_with_empty_tables_are_left_out(spark):
    rows = users(spark, user("u1"))
    left = rows.join(schemas.empty_table(spark, "users").select("id_user"), "id_user", "left_anti")
    assert "Join" not in _optimized(left) and left.count() == 1
    assert schemas.empty_table(spark, "users").schema == schemas.nullable(schemas.USERS)
