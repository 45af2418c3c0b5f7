"""Layers, store, streaming and models end to end."""

import json
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from folkmeter import schemas
from folkmeter.operators import cleaning, modeling
from folkmeter.operators.evaluation import clean_training
from folkmeter.plans import jobs
from folkmeter.plans.registry import Tables
from folkmeter.session import shuffles_dropped
from folkmeter.sources import pagestore, store, tables
from folkmeter.streaming import incremental


def test_build_and_status(spark, sf_dir, tmp_path):
    raw = {n: Tables(spark, sf_dir).raw[n] for n in tables.SILVER}
    silver, gold = f"{tmp_path}/silver", f"{tmp_path}/gold"
    result = jobs.build(spark, raw, silver, gold)
    assert result["silver"]["users"]["rows"] == raw["users"].count()
    assert [result["gold"][n]["columns"] for n in ("user_features", "post_features", "comment_features")] == [21, 25, 27]
    status = jobs.status(spark, f"{tmp_path}/none", silver, gold)
    rows = {r.table_name: r.rows for r in status["gold"].collect()}
    assert rows["post_features"] == raw["posts"].count()
    assert {r.rows for r in status["stored"].collect()} == {0}
    missing = jobs.status(spark, f"{tmp_path}/none", f"{tmp_path}/no", gold)["silver"].collect()
    assert {(r.table_name, r.rows, r.files) for r in missing} == {(n, 0, 0) for n in tables.SILVER}


def test_reports(spark, sf_dir, tmp_path):
    raw = {n: Tables(spark, sf_dir).raw[n] for n in tables.SILVER}
    jobs.build_silver(raw, f"{tmp_path}/s")
    written = jobs.eda(spark, f"{tmp_path}/s", f"{tmp_path}/eda")
    assert written["record_counts"] == 3 and written["users_describe"] == 9
    Tables(spark, sf_dir).predictions.write.parquet(f"{tmp_path}/p")
    written = jobs.evaluate(spark, f"{tmp_path}/p", f"{tmp_path}/report")
    assert written["log_scale"] == 1 and written["quartile_analysis"] >= 4
    with pytest.raises(FileNotFoundError):
        jobs.eda(spark, f"{tmp_path}/nothing", f"{tmp_path}/x")


def test_a_broken_table_does_not_stop_the_others(spark, sf_dir, tmp_path):
    raw = {n: Tables(spark, sf_dir).raw[n] for n in tables.SILVER}
    raw["posts"] = raw["posts"].withColumn("rating", F.lit("bad"))
    result = jobs.build_silver(raw, f"{tmp_path}/s")
    assert "CAST_INVALID_INPUT" in result["posts"]["error"] and result["users"]["rows"] > 0
    assert jobs.build_silver(raw, f"{tmp_path}/t", lenient=True)["posts"]["rows"] > 0


def test_missing_tables(spark, tmp_path):
    assert tables.read_silver(spark, str(tmp_path))["users"].count() == 0
    with pytest.raises(FileNotFoundError):
        tables.read_required(spark, f"{tmp_path}/user_features")


def test_first_available(spark):
    def broken():
        raise OSError("no database")

    assert tables.first_available(broken, lambda: spark.range(3)).count() == 3
    with pytest.raises(RuntimeError, match="no database"):
        tables.first_available(broken)


def test_jdbc_options():
    got = tables.jdbc_options("jdbc:x", "users", "n", (0, 9), 4, user="me")
    assert got["partitionColumn"] == "n" and got["numPartitions"] == "4" and got["user"] == "me"
    assert "partitionColumn" not in tables.jdbc_options("jdbc:x", "users")


def test_page_store(spark):
    urls = spark.createDataFrame([("https://a.org/x",), ("https://a.org/y",)], "url string")
    stored = urls.limit(1)
    here, away = pagestore.cached(urls, stored), pagestore.to_fetch(urls, stored)
    assert here.count() + away.count() == 2 and here.count() == 1
    assert pagestore.to_fetch(urls, stored, force_refresh=True).count() == 2
    assert pagestore.cached(urls, stored, force_refresh=True).count() == 0


def person(spark, *rows):
    full = [(i, n, None, None, None, "s", k, 0, 0) for i, n, k in rows]
    return spark.createDataFrame(full, schemas.nullable(schemas.USERS))


def test_store(spark, tmp_path):
    root = str(tmp_path)

    def current(place=root):
        return {r.id_user: r.karma for r in store.read_current(spark, place, "users").collect()}

    assert current() == {}
    store.append_batch(person(spark, ("a", "A", 1), ("b", "B", 1)), root, "users", 1)
    store.append_batch(person(spark, ("b", "B", 2), ("c", "C", 2)), root, "users", 2)
    assert current() == {"a": 1, "b": 2, "c": 2}
    store.append_batch(person(spark, ("c", "C", 3)), root, "users", 3)
    store.append_batch(person(spark, ("c", "C", 4)), root, "users", 3)  # a repeated load
    assert current() == {"a": 1, "b": 2, "c": 4}
    store.append_batch(person(spark, ("a", "A", 5), ("b", "B", 5)), root, "users", 1)
    assert current() == {"a": 5, "b": 2, "c": 4}  # a load that is written again keeps its time
    assert {r.id_user for r in store.read_current(spark, root, "users", ("load", 2)).collect()} == {"a", "b", "c"}
    assert store.write_settled(spark, root, "users", f"{root}/folded") == 3
    assert current(f"{root}/folded") == current()
    store.append_batch(person(spark, ("b", "B", 6)), f"{root}/folded", "users", 2)  # known by its marks
    store.append_batch(person(spark, ("a", "A", 7)), f"{root}/folded", "users", 4)
    assert current(f"{root}/folded") == {"a": 7, "b": 6, "c": 4}


def test_store_keeps_the_loads_of_all_writers(spark, tmp_path):
    root = str(tmp_path)

    def current():
        return {r.id_user: r.karma for r in store.read_current(spark, root, "users").collect()}

    store.append_batch(person(spark, ("a", "A", 1)), root, "users", 3, "one")
    store.append_batch(person(spark, ("b", "B", 1)), root, "users", 1, "two")
    store.append_batch(person(spark, ("a", "A", 2)), root, "users", 1, "one")
    assert current() == {"a": 2, "b": 1}  # the times of the loads count, not their numbers
    store.append_batch(person(spark, ("c", "C", 1)), root, "users", 2, "two")
    assert current() == {"a": 2, "b": 1, "c": 1}
    store.append_batch(person(spark, ("b", "B", 9)), root, "users", 1, "two")
    assert current() == {"a": 2, "b": 9, "c": 1}
    with pytest.raises(ValueError, match="name of a writer"):
        store.append_batch(person(spark, ("b", "B", 1)), root, "users", 1, "../x")


def test_stream_with_a_new_checkpoint(spark, tmp_path):
    landed, root = f"{tmp_path}/landed", f"{tmp_path}/root"

    def land(*rows):
        frame = body(spark, "name", *[(n, {"success": True, "agent": {"karma": k}}) for n, k in rows])
        frame.coalesce(1).write.mode("append").json(landed)

    def run(progress):
        incremental.profile_stream(spark, landed, root, f"{tmp_path}/{progress}", F.lit("s")).awaitTermination()

    land(("Ann", 1))
    run("first")
    store.append_batch(person(spark, ("x", "X", 7)), root, "users", 1)
    land(("Ann", 2), ("Bob", 3))
    run("second")
    got = {r.name: r.karma for r in store.read_current(spark, root, "users").collect()}
    assert got == {"Ann": 2, "Bob": 3, "X": 7}


def body(spark, key, *rows):
    return spark.createDataFrame([(k, json.dumps(b)) for k, b in rows], f"{key} string, body string")


def load(spark):
    post = {"id": "p1", "title": "t", "upvotes": 3, "author": {"name": "Ann"}}
    other = {"id": "p2", "title": "t2", "author": {"name": "Bob"}}
    talk = {"comments": [{"author": {"name": "Cyd"}, "content": "hi", "replies": [{"author": {"name": "ann"}, "content": "yo"}]}]}
    agent = {"karma": 9, "description": "d", "created_at": "2024-01-01"}
    return {
        "communities": body(spark, "name", ("town", {"success": True, "community": {"description": "x"}, "posts": [post, other]})),
        "posts": body(spark, "id_post", ("p1", talk)),
        "profiles": body(spark, "name", ("Ann", {"success": True, "agent": agent})),
    }


def test_ingest(spark, tmp_path):
    root = str(tmp_path)
    counts = jobs.ingest(spark, root, 1, F.lit("s1"), **load(spark))
    assert counts == {"users": 3, "communities": 1, "memberships": 3, "posts": 2, "comments": 2}
    people = {r.name: r.karma for r in store.read_current(spark, root, "users").collect()}
    assert people == {"Ann": 9, "Bob": 0, "Cyd": 0}
    again = jobs.ingest(spark, root, 2, F.lit("s2"), **load(spark))
    assert (again["posts"], again["communities"], again["users"]) == (0, 0, 1)
    totals = {r.table_name: r.rows for r in store.stored_counts(spark, root).collect()}
    assert totals == {"users": 3, "communities": 1, "memberships": 3, "posts": 2, "comments": 2}


def test_ingest_pages(spark, tmp_path):
    card = '<a href="/post/p9"><h3>Title</h3><div class="text-xs"><span class="hover:underline">u/ann</span> 1d ago</div></a>'
    box = '<div class="mt-6"><div class="py-2"><a href="/u/bob">u/bob</a><div class="prose-invert"><p>hey</p></div></div></div>'
    rows = [
        ("https://x.org/m/town", f"<body>{card}</body>"),
        ("https://x.org/post/p9", f"<body>{box}</body>"),
        ("https://x.org/u/ann", "<body><h1>ann</h1><p>bio</p>5 karma</body>"),
        ("https://x.org/u/late", "Rate limit exceeded"),
    ]
    pages = spark.createDataFrame(rows, "url string, html string")
    now = F.lit("2024-03-10 00:00:00").cast("timestamp")
    counts = jobs.ingest_pages(spark, str(tmp_path), 1, pages, now, F.lit("s"))
    assert counts == {"users": 2, "communities": 1, "memberships": 2, "posts": 1, "comments": 1}
    people = {r.name: r.karma for r in store.read_current(spark, str(tmp_path), "users").collect()}
    assert people == {"ann": 5, "bob": 0}


def test_pages_of_one_entity_meet(spark, tmp_path):
    """Addresses with a query, stored ids of old loads, more comments than any old limit."""
    root = str(tmp_path)
    store.append_batch(person(spark, ("u-old", "Ann", 3)), root, "users", 1, "old")
    town = spark.createDataFrame([("m-old", "town", "d", "s")], schemas.nullable(schemas.COMMUNITIES))
    store.append_batch(town, root, "communities", 1, "old")
    card = '<a href="/post/p9?ref=1"><h3>Title</h3><div class="text-xs"><span class="hover:underline">u/ann</span></div></a>'
    box = '<div class="py-2"><a href="/u/bob?x=1">u/bob</a><div class="prose-invert"><p>say {}</p></div></div>'
    talk = '<div class="mt-6">' + "".join(box.format(i) for i in range(300)) + "</div>"
    rows = [
        ("https://x.org/m/town?sort=new", f"<body>{card}</body>"),
        ("https://x.org/post/p9?ref=1", f"<body>{talk}</body>"),
        ("https://x.org/u/ann?tab=posts", "<body><h1>ann</h1><p>bio</p>5 karma</body>"),
    ]
    pages = spark.createDataFrame(rows, "url string, html string")
    now = F.lit("2024-03-10 00:00:00").cast("timestamp")
    counts = jobs.ingest_pages(spark, root, 1, pages, now, F.lit("s"))
    assert counts["comments"] == 300
    people = {r.id_user: r.name for r in store.read_current(spark, root, "users").collect()}
    assert people["u-old"] == "ann" and len(people) == 2
    posts = store.read_current(spark, root, "posts").collect()
    assert [(p.id_post, p.id_user, p.id_community) for p in posts] == [("p9", "u-old", "m-old")]
    assert store.read_current(spark, root, "communities").count() == 1
    members = {r.id_user for r in store.read_current(spark, root, "memberships").collect()}
    assert members == set(people)
    assert {r.id_post for r in store.read_current(spark, root, "comments").collect()} == {"p9"}
    few = jobs.ingest_pages(spark, f"{root}/few", 1, pages, now, F.lit("s"), max_comments=100)
    assert few["comments"] == 100 and few["cut_by_limits"] == {"comments": 200}


def test_bad_rows_are_put_aside(spark, tmp_path):
    root = str(tmp_path)
    counts = jobs.load_batch({"users": person(spark, ("a", "A", 1), ("b", None, 2), (None, "C", 3))}, root, 1)
    assert counts == {"users": 1, "quarantined": {"users": 2}}
    bad = spark.read.parquet(f"{root}/_quarantine/users/load=load-1")
    assert {(r.id_user, r.missing) for r in bad.collect()} == {("b", "name"), (None, "id_user")}


def test_payloads_keep_stored_ids(spark, tmp_path):
    root = str(tmp_path)
    store.append_batch(person(spark, ("u-old", "ANN", 3)), root, "users", 1, "old")
    town = spark.createDataFrame([("m-old", "town", "d", "s")], schemas.nullable(schemas.COMMUNITIES))
    store.append_batch(town, root, "communities", 1, "old")
    counts = jobs.ingest(spark, root, 1, F.lit("s1"), **load(spark))
    assert counts["communities"] == 0 and counts["users"] == 3
    people = {r.name: r.id_user for r in store.read_current(spark, root, "users").collect()}
    assert people["Ann"] == "u-old" and len(people) == 3
    assert {r.id_community for r in store.read_current(spark, root, "posts").collect()} == {"m-old"}


def test_stream_equals_batch(spark, tmp_path):
    landed, root, progress = (f"{tmp_path}/{n}" for n in ("landed", "root", "progress"))
    first = [("Ann", 1), ("Bob", 2)]
    second = [("ann", 5), ("Cyd", 3)]

    def payloads(rows):
        return body(spark, "name", *[(n, {"success": True, "agent": {"karma": k}}) for n, k in rows])

    for rows in (first, second):
        payloads(rows).coalesce(1).write.mode("append").json(landed)
        incremental.profile_stream(spark, landed, root, progress, F.lit("s")).awaitTermination()
    got = {r.name: r.karma for r in store.read_current(spark, root, "users").collect()}
    assert got == {"ann": 5, "Bob": 2, "Cyd": 3}
    incremental.profile_stream(spark, landed, root, progress, F.lit("s")).awaitTermination()
    assert store.read_current(spark, root, "users").count() == 3


def everything(spark, root):
    return {n: sorted(map(str, df.collect())) for n, df in store.read_all(spark, root).items()}


def test_payload_stream_equals_batch_ingest(spark, tmp_path):
    """All kinds in one stream; a micro-batch that runs again changes nothing."""
    parts = load(spark)
    kinds = {"communities": "community", "posts": "post", "profiles": "profile"}
    landed = [
        (kinds[n], getattr(r, "name", None) if n != "posts" else None, getattr(r, "id_post", None) if n == "posts" else None, r.body)
        for n, df in parts.items()
        for r in df.collect()
    ]
    folder, root = f"{tmp_path}/landed", f"{tmp_path}/stream"
    spark.createDataFrame(landed, incremental.LANDED).coalesce(1).write.json(folder)

    def run(progress):
        source = incremental.landed_files(spark, folder, incremental.LANDED)
        incremental.payload_stream(source, root, f"{tmp_path}/{progress}", F.lit("s1")).awaitTermination()

    run("one")
    counts = jobs.ingest(spark, f"{tmp_path}/batch", 1, F.lit("s1"), **parts)
    assert counts["comments"] == 2
    got = everything(spark, root)
    assert got == everything(spark, f"{tmp_path}/batch")
    writer = spark.read.parquet(f"{root}/posts").first().writer
    jobs.ingest(spark, root, 0, F.lit("s1"), writer, **parts)  # the micro-batch once more
    assert everything(spark, root) == got
    assert spark.read.parquet(f"{root}/posts").select("load").distinct().count() == 1
    more = [("post", None, "p2", json.dumps({"comments": [{"author": {"name": "Dan"}, "content": "new"}]}))]
    spark.createDataFrame(more, incremental.LANDED).coalesce(1).write.mode("append").json(folder)
    run("one")
    assert len(everything(spark, root)["comments"]) == 3


def test_loads_keep_nothing_in_the_memory_of_executors(spark, tmp_path, monkeypatch):
    """Neither the payloads of a micro-batch nor the frames of its tables, which are as large as the load."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    people = person(spark, ("a", "A", 1), ("b", "B", 2)).coalesce(1)
    rows = {"users": people.mapInArrow(count, people.schema)}

    def kept(*_, **__):
        raise AssertionError("kept in memory")

    monkeypatch.setattr(type(people), "persist", kept)
    monkeypatch.setattr(type(people), "cache", kept)
    folder, root = f"{tmp_path}/landed", f"{tmp_path}/stream"
    listed = {"success": True, "community": {"description": "d"}, "posts": [{"title": "t", "author": {"name": "Ann"}}]}
    agent = {"success": True, "agent": {"karma": 7}}
    landed = [("community", "town", None, json.dumps(listed)), ("profile", "Ann", None, json.dumps(agent))]
    spark.createDataFrame(landed, incremental.LANDED).coalesce(1).write.json(folder)
    source = incremental.landed_files(spark, folder, incremental.LANDED)
    incremental.payload_stream(source, root, f"{tmp_path}/progress", F.lit("s1")).awaitTermination()
    assert [(r.title, r.id_user) for r in store.read_current(spark, root, "posts").collect()] == [
        ("t", store.read_current(spark, root, "users").first().id_user)
    ]
    assert store.read_current(spark, root, "users").first().karma == 7
    assert jobs.load_batch(rows, f"{tmp_path}/batch", 1) == {"users": 2}
    assert made.value == 2  # a frame that takes work is worked out once


def test_shuffles_of_a_load_are_dropped(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with pytest.raises(ValueError), shuffles_dropped(spark):
        assert spark.conf.get(key) == "true"
        counts = spark.range(9).groupBy((F.col("id") % 3).alias("k")).count()
        assert [sorted(map(tuple, counts.collect())) for _ in range(2)] == [[(0, 3), (1, 3), (2, 3)]] * 2
        raise ValueError
    assert spark.conf.get(key, None) == before


def test_orphans_wait_for_their_parents(spark, tmp_path):
    root = str(tmp_path)

    def talk(*rows):
        return spark.createDataFrame([(k, u, p, "d", "s", "s", 1) for k, u, p in rows], schemas.nullable(schemas.COMMENTS))

    post = spark.createDataFrame([("p", "a", None, "t", "d", "s", "s", 1)], schemas.nullable(schemas.POSTS))
    first = jobs.load_batch({"users": person(spark, ("a", "A", 1)), "comments": talk(("1", "a", "p"), ("2", "b", "p"), ("3", "a", "q"))}, root, 1)
    assert first == {"users": 1, "comments": 0, "orphans": {"comments": 3}}
    lacking = {r.id_comment: r.lacking for r in store.waiting(spark, root, "comments", store.read_current(spark, root, "comments")).collect()}
    assert lacking == {"1": "id_post", "2": "id_user,id_post", "3": "id_post"}
    second = {"posts": post, "comments": talk(("3", "a", "q"))}
    assert jobs.load_batch(second, root, 2) == {"posts": 1, "comments": 1, "orphans": {"comments": 1}, "readmitted": {"comments": 1}}
    assert jobs.load_batch(second, root, 2) == {"posts": 1, "comments": 1, "orphans": {"comments": 1}, "readmitted": {"comments": 1}}
    assert jobs.load_batch({"users": person(spark, ("b", "B", 1))}, root, 3) == {"users": 1, "comments": 1, "readmitted": {"comments": 1}}
    assert {r.id_comment for r in store.read_current(spark, root, "comments").collect()} == {"1", "2"}
    left = store.waiting(spark, root, "comments", store.read_current(spark, root, "comments"))
    assert {r.id_comment for r in left.collect()} == {"3"}
    violations = cleaning.constraint_violations(store.read_all(spark, root)).filter("violations > 0")
    assert violations.count() == 0


def test_collect_goes_through_all_steps(spark, tmp_path):
    """Two rounds: pages are loaded, names discovered, an incomplete profile filled in, all reported."""
    root = str(tmp_path)
    card = '<a href="/post/p9"><h3>Title</h3><div class="text-xs"><span class="hover:underline">u/ann</span></div></a>'
    rows = [
        ("https://x.org/m/town", f'<body>{card}<a href="/m/lake">lake</a> <a href="/m/create">new</a></body>'),
        ("https://x.org/m/lake", '<body><a href="/m/hill">hill</a><a href="/m/town">town</a></body>'),
        ("https://x.org/m/apart", '<body><a href="/m/never">never</a></body>'),
    ]
    pages = spark.createDataFrame(rows[:2], "url string, html string")
    now = F.lit("2024-03-10 00:00:00").cast("timestamp")
    counts = jobs.collect(spark, root, 1, pages, now, F.lit("s"), site="https://x.org")
    assert counts["loaded"]["posts"] == 1 and counts["violations"] == 0
    found = spark.read.parquet(f"{root}/_runs/discovered")
    assert {(r.name, r.depth, r.landed) for r in found.collect()} == {("town", 0, True), ("lake", 0, True), ("hill", 1, False)}
    wanted = {r.url for r in spark.read.parquet(f"{root}/_runs/to_fetch").collect()}
    assert wanted == {"https://x.org/m/hill", "https://x.org/u/ann"}
    summary = {r.entity: (r.new_rows, r.total_rows) for r in spark.read.parquet(f"{root}/_runs/summary").collect()}
    assert summary["users"] == (1, 1) and summary["posts"] == (1, 1)

    fetched = spark.createDataFrame([("https://x.org/u/ann", "<body><h1>ann</h1><p>bio</p>5 karma</body>")], "url string, html string")
    more = spark.createDataFrame([("https://x.org/m/hill", "<body></body>")], "url string, html string")
    seeds = spark.createDataFrame([("apart",)], "name string")
    counts = jobs.collect(spark, root, 2, more, now, F.lit("s2"), seeds=seeds, refreshed=fetched, site="https://x.org")
    assert counts["enriched"] == 1
    people = {r.name: r.karma for r in store.read_current(spark, root, "users").collect()}
    assert people == {"ann": 5}
    wanted = {r.url for r in spark.read.parquet(f"{root}/_runs/to_fetch/load=load-2").collect()}
    assert "https://x.org/u/ann" not in wanted and "https://x.org/m/apart" in wanted


@pytest.fixture(scope="module")
def signal(spark):
    """Karma that follows the followers, with some noise from a hash."""
    noise = F.pmod(F.xxhash64("id"), F.lit(7))
    frame = spark.range(1200).select(
        F.concat(F.lit("u"), "id").alias("id_user"),
        F.concat(F.lit("n"), "id").alias("name"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(300)) * 3 + noise).cast("bigint").alias("karma"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(300)).alias("followers"),
        noise.alias("following"),
        (F.col("id") % 5 + 1).alias("post_count"),
        F.lit(0).cast("bigint").alias("comment_count"),
    )
    return frame.cache()


def test_models(spark, signal, tmp_path):
    signal.write.parquet(f"{tmp_path}/gold/user_features")
    out = f"{tmp_path}/models"
    result = jobs.train(spark, f"{tmp_path}/gold", out, max_models=2, folds=2)
    assert result["features"] == ["followers", "following", "post_count", "comment_count"]
    assert result["metrics"]["r2"] > 0.5 and result["metrics"]["karma_medae"] < 60
    assert result["predictions"] == 1200
    metrics = modeling.evaluate_model(result["model_path"], signal)
    assert metrics["r2"] > 0.5
    scored = spark.read.parquet(result["predictions_path"])
    assert scored.filter("karma_predicted < 0").count() == 0
    assert scored.columns == [*signal.columns, "karma_predicted"]

    model = modeling.load_model(result["model_path"])
    rises = modeling.permutation_importance(model, clean_training(signal))
    top = rises.orderBy(F.desc("importance")).first()
    assert top.variable == "followers" and top.scaled == 1.0


def test_split_does_not_depend_on_partitions(signal):
    one, _ = modeling.split(signal.coalesce(1))
    many, rest = modeling.split(signal.repartition(9))
    assert sorted(r.id_user for r in one.collect()) == sorted(r.id_user for r in many.collect())
    assert 0.15 < rest.count() / 1200 < 0.25


def test_grid(spark, signal):
    train, valid = modeling.split(clean_training(signal))
    grid = {"maxDepth": [2, 3], "stepSize": [0.1], "maxIter": [5], "subsamplingRate": [1.0]}
    found = modeling.optimize_gbt(train, valid, grid=grid, max_models=9)
    best = found.model
    hurried = modeling.optimize_gbt(train, valid, grid=grid, max_runtime_secs=0, parallelism=1)
    assert sorted(r.status for r in hurried.results.collect()) == ["fitted", "skipped"]
    rows = found.results.orderBy("place").collect()
    assert len(rows) == 2 and rows[0].mae <= rows[1].mae
    own = modeling.tree_importance(best)
    assert own.orderBy(F.desc("importance")).first().variable == "followers"
    assert modeling.feature_importance(best, valid).count() == 4


def plain_stop(history, rounds, tolerance):
    """Moving averages written out: stop at the first score whose last windows bring too little."""
    averages = [sum(history[i : i + rounds]) / rounds for i in range(len(history) - rounds + 1)]
    for last in range(rounds, len(averages)):
        before, recent = averages[last - rounds], averages[last - rounds + 1 : last + 1]
        if not any(r < before * (1 - tolerance) for r in recent):
            return last + rounds
    return len(history)


def test_stop_round_equals_the_plain_version():
    draw = random.Random(5)
    stops = set()
    for _ in range(400):
        length, floor = draw.randint(1, 60), draw.random()
        history = [floor + 0.9 ** (i * draw.random()) + draw.random() * 0.05 for i in range(length)]
        rounds, tolerance = draw.choice([1, 3, 5]), draw.choice([0.0, 0.001, 0.05])
        stop = modeling.stop_round(history, rounds, tolerance)
        assert stop == plain_stop(history, rounds, tolerance)
        kept = modeling.kept_trees(history, rounds, tolerance)
        assert history[kept - 1] == min(history[:stop])
        stops.add(stop < length)
    assert stops == {True, False}
    assert modeling.stop_round([5, 4, 3, 2, 1] * 1) == 5  # too few scores for two windows
    assert modeling.stop_round([1.0] * 50) == 10


def test_grid_stops_where_the_windows_say(spark, signal):
    train, valid = modeling.split(clean_training(signal))
    grid = {"maxDepth": [2], "stepSize": [0.1, 1.0], "maxIter": [40], "subsamplingRate": [1.0]}
    found = modeling.optimize_gbt(train, valid, grid=grid)
    scores = {}
    for r in found.history.orderBy("trees").collect():
        scores.setdefault(r.combination, []).append(r.mae)
    for r in found.results.collect():
        history = scores[r.combination]
        assert r.stop_round == plain_stop(history, 5, 0.001)
        assert r.mae == min(history[: r.stop_round]) == history[r.kept_trees - 1]
    best = found.results.orderBy("place").first()
    model = found.model.stages[-1]
    assert len(model.trees) == best.kept_trees
    scored = found.model.transform(valid.na.fill(0))
    assert _mae(scored) == pytest.approx(best.mae, rel=1e-9)
    assert len(modeling.grid_sample(modeling.GRID, 15, 42)) == 15
    assert len(modeling.grid_sample(modeling.GRID, 1000, 42)) == 108


def _mae(scored):
    return scored.agg(F.avg(F.abs(F.col("log_karma") - F.col("prediction")))).first()[0]


def plain_non_negative(x, y):
    """Least squares with an intercept and weights >= 0: the best over all sets of free columns."""
    best = None
    for mask in range(1 << x.shape[1]):
        free = [i for i in range(x.shape[1]) if mask >> i & 1]
        full = np.column_stack([np.ones(len(x)), x[:, free]])
        w, *_ = np.linalg.lstsq(full, y, rcond=None)
        if (w[1:] >= -1e-12).all():
            error = ((full @ w - y) ** 2).sum()
            if best is None or error < best[0] - 1e-12:
                best = error, w[0], free, w[1:]
    weights = np.zeros(x.shape[1])
    weights[best[2]] = best[3]
    return best[1], weights


def test_weights_equal_plain_non_negative_least_squares(spark):
    draw = np.random.default_rng(3)
    for columns in (1, 3, 5):
        y = draw.normal(size=200)
        x = y[:, None] * draw.normal(size=columns) + draw.normal(size=(200, columns)) + 2
        names = [f"p{i}" for i in range(columns)]
        frame = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], [*names, "label"])
        values = list(frame.agg(*modeling.moments(names)).first())
        matrix = modeling.moment_matrix(values, columns + 2)
        intercept, weights = modeling.non_negative_weights(matrix, list(range(columns)))
        want, want_weights = plain_non_negative(x, y)
        assert intercept == pytest.approx(want, abs=1e-6)
        assert weights == pytest.approx(want_weights, abs=1e-6) and (weights >= 0).all()
    nothing = modeling.non_negative_weights(np.zeros((4, 4)), [0, 1])
    assert nothing[0] == 0 and (nothing[1] == 0).all()


def test_stacks(spark, signal, monkeypatch, tmp_path):
    """Both stacks stand on the board, and the leading one predicts its weighted sum."""
    rows = clean_training(signal)
    result = modeling.train_models(rows, max_models=3, folds=2)
    board = {r.model: r for r in result.leaderboard.collect()}
    assert {modeling.STACK_ALL, modeling.STACK_BEST} < board.keys() and len(board) == 5
    assert result.weights.filter("model != 'intercept' and weight < 0").count() == 0
    singles = {n: board[n].rmse for n in ("ridge", "gbt_5", "forest_5")}
    used = {r.model for r in result.weights.filter(F.col("stack") == modeling.STACK_BEST).collect()}
    assert used == {"intercept", *modeling.best_of_family(singles)}
    assert board[modeling.STACK_ALL].rmse <= 1.05 * min(singles.values())

    monkeypatch.setattr(modeling, "metric_columns", _stack_first(modeling.metric_columns))
    led = modeling.train_models(rows, max_models=2, folds=2)
    assert led.model_id == modeling.STACK_ALL
    stage = led.model.stages[-1].getStatement()
    assert "ridge" in stage or "gbt_5" in stage
    modeling.save_model(led.model, f"{tmp_path}/stack")
    again = modeling.load_model(f"{tmp_path}/stack").transform(rows.na.fill(0))
    weights = {r.model: r.weight for r in led.weights.filter(F.col("stack") == modeling.STACK_ALL).collect()}
    parts = [F.lit(w) * (F.lit(1.0) if m == "intercept" else F.col(m)) for m, w in weights.items() if w > 0 or m == "intercept"]
    gap = again.agg(F.max(F.abs(sum(parts[1:], parts[0]) - F.col("prediction")))).first()[0]
    assert gap < 1e-9


def _stack_first(original):
    """Errors under which the stack of all models leads."""

    def changed(label, prediction):
        out = original(label, prediction)
        if modeling.STACK_ALL in str(prediction):
            out["rmse"] = F.lit(0.0) * F.count(label)
        return out

    return changed


def test_best_of_family():
    errors = {"ridge": 3.0, "gbt_5": 2.0, "forest_5": 5.0, "glm": 1.0, "gbt_3": 2.5}
    assert modeling.best_of_family(errors) == ["gbt_5", "forest_5", "glm"]


def test_no_features(spark):
    with pytest.raises(ValueError):
        modeling.available_features(spark.range(1))


def test_keys_of_loads_are_read_without_settling(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([("u1", "A", None, None, None, "s", 1, 1, 1)], schemas.nullable(schemas.USERS))
    store.append_batch(rows, root, "users", 1)
    store.append_batch(rows, root, "users", 2)
    keys = store.known_keys(spark, root, "users")
    assert "Window" not in keys._jdf.queryExecution().optimizedPlan().toString()
    assert {r.id_user for r in keys.collect()} == {"u1"}
    assert store.known_keys(spark, root, "posts").isEmpty()


def test_loads_without_orphans_store_no_rows_twice(spark, tmp_path, monkeypatch):
    def twice(*_):
        raise AssertionError("stored although no parent is missing")

    monkeypatch.setattr(jobs, "cut_lineage", twice)
    people = spark.createDataFrame([("u1", "A", None, None, None, "s", 1, 1, 1)], schemas.nullable(schemas.USERS))
    posts = spark.createDataFrame([("p1", "u1", None, "t", "d", "s", "s", 1)], schemas.nullable(schemas.POSTS))
    assert jobs.load_batch({"users": people, "posts": posts}, str(tmp_path), 1) == {"users": 1, "posts": 1}


def test_fits_have_no_more_tasks_than_cores(spark, signal, monkeypatch):
    """However many partitions the rows come in; the levels of all trees are jobs over them."""
    seen = []

    def spied(kind):
        class Spy(kind):
            def fit(self, part, *rest):
                seen.append(part.rdd.getNumPartitions())
                return super().fit(part, *rest)

        return Spy

    line, boosted = spied(modeling.LinearRegression), spied(modeling.GBTRegressor)
    monkeypatch.setattr(modeling, "candidates", lambda *_: {"ridge": line(regParam=0.1)})
    monkeypatch.setattr(modeling, "GBTRegressor", boosted)
    rows = clean_training(signal).localCheckpoint().repartition(40)
    result = modeling.train_models(rows, folds=2)
    assert result.metrics["train_size"] + result.metrics["test_size"] == rows.count()
    train, valid = modeling.split(rows)
    grid = {"maxDepth": [2], "stepSize": [0.1], "maxIter": [4], "subsamplingRate": [1.0]}
    assert modeling.optimize_gbt(train, valid, grid=grid).results.count() == 1
    assert len(seen) > 4 and max(seen) <= spark.sparkContext.defaultParallelism


def test_rows_in_few_partitions_are_the_same_rows(spark):
    rows = spark.range(1000, numPartitions=40).withColumn("x", F.col("id") % 7)
    few = modeling.persisted_in_few(rows)
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert few.exceptAll(rows).count() == 0 and few.count() == 1000
    as_before = modeling.persisted_in_few(spark.range(10, numPartitions=3))
    assert as_before.rdd.getNumPartitions() == 3
    few.unpersist(), as_before.unpersist()


def test_permuted_rows_are_scored_by_all_cores(spark, signal):
    """A bucket of rows is one task; the scores of its rows are not."""
    rows = clean_training(signal).localCheckpoint()
    stages = [
        VectorAssembler(inputCols=["followers", "following"], outputCol="features"),
        modeling.LinearRegression(labelCol=modeling.TARGET),
    ]
    rises = modeling.permutation_importance(Pipeline(stages=stages).fit(rows), rows)
    plan = rises._jdf.queryExecution().optimizedPlan().toString()
    assert f"Repartition {spark.sparkContext.defaultParallelism}, true" in plan
    assert rises.orderBy(F.desc("importance")).first().variable == "followers"
