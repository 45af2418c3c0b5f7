"""Whole jobs: ingest landed data, build the layers, train, report status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folkmeter import schemas
from folkmeter.functions import keys as K
from folkmeter.functions import scalars as S
from folkmeter.operators import (
    evaluation,
    features,
    frontier,
    modeling,
    profiling,
    references,
    relational,
)
from folkmeter.operators.cleaning import (
    clean,
    constraint_violations,
    incomplete_profiles,
    usable_pages,
)
from folkmeter.operators.evaluation import clean_training
from folkmeter.operators.upsert import profiles_of_incomplete, run_summary, split_valid
from folkmeter.session import cut_lineage, persisted, scratch, shuffles_dropped, stored_once
from folkmeter.sources import pages as P
from folkmeter.sources import payloads as J
from folkmeter.sources import store, tables


def _attempt(results: dict, name: str, write) -> None:
    """A failed table is reported with its error and does not stop the others."""
    try:
        results[name] = write()
    except Exception as error:
        results[name] = {"rows": 0, "error": f"{type(error).__name__}: {error}"}


def build_silver(raw: dict[str, DataFrame], folder: str, lenient: bool = False) -> dict:
    results: dict = {}
    for name in tables.SILVER:
        _attempt(
            results,
            name,
            lambda n=name: tables.write_counted(clean(raw[n], n, lenient), f"{folder}/{n}"),
        )
    return results


def build_gold(spark: SparkSession, silver: str, folder: str) -> dict:
    """The three feature tables; post features read the user features just written."""
    data = tables.read_silver(spark, silver)
    users, posts, comments = data["users"], data["posts"], data["comments"]
    communities = data["communities"]
    results: dict = {}

    def user_table():
        frame = features.user_features(users, posts, comments)
        return tables.write_counted(frame, f"{folder}/user_features")

    def post_table():
        done = "error" not in results["user_features"]
        stored = spark.read.parquet(f"{folder}/user_features") if done else None
        frame = features.post_features(posts, users, comments, communities, stored)
        return tables.write_counted(frame, f"{folder}/post_features")

    def comment_table():
        frame = features.comment_features(comments, posts, users, communities)
        return tables.write_counted(frame, f"{folder}/comment_features")

    _attempt(results, "user_features", user_table)
    _attempt(results, "post_features", post_table)
    _attempt(results, "comment_features", comment_table)
    return results


def build(spark: SparkSession, raw: dict[str, DataFrame], silver: str, gold: str) -> dict:
    return {"silver": build_silver(raw, silver), "gold": build_gold(spark, silver, gold)}


def train(
    spark: SparkSession,
    gold: str,
    out: str,
    scope: str = "all",
    max_models: int = 10,
    max_runtime_secs: float | None = None,
    **options,
) -> dict:
    """Fit, save, score and write; ``scope`` says whether all or only cleaned rows are scored."""
    data = tables.read_required(spark, f"{gold}/user_features")
    with scratch(spark):
        cleaned = cut_lineage(clean_training(data))  # read by every fit and by the test score
        result = modeling.train_models(
            cleaned, max_models=max_models, max_runtime_secs=max_runtime_secs, **options
        )
        modeling.save_model(result.model, f"{out}/model")
        rows = cleaned if scope == "cleaned" else data
        written = tables.write_counted(modeling.predict(result.model, rows), f"{out}/predictions")
    return {
        "model_id": result.model_id,
        "metrics": result.metrics,
        "features": result.features,
        "model_path": f"{out}/model",
        "predictions_path": f"{out}/predictions",
        "predictions": written["rows"],
    }


def _write_report(report: dict[str, DataFrame], out: str) -> dict[str, int]:
    return {
        name: tables.write_counted(frame.coalesce(1), f"{out}/{name}")["rows"]
        for name, frame in report.items()
    }


def eda(spark: SparkSession, silver: str, out: str) -> dict[str, int]:
    """The exploratory report over the silver layer, each part as a small table."""
    names = ("users", "posts", "comments")
    data = {n: tables.read_required(spark, f"{silver}/{n}") for n in names}
    with persisted(data["users"]):
        return _write_report(profiling.eda_report(data), out)


def evaluate(
    spark: SparkSession, predictions: str, out: str, method: str = "approx"
) -> dict[str, int]:
    """The evaluation report over scored rows, each part as a small table."""
    columns = [evaluation.ACTUAL, evaluation.PREDICTED]
    scored = tables.read_required(spark, predictions).select(*columns)
    with persisted(scored):
        return _write_report(evaluation.evaluation_report(scored, method), out)


def with_stored_ids(rows: DataFrame, users: DataFrame) -> DataFrame:
    """User rows under the id by which their name is stored, if it is."""
    return relational.resolve_authors(rows.drop("id_user"), users, "name")


def entities(
    stored: dict[str, DataFrame],
    scraped_at: Column,
    communities: DataFrame,
    posts: DataFrame,
    profiles: DataFrame,
    max_posts: int | None = None,
    max_comments: int | None = None,
) -> dict[str, DataFrame]:
    """Entity rows of one load of payloads.

    ``communities`` and ``profiles`` are (name, body), ``posts`` is (id_post, body).
    Stored communities and posts are not inserted again; authors without a profile
    get a minimal one unless they are stored.
    """
    known, places = stored["users"], stored["communities"]
    # Read by the tables of posts, authors and memberships: parsed once. It has nearly all the text.
    listed = cut_lineage(J.posts_in_payloads(communities, max_posts), compression="zstd")
    post_rows = J.post_rows(listed, known, scraped_at, places)
    comment_rows = cut_lineage(J.comment_rows(posts, known, scraped_at, max_comments))
    profile_rows = cut_lineage(with_stored_ids(J.profile_rows(profiles, scraped_at), known))
    described = cut_lineage(J.community_rows(communities, scraped_at).drop("id_community"))
    community_rows = relational.resolve_communities(described, places)
    authors = J.discovered_authors(listed, comment_rows)
    named = known.select("id_user", "name").unionByName(profile_rows.select("id_user", "name"))
    minimal = relational.new_minimal_users(authors, named, scraped_at)
    placed = ["id_post", "id_user", "id_community"]
    lookup = post_rows.select(*placed).unionByName(stored["posts"].select(*placed))
    pairs = relational.memberships(post_rows, comment_rows, lookup.dropDuplicates(["id_post"]))
    return {
        "users": profile_rows.unionByName(minimal),
        "communities": community_rows.filter("is_new").drop("is_new"),
        "memberships": pairs,
        "posts": J.new_rows_only(post_rows, stored["posts"], "id_post"),
        "comments": comment_rows.drop("author", "path"),
    }


def page_entities(
    stored: dict[str, DataFrame],
    pages: DataFrame,
    now: Column,
    scraped_at: Column,
    site: str = "",
    max_posts: int | None = None,
    max_comments: int | None = None,
) -> dict[str, DataFrame]:
    """Entity rows of landed pages (url, html); the address tells the kind of page."""
    good = usable_pages(pages)
    url = F.col("url")
    profile_pages = good.filter(K.username_from_url(url).isNotNull())
    community_pages = good.filter(K.community_from_url(url).isNotNull())
    post_pages = good.filter(K.url_entity(url, "post").isNotNull())
    known = stored["users"]

    # Rows of parsed pages are read by several tables: each page is parsed once.
    profile_rows = P.user_entities(P.profiles(profile_pages), scraped_at)
    profile_rows = cut_lineage(with_stored_ids(profile_rows, known))
    places = stored["communities"]
    cards = P.posts_on_pages(community_pages, now, max_posts, site).filter("author != ''")
    cards = cut_lineage(cards)
    placed_cards = relational.resolve_communities(cards, places, "community")
    post_rows = relational.resolve_authors(placed_cards, known).select(
        K.url_entity(F.col("post_url"), "post").alias("id_post"),
        "id_user",
        "id_community",
        "title",
        "description",
        "date",
        scraped_at.alias("scraped_at"),
        "rating",
    )
    boxes = cut_lineage(P.comments_on_pages(post_pages, now, max_comments))
    talk = relational.resolve_authors(boxes, known).withColumn("id_post", K.url_entity(url, "post"))
    comment_rows = talk.select(
        K.comment_id(F.col("id_user"), F.col("id_post"), F.col("description")).alias("id_comment"),
        "id_user",
        "id_post",
        "description",
        "date",
        scraped_at.alias("scraped_at"),
        "rating",
    )
    authors = J.discovered_authors(cards, boxes)
    named = known.select("id_user", "name").unionByName(profile_rows.select("id_user", "name"))
    placed = ["id_post", "id_user", "id_community"]
    lookup = post_rows.select(*placed).unionByName(stored["posts"].select(*placed))
    return {
        "users": profile_rows.unionByName(
            relational.new_minimal_users(authors, named, scraped_at)
        ),
        "communities": relational.resolve_communities(
            P.community_pages(community_pages, scraped_at).drop("id_community"), places
        ).drop("is_new"),
        "memberships": relational.memberships(
            post_rows, comment_rows, lookup.dropDuplicates(["id_post"])
        ),
        "posts": post_rows,
        "comments": comment_rows,
    }


def load_batch(
    rows: dict[str, DataFrame],
    root: str,
    number: int,
    writer: str = store.WRITER,
    stored: dict[str, DataFrame] | None = None,
) -> dict:
    """Write one load, parents before children; repeating a load changes nothing.

    Rows without a required column go to ``_quarantine`` next to the tables, with the names of
    the columns they lack. Rows that name a parent which is neither stored nor in the load are set
    aside in ``_orphans`` and are taken up by the first load after which all their parents are
    there. What was put aside or taken up is reported when there is any. ``stored`` are the tables
    without this load, if they are not those below ``root``.

    A frame that takes more than reading is stored until its table is written. None is kept in
    memory: frames of a load are as large as the load, and the tasks need the heap.
    """
    spark = next(iter(rows.values())).sparkSession
    own = (writer, number)
    if stored is None:
        keys = {n: store.known_keys(spark, root, n, own) for n in schemas.TABLES}
    else:
        keys = {n: stored[n].select(*schemas.PRIMARY_KEYS[n]) for n in schemas.TABLES}
    counts: dict = {}
    aside: dict[str, dict[str, int]] = {"quarantined": {}, "orphans": {}, "readmitted": {}}
    for name in schemas.WRITE_ORDER:
        key = schemas.PRIMARY_KEYS[name]
        frame = rows.get(name, schemas.empty_table(spark, name))
        checked = name in schemas.FOREIGN_KEYS
        late = stored_once(store.waiting(spark, root, name, keys[name], own).drop("lacking")) if checked else None
        if name not in rows and (late is None or late.isEmpty()):
            continue
        with scratch(spark), shuffles_dropped(spark):
            frame = stored_once(frame)
            good, bad = split_valid(frame, name)
            latest = relational.keep_last(good, key).select(*schemas.TABLES[name].fieldNames())
            if not bad.isEmpty():
                folder = store.load_folder(f"{root}/_quarantine", name, number, writer)
                aside["quarantined"][name] = tables.write_counted(bad, folder)["rows"]
            if checked:
                late = late.join(latest.select(*key), key, "left_anti").select(*latest.columns)
                both = latest.withColumn("_new", F.lit(True)).unionByName(late.withColumn("_new", F.lit(False)))
                # All rows that may be written say which parents to look for, so none is settled for it.
                named = [c for c, *_ in schemas.FOREIGN_KEYS[name]]
                missing = references.missing_parents(
                    good.select(*named).unionByName(late.select(*named)), name, keys
                )
                if missing:  # read for the orphans, for what is taken up and for the table
                    both = cut_lineage(both)
                both = references.with_lacking(both, missing)
                orphans = both.filter("_new and lacking is not null")
                if not orphans.isEmpty():
                    aside["orphans"][name] = store.set_aside(orphans, root, name, number, writer)
                latest = both.filter("lacking is null")
                back = latest.filter("not _new").count()
                if back:
                    aside["readmitted"][name] = back
            counts[name] = store.append_batch(latest, root, name, number, writer)
        written = spark.read.parquet(store.load_folder(root, name, number, writer))
        keys[name] = keys[name].unionByName(written.select(*key))
    return counts | {k: v for k, v in aside.items() if v}


def ingest(
    spark: SparkSession,
    root: str,
    number: int,
    scraped_at: Column,
    writer: str = store.WRITER,
    **payloads,
) -> dict:
    """Landed payloads -> entities -> stored tables under ``root``."""
    with scratch(spark), shuffles_dropped(spark):
        stored = store.read_all(spark, root, (writer, number))
        rows = entities(stored, scraped_at, **payloads)
        return load_batch(rows, root, number, writer)


def ingest_pages(
    spark: SparkSession,
    root: str,
    number: int,
    pages: DataFrame,
    now: Column,
    scraped_at: Column,
    writer: str = store.WRITER,
    max_posts: int | None = None,
    max_comments: int | None = None,
) -> dict:
    """Landed pages -> entities -> stored tables; limits that cut something off are reported."""
    with scratch(spark):
        stored = store.read_all(spark, root, (writer, number))
        rows = page_entities(stored, pages, now, scraped_at, "", max_posts, max_comments)
        counts = load_batch(rows, root, number, writer)
    good, cut = usable_pages(pages), {}
    for name, limit, rule, needed in (
        ("posts", max_posts, "post_cards", ("title",)),
        ("comments", max_comments, "comment_boxes", ("author", "description")),
    ):
        if limit is not None:
            kind = K.community_from_url if name == "posts" else K.page_post
            here = good.filter(kind(F.col("url")).isNotNull())
            found = P.extract(here, rule, needed).groupBy("url").agg(F.count("*").alias("n"))
            over = found.filter(F.col("n") > limit).agg(F.sum(F.col("n") - limit)).first()[0]
            if over:
                cut[name] = over
    return counts | ({"cut_by_limits": cut} if cut else {})


def usable_refs(html: Column) -> Column:
    """Community names that a page mentions."""
    found = S.all_matches(html, P.REF_PATTERN)
    return F.filter(found, lambda n: (F.length(n) > 1) & ~n.isin(P.NOT_A_NAME))


def collect(
    spark: SparkSession,
    root: str,
    number: int,
    pages: DataFrame,
    now: Column,
    scraped_at: Column,
    seeds: DataFrame | None = None,
    refreshed: DataFrame | None = None,
    site: str = "",
    writer: str = store.WRITER,
    **limits,
) -> dict:
    """One round of collection over landed pages (url, html), to be repeated with what it asks for.

    1. The pages become entities and are loaded; rows without their parents wait.
    2. ``refreshed``, pages fetched anew for incomplete profiles, fill these in under their stored
       ids, as a load of its own.
    3. Discovery walks the references of the landed community pages, from the stored communities
       and the ``seeds`` (name).
    4. Reports are written below ``_runs`` next to the tables: ``discovered``, ``to_fetch`` (the
       pages of discovered communities that have not landed, and of profiles that are still
       incomplete), ``summary`` (new and total rows), and ``violations`` of the declared rules.

    Returns the counts of the loads and of the reports.
    """
    before = store.read_all(spark, root, (writer, number))
    counts: dict = {"loaded": ingest_pages(spark, root, number, pages, now, scraped_at, writer, **limits)}
    again = f"{writer}-enriched"
    if refreshed is not None:
        with scratch(spark):
            users = store.read_current(spark, root, "users", (again, number))
            profiles = P.user_entities(P.profiles(usable_pages(refreshed)), scraped_at)
            fresh = cut_lineage(profiles_of_incomplete(users, profiles))
            counts["enriched"] = load_batch({"users": fresh}, root, number, again)["users"]
    after = store.read_all(spark, root)
    with scratch(spark):
        named = usable_pages(pages).select(
            K.community_from_url(F.col("url")).alias("name"), usable_refs(F.col("html")).alias("refs")
        )
        named = named.filter("name is not null")
        start = after["communities"].select("name")
        start = start if seeds is None else start.unionByName(seeds.select("name"))
        found = cut_lineage(frontier.discover(named, "name", F.col("refs"), start))
        wanted = found.filter("not landed").select(
            F.lit("community").alias("kind"), "name", K.build_url(site, "m", F.col("name")).alias("url")
        )
        lacking = incomplete_profiles(after["users"]).select(
            F.lit("profile").alias("kind"), "name", K.build_url(site, "u", F.col("name")).alias("url")
        )
        reports = {
            "discovered": found,
            "to_fetch": wanted.unionByName(lacking),
            "summary": run_summary(before, after),
            "violations": constraint_violations(after).filter("violations > 0"),
        }
        for name, frame in reports.items():
            folder = f"{root}/_runs/{name}/load={store.checked_writer(writer)}-{number}"
            counts[name] = tables.write_counted(frame, folder)["rows"]
    return counts


def status(spark: SparkSession, root: str, silver: str, gold: str) -> dict[str, DataFrame]:
    """Row counts of the stored tables, rows and files of the layers."""
    golden = ("user_features", "post_features", "comment_features")
    return {
        "stored": store.stored_counts(spark, root),
        "silver": tables.layer_status(spark, {n: f"{silver}/{n}" for n in tables.SILVER}),
        "gold": tables.layer_status(spark, {n: f"{gold}/{n}" for n in golden}),
    }
