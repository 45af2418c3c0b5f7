"""Keyed relational steps: keep-last, caps per group, skew-safe joins, set steps, resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folkmeter.functions import keys as K

HOT_KEYS = 10_000  # a key with more than this part of all rows is heavy: so many keys at most
HOT_ROWS = 1_000_000  # rows of one key that fit one task with ease
KEY_BUCKETS = 1 << 16  # buckets of keys that are counted before keys are
CAP_ROWS = 1_000  # limits per group up to which Spark cuts ranks before the shuffle by itself
CAP_SALTS = 32


def keep_last(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """Last row per key by ``order_by``, ties broken by all other columns.

    The explicit order makes the result independent of partitioning. The rank
    filter is also applied before the shuffle, so a key with many copies leaves
    each map task as one row.
    """
    if order_by is None:
        order_by = [c for c in ("scraped_at",) if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    order = [F.col(c).desc_nulls_last() for c in [*order_by, *rest]]
    if not order:  # a table of keys only
        return df.dropDuplicates(keys)
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def cap_per_group(
    df: DataFrame, keys: list[str], order_by: list[str | Column], limit: int, salts: int = CAP_SALTS
) -> DataFrame:
    """Exactly the first ``limit`` rows of each group.

    Up to CAP_ROWS the ranks are cut inside each map task before the single shuffle. For a larger
    limit salted groups are cut first, so that one hot group never meets in one task with more
    than ``salts * limit`` rows.
    """

    def first(rows: DataFrame, group: list[str]) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order_by))
        return rows.withColumn("_rank", rank).filter(F.col("_rank") <= limit).drop("_rank")

    if limit <= CAP_ROWS:
        return first(df, keys)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    return first(first(salted, [*keys, "_salt"]), keys).drop("_salt")


def _setting_bytes(text: str) -> int:
    units = {"k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}
    bare = text.strip().lower().removesuffix("b")
    return int(bare[:-1]) * units[bare[-1]] if bare[-1:] in units else int(bare)


def fits_broadcast(df: DataFrame) -> bool:
    """True when the optimizer's size estimate is within its broadcast limit."""
    limit = _setting_bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10mb"))
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(estimate)) <= limit


def heavy_keys(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Keys above ``hot_rows`` rows and above a HOT_KEYS-th of all, with their number of salts.

    The second condition bounds the table by HOT_KEYS rows without leaving a larger key out.
    Buckets of keys are counted first: a heavy key lies in a heavy bucket, so only the keys of
    these few are counted one by one, and the others are not shuffled.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).alias("_bucket")
    present = df.filter(F.col(key).isNotNull()).select(key, bucket)
    sizes = present.groupBy("_bucket").agg(F.count("*").alias("_size"))
    share = sizes.agg(F.coalesce(F.sum("_size"), F.lit(0)) / HOT_KEYS).scalar()
    full = sizes.filter((F.col("_size") > hot_rows) & (F.col("_size") > share)).select("_bucket")
    counts = present.join(F.broadcast(full), "_bucket", "left_semi").groupBy(key).agg(F.count("*").alias("_n"))
    heavy = counts.filter((F.col("_n") > hot_rows) & (F.col("_n") > share))
    return heavy.select(F.col(key), F.ceil(F.col("_n") / hot_rows).alias("_salts"))


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    keys_from: DataFrame | None = None,
    bound: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Left equi-join on a key that is unique in ``right`` and may be hot in ``left``.

    A right side within the broadcast limit needs no care. Otherwise rows of heavy
    keys, and rows without a key, are spread over salts; the few matching right rows
    are repeated once per salt. ``keys_from`` is the stored table the keys of ``left``
    come from, so that counting them does not run the steps before this join again.
    ``bound`` is a table with no fewer rows than ``right``, whose size estimate stands
    in for a right side that is itself joined (estimates of joins are products).
    """
    if fits_broadcast(right if bound is None else bound):
        return left.join(right, key, "left")
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    hot = F.broadcast(heavy_keys(left if keys_from is None else keys_from, key, hot_rows))
    spread = F.xxhash64(*left.columns)
    salt = (
        F.when(F.col(key).isNull(), spread)  # meets no row of the right side
        .when(F.col("_salts").isNotNull(), F.pmod(spread, F.col("_salts")))
        .otherwise(F.lit(0).cast("bigint"))
    )
    salted_left = left.join(hot, key, "left").withColumn("_salt", salt).drop("_salts")
    none = F.lit(0).cast("bigint")
    copies = F.sequence(none, F.coalesce(F.col("_salts") - 1, none))
    salted_right = (
        right.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    )
    joined = salted_left.join(salted_right, [key, "_salt"], "left").drop("_salt")
    return joined.select(*left.columns, *[c for c in right.columns if c != key])


def not_known(df: DataFrame, known: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Rows whose key is not stored yet; ``force`` keeps all."""
    return df if force else df.join(known.select(key), key, "left_anti")


def known_only(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return df.join(known.select(key), key, "left_semi")


def names_to_ids(users: DataFrame, id_column: str = "id_user") -> DataFrame:
    """One stored id per lower-cased name."""
    return users.groupBy(F.lower("name").alias("_name")).agg(F.min(id_column).alias("_known_id"))


def resolve_authors(rows: DataFrame, users: DataFrame, author: str = "author") -> DataFrame:
    """Add ``id_user``: the stored id of the author's name, else the id the name generates.

    The case-insensitive name is the identity, so an author seen in many rows of
    one load gets the same id in all of them.
    """
    keyed = rows.withColumn("_name", F.lower(F.col(author)))
    joined = left_join(keyed, names_to_ids(users), "_name")
    resolved = F.coalesce(F.col("_known_id"), K.user_id(F.col(author)))
    return joined.withColumn("id_user", resolved).drop("_name", "_known_id")


def new_minimal_users(
    rows: DataFrame, users: DataFrame, scraped_at: Column, author: str = "author"
) -> DataFrame:
    """One bare profile per author who is not stored; stored profiles are left alone."""
    names = (
        rows.filter(F.col(author).isNotNull() & (F.col(author) != ""))
        .groupBy(F.lower(author).alias("_name"))
        .agg(F.min(author).alias("name"))
    )
    fresh = names.join(names_to_ids(users).select("_name"), "_name", "left_anti")
    zero, nothing = F.lit(0).cast("bigint"), F.lit(None).cast("string")
    return fresh.select(
        K.user_id(F.col("name")).alias("id_user"),
        "name",
        nothing.alias("description"),
        nothing.alias("human_owner"),
        nothing.alias("joined"),
        scraped_at.alias("scraped_at"),
        zero.alias("karma"),
        zero.alias("followers"),
        zero.alias("following"),
    )


def resolve_communities(names: DataFrame, communities: DataFrame, name: str = "name") -> DataFrame:
    """Add ``id_community`` and ``is_new`` for each community name."""
    known = communities.filter("name is not null").groupBy(F.col("name").alias(name)).agg(
        F.min("id_community").alias("_known_id")
    )
    return (
        left_join(names, known, name)
        .withColumn("is_new", F.col("_known_id").isNull())
        .withColumn("id_community", F.coalesce("_known_id", K.community_id(F.col(name))))
        .drop("_known_id")
    )


def new_first(names: DataFrame, known: DataFrame, limit: int, name: str = "name") -> DataFrame:
    """Unknown names before known ones, each in listing order, cut to ``limit``."""
    flagged = known.select(name).distinct().withColumn("_known", F.lit(True))
    return (
        left_join(names, flagged, name)
        .withColumn("is_known", F.coalesce("_known", F.lit(False)))
        .drop("_known")
        .orderBy("is_known", "pos", name)
        .limit(limit)
    )


def union_seed(discovered: DataFrame, seed: DataFrame, name: str = "name") -> DataFrame:
    """Discovered names, then seed names not among them; both keep their order (``pos``)."""
    extra = seed.join(discovered.select(name), name, "left_anti")
    first = discovered.select(F.lit(0).alias("part"), "pos", name)
    return first.unionByName(extra.select(F.lit(1).alias("part"), "pos", name))


def frontier_minus_seen(found: DataFrame, seen: DataFrame, name: str = "name") -> DataFrame:
    return found.select(name).distinct().join(seen.select(name), name, "left_anti")


def refs_union(*parts: DataFrame) -> DataFrame:
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united.distinct()


def memberships(
    posts: DataFrame, comments: DataFrame, lookup: DataFrame | None = None
) -> DataFrame:
    """Distinct (user, community) pairs of post authors and comment authors.

    ``lookup`` gives the community of commented posts when ``posts`` holds only some.
    """
    own = posts.select("id_user", "id_community")
    # Authors repeat under a post: collapse pairs before they meet the post table.
    talk = comments.select("id_post", "id_user").distinct()
    placed = (posts if lookup is None else lookup).select("id_post", "id_community")
    via = left_join(talk, placed, "id_post", keys_from=comments)
    pairs = own.unionByName(via.select("id_user", "id_community"))
    return pairs.filter("id_user is not null and id_community is not null").distinct()


RANK_RANGES = 64  # key ranges that a page by position counts
SAMPLED_KEYS = 4096  # keys, about, from which their borders are taken


def rank_index(df: DataFrame, key: str) -> list[tuple]:
    """(least key, rows, rows before) of up to ``RANK_RANGES`` ranges in key order; the first, of
    rows without a key and of keys below the first border, has None.

    The borders come from a sample of about ``SAMPLED_KEYS`` keys and only decide how even the
    ranges are; the counts are exact.
    """
    total = df.count()
    if total == 0:
        return []
    share = min(1.0, 2.0 * SAMPLED_KEYS / total)
    keys = df.filter(F.col(key).isNotNull()).select(key)
    sampled = keys if share == 1.0 else keys.sample(share, seed=1)
    # A bounded number of keys: the sample, thinned where it came out larger.
    found = sorted({r[0] for r in sampled.limit(4 * SAMPLED_KEYS).collect()}, key=_sort_key)
    borders = found[:: max(1, len(found) // (RANK_RANGES - 1))]
    counts = dict(df.groupBy(_range_of(df, key, borders).alias("r")).count().collect())
    out, before = [], 0
    for number in range(len(borders) + 1):
        rows = counts.get(number, 0)
        out.append((borders[number - 1] if number else None, rows, before))
        before += rows
    return out


def _sort_key(value):
    """Strings as Spark orders them, by their bytes."""
    return value.encode() if isinstance(value, str) else value


def _range_of(df: DataFrame, key: str, borders: list) -> Column:
    """The number of borders that are not above the key; 0 without a key."""
    if not borders:
        return F.lit(0)
    kind = df.schema[key].dataType
    held = F.lit(borders).cast(T.ArrayType(kind))
    return F.coalesce(F.size(F.filter(held, lambda b: b <= F.col(key))), F.lit(0))


def page_of_rows(df: DataFrame, key: str, limit: int, offset: int = 0) -> DataFrame:
    """One page in key order, so that pages neither overlap nor miss rows; nulls come first.

    Counts per key range say in which ranges the page lies; only rows of these are read and
    sorted, so a page in the middle of a table does not sort the rows before it. A range bound is
    a predicate on the key and reaches the scan.
    """
    index = rank_index(df, key)
    meets = [i for i, (_, n, before) in enumerate(index) if before < offset + limit and before + n > offset]
    if not meets:
        return df.limit(0)
    first, last = meets[0], meets[-1]
    column, rows = F.col(key), df
    if first > 0:
        rows = rows.filter(column >= F.lit(index[first][0]))
    if last + 1 < len(index):
        below = column < F.lit(index[last + 1][0])
        rows = rows.filter(below | column.isNull() if first == 0 else below)
    return rows.orderBy(key).offset(offset - index[first][2]).limit(limit)


def top_rows(df: DataFrame, by: str, tie: str, limit: int, columns: list[str]) -> DataFrame:
    return df.select(*columns).orderBy(F.desc(by), F.asc(tie)).limit(limit)


def lookup(df: DataFrame, **key) -> DataFrame:
    """Rows of a (possibly composite) key; the predicate reaches the scan."""
    for column, value in key.items():
        df = df.filter(F.col(column) == F.lit(value))
    return df


def exists(df: DataFrame, **key) -> bool:
    return not lookup(df, **key).limit(1).isEmpty()
