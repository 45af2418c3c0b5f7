"""Breadth-first discovery over the references of landed pages, from any number of seeds."""

from __future__ import annotations

import itertools
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folkmeter.session import step_folder

BUCKETS = 32  # parts of the names seen and of the references, by hash of the name
SEEN = "name string, depth int, round int, bucket int"
EDGES = "src string, dst string, bucket int"


def _bucket(name: str) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(BUCKETS)).cast("int").alias("bucket")


def _in_buckets(df: DataFrame, buckets: list[int]) -> DataFrame:
    """Only the folders of these buckets are read."""
    return df.filter(F.col("bucket").isin(buckets))


def _buckets_of(names: DataFrame) -> list[int]:
    """At most ``BUCKETS`` numbers."""
    return sorted(r.bucket for r in names.select("bucket").distinct().collect())


def references(pages: DataFrame, name: str, found: Column) -> DataFrame:
    """(src, dst) of landed pages: ``name`` is the column with the name that a page belongs to,
    ``found`` the list of names it mentions. Repeated mentions of a page are one."""
    return pages.select(F.col(name).alias("src"), F.explode(F.array_distinct(found)).alias("dst"))


def frontier_bfs(
    edges: DataFrame, seeds: DataFrame, max_rounds: int | None = None, max_names: int | None = None
) -> DataFrame:
    """Names (name, depth) reached from ``seeds`` over ``edges`` (src, dst).

    Pages are read once, for their references, which are stored by bucket of their source. A
    round then works on differences only: it reads the references in the buckets of the names
    found last, drops repeats, and compares what is left with the seen names in the buckets
    where they fall. The seen names are a table by round and bucket to which each round adds its
    own, so no round writes or reads again what it does not touch, and plans do not grow. A name
    that a third of the pages mention is one row per task before it moves, and a page name that
    holds a third of the references fills several files of its bucket.

    It ends when a round finds no new name; a limit of rounds or names that cuts something off is
    reported by a warning. Null names are no names.
    """
    spark, folder = edges.sparkSession, step_folder(edges.sparkSession)
    linked = edges.filter("src is not null and dst is not null").select("src", "dst", _bucket("src"))
    linked.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{folder}/edges")
    links = spark.read.schema(EDGES).parquet(f"{folder}/edges")

    def add(names: DataFrame, depth: int) -> DataFrame:
        """Store the names of a round; what is stored of this round."""
        own = f"{folder}/seen/round={depth}"
        rows = names.select("name", F.lit(depth).alias("depth"), _bucket("name"))
        rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(own)
        return spark.read.schema("name string, depth int, bucket int").parquet(own)

    def seen() -> DataFrame:
        return spark.read.schema(SEEN).parquet(f"{folder}/seen")

    latest = add(seeds.select("name").filter("name is not null").distinct(), 0)
    total = latest.count() if max_names is not None else 0
    for depth in itertools.count(1):
        touched = _buckets_of(latest)
        if not touched:
            break
        step = _in_buckets(links, touched).join(
            latest.select(F.col("name").alias("src"), "bucket"), ["bucket", "src"], "left_semi"
        )
        named = step.select(F.col("dst").alias("name")).distinct().select("name", _bucket("name"))
        named.write.parquet(f"{folder}/named/{depth}")
        named = spark.read.schema("name string, bucket int").parquet(f"{folder}/named/{depth}")
        known = _in_buckets(seen(), _buckets_of(named))
        fresh = named.join(known.select("name", "bucket"), ["bucket", "name"], "left_anti")
        if max_rounds is not None and depth > max_rounds:
            if not fresh.isEmpty():
                warnings.warn(f"discovery stopped after {max_rounds} rounds", stacklevel=2)
            break
        if max_names is not None:
            if fresh.limit(max_names - total + 1).count() > max_names - total:
                warnings.warn(f"discovery stopped at {max_names} names", stacklevel=2)
            fresh = fresh.orderBy("name").limit(max(max_names - total, 0))
        latest = add(fresh, depth)
        if max_names is not None:
            total += latest.count()
    return seen().select("name", "depth")


def discover(
    pages: DataFrame,
    name: str,
    found: Column,
    seeds: DataFrame,
    max_rounds: int | None = None,
    max_names: int | None = None,
) -> DataFrame:
    """Names (name, depth, landed) reached from ``seeds`` over landed pages; those that have no
    page yet are the ones to fetch next."""
    reached = frontier_bfs(references(pages, name, found), seeds, max_rounds, max_names)
    have = pages.select(F.col(name).alias("name")).filter("name is not null").distinct()
    have = have.withColumn("landed", F.lit(True))
    return reached.join(have, "name", "left").na.fill(False, ["landed"])
