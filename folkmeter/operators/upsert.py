"""Keyed merges of a batch into a stored table, with validation and run summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folkmeter import schemas
from folkmeter.operators.cleaning import incomplete_profiles
from folkmeter.operators.relational import keep_last


def upsert(
    target: DataFrame, batch: DataFrame, keys: list[str], order_by: list[str] | None = None
) -> DataFrame:
    """``target`` with the rows of ``batch`` inserted or replacing their key.

    The batch is reduced to one row per key first. The stored table, which is unique
    per key, only meets the keys of the batch in an anti-join, so it is not shuffled
    when they fit a broadcast.
    """
    latest = keep_last(batch, keys, order_by)
    kept = target.join(latest.select(*keys), keys, "left_anti")
    return kept.unionByName(latest.select(*target.columns))


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` plus the batch rows whose key is new (tables made of keys only)."""
    fresh = batch.select(*target.columns).dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh)


def split_valid(batch: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows with all required columns, and the others with the columns they lack."""
    needed = [c for c in schemas.required_columns(table) if c in batch.columns]
    lacking = F.array_compact(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in needed])
    )
    flagged = batch.withColumn("missing", lacking)
    good = flagged.filter(F.size("missing") == 0).drop("missing")
    bad = flagged.filter(F.size("missing") > 0)
    return good, bad.withColumn("missing", F.array_join("missing", ","))


def upsert_checked(
    target: DataFrame, batch: DataFrame, table: str, order_by: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(merged, quarantine): a bad row costs itself, never the batch."""
    good, bad = split_valid(batch, table)
    return upsert(target, good, schemas.PRIMARY_KEYS[table], order_by), bad


def profiles_of_incomplete(users: DataFrame, profiles: DataFrame) -> DataFrame:
    """The profiles of users that are stored as incomplete.

    They are matched by name and take the stored id, whatever id the profile came with.
    """
    wanted = incomplete_profiles(users).select(F.lower("name").alias("_name"), F.col("id_user").alias("_id"))
    keyed = profiles.withColumn("_name", F.lower("name"))
    return keyed.join(wanted, "_name").withColumn("id_user", F.col("_id")).drop("_name", "_id")


def enrich_incomplete(users: DataFrame, profiles: DataFrame) -> DataFrame:
    """Users with the profiles of incomplete ones replaced by freshly read profiles."""
    return upsert(users, profiles_of_incomplete(users, profiles), ["id_user"])


def run_summary(stored: dict[str, DataFrame], batch: dict[str, DataFrame]) -> DataFrame:
    """Rows (entity, new_rows, total_rows) after a load, with a grand total."""
    parts = []
    for name, df in stored.items():
        keys = schemas.PRIMARY_KEYS[name]
        old = df.agg(F.count("*").alias("old_rows"))
        fresh = batch[name].select(*keys).distinct().join(df.select(*keys), keys, "left_anti")
        new = fresh.agg(F.count("*").alias("n")).scalar()
        parts.append(
            old.select(
                F.lit(name).alias("entity"),
                new.alias("new_rows"),
                (F.col("old_rows") + new).alias("total_rows"),
            )
        )
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    # An empty grouping set next to the entities adds the grand total in the same pass.
    return lines.rollup("entity").agg(
        F.sum("new_rows").alias("new_rows"), F.sum("total_rows").alias("total_rows")
    ).na.fill({"entity": "total"})
