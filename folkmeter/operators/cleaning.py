"""Silver layer: typed, trimmed, de-duplicated tables, and the row filters around them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folkmeter import schemas
from folkmeter.functions import scalars as S
from folkmeter.operators.relational import keep_last

# table -> (integer columns, trimmed text with '' for null, trimmed text kept null)
RULES = {
    "users": (["karma", "followers", "following"], ["description"], ["name", "human_owner", "joined"]),
    "posts": (["rating"], ["title", "description"], []),
    "comments": (["rating"], ["description"], []),
    "communities": ([], ["description"], ["name"]),
}
NAMED = {"users", "communities"}


def clean(df: DataFrame, table: str, lenient: bool = False) -> DataFrame:
    """Cast, trim, fill, keep the last row per key, then drop rows without a name.

    The name filter comes last: a blank latest name removes the entity.
    """
    numbers, filled, kept = RULES[table]
    typed = {c: S.cast_default(F.col(c), lenient=lenient) for c in numbers}
    typed |= {c: F.coalesce(S.trim_ws(F.col(c)), F.lit("")) for c in filled}
    typed |= {c: S.trim_ws(F.col(c)) for c in kept}
    last = keep_last(df.withColumns(typed), schemas.PRIMARY_KEYS[table])
    return last.filter(F.length("name") > 0) if table in NAMED else last


def fill_zero(df: DataFrame) -> DataFrame:
    """Zero for null in every numeric column."""
    return df.na.fill(0)


def non_negative(df: DataFrame, column: str = "karma") -> DataFrame:
    return df.filter(F.col(column) >= 0)


def active(df: DataFrame) -> DataFrame:
    return df.filter((F.col("post_count") > 0) | (F.col("comment_count") > 0))


def incomplete_profiles(users: DataFrame) -> DataFrame:
    karma = F.col("karma")
    lacking = F.col("description").isNull() | (karma == 0) | karma.isNull()
    return users.filter(F.col("name").isNotNull() & lacking)


def enriched_profiles(users: DataFrame) -> DataFrame:
    return users.filter((F.col("karma") > 0) | F.col("description").isNotNull())


RATE_LIMIT_MARK = "Rate limit exceeded"  # fixed value: text of a refused page


def usable_pages(pages: DataFrame) -> DataFrame:
    """Pages with content that the site did not refuse."""
    return pages.filter(F.col("html").isNotNull() & ~F.col("html").contains(RATE_LIMIT_MARK))


def zero_split(users: DataFrame, column: str = "karma") -> DataFrame:
    return users.agg(
        F.count_if(F.col(column) == 0).alias("zero"), F.count_if(F.col(column) > 0).alias("positive")
    )


def constraint_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows (table, rule, column, violations) for keys, required, unique and parent columns."""
    checks: list[DataFrame] = []

    def add(found: DataFrame, table: str, rule: str, column: str) -> None:
        checks.append(
            found.select(
                F.lit(table).alias("table_name"),
                F.lit(rule).alias("rule"),
                F.lit(column).alias("column_name"),
                F.col("violations").cast("bigint").alias("violations"),
            )
        )

    for name, df in tables.items():
        key = schemas.PRIMARY_KEYS[name]
        unique = [key] + [[c] for c in schemas.UNIQUE_COLUMNS.get(name, [])]
        for columns in unique:
            repeated = df.groupBy(*columns).count().filter("count > 1")
            rule = "primary_key" if columns == key else "unique"
            add(repeated.agg(F.count("*").alias("violations")), name, rule, ",".join(columns))
        needed = schemas.required_columns(name)
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in needed])
        lines = [F.struct(F.lit(c).alias("c"), F.col(c).alias("violations")) for c in needed]
        nulls = counts.select(F.inline(F.array(*lines)))
        checks.append(
            nulls.select(
                F.lit(name).alias("table_name"),
                F.lit("not_null").alias("rule"),
                F.col("c").alias("column_name"),
                "violations",
            )
        )
        for column, parent, parent_key in schemas.FOREIGN_KEYS.get(name, []):
            if parent not in tables:
                continue
            # Distinct child keys first: a hot parent is one row in the anti-join.
            wanted = df.filter(F.col(column).isNotNull()).groupBy(column).count()
            known = tables[parent].select(F.col(parent_key).alias(column))
            orphans = wanted.join(known, column, "left_anti")
            total = orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("violations"))
            add(total, name, "foreign_key", column)
    united = checks[0]
    for check in checks[1:]:
        united = united.unionByName(check)
    return united


def empty_silver(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: schemas.empty_table(spark, name) for name in RULES}
