"""Foreign keys of a load: rows whose parents are neither stored nor in the load itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folkmeter import schemas
from folkmeter.operators.relational import left_join
from folkmeter.session import cut_lineage


def missing_parents(rows: DataFrame, table: str, parents: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """By column, the keys that ``rows`` name and that are not there; columns without any are left out.

    ``parents`` has the known keys of each parent table. Only the keys that the load names are
    looked up, each once, so a hot parent is one row there. A null names no parent.
    """
    found = {}
    for column, parent, key in schemas.FOREIGN_KEYS.get(table, []):
        known = parents[parent].select(F.col(key).alias(column))
        named = rows.filter(F.col(column).isNotNull()).select(column).distinct()
        missing = cut_lineage(named.join(known, column, "left_anti"))  # usually none
        if not missing.isEmpty():
            found[column] = missing
    return found


def with_lacking(rows: DataFrame, missing: dict[str, DataFrame]) -> DataFrame:
    """``rows`` with ``lacking``: the columns that name a parent which is not there, or null.

    The rows meet just the keys that are missing, in a join that spreads hot ones.
    """
    columns, flags = rows.columns, []
    for i, (column, keys) in enumerate(missing.items()):
        rows = left_join(rows, keys.withColumn(f"_lacks{i}", F.lit(column)), column)
        flags.append(F.col(f"_lacks{i}"))
    found = F.concat_ws(",", *flags) if flags else F.lit("")
    return rows.select(*columns, F.nullif(found, F.lit("")).alias("lacking"))
