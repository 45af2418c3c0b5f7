"""Keyed tables as Parquet folders, one folder per load.

Every row says which load brought it in plain columns: ``writer`` and ``batch`` name the load,
``loaded_at`` is the time at which it was first written. Readers settle a key by its latest load,
with a window over these columns. Writing a load again replaces its folder and keeps its time, so
a repeated load changes nothing, and writers do not touch each other's folders. Loads of one
table that are written at the same moment by clocks that differ are in the order of the clocks.

There are no transactions here: a reader beside a load that is written again, or a table whose
loads are to be folded while others write, needs a table format that has them.
"""

from __future__ import annotations

import re
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folkmeter import schemas
from folkmeter.operators.relational import keep_last
from folkmeter.sources.tables import path_exists, write_counted

WRITER = "load"
MARKS = ["writer", "batch", "loaded_at"]


def _schema(table: str, *more: T.StructField) -> T.StructType:
    fields = schemas.nullable(schemas.TABLES[table]).fields
    kinds = (T.StringType(), T.LongType(), T.TimestampType())
    return T.StructType([*fields, *more, *[T.StructField(n, k) for n, k in zip(MARKS, kinds)]])


def _of_load(writer: str, number: int) -> Column:
    return (F.col("writer") == writer) & (F.col("batch") == number)


def checked_writer(writer: str) -> str:
    if not re.fullmatch(r"[\w.\-]+", writer):
        raise ValueError(f"not a name of a writer: {writer!r}")
    return writer


def load_folder(root: str, table: str, number: int, writer: str) -> str:
    return f"{root}/{table}/load={checked_writer(writer)}-{number}"


def _rows(
    spark: SparkSession, folder: str, schema: T.StructType, without: tuple[str, int] | None = None
) -> DataFrame:
    """All rows, or those of all other loads. The folder of a load that is left out is not read,
    so it can be written again from what is read here."""
    if not path_exists(spark, folder):
        return schemas.no_rows(spark, schema)
    rows = spark.read.schema(schema).parquet(folder)
    if without is not None:
        writer, number = without
        rows = rows.filter((F.col("load") != f"{writer}-{number}") & ~_of_load(writer, number))
    return rows.select(*schema.fieldNames())


def marked(df: DataFrame, root: str, table: str, number: int, writer: str) -> DataFrame:
    """``df`` with the marks of its load; the time is that of the first writing, if there was one."""
    spark = df.sparkSession
    known = _rows(spark, f"{root}/{table}", _schema(table)).filter(_of_load(writer, number))
    first = known.agg(F.min(F.unix_micros("loaded_at"))).first()[0]
    micros = time.time_ns() // 1000 if first is None else first
    marks = (F.lit(writer), F.lit(number).cast("bigint"), F.timestamp_micros(F.lit(micros)))
    return df.withColumns(dict(zip(MARKS, marks)))


def append_batch(df: DataFrame, root: str, table: str, number: int, writer: str = WRITER) -> int:
    """Write load ``number`` of ``writer``; writing it again replaces it. Ids are digests, which zstd
    halves and the default codec does not."""
    folder = load_folder(root, table, number, writer)
    rows = marked(df.select(*schemas.TABLES[table].fieldNames()), root, table, number, writer)
    return write_counted(rows, folder, compression="zstd")["rows"]


def read_current(
    spark: SparkSession, root: str, table: str, without: tuple[str, int] | None = None
) -> DataFrame:
    """The latest row of each key; ``without`` leaves out one load (writer, number), for that load
    to be worked out anew."""
    return _settled(spark, root, table, without).drop(*MARKS)


def known_keys(
    spark: SparkSession, root: str, table: str, without: tuple[str, int] | None = None
) -> DataFrame:
    """The keys that are stored, one row per load that holds them: nothing is settled for them."""
    rows = _rows(spark, f"{root}/{table}", _schema(table), without)
    return rows.select(*schemas.PRIMARY_KEYS[table])


def _settled(spark: SparkSession, root: str, table: str, without: tuple[str, int] | None) -> DataFrame:
    rows = _rows(spark, f"{root}/{table}", _schema(table), without)
    return keep_last(rows, schemas.PRIMARY_KEYS[table], ["loaded_at", "writer", "batch"])


def write_settled(spark: SparkSession, root: str, table: str, target: str) -> int:
    """The latest rows, with the marks of their loads, as the one folder of a new place."""
    folder = load_folder(target, table, 0, "settled")
    return write_counted(_settled(spark, root, table, None), folder)["rows"]


def read_all(
    spark: SparkSession, root: str, without: tuple[str, int] | None = None
) -> dict[str, DataFrame]:
    return {name: read_current(spark, root, name, without) for name in schemas.TABLES}


# --- rows that wait for their parents -----------------------------------------------

LACKING = T.StructField("lacking", T.StringType())


def set_aside(orphans: DataFrame, root: str, table: str, number: int, writer: str) -> int:
    """Write the rows of a load that lack a parent, with the columns that name none (``lacking``)."""
    folder = load_folder(f"{root}/_orphans", table, number, writer)
    columns = [*schemas.TABLES[table].fieldNames(), "lacking"]
    return write_counted(marked(orphans.select(*columns), root, table, number, writer), folder)["rows"]


def waiting(
    spark: SparkSession, root: str, table: str, stored: DataFrame, without: tuple[str, int] | None = None
) -> DataFrame:
    """Rows that were set aside and are not stored since, the latest of each key, with ``lacking``."""
    rows = _rows(spark, f"{root}/_orphans/{table}", _schema(table, LACKING), without)
    keys = schemas.PRIMARY_KEYS[table]
    latest = keep_last(rows, keys, ["loaded_at", "writer", "batch"]).drop(*MARKS)
    return latest.join(stored.select(*keys), keys, "left_anti").select(*rows.drop(*MARKS).columns)


def stored_counts(spark: SparkSession, root: str) -> DataFrame:
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows")
        for n, df in read_all(spark, root).items()
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
