"""Table scans and sinks: Parquet layers, JDBC, fallbacks, counted writes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from folkmeter import schemas

SILVER = ("users", "posts", "comments", "communities")


def jdbc_options(
    url: str,
    table: str,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    **properties: str,
) -> dict[str, str]:
    """Reader options; a numeric ``split_on`` column lets the executors read in parallel."""
    options = {"url": url, "dbtable": table, "fetchsize": "10000", **properties}
    if split_on and bounds:
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """A database table; Spark pushes its filters and column list to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()


def write_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 1000, **properties) -> None:
    options = jdbc_options(url, table, batchsize=str(batch_rows), **properties)
    df.write.format("jdbc").options(**options).mode("append").save()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Works for every file system Spark can read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored table with its declared schema; a missing one is empty, not broken."""
    path = f"{folder}/{name}"
    if not path_exists(spark, path):
        return schemas.empty_table(spark, name)
    return spark.read.schema(schemas.nullable(schemas.TABLES[name])).parquet(path)


def read_silver(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, folder, name) for name in SILVER}


def read_required(spark: SparkSession, path: str) -> DataFrame:
    """A table that must exist, such as the user features before training."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no table at {path}; build the gold layer first")
    return spark.read.parquet(path)


def first_available(*readers: Callable[[], DataFrame]) -> DataFrame:
    """The first source that can be opened, for example a database, then the silver layer."""
    failures = []
    for reader in readers:
        try:
            return reader()
        except Exception as error:  # any source may fail in its own way
            failures.append(f"{type(error).__name__}: {str(error).splitlines()[0]}")
    raise RuntimeError("no source available: " + "; ".join(failures))


def write_counted(df: DataFrame, path: str, **options) -> dict[str, int]:
    """Write Parquet; the row count is observed during the write, without a second scan."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").options(**options).parquet(path)
    return {"rows": seen.get["rows"], "columns": len(df.columns)}


def layer_status(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """Rows (table, rows, files); a table that is not stored has 0 rows in 0 files."""
    parts = []
    for name, path in folders.items():
        if not path_exists(spark, path):
            nothing = [(name, 0, 0)]
            parts.append(spark.createDataFrame(nothing, "table_name string, rows bigint, files bigint"))
            continue
        parts.append(
            spark.read.parquet(path)
            .select(F.col("_metadata.file_path").alias("file"))
            .groupBy("file")
            .count()
            .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows"), F.count("*").alias("files"))
            .select(F.lit(name).alias("table_name"), "rows", "files")
        )
    if not parts:
        return spark.createDataFrame([], "table_name string, rows bigint, files bigint")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
