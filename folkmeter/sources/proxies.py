"""The five entity tables read out of the test star schema.

The same rules stand as SQL in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str):
    return F.col(column).cast("string")


def _day(column: str):
    return F.col(column).cast("date").cast("string")


def _stamp(column: str):
    return F.concat(_day(column), F.lit("T00:00:00"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("id_user"),
        F.col("c_name").alias("name"),
        F.floor("c_acctbal").cast("bigint").alias("karma"),
        F.when(key % 7 == 0, None).when(key % 7 == 1, "").otherwise(segment).alias("description"),
        F.when(key % 3 != 0, segment).alias("human_owner"),
        F.lit(None).cast("string").alias("joined"),
        (key % 97).alias("followers"),
        (key % 13).alias("following"),
        F.lit("2024-01-01T00:00:00").alias("scraped_at"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("id_post"),
        _text("o_custkey").alias("id_user"),
        (F.col("o_custkey") % 30).cast("string").alias("id_community"),
        F.col("o_orderpriority").alias("title"),
        F.when(status == "P", "").otherwise(status).alias("description"),
        F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("rating"),
        _day("o_orderdate").alias("date"),
        _stamp("o_orderdate").alias("scraped_at"),
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("id_comment"),
        _text("l_partkey").alias("id_user"),
        _text("l_orderkey").alias("id_post"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("description"),
        F.floor("l_quantity").cast("bigint").alias("rating"),
        _day("l_shipdate").alias("date"),
        _stamp("l_shipdate").alias("scraped_at"),
    )


def communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        _text("n_nationkey").alias("id_community"),
        F.col("n_name").alias("name"),
        F.lit(None).cast("string").alias("description"),
        F.lit("2024-01-01T00:00:00").alias("scraped_at"),
    )
