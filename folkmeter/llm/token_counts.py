"""Token counts through a cache of digests.

The content of a text is normalised to the form in which the tokenizer sees it, as far as that is
known to leave the count alone: null becomes empty, and a space becomes the mark that the
tokenizer puts in its place. Its SHA-256 digest and the digest of the tokenizer file are the key
of the stored count. Only distinct contents without a stored count are encoded, and their counts
are appended to the cache, a Parquet folder partitioned by tokenizer. A rerun after a failure
finds what was appended before; counts that two runs append twice are read as one.

Defined cases: a null text counts as empty and has no tokens; repeated rows and equal texts each
get the count; texts are encoded whole, whatever their length; other columns pass unchanged
unless they bear the name of a result column, which then replaces them; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folkmeter.llm import common
from folkmeter.sources.tables import path_exists

LIMIT = 4096
SPACE_MARK = "▁"  # what a piece model writes for a space
CACHE = T.StructType(
    [
        T.StructField("content", T.BinaryType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("tokenizer", T.StringType()),
    ]
)


def version(model: str) -> str:
    with open(model, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def content_digest(text: str) -> Column:
    seen = F.replace(F.coalesce(F.col(text), F.lit("")), F.lit(" "), F.lit(SPACE_MARK))
    return F.unhex(F.sha2(seen, 256))


def stored_counts(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """(content, n_tokens) of one tokenizer; a cache that is not there yet is empty."""
    there = path_exists(spark, cache)
    rows = spark.read.schema(CACHE).parquet(cache) if there else spark.createDataFrame([], CACHE)
    rows = rows.filter(F.col("tokenizer") == tokenizer)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def _model(path: str):
    import sentencepiece

    make = sentencepiece.SentencePieceProcessor
    return common.resident(("pieces", path), lambda: make(model_file=path))


def _encode(batches: Iterator[pa.RecordBatch], model: str, tokenizer: str):
    tool = _model(model)
    for batch, *_ in common.blocks(batches):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        counts = [len(ids) for ids in tool.encode(texts, num_threads=1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("content"), pa.array(counts, pa.int64()), pa.array([tokenizer] * len(counts))],
            names=CACHE.names,
        )


def fill(docs: DataFrame, model: str, cache: str, text: str = "text") -> None:
    """Encode the distinct contents of ``docs`` without a stored count and append the counts.

    Equal contents are reduced to one before the shuffle, so a content that fills a third of the
    table moves once per task.
    """
    tokenizer = version(model)
    known = stored_counts(docs.sparkSession, cache, tokenizer).select("content")
    asked = docs.select(content_digest(text).alias("content"), F.col(text).alias("text"))
    misses = asked.dropDuplicates(["content"]).join(known, "content", "left_anti")
    counted = misses.mapInArrow(lambda it: _encode(it, model, tokenizer), CACHE)
    counted.write.mode("append").partitionBy("tokenizer").parquet(cache)


def count(
    docs: DataFrame, model: str, cache: str, text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """``docs`` without the text, with n_bytes, n_tokens and over_limit, by way of the cache."""
    fill(docs, model, cache, text)
    counts = stored_counts(docs.sparkSession, cache, version(model))
    own = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens", "over_limit")]
    asked = docs.select(
        *own,
        F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint").alias("n_bytes"),
        content_digest(text).alias("_content"),
    )
    counts = counts.withColumnRenamed("content", "_content")
    return asked.join(counts, "_content", "left").select(
        *own, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
