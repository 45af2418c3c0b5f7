"""The stages of the corpus pipeline: tables with the columns of ``documents``.

What holds for each of them: a null text counts as empty and texts are worked on whole, whatever
their length; rows may repeat and share a ``doc_id``; nulls in other columns pass; an empty table
gives an empty table with the same columns; further columns pass unchanged, whatever their names,
but for the last stage, which returns its results alone. ``n_chars``, where there is one, follows
the text that a stage leaves.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folkmeter.llm import bpe, common, decontaminate, near_duplicates, suffix_dedup
from folkmeter.llm import quality as scores


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.length(F.coalesce(F.col("text"), F.lit(""))).cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", length)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.5 or more.

    Empty texts are scored as any other; equal texts have equal scores, so copies go or stay
    together; scores of exactly 0.5 stay.
    """
    found = common.stored(scores.features(docs.select("doc_id", "text")), "statistics")
    model = scores.fit(found, common.table(spark, sf_dir, "labels"))
    return scores.keep_good(docs, model)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document of the least id.

    Texts without words are alike only if they are equal, null counting as empty. Of rows that
    repeat one stays; a null ``doc_id`` is the least only where a class has no other.
    """
    return near_duplicates.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; of strings of 100 bytes that came before, the later ones are cut out.

    Before means a smaller ``doc_id``, or an earlier start in the same document. A character
    goes only if all its bytes do; texts below 100 bytes stay as they are; a null text stays null
    or empty.
    """
    return _counted(suffix_dedup.clean(docs))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that hold little else go.

    Items that are null or without words hit nothing; with an empty benchmark all documents stay
    as they are. A document goes if more than four fifths of its words are hit.
    """
    return _counted(decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of the kept texts, with the digests of the ids and of the bytes decoded from them.

    One row per document with ``doc_id`` and the results; the other columns of ``documents`` end
    here. An empty text has no ids.
    """
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN, ids="ids")
