"""Micro-batch ingestion: landed files -> entities -> loads of the stored tables."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folkmeter import schemas
from folkmeter.operators.relational import keep_last
from folkmeter.sources import store

LANDED = "kind string, name string, id_post string, body string"


def each_batch(
    source: DataFrame, checkpoint: str, write: Callable[[DataFrame, int, str], None]
) -> StreamingQuery:
    """Run ``write(batch, number, writer)`` for each micro-batch of what has landed by now.

    The writer is the stream as its checkpoint knows it, the number that of the micro-batch: a
    replayed micro-batch is the same load, and a stream with a new checkpoint is a new writer.
    """
    known = threading.Event()
    stream: list[str] = []

    def run(batch: DataFrame, number: int) -> None:
        known.wait()
        write(batch, number, f"stream-{stream[0]}")

    query = (
        source.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.append(str(query.id))
    known.set()
    return query


def upsert_stream(
    source: DataFrame,
    root: str,
    table: str,
    checkpoint: str,
    to_rows: Callable[[DataFrame], DataFrame] = lambda df: df,
    order_by: list[str] | None = None,
) -> StreamingQuery:
    """Upsert the rows of a stream into ``table``, each micro-batch as one load."""

    def write(batch: DataFrame, number: int, writer: str) -> None:
        latest = keep_last(to_rows(batch), schemas.PRIMARY_KEYS[table], order_by)
        store.append_batch(latest, root, table, number, writer)

    return each_batch(source, checkpoint, write)


def landed_files(
    spark: SparkSession, folder: str, schema: str, kind: str = "json", per_batch: int | None = None, **options
) -> DataFrame:
    """Stream over files that land in ``folder``."""
    reader = spark.readStream.format(kind).schema(schema).options(**options)
    if per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(folder)


def profile_stream(
    spark: SparkSession, folder: str, root: str, checkpoint: str, scraped_at: Column
) -> StreamingQuery:
    """Landed profile payloads (name, body) -> users."""
    from folkmeter.sources.payloads import profile_rows

    source = landed_files(spark, folder, "name string, body string")
    return upsert_stream(
        source, root, "users", checkpoint, lambda df: profile_rows(df, scraped_at)
    )


def payload_stream(
    source: DataFrame, root: str, checkpoint: str, scraped_at: Column, **limits
) -> StreamingQuery:
    """Landed payloads of all kinds -> users, communities, memberships, posts and comments.

    ``source`` is a stream of ``LANDED`` rows, ``kind`` being community, post or profile. Each
    micro-batch goes through the same job as a batch load: authors and communities are resolved
    by a join of the stream with the stored tables as they are without this load, rows that lack a
    parent wait for it, and all tables of the batch are written under (writer, batch). So a
    replayed micro-batch finds what it found the first time and replaces itself.

    Payloads are not kept in memory, where they would crowd out the tasks of the load: each kind
    reads its own out of the source, and the job stores the rows it takes from them.
    """
    from folkmeter.plans import jobs

    def write(batch: DataFrame, number: int, writer: str) -> None:
        parts = {
            "communities": batch.filter("kind = 'community'").select("name", "body"),
            "posts": batch.filter("kind = 'post'").select("id_post", "body"),
            "profiles": batch.filter("kind = 'profile'").select("name", "body"),
        }
        jobs.ingest(batch.sparkSession, root, number, scraped_at, writer, **parts, **limits)

    return each_batch(source.select(*[F.col(c) for c in ("kind", "name", "id_post", "body")]), checkpoint, write)
