"""Session set-up and the one place that decides where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def get_session(app_name: str = "folkmeter", **conf) -> SparkSession:
    """Create or reuse a session; cluster sizing is left to the submitter."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Rows here are whole web pages: keep the batches handed to Python small.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
        # Call sites of every column expression cost more than planning itself.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The reliable folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="folkmeter-"))
    return context.getCheckpointDir()


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def step_folder(spark: SparkSession) -> str:
    """A new folder for a stored step: of the run that is going on, or of the session."""
    return f"{_run_folder.get() or shared_dir(spark)}/folkmeter-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession):
    """Stored steps of this block go when it ends: only for work that leaves its results elsewhere."""
    folder = f"{shared_dir(spark)}/folkmeter-run-{uuid.uuid4().hex}"
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """What a query of this block has shuffled goes when the query ends, not when the driver happens
    to collect its garbage: for rows of about the size of the input that are shuffled step by step."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def cut_lineage(df: DataFrame, **options: str) -> DataFrame:
    """Store ``df`` where all executors see it, so that iterations do not grow the plan.

    Parquet, so that later steps read only their columns and the optimizer knows the size;
    ``options`` are those of the writer.
    """
    folder = step_folder(df.sparkSession)
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def stored_once(df: DataFrame) -> DataFrame:
    """``df``, stored if working it out takes more than reading its rows, for several readers."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    costly = any(name in plan for name in ("Join", "Aggregate", "Window", "Sort", "MapIn"))
    return cut_lineage(df) if costly else df


@contextmanager
def persisted(*frames: DataFrame):
    """Keep frames that several actions read, and let go of them in any case."""
    for frame in frames:
        frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield frames
    finally:
        for frame in frames:
            frame.unpersist()
