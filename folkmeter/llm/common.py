"""What the document operators share: reading, stored steps, byte blocks, word hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from folkmeter.session import shared_dir

BLOCK_BYTES = 1 << 20  # text handled at once inside a task
BATCH_ROWS = 2_000  # rows sent to Python at once


def bounded_batches(spark: SparkSession) -> None:
    """Rows are whole texts here: fewer of them at once on the way to Python than by default."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


_tools: dict = {}


def resident(key, make):
    """A large tool that a Python worker keeps between tasks; only the last one stays."""
    if key not in _tools:
        _tools.clear()
        _tools[key] = make()
    return _tools[key]


def release() -> None:
    """For tasks that need no such tool."""
    _tools.clear()


def unused(columns: list[str], *names: str) -> list[str]:
    """``names`` with as many underscores before them as no column of a table has."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/llm-{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, kind: str = "step") -> DataFrame:
    """``df`` as a Parquet table in the shared folder: survives the loss of executors."""
    bounded_batches(df.sparkSession)
    folder = new_folder(df.sparkSession, kind)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and the offsets of each; null is empty."""
    raw = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(raw) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = raw.buffers()
    at = np.frombuffer(ends, np.int64)[raw.offset : raw.offset + len(raw) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def blocks(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut into runs of rows of about ``limit`` bytes of text; a row is never cut."""
    for batch in batches:
        data, at = utf8(batch.column(batch.schema.get_field_index(text)))
        low, n = 0, len(at) - 1
        while low < n:
            high = max(low + 1, int(np.searchsorted(at, at[low] + limit, side="right")) - 1)
            yield batch.slice(low, high - low), data[at[low] : at[high]], at[low : high + 1] - at[low]
            low = high


# ---- hashes -----------------------------------------------------------------------------

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(33)
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


BYTE_CODES = mix(np.arange(1, 257, dtype=_U))


def _power_table(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, BLOCK_BYTES + 4096)
        known = np.full(size, base, _U)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _powers[base] = known
    return known[:n]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``codes[start:end]``, equal for equal spans wherever they stand."""
    sums = np.zeros(len(codes) + 1, _U)
    np.cumsum(codes * _power_table(_BASE, len(codes)), out=sums[1:])
    part = (sums[ends] - sums[starts]) * _power_table(_INVERSE, len(codes) + 1)[starts]
    return mix(part ^ (ends - starts).astype(_U))


def _word_table() -> np.ndarray:
    """Byte to its lower-case form when it is part of a word, else 0."""
    out = np.zeros(256, np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        out[low : high + 1] = np.arange(low, high + 1)
    out[0x41:0x5B] = np.arange(0x61, 0x7B)
    return out


WORD_BYTES = _word_table()
_WORD_CODES = np.where(WORD_BYTES > 0, BYTE_CODES[WORD_BYTES], _U(0))


class Words:
    """The words of a block: ASCII digits and letters (lower-cased) and all other than ASCII.

    ``start``, ``end``: byte places; ``doc``: row of the block; ``hash``: 64 bits;
    ``first``: for each row (and once more at the end) the number of its first word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = WORD_BYTES[data] > 0
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.empty(len(data) + 1, bool)
        before[0], before[1:] = False, inside
        after = np.empty(len(data) + 1, bool)
        after[-1], after[:-1] = False, inside
        self.start = np.flatnonzero(after & (~before | edge))
        self.end = np.flatnonzero(before & (~after | edge))
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        self.first = np.searchsorted(self.start, offsets)
        self.hash = (
            span_hashes(_WORD_CODES[data], self.start, self.end)
            if len(self.start)
            else np.zeros(0, _U)
        )
