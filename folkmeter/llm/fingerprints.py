"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into pieces of paragraphs: at each line break, and after each word whose hash is a
multiple of ``PIECE_WORDS``, so that an edit changes only the pieces it touches. Each piece has a
64-bit digest, in which its occurrence number within the text is mixed. A digest is put in three
cells of the sketch, and a cell holds the number, the exclusive or of the digests and that of
their checks. Sketches of two versions subtract cell by cell; what both have cancels out, and
peeling (a cell with one digest gives it away, which empties two more) recovers the digests in
which they differ. If that gets stuck, both sides are sketched with twice the cells.

The likeness of two texts is the share of pieces that both have among all pieces of either.

Defined cases: a null text counts as empty; two texts without pieces have likeness 1; equal texts
have equal fingerprints; rows with one ``doc_id`` stand in the order of their texts, and a null id
stands first; the only row of a table is its own successor; an empty table gives no rows; other
columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folkmeter.llm import common

PIECE_WORDS = 4  # words of a piece, on average
CELLS = 8  # cells of each of the three tables of a first sketch
PARTS = 4  # ranges of documents per task
RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, n_pieces bigint"
)
_U = np.uint64
_SEEDS = common.mix(np.array([11, 12, 13], _U))
_CHECK = _U(0x5851F42D4C957F2D)


class Pieces:
    """Piece digests of the texts of a block, in the order of the rows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = common.Words(data, offsets)
        lines = np.concatenate([[0], np.cumsum(data == 10)])
        cut = common.mix(words.hash[:-1]) % _U(PIECE_WORDS) == 0
        cut |= lines[words.end[:-1]] != lines[words.start[1:]]
        cut &= words.doc[:-1] == words.doc[1:]
        begins = offsets[:-1][np.diff(offsets) > 0]
        start = np.union1d(begins, words.start[1:][cut])
        self.rows = len(offsets) - 1
        self.row = np.searchsorted(offsets, start, side="right") - 1
        end = np.minimum(np.append(start[1:], len(data)), offsets[self.row + 1])
        plain = common.span_hashes(common.BYTE_CODES[data], start, end) if len(start) else start.astype(_U)
        order = np.lexsort((plain, self.row))
        self.row, plain = self.row[order], plain[order]
        new = np.ones(len(plain), bool)
        new[1:] = (plain[1:] != plain[:-1]) | (self.row[1:] != self.row[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(plain)), 0)) if len(plain) else start
        self.key = common.mix(plain + (np.arange(len(plain)) - first).astype(_U) * _U(0x9E3779B97F4A7C15))
        self.at = np.searchsorted(self.row, np.arange(self.rows + 1))
        self.count = np.diff(self.at)

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Digests of chosen rows, and to which place in ``rows`` each belongs."""
        sizes = self.count[rows]
        place = np.repeat(np.arange(len(rows)), sizes)
        inner = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.key[self.at[rows][place] + inner], place


class Sketches:
    """One sketch per line: three tables of ``size`` cells."""

    def __init__(self, lines: int, size: int):
        self.lines, self.size = lines, size
        self.number = np.zeros(lines * 3 * size, np.int64)
        self.digest = np.zeros(lines * 3 * size, _U)
        self.check = np.zeros(lines * 3 * size, _U)

    def cells(self, key: np.ndarray, line: np.ndarray) -> np.ndarray:
        seeds = _SEEDS[:, None] ^ _U(self.size)
        inner = (common.mix(key[None, :] ^ seeds) % _U(self.size)).astype(np.int64)
        return (line * 3 * self.size)[None, :] + np.arange(3)[:, None] * self.size + inner

    def put(self, key: np.ndarray, line: np.ndarray, sign) -> None:
        if not len(key):
            return
        cell = self.cells(key, line).ravel()
        self.number += np.bincount(
            cell, np.broadcast_to(sign, (3, len(key))).ravel(), minlength=len(self.number)
        ).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        where = order % len(key)
        self.digest[cell[first]] ^= np.bitwise_xor.reduceat(key[where], first)
        self.check[cell[first]] ^= np.bitwise_xor.reduceat(common.mix(key ^ _CHECK)[where], first)

    def minus(self, rows: np.ndarray, other: "Sketches", others: np.ndarray) -> "Sketches":
        out = Sketches(len(rows), self.size)
        for name in ("number", "digest", "check"):
            a = getattr(self, name).reshape(self.lines, -1)[rows]
            b = getattr(other, name).reshape(other.lines, -1)[others]
            setattr(out, name, (a - b if name == "number" else a ^ b).ravel())
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Recovered digests, their lines and signs; and which lines came out empty."""
        keys, lines, signs = [], [], []
        while True:
            pure = np.flatnonzero(np.abs(self.number) == 1)
            pure = pure[self.check[pure] == common.mix(self.digest[pure] ^ _CHECK)]
            key, line, sign = self.digest[pure], pure // (3 * self.size), self.number[pure]
            order = np.lexsort((key, line))
            key, line, sign = key[order], line[order], sign[order]
            one = np.ones(len(key), bool)
            one[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1])
            key, line, sign = key[one], line[one], sign[one]
            if not len(key):
                break
            self.put(key, line, -sign)
            keys.append(key), lines.append(line), signs.append(sign)
        left = (self.number != 0) | (self.digest != 0)
        done = ~left.reshape(self.lines, -1).any(axis=1)
        empty = np.zeros(0, np.int64)
        return (
            np.concatenate([empty.astype(_U), *keys]),
            np.concatenate([empty, *lines]),
            np.concatenate([empty, *signs]),
            done,
        )

    def text(self) -> list[str]:
        """A string per sketch: numbers and digests of the cells."""
        number = self.number.reshape(self.lines, -1).astype("<u2")
        digest = self.digest.reshape(self.lines, -1).astype("<u8")
        return [n.tobytes().hex() + d.tobytes().hex() for n, d in zip(number, digest)]


def sketch(pieces: Pieces, size: int = CELLS) -> Sketches:
    out = Sketches(pieces.rows, size)
    out.put(pieces.key, pieces.row, 1)
    return out


def differences(
    a: Pieces, rows: np.ndarray, b: Pieces, others: np.ndarray, first: Sketches
) -> np.ndarray:
    """For each pair of rows the number of digests that only one of them has.

    ``first``: the subtracted first sketches. Pairs that do not peel are sketched larger.
    """
    out = np.zeros(len(rows), np.int64)
    todo, now = np.arange(len(rows)), first
    while True:
        _, line, _, done = now.peel()
        found = np.bincount(line, minlength=now.lines)
        out[todo[done]] = found[done]
        todo = todo[~done]
        if not len(todo):
            return out
        now = Sketches(len(todo), now.size * 2)
        now.put(*a.of(rows[todo]), 1)
        now.put(*b.of(others[todo]), -1)


def _likeness(n: np.ndarray, m: np.ndarray, differ: np.ndarray) -> np.ndarray:
    return np.where(n + m + differ > 0, (n + m - differ) / np.maximum(n + m + differ, 1), 1.0)


def edited(text: str, after: str) -> str:
    """``text`` with its last quarter replaced by the beginning of the next text."""
    n = len(text) // 4
    return text[: len(text) - n] + after[:n]


def _results(ids: list, own: list[int], texts: list[str]) -> pa.RecordBatch:
    """``own``: places in ``texts`` of the documents; the next place holds the next document."""
    changed = [edited(texts[i], texts[i + 1]) for i in own]
    a = Pieces(*common.utf8(pa.array(texts, pa.large_string())))
    b = Pieces(*common.utf8(pa.array(changed, pa.large_string())))
    one, two, rows = sketch(a), sketch(b), np.array(own, np.int64)
    to = np.arange(len(own))
    near_edited = differences(a, rows, b, to, one.minus(rows, two, to))
    near_next = differences(a, rows, a, rows + 1, one.minus(rows, one, rows + 1))
    said = one.text()
    n = a.count[rows]
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(ids, pa.int64()),
            "n_chars": pa.array([len(texts[i]) for i in own], pa.int64()),
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            "fingerprint": [f"{k:x}-{said[i]}" for k, i in zip(n, own)],
            "edited_fingerprint": [f"{k:x}-{s}" for k, s in zip(b.count, two.text())],
            "near_edited": pa.array(_likeness(n, b.count, near_edited)),
            "near_next": pa.array(_likeness(n, a.count[rows + 1], near_next)),
            "n_pieces": pa.array(n, pa.int64()),
        }
    )


def _walk(batches: Iterator[pa.RecordBatch]):
    """Rows in order of (part, wrap, id, text). Every row but those of ``wrap`` is a document, and
    the row after it, in the same part, is the next document."""
    ids: list = []
    own: list[int] = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "_wrap"))
        for doc_id, text, wrap in zip(*columns):
            texts.append(text or "")
            if size > common.BLOCK_BYTES and own:
                yield _results(ids, own, texts)
                ids, own, texts, size = [], [], texts[-1:], 0
            if not wrap:
                ids.append(doc_id)
                own.append(len(texts) - 1)
            size += len(texts[-1])
    if own:
        yield _results(ids, own, texts)


def compare(docs: DataFrame) -> DataFrame:
    """RESULT for the documents (doc_id, text), each against its edited text and its successor.

    The texts are shuffled once, into ranges of ``doc_id``. The first document of each range also
    goes to the end of the range before it, and the very first one to the end of the last range.
    Ranges lie at approximate quantiles of the ids; the driver holds a number per range.
    """
    lowest = -(1 << 63)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(lowest)).alias("_key"),
    )
    n = tasks * PARTS
    marks = F.lit([i / n for i in range(1, n)])
    cuts = keyed.agg(F.array_distinct(F.percentile_approx("_key", marks, 10 * n))).first()[0] or []
    if cuts:
        part = F.size(F.filter(F.lit(cuts), lambda c: c < F.col("_key")))
    else:
        part = F.lit(0)
    parted = keyed.withColumn("_part", part)
    firsts = parted.groupBy("_part").agg(F.min("_key").alias("k")).orderBy("_part").collect()
    if not firsts:
        return docs.sparkSession.createDataFrame([], RESULT)
    full = len(cuts) + 1
    first, before = [None] * full, [None] * full
    for i, row in enumerate(firsts):
        first[row["_part"]] = row["k"]
        before[row["_part"]] = firsts[i - 1]["_part"]  # of the first range: the last one
    at = F.col("_part") + 1
    leads = F.element_at(F.lit(first), at) == F.col("_key")
    here = F.struct(F.col("_part").alias("part"), F.lit(0).alias("wrap"))
    there = F.struct(F.element_at(F.lit(before), at).alias("part"), F.lit(1).alias("wrap"))
    goes = F.when(leads, F.array(here, there)).otherwise(F.array(here))
    dealt = parted.select("doc_id", "text", "_key", F.explode(goes).alias("_to"))
    dealt = dealt.select("doc_id", "text", "_key", "_to.part", F.col("_to.wrap").alias("_wrap"))
    ordered = dealt.repartition(tasks, "part").sortWithinPartitions("part", "_wrap", "_key", "text")
    return ordered.select("doc_id", "text", "_wrap").mapInArrow(_walk, RESULT)
