"""Harmonic packing of token sequences.

Pieces of documents are put in classes by reciprocals of the capacity: a piece of n ids is in
class ``capacity // n``, and a bin of class j holds exactly j pieces. A worker fills the bins of
each class by counting, without asking any other worker and without looking at what other bins
have left: a bin is closed when it has its number.

Since documents may be cut, they are cut so that the classes are tight: as many whole bins as a
document has, then from the rest one piece each of a half, a quarter, ... of the capacity down to
``LEAST`` ids, where it is large enough, and a last piece below ``LEAST``. Only bins of last
pieces have room left, less than one piece of theirs. No document has more than
``capacity / LEAST``'s binary digits of such pieces besides its whole bins.

The bins that a worker leaves open hold less than a bin per class. Groups of ``FAN`` workers hand
theirs to one of the next round, which fills them in the same way, until one task has what is
left: less than one bin per class, whatever the input. There the open bins are laid end to end
and cut at the capacity, so that a single sequence is not full.

Encoding happens once; each round is stored, and rows of closed bins are never moved again.
Names of sequences hold round, worker and number, so no two workers make the same one.

Defined cases: a null text counts as empty and consists of the end id; texts are encoded whole;
documents that share a ``doc_id`` are packed each; a null ``doc_id`` stays null; an empty table
gives no rows; other columns are not carried, whatever their names.
"""

from __future__ import annotations

import json
import os
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folkmeter.llm import common

CAPACITY = 1024
LEAST = 32  # shorter rests are not cut further
FAN = 32  # workers whose open bins go to one of the next round
FLUSH_BYTES = 4 << 20  # ids kept before rows are handed on
ID_BYTES = 4  # ids are little-endian unsigned 32-bit integers
LEFT_OPEN = -1  # sequence of a piece in an open bin

PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
STORED = PIECES + ", worker int"

#: Fixed value: the pattern by which byte-level pre-tokenizers split text.
BYTE_LEVEL_PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes for
    themselves, the others in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


def _ranked(path: str):
    """The vocabulary as a rank table with its special tokens, or None where that is not the same.

    It is the same if the tokenizer is byte-level BPE with the usual pattern and nothing before or
    after it, and its ids are in the order of its merges.
    """
    with open(path, encoding="utf-8") as lines:
        spec = json.load(lines)
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    vocab = model.get("vocab", {})
    added = spec["added_tokens"]
    same = (
        model.get("type") == "BPE"
        and spec["normalizer"] is None
        and cut.get("type") == "ByteLevel"
        and cut.get("use_regex")
        and not cut.get("add_prefix_space")
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        and [vocab.get(a + b) for a, b in pairs] == list(range(len(vocab) - len(pairs), len(vocab)))
        and len(vocab) - len(pairs) == 256
    )
    if not same:
        return None
    byte = _byte_letters()
    ranks = {bytes(byte[c] for c in token): rank for token, rank in vocab.items()}
    return ranks, {t["content"]: t["id"] for t in added}


class Encoder:
    """The ids that the tokenizers library gives for a file, without begin or end tokens.

    Where the file amounts to a rank table, tiktoken does the merges, which is faster; texts that
    its pattern engine refuses, such as a million blanks, go to the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        found, self.fast = _ranked(path), None
        if found is not None:
            import tiktoken

            self.fast = tiktoken.Encoding(
                "own", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=found[0], special_tokens=found[1]
            )

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # the pattern engine ran out of stack
                pass
        found = self.tool.encode(text, add_special_tokens=False)
        return np.array(found.ids, np.uint32)


def encoder(path: str) -> Encoder:
    return common.resident(("packing", path), lambda: Encoder(path))


def cuts(n: int, capacity: int = CAPACITY, least: int = LEAST) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    out = [(at, capacity) for at in range(0, n - capacity + 1, capacity)]
    at, size = n - n % capacity, capacity // 2
    while size >= least:
        if n - at >= size:
            out.append((at, size))
            at += size
        size //= 2
    if at < n:
        out.append((at, n - at))
    return out


class Bins:
    """The bins of one worker: pieces in, rows of closed bins out."""

    def __init__(self, level: int, worker: int, capacity: int):
        self.worker, self.capacity = worker, capacity
        self.next = (level << 56) | (worker << 32)
        self.open: dict[int, list[tuple]] = defaultdict(list)
        self.columns: list[list] = [[] for _ in range(7)]
        self.bytes = 0

    def put(self, doc_id, start: int, length: int, ids: bytes, doc_tokens: int) -> None:
        j = self.capacity // length
        held = self.open[j]
        held.append((doc_id, start, length, ids, doc_tokens))
        if len(held) == j:
            self.close(held)
            held.clear()

    def close(self, pieces: list[tuple]) -> None:
        """One sequence of these pieces."""
        at = 0
        for piece in pieces:
            self.row(piece, self.next, at)
            at += piece[2]
        self.next += 1

    def row(self, piece: tuple, sequence: int, at: int) -> None:
        for column, value in zip(self.columns, (*piece, sequence, at)):
            column.append(value)
        self.bytes += len(piece[3]) + 64

    def leave(self) -> None:
        """Pieces of open bins become rows without a sequence."""
        for pieces in self.open.values():
            for piece in pieces:
                self.row(piece, LEFT_OPEN, 0)
        self.open.clear()

    def join(self) -> None:
        """Open bins end to end, cut at the capacity."""
        room, held = self.capacity, []
        for _, pieces in sorted(self.open.items()):
            for doc_id, start, length, ids, doc_tokens in pieces:
                while length:
                    n = min(length, room)
                    held.append((doc_id, start, n, ids[: n * ID_BYTES], doc_tokens))
                    start, length, ids, room = start + n, length - n, ids[n * ID_BYTES :], room - n
                    if not room:
                        self.close(held)
                        room, held = self.capacity, []
        if held:
            self.close(held)
        self.open.clear()

    def flush(self) -> pa.RecordBatch:
        kinds = [pa.binary() if i == 3 else pa.int64() for i in range(7)]
        arrays = [pa.array(c, k) for c, k in zip(self.columns, kinds)]
        arrays.append(pa.array([self.worker] * len(arrays[0]), pa.int32()))
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "worker"]
        self.columns, self.bytes = [[] for _ in range(7)], 0
        return pa.RecordBatch.from_arrays(arrays, names=names)


def _encoded(batches: Iterator[pa.RecordBatch], path: str, end: int, capacity: int, least: int):
    """First round: documents in, rows of closed and open bins out."""
    tool, bins = encoder(path), Bins(0, TaskContext.get().partitionId(), capacity)
    for batch, *_ in common.blocks(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids = np.append(tool.encode(text) if text else np.zeros(0, np.uint32), np.uint32(end))
            raw, n = ids.astype("<u4").tobytes(), len(ids)
            for start, length in cuts(n, capacity, least):
                piece = raw[start * ID_BYTES : (start + length) * ID_BYTES]
                bins.put(doc_id, start, length, piece, n)
            if bins.bytes > FLUSH_BYTES:
                yield bins.flush()
    bins.leave()
    yield bins.flush()


def _refilled(batches: Iterator[pa.RecordBatch], level: int, capacity: int, last: bool):
    """A later round: what workers of the round before left open."""
    bins = Bins(level, TaskContext.get().partitionId(), capacity)
    names = ["doc_id", "start", "length", "ids", "doc_tokens"]
    for batch in batches:
        for piece in zip(*(batch.column(n).to_pylist() for n in names)):
            bins.put(*piece)
        if bins.bytes > FLUSH_BYTES:
            yield bins.flush()
    (bins.join if last else bins.leave)()
    yield bins.flush()


def _round(rows: DataFrame, fill: Callable, kind: str) -> DataFrame:
    return common.stored(rows.mapInArrow(fill, STORED), kind)


def pack(
    docs: DataFrame, path: str, end: int, capacity: int = CAPACITY, least: int = LEAST
) -> DataFrame:
    """Pieces with their ids (little-endian unsigned 32-bit) and their places in sequences."""
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = _round(own, lambda it: _encoded(it, path, end, capacity, least), "pieces")
    closed = F.col("sequence_id") != LEFT_OPEN
    out, level = rows.filter(closed), 0
    workers = (rows.agg(F.max("worker")).first()[0] or 0) + 1
    while True:
        workers, level = -(-workers // FAN), level + 1
        last = workers == 1
        left = rows.filter(~closed).repartition(workers, "worker") if not last else rows.filter(~closed).coalesce(1)
        left = left.sortWithinPartitions("worker", "doc_id", "start")
        rows = _round(left, lambda it, n=level, e=last: _refilled(it, n, capacity, e), "left")
        out = out.unionByName(rows.filter(closed))
        if last:
            return out.drop("worker")


def padding(filled, capacity: int = CAPACITY):
    """Column of the places that a sequence of ``filled`` ids pads: none at a power of two."""
    power = F.bit_count(filled) == 1
    return F.when(power, 0).otherwise(F.lit(capacity) - filled)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: its ids, the place in its document of each piece, and its padding.

    A sequence has at most as many pieces as its capacity, so none is large.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    grouped = pieces.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("length"))
    joined = F.aggregate("parts.ids", F.lit(b""), lambda a, b: F.concat(a, b))
    return grouped.select(
        "sequence_id",
        "length",
        joined.alias("ids"),
        F.transform("parts", lambda p: p.dropFields("ids")).alias("pieces"),
        padding(F.col("length")).alias("padding"),
    )
