"""Token ids in Arrow stream files of equal-length sequences.

The texts are put in ascending order of ``doc_id`` into ranges, one shard per range. A shard is
the stream of its ids, cut into sequences of ``length`` ids, with a mask that is false on the
padding of the last one. Its file is an Arrow stream whose batches hold two fixed-size lists, ids
and mask. All batches but the last have the same number of sequences and so the same size in
bytes: sequence i is found by a multiplication, and a mapped file gives it without a copy. A
second stream beside it holds, per document, the id, the first place and the number of ids.

Files get a name of their own in each attempt of a task, and only those that a finished task
reports stand in the manifest, so lost executors and repeated tasks do no harm.

Words between white space are encoded by the tokenizers library in lots, and kept in a cache of
bounded size: its normalisation, its split and its merges never reach across white space.

Defined cases: a null text counts as empty and consists of the end id alone; documents that share
a ``doc_id`` stand in the order of their texts, and a null ``doc_id`` stands first; an empty table
gives no rows; texts are encoded whole; other columns are not stored.
"""

from __future__ import annotations

import os
import re
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folkmeter.llm import common

LENGTH = 2048  # ids in a sequence
SEQUENCES = 128  # sequences in a batch
CACHE_WORDS = 700_000  # remembered words, per generation
MARKS = ".,;:!?"  # marks after a word
# Letters whose normal form is the letter itself and whose small form is one letter.
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+").fullmatch
# Bytes that the vocabulary does not write as the character of their number.
_UNSEEN = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
BYTE_SIGNS = {byte: 0x100 + i for i, byte in enumerate(_UNSEEN)}
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "part int, name string, n_tokens bigint, n_docs bigint"
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


class WordEncoder:
    """Ids of whole texts, by encoding each word between white space once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tool.get_vocab_size() <= 1 << 16 else "<u4")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        """A word of letters before closing marks is two matches of the tokenizer's pattern, which
        are encoded apart: so the forms of a word with and without marks are one to the library,
        as are those in capitals if they are ASCII."""
        young, old = self.young, self.old
        pairs = []
        for word in words:
            if word in old:
                young[word] = old[word]
                continue
            stem = word.rstrip(MARKS)
            mark = word[len(stem) :]
            if LATIN(stem):
                stem = stem.lower()
            elif not unicodedata.normalize("NFC", stem).lower().isalpha():
                stem, mark = word, ""  # its normal form has more than letters
            pairs.append((word, stem, mark))
        new = {x for _, *xs in pairs for x in xs} - young.keys()
        # All steps before the merges leave small Latin letters as they are, but for the signs of
        # their bytes.
        plain = {x for x in new if LATIN(x) and x == x.lower()}
        merges, kind = self.tool.model.tokenize, self.kind.char
        for word in plain:
            signs = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_SIGNS)
            young[word] = array(kind, [token.id for token in merges(signs)]).tobytes()
        rest = list(new - plain)
        for word, found in zip(rest, self.tool.encode_batch_fast(rest, add_special_tokens=False)):
            young[word] = array(self.kind.char, found.ids).tobytes()
        for word, stem, mark in pairs:
            young[word] = young[stem] + young[mark] if mark else young[stem]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text."""
        cut = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        missing: set[str] = set()
        for line in cut:
            missing.update(filterfalse(self.young.__contains__, line))
        if missing and len(self.young) + len(missing) > CACHE_WORDS:
            self.old, self.young, missing = self.young, {}, set().union(*cut)
        self._learn(missing)
        get = self.young.__getitem__
        return [b"".join(map(get, line)) for line in cut]


def encoder(path: str) -> WordEncoder:
    return common.resident(("words", path), lambda: WordEncoder(path))


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:") :]
    return pafs.FileSystem.from_uri(folder)


def _layout(kind: np.dtype, length: int) -> pa.Schema:
    ids = pa.from_numpy_dtype(kind)
    return pa.schema(
        [
            pa.field("ids", pa.list_(pa.field("item", ids, False), length), False),
            pa.field("mask", pa.list_(pa.field("item", pa.bool_(), False), length), False),
        ]
    )


def _batch(schema: pa.Schema, ids: np.ndarray, length: int) -> pa.RecordBatch:
    rows = -(-len(ids) // length)
    full = np.zeros(rows * length, ids.dtype)
    full[: len(ids)] = ids
    mask = np.arange(rows * length) < len(ids)
    columns = [
        pa.FixedSizeListArray.from_arrays(pa.array(values), type=field.type)
        for values, field in zip((full, mask), schema)
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _write(batches: Iterator[pa.RecordBatch], path: str, end: int, folder: str, length: int):
    tool, part = encoder(path), TaskContext.get().partitionId()
    files, top = _place(folder)
    name = f"shard-{part:06d}-{uuid.uuid4().hex}"
    schema, step = _layout(tool.kind, length), length * SEQUENCES
    tail = np.array([end], tool.kind).tobytes()
    total = docs = waiting = 0
    rest: list[bytes] = []
    ids = index = ids_file = index_file = None
    for batch, *_ in common.blocks(batches):
        if ids is None:
            files.create_dir(top, recursive=True)
            ids_file = files.open_output_stream(f"{top}/{name}.ids.arrows")
            index_file = files.open_output_stream(f"{top}/{name}.index.arrows")
            ids = pa.ipc.new_stream(ids_file, schema)
            index = pa.ipc.new_stream(index_file, INDEX)
        coded = [c + tail for c in tool.encode([t or "" for t in batch.column("text").to_pylist()])]
        sizes = np.array([len(c) // tool.kind.itemsize for c in coded], np.int64)
        starts = total + np.cumsum(sizes) - sizes
        index.write_batch(
            pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(starts), pa.array(sizes)],
                schema=INDEX,
            )
        )
        total, docs, waiting = total + int(sizes.sum()), docs + len(sizes), waiting + int(sizes.sum())
        rest += coded
        if waiting >= step:
            stream = np.frombuffer(b"".join(rest), tool.kind)
            for at in range(0, waiting - step + 1, step):
                ids.write_batch(_batch(schema, stream[at : at + step], length))
            left = stream[waiting - waiting % step :]
            rest, waiting = [left.tobytes()], len(left)
    if ids is None:
        return
    if waiting:
        ids.write_batch(_batch(schema, np.frombuffer(b"".join(rest), tool.kind), length))
    for writer in (ids, index, ids_file, index_file):
        writer.close()
    yield pa.RecordBatch.from_pydict(
        {
            "part": pa.array([part], pa.int32()),
            "name": [name],
            "n_tokens": pa.array([total], pa.int64()),
            "n_docs": pa.array([docs], pa.int64()),
        }
    )


def write(
    docs: DataFrame, path: str, end: int, folder: str, length: int = LENGTH
) -> DataFrame:
    """Write the shards below ``folder``; the manifest with the first place of each shard.

    ``doc_id`` is an integer. The manifest has a row per shard, so its running sum is small.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    ordered = ordered.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    shards = ordered.mapInArrow(lambda it: _write(it, path, end, folder, length), MANIFEST)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first")
    return common.stored(shards, "manifest").select("*", first)


class Shard:
    """Random access to one shard."""

    def __init__(self, folder: str, name: str):
        files, top = _place(folder)
        where = f"{top}/{name}.ids.arrows"
        local = isinstance(files, pafs.LocalFileSystem)
        self.source = pa.memory_map(where) if local else files.open_input_file(where)
        with pa.ipc.open_stream(files.open_input_stream(f"{top}/{name}.index.arrows")) as stream:
            self.index = stream.read_all()
        self.schema = pa.ipc.read_schema(self.source)
        self.length = self.schema.field("ids").type.list_size
        self.head = self.source.tell()
        self.size = self.source.size()
        if self.size > self.head + 8:
            pa.ipc.read_message(self.source)
        self.step = self.source.tell() - self.head  # bytes of each full batch

    def batch(self, k: int) -> pa.RecordBatch:
        self.source.seek(self.head + k * self.step)
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of a sequence; the ids are a view of the file."""
        batch, row = self.batch(i // SEQUENCES), i % SEQUENCES
        ids = batch.column(0).values.to_numpy()[row * self.length : (row + 1) * self.length]
        mask = batch.column(1).values.slice(row * self.length, self.length)
        return ids, mask.to_numpy(zero_copy_only=False)

    def pieces(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from a place on, as views of the batches they lie in."""
        step, k, ids = self.length * SEQUENCES, -1, None
        while n > 0:
            if start // step != k:
                k = start // step
                ids = self.batch(k).column(0).values.to_numpy()
            take = min(n, step - start % step)
            yield ids[start % step : start % step + take]
            start, n = start + take, n - take


def _read(batches: Iterator[pa.RecordBatch], folder: str):
    for batch in batches:
        for name, first in zip(batch.column("name").to_pylist(), batch.column("first").to_pylist()):
            shard = Shard(folder, name)
            step = shard.length * SEQUENCES
            stream = (shard.batch(k).column(0).values.to_numpy() for k in range(1 << 62))
            held, at = np.zeros(0, np.uint32), 0  # documents stand in the order of the stream
            for rows in shard.index.to_batches(max_chunksize=1000):
                sums = []
                for n in rows.column("n_tokens").to_numpy():
                    crc = 0
                    while n > 0:
                        if at == len(held):
                            held, at = next(stream), 0
                        take = min(int(n), len(held) - at)
                        crc = zlib.crc32(held[at : at + take].astype("<u4").tobytes(), crc)
                        at, n = at + take, n - take
                    sums.append(crc)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(rows.column("start").to_numpy() + first),
                        rows.column("n_tokens"),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files alone: place, number and checksum of its ids."""
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = manifest.select("part", "name", "first").repartition(parts, "part")
    return dealt.mapInArrow(lambda it: _read(it, folder), DOCUMENTS)
