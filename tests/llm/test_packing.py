"""Harmonic packing against the tokenizers library and its own rules."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folkmeter.llm import packing

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, length string, ids string"
ROWS = [
    (1, "plain words, and more of them."),
    (2, None),
    (3, ""),
    (4, "x<|endoftext|> y"),
    (4, "the same id again"),
    (None, "no id"),
    (5, "'s don't 12 34  \n\n 日本 é́ \x85 \x1c  end "),
    (6, "word and other " * 3000),
    (7, "a" * 5000),
    (8, "plain words, and more of them."),
    (9, "plain words, and more of them."),
]


@pytest.fixture(scope="module")
def tool():
    return Tokenizer.from_file(BYTES)


def checked(rows, tool, texts, capacity, end=0):
    """The pieces, after the checks that hold for any packing: every id once, gapless sequences."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) // 4 > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[(r.doc_id, r.doc_tokens)].append((r.start, bytes(r.ids)))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    want = defaultdict(list)
    for doc_id, text in texts:
        ids = [*tool.encode(text or "", add_special_tokens=False).ids, end]
        want[(doc_id, len(ids))].append(np.array(ids, "<u4").tobytes())
    for key, found in documents.items():
        whole = b"".join(sorted(want[key]))
        if len(want[key]) == 1:
            assert b"".join(ids for _, ids in sorted(found)) == whole
        else:
            assert sorted(b"".join(ids for _, ids in found)) == sorted(whole)
    assert documents.keys() == want.keys()
    return sequences


@pytest.mark.parametrize("capacity,least", [(1024, 32), (64, 8), (100, 7)])
def test_every_id_stands_once(spark, tool, capacity, least):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in ROWS], SCHEMA).repartition(3)
    rows = packing.pack(docs, BYTES, 0, capacity, least).collect()
    checked(rows, tool, ROWS, capacity)


def test_rounds_of_workers(spark, tool, monkeypatch):
    monkeypatch.setattr(packing, "FAN", 2)
    texts = [(i, "some words " * (i % 37 + 1)) for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(7)
    rows = packing.pack(docs, BYTES, 0, 128, 8).collect()
    sequences = checked(rows, tool, texts, 128)
    assert len({s >> 56 for s in sequences}) > 2  # rounds 0, 1, 2, ... each closed some
    room = sum(128 - sum(n for _, n in pieces) for pieces in sequences.values())
    filled = sum(n for pieces in sequences.values() for _, n in pieces)
    assert room < 0.02 * filled + 128


def test_bins_of_a_class_hold_its_number(spark):
    texts = [(i, "a b c") for i in range(500)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    rows = packing.pack(docs, BYTES, 0, 64, 16).collect()
    counts = defaultdict(int)
    for r in rows:
        counts[r.sequence_id] += 1
    assert sorted(counts.values(), reverse=True)[:30] == [64 // 4] * 30


def test_padding_is_little(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = packing.sequences(packing.pack(docs, BYTES, 0))
    row = found.agg(
        F.sum("padding").alias("p"), F.sum("length").alias("n"), F.max("length").alias("m")
    ).first()
    assert row.p <= 1024 + 0.001 * row.n and row.m == 1024
    one = found.orderBy("sequence_id").first()
    assert len(one.ids) == 4 * one.length and sum(p.length for p in one.pieces) == one.length


def test_cuts():
    for n in range(1, 3000):
        found = packing.cuts(n)
        assert [s for s, _ in found] == [sum(m for _, m in found[:i]) for i in range(len(found))]
        assert sum(m for _, m in found) == n
        assert len(found) <= n // 1024 + 6
    assert packing.cuts(1024) == [(0, 1024)]
    assert packing.cuts(1024 + 512 + 33) == [(0, 1024), (1024, 512), (1536, 32), (1568, 1)]


def test_ids_equal_the_library(tool):
    fast = packing.Encoder(BYTES)
    assert fast.fast is not None
    texts = [t or "" for _, t in ROWS] + [chr(c) + "a " + chr(c) for c in range(0x20, 0x3000, 7)]
    for text in texts:
        assert fast.encode(text).tolist() == tool.encode(text, add_special_tokens=False).ids
    blanks = " " * 200_000 + "x" + "\n " * 400_000  # more than the fast pattern engine takes
    assert fast.encode(blanks).tolist() == tool.encode(blanks, add_special_tokens=False).ids


def test_other_tokenizers_go_to_the_library():
    other, library = packing.Encoder(WORDS), Tokenizer.from_file(WORDS)
    assert other.fast is None
    assert other.encode("Some Words").tolist() == library.encode("Some Words", add_special_tokens=False).ids


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), BYTES, 0).collect() == []


def test_query_digests(spark, sf_dir, tool):
    from folkmeter.llm import queries

    rows = queries.op13(spark, sf_dir).collect()
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    for r in rows[::50]:
        ids = np.array([*tool.encode(texts[r.doc_id], add_special_tokens=False).ids, 0], "<u4")
        assert len(ids) == r.doc_tokens
        assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
