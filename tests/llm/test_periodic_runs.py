"""Runs of words against a plain enumeration, and extensions against comparing word by word."""

import random

import numpy as np
import pytest

from folkmeter.llm import periodic_runs as runs

SCHEMA = "doc_id bigint, text string, n_words string, runs string, collapsed string, h string"


def plain_runs(words):
    """(start, length, period): every stretch of every period, the smallest period of each."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            end = i
            while end < n - q and words[end] == words[end + q]:
                end += 1
            if end > i and end - i + q >= max(6, 4 * q):
                found.setdefault((i, end - i + q), q)
            i = max(end, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words):
    gone = {i for s, n, q in plain_runs(words) for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def made(seed):
    rnd = random.Random(seed)
    kinds, size = rnd.choice([1, 2, 3, 5, 50]), rnd.choice([0, 3, 10, 60, 400])
    words = [f"w{rnd.randrange(kinds)}" for _ in range(size)]
    for _ in range(rnd.randrange(3)):
        part = words[: rnd.randint(1, max(1, size // 5))]
        words = words + part * rnd.randint(2, 8) + [f"w{rnd.randrange(kinds)}"]
    return words


def test_every_difference_is_covered():
    found = {(a - b) % runs.MODULUS for a in runs.COVER for b in runs.COVER}
    assert found == set(range(runs.MODULUS))
    assert runs.MEETING.max() < runs.MODULUS


@pytest.mark.parametrize("kinds", [1, 2, 40])
def test_extensions(kinds):
    rnd = np.random.default_rng(kinds)
    docs = [rnd.integers(1, kinds + 1, n) for n in (700, 1, 90)]
    docs[0][350:650] = docs[0][20:320]
    codes = np.concatenate([[0], *[np.concatenate([d, [0]]) for d in docs]]).astype(np.int32)
    tool = runs.CoverLCE(codes, 700)
    i = rnd.integers(1, 690, 4000)
    j = i + rnd.integers(1, 701 - i)
    found = tool.extend(i, j)
    for a, b, n in zip(i, j, found):
        want = 0
        while codes[b + want] and codes[a + want] == codes[b + want]:
            want += 1
        assert n == want


@pytest.mark.parametrize("pairs", [40, 1 << 20])
def test_equals_plain_enumeration(spark, monkeypatch, pairs):
    texts = {i: made(i) for i in range(300)}
    rows = [(i, (" ", "\n ", "\t")[i % 3].join(w) + " " * (i % 2), "a", "b", "c", "d") for i, w in texts.items()]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    monkeypatch.setattr(runs, "PAIRS", pairs)
    batches = docs.toArrow().combine_chunks().to_batches() if pairs == 40 else None
    found = (
        [r for b in runs._found(iter(batches)) for r in b.to_pylist()]
        if batches
        else [r.asDict() for r in runs.find(docs).collect()]
    )
    assert len(found) == len(texts)
    for r in found:
        words = texts[r["doc_id"]]
        assert [(x["start"], x["length"], x["period"]) for x in r["runs"]] == plain_runs(words)
        assert r["collapsed"] == collapsed(words) and r["n_words"] == len(words)


ODD = [
    (1, None), (2, ""), (3, " \t\n\r\x0b\x0c "), (4, "a"), (5, "a " * 6), (5, "a " * 6), (None, "b b b b b b b"),
    (6, "é\xa0é é\xa0é é\xa0é é\xa0é é\xa0é é\xa0é x\x1cy"), (7, "one two " * 40_000 + "end"), (8, "a a a a a"),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in ODD], SCHEMA)
    found = runs.find(docs).collect()
    want = []
    for i, text in ODD:
        words = [w.decode() for w in (text or "").encode().split()]
        want.append((i, len(words), plain_runs(words) if i != 7 else [(0, 80_000, 2)], collapsed(words) if i != 7 else "one two end"))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert runs.find(docs.limit(0)).collect() == []


def test_repeated_tail(spark):
    from pyspark.sql import functions as F

    words = [str(i) for i in range(20)]
    frame = spark.createDataFrame([(words,)], "words array<string>")
    for a, p in ((0, 1), (0, 20), (7, 3), (19, 1), (5, 15)):
        row = frame.select(runs.repeat_tail("words", F.lit(a), F.lit(p)).alias("w")).first()
        assert row.w == words[:a] + [words[a + (i - a) % p] for i in range(a, 20)]
    text = spark.createDataFrame([(" a\tb\x0b\x0cc\r\n d\xa0e ",)], "text string")
    assert text.select(runs.split_words("text").alias("w")).first().w == ["a", "b", "c", "d\xa0e"]
