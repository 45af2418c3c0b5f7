"""Quality scores: ridge regression on random Fourier features of document statistics.

Each text gives some twenty statistics (lengths, shares of kinds of characters, repetition of
words, word pairs and lines). They are standardised and mapped by ``cos(Wx + b)``, which
approximates a Gaussian kernel. The normal equations are summed per partition, then row by row,
so that only a table of fixed size reaches the driver, where the ridge weights are solved for.
The raw score is calibrated by isotonic regression (pool adjacent violators) over counts per
score bin, again a table of fixed size.

All labelled rows take part in the fit but those held out: crc32 of the id as text, modulo 3,
is 1. Several labels of a document count as their mean. The score depends on the text alone.

Defined cases: a null text counts as empty and gets a score like any other; null labels are no
labels; without labels the score is 0.5, and with one kind of label it is that label; repeated
rows are scored each; other columns pass unchanged unless they bear the name of a result column,
which then replaces them; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folkmeter.llm import common

FEATURES = 256  # random Fourier features
RIDGE = 1.0
SEED = 17
TASKS = 64  # partial sums of the normal equations
CLIP = 4.0
BINS = 2000  # score bins of the calibration

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[ord(c) for c in "!\"'(),-.:;?"]] = True
NAMES = [
    "log_bytes",
    "log_words",
    "mean_word",
    "word_spread",
    "upper",
    "digits",
    "symbols",
    "punctuation",
    "spaces",
    "beyond_ascii",
    "shouting",
    "log_line",
    "distinct_words",
    "distinct_pairs",
    "top_word",
    "repeated_lines",
    "short_words",
    "long_words",
]


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask)])
    return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)


def _distinct(values: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the number of distinct values, and the count of the most frequent."""
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(v)))
    top = np.zeros(rows, np.int64)
    np.maximum.at(top, r[first], counts)
    return np.bincount(r[first], minlength=rows).astype(float), top.astype(float)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One line of NAMES per text of a block."""
    rows = len(offsets) - 1
    words = common.Words(data, offsets)
    size = np.diff(offsets).astype(float)
    n = np.diff(words.first).astype(float)
    some, any_word = np.maximum(size, 1), np.maximum(n, 1)
    length = (words.end - words.start).astype(float)

    def by_word(x):
        return np.bincount(words.doc, x, minlength=rows)

    mean = by_word(length) / any_word
    spread = np.sqrt(np.maximum(by_word(length**2) / any_word - mean**2, 0))
    upper = _per_row((data >= 65) & (data <= 90), offsets)
    lower = _per_row((data >= 97) & (data <= 122), offsets)
    kinds, top = _distinct(words.hash, words.doc, rows)
    same = words.doc[1:] == words.doc[:-1]
    pair = common.mix(words.hash[:-1] * np.uint64(3) + words.hash[1:])[same]
    pairs, _ = _distinct(pair, words.doc[1:][same], rows)
    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offsets[:-1][size > 0], breaks + 1]))
    line_start = line_start[line_start < len(data)]
    line_row = np.searchsorted(offsets, line_start, side="right") - 1
    line_end = np.minimum(np.append(line_start[1:], len(data)), offsets[line_row + 1])
    codes = common.BYTE_CODES[data]
    lines = np.bincount(line_row, minlength=rows).astype(float)
    if len(line_start):
        trimmed = line_end - ((line_end > line_start) & (data[np.maximum(line_end - 1, 0)] == 10))
        line_kinds, _ = _distinct(common.span_hashes(codes, line_start, trimmed), line_row, rows)
    else:
        line_kinds = lines
    columns = [
        np.log1p(size),
        np.log1p(n),
        mean,
        spread,
        upper / some,
        _per_row((data >= 48) & (data <= 57), offsets) / some,
        _per_row(_SYMBOLS[data], offsets) / some,
        _per_row(_PUNCTUATION[data], offsets) / some,
        _per_row((data == 32) | ((data >= 9) & (data <= 13)), offsets) / some,
        _per_row(data >= 128, offsets) / some,
        upper / np.maximum(upper + lower, 1),
        np.log1p(size / np.maximum(lines, 1)),
        kinds / any_word,
        pairs / np.maximum(n - 1, 1),
        top / any_word,
        1 - line_kinds / np.maximum(lines, 1),
        by_word(length <= 3) / any_word,
        by_word(length > 12) / any_word,
    ]
    return np.stack(columns, axis=1)


def _held_out(name: str) -> Column:
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the statistics in place of the text."""
    kept = [f for f in docs.schema.fields if f.name not in (text, "statistics")]
    schema = T.StructType(kept + [T.StructField("statistics", T.ArrayType(T.DoubleType()))])

    def work(batches: Iterator[pa.RecordBatch]):
        common.release()
        for batch, data, offsets in common.blocks(batches, text):
            values = statistics(data, offsets)
            flat = pa.array(values.ravel())
            ends = pa.array(np.arange(len(values) + 1, dtype=np.int32) * len(NAMES))
            columns = [batch.column(f.name) for f in kept] + [pa.ListArray.from_arrays(ends, flat)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(work, schema)


@dataclass
class Model:
    """A fitted scorer; all arrays have a fixed size."""

    mean: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    phase: np.ndarray
    weights: np.ndarray  # the last one is the constant
    steps: np.ndarray  # calibrated scores at ``places``
    places: np.ndarray

    def lift(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        waves = np.cos(z @ self.turn + self.phase) * np.sqrt(2 / self.turn.shape[1])
        return np.concatenate([waves, np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.places, self.steps)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, len(NAMES))


def _sums(batches: Iterator[pa.RecordBatch], model: Model):
    """Per partition, the lines of the matrix of products (with the label as the last column)."""
    n = FEATURES + 1
    total = np.zeros((n, n + 1))
    for batch in batches:
        lifted = model.lift(_matrix(batch.column("statistics")))
        labelled = np.column_stack([lifted, batch.column("label").to_numpy()])
        total += lifted.T @ labelled
    if total.any():
        yield pa.RecordBatch.from_pydict(
            {"line": pa.array(range(n), pa.int32()), "part": pa.array(list(total))}
        )


def _add(tables: pa.Table) -> pa.Table:
    sums = np.sum(np.stack(tables.column("part").to_pylist()), axis=0)
    return pa.table({"line": tables.column("line")[:1], "part": pa.array([sums])})


def pooled(places: np.ndarray, counts: np.ndarray, sums: np.ndarray):
    """Isotonic regression: (places, values) of the pooled blocks."""
    blocks: list[list[float]] = []
    for place, count, total in zip(places, counts, sums):
        blocks.append([count, total, place * count])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    done = np.array(blocks)
    return done[:, 2] / done[:, 0], done[:, 1] / done[:, 0]


def _bin(batches: Iterator[pa.RecordBatch], model: Model):
    for batch in batches:
        raw = np.clip(model.raw(_matrix(batch.column("statistics"))), -1, 2)
        bins = np.rint((raw + 1) / 3 * BINS).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("label")], names=["bin", "label"])


def fit(found: DataFrame, labels: DataFrame, id_: str = "doc_id", label: str = "quality") -> Model:
    """Learn from ``found`` (id and statistics) and ``labels``; held-out rows are left out."""
    known = labels.filter(F.col(label).isNotNull() & F.col(id_).isNotNull() & ~_held_out(id_))
    known = known.groupBy(F.col(id_).alias("id")).agg(F.avg(label).alias("label"))
    rows = found.select(F.col(id_).alias("id"), "statistics").join(known, "id")
    rows = common.stored(rows.select("statistics", "label"), "labelled").coalesce(TASKS)

    moments = rows.agg(
        F.count("*").alias("n"),
        *[F.avg(F.col("statistics")[i]).alias(f"m{i}") for i in range(len(NAMES))],
        *[F.stddev_pop(F.col("statistics")[i]).alias(f"s{i}") for i in range(len(NAMES))],
    ).first()
    random = np.random.default_rng(SEED)
    turn = random.normal(size=(len(NAMES), FEATURES)) / np.sqrt(len(NAMES))
    phase = random.uniform(0, 2 * np.pi, FEATURES)
    n = moments["n"]
    mean = np.array([moments[f"m{i}"] or 0.0 for i in range(len(NAMES))])
    scale = np.array([moments[f"s{i}"] or 0.0 for i in range(len(NAMES))])
    scale[scale < 1e-9] = 1.0
    model = Model(mean, scale, turn, phase, np.zeros(FEATURES + 1), np.full(2, 0.5), np.array([0.0, 1.0]))
    if n == 0:
        return model
    part = "line int, part array<double>"
    sums = rows.mapInArrow(lambda it: _sums(it, model), part).groupBy("line").applyInArrow(_add, part)
    lines = np.array([r["part"] for r in sums.orderBy("line").collect()])  # of fixed size
    penalty = np.eye(FEATURES + 1) * RIDGE
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(lines[:, :-1] + penalty, lines[:, -1])
    bins = rows.mapInArrow(lambda it: _bin(it, model), "bin int, label double")
    counted = bins.groupBy("bin").agg(F.count("*").alias("n"), F.sum("label").alias("s"))
    table = np.array([tuple(r) for r in counted.orderBy("bin").collect()], float)
    model.places, model.steps = pooled(table[:, 0] * 3 / BINS - 1, table[:, 1], table[:, 2])
    return model


def score(found: DataFrame, model: Model) -> DataFrame:
    """``found`` with score and predicted in place of the statistics."""
    names = ("statistics", "score", "predicted")
    kept = [f for f in found.schema.fields if f.name not in names]
    schema = T.StructType(
        kept + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            value = model.score(_matrix(batch.column("statistics")))
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array(value), pa.array((value >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return found.mapInArrow(work, schema)


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of 0.5 or more."""

    def work(batches: Iterator[pa.RecordBatch]):
        common.release()
        for batch, data, offsets in common.blocks(batches, text):
            value = model.score(statistics(data, offsets))
            yield batch.filter(pa.array(value >= 0.5))

    return docs.mapInArrow(work, docs.schema)


def held_out(id_: str = "doc_id") -> Column:
    return _held_out(id_)
