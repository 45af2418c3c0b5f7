"""Toxicity: cumulative-link (proportional odds) regression of severity on sparse text features.

A feature is a word, or the first four or five bytes of a longer word, known by a 64-bit hash;
its value is ``log(1 + occurrences)``. The chance that the severity exceeds grade k is
``sigmoid(x w - t_k)``, with one weight vector for all grades and ordered thresholds. The result
is the expected severity, the sum of these chances.

Labels say only whether a text is toxic. The grades above 0 are the toxic training texts cut into
``GRADES`` equal parts by the number of occurrences of features that speak for toxicity.

The fit uses a bounded sample: at most ``TOXIC_ROWS`` toxic and ``CLEAN_ROWS`` other labelled
texts, taken in the order of a hash of the id, in one task. The vocabulary holds at most
``VOCABULARY`` features, those with the largest likelihood ratio. Texts whose crc32 of the id
modulo 3 is 1 are held out. Every text is scored whole, in one pass without a shuffle.

Defined cases: a null or empty text has no features and gets the score of such; null labels are
no labels; without toxic or without other labels nothing is toxic; a document with several labels
is toxic if one of them says so; repeated rows are scored each; an empty table gives no rows;
columns of the input that bear the name of a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folkmeter.llm import common
from folkmeter.llm.quality import held_out

TOXIC_ROWS = 2000
CLEAN_ROWS = 3000
VOCABULARY = 4096
GRADES = 3
STARTS = (4, 5)  # bytes of the beginnings of words
STEPS = 400
PENALTY = 1e-3


def text_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every feature occurrence."""
    words = common.Words(data, offsets)
    codes = np.where(common.WORD_BYTES[data] > 0, common.BYTE_CODES[common.WORD_BYTES[data]], 0)
    rows, values = [words.doc], [words.hash]
    for n in STARTS:
        long = words.end - words.start > n
        start = words.start[long]
        rows.append(words.doc[long])
        values.append(common.mix(common.span_hashes(codes, start, start + n) ^ np.uint64(n)))
    return np.concatenate(rows), np.concatenate(values)


@dataclass
class Model:
    vocabulary: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray  # rising

    def line(self, row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        """x w per row."""
        if not len(self.vocabulary) or not len(value):
            return np.zeros(rows)
        at = np.minimum(np.searchsorted(self.vocabulary, value), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == value
        cell, count = np.unique(row[known] * len(self.vocabulary) + at[known], return_counts=True)
        part = np.log1p(count) * self.weights[cell % len(self.vocabulary)]
        return np.bincount(cell // len(self.vocabulary), part, minlength=rows)

    def exceeds(self, line: np.ndarray) -> np.ndarray:
        """Per row and grade the chance that the severity is above the grade."""
        return 1 / (1 + np.exp(-np.clip(line[:, None] - self.thresholds[None, :], -40, 40)))


NOTHING = Model(np.zeros(0, np.uint64), np.zeros(0), np.full(GRADES, 30.0) + np.arange(GRADES))


def _gain(with_toxic: np.ndarray, with_clean: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Likelihood ratio of presence of a feature against independence of the label."""
    n = toxic + clean
    out = np.zeros(len(with_toxic))
    for seen, size in ((with_toxic, toxic), (with_clean, clean)):
        share = (with_toxic + with_clean) / n
        for cell, expected in ((seen, share * size), (size - seen, (1 - share) * size)):
            out += np.where(cell > 0, cell * np.log(np.maximum(cell, 1) / np.maximum(expected, 1e-12)), 0)
    return 2 * out


def learn(row: np.ndarray, value: np.ndarray, count: np.ndarray, toxic: np.ndarray) -> Model:
    """Fit from (row, feature, occurrences) triples and a label per row."""
    n, n_toxic = len(toxic), int(toxic.sum())
    if n_toxic == 0 or n_toxic == n:
        return NOTHING
    known, at = np.unique(value, return_inverse=True)
    bad = np.bincount(at, toxic[row], minlength=len(known))
    good = np.bincount(at, minlength=len(known)) - bad
    gain = _gain(bad, good, n_toxic, n - n_toxic)
    chosen = np.sort(np.argsort(-gain, kind="stable")[:VOCABULARY])
    place = np.full(len(known), -1)
    place[chosen] = np.arange(len(chosen))
    use = place[at] >= 0
    row, col, x = row[use], place[at][use], np.log1p(count[use])
    speaks = (bad[chosen] / n_toxic > 3 * good[chosen] / (n - n_toxic)) & (gain[chosen] > 20)
    amount = np.bincount(row, np.where(speaks[col], count[use], 0), minlength=n)
    grade = np.zeros(n, int)
    cuts = np.quantile(amount[toxic > 0], np.arange(1, GRADES) / GRADES)
    grade[toxic > 0] = 1 + np.searchsorted(cuts, amount[toxic > 0], side="left")

    # Maximum likelihood by Adam over the weights, the first threshold and the log gaps.
    size = len(chosen)
    p = np.zeros(size + GRADES)
    p[size:] = [2.0] + [0.0] * (GRADES - 1)
    m, v = np.zeros_like(p), np.zeros_like(p)
    each = np.arange(n)
    balance = np.where(toxic > 0, n / (2 * n_toxic), n / (2 * (n - n_toxic)))
    for step in range(1, STEPS + 1):
        line = np.bincount(row, x * p[col], minlength=n)
        t = np.concatenate([[-1e3], p[size] + np.concatenate([[0], np.cumsum(np.exp(p[size + 1 :]))]), [1e3]])
        above = 1 / (1 + np.exp(-np.clip(line[:, None] - t[None, :], -40, 40)))
        low, high = above[each, grade], above[each, grade + 1]
        chance = np.maximum(low - high, 1e-9)
        d_low, d_high = low * (1 - low) / chance * balance, high * (1 - high) / chance * balance
        d_line = -(d_low - d_high) / n
        g = np.zeros_like(p)
        g[:size] = np.bincount(col, x * d_line[row], minlength=size) + PENALTY * p[:size]
        d_t = np.zeros(GRADES + 2)
        np.add.at(d_t, grade, d_low / n)
        np.add.at(d_t, grade + 1, -d_high / n)
        tail = np.cumsum(d_t[1:-1][::-1])[::-1]
        g[size] = tail[0]
        g[size + 1 :] = tail[1:] * np.exp(p[size + 1 :])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    thresholds = p[size] + np.concatenate([[0], np.cumsum(np.exp(p[size + 1 :]))])
    return Model(known[chosen], p[:size], thresholds)


def _learn(batches: Iterator[pa.RecordBatch]):
    """One task: the sample is bounded."""
    rows, values, counts, labels, done = [], [], [], [], 0
    for batch, data, offsets in common.blocks(batches):
        row, value = text_features(data, offsets)
        order = np.lexsort((value, row))
        row, value = row[order], value[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        first = np.flatnonzero(new)
        rows.append(row[first] + done)
        values.append(value[first])
        counts.append(np.diff(np.append(first, len(row))))
        labels.append(batch.column("toxic").to_numpy())
        done += batch.num_rows
    if done:
        model = learn(*(np.concatenate(a) for a in (rows, values, counts, labels)))
        yield pa.RecordBatch.from_pydict(
            {
                "vocabulary": pa.array([model.vocabulary.astype(np.int64)]),
                "weights": pa.array([model.weights]),
                "thresholds": pa.array([model.thresholds]),
            }
        )


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id_: str = "doc_id") -> Model:
    known = labels.filter(F.col("toxic").isNotNull() & F.col(id_).isNotNull() & ~held_out(id_))
    known = known.groupBy(F.col(id_).alias("id")).agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.col("id"), F.lit(4))
    sample = known.filter("toxic = 1").orderBy(order, "id").limit(TOXIC_ROWS)
    sample = sample.unionAll(known.filter("toxic = 0").orderBy(order, "id").limit(CLEAN_ROWS))
    texts = docs.select(F.col(id_).alias("id"), F.col(text).alias("text"))
    # The broadcast holds TOXIC_ROWS + CLEAN_ROWS rows at most; copies of an id count once.
    texts = texts.join(F.broadcast(sample), "id").groupBy("id").agg(
        F.min("text").alias("text"), F.first("toxic").alias("toxic")
    )
    fields = "vocabulary array<bigint>, weights array<double>, thresholds array<double>"
    # Ordered, as sums of floating-point numbers depend on the order.
    fitted = texts.coalesce(1).sortWithinPartitions("id").mapInArrow(_learn, fields).collect()
    if not fitted or not fitted[0]["thresholds"]:
        return NOTHING
    vocabulary = np.array(fitted[0]["vocabulary"], np.int64).astype(np.uint64)
    return Model(vocabulary, np.array(fitted[0]["weights"]), np.array(fitted[0]["thresholds"]))


RESULT = [
    T.StructField("expected_severity", T.DoubleType()),
    T.StructField("severity", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("toxic", T.BooleanType()),
]


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the text, with the expected severity, the likeliest grade, the chance of
    any toxicity and whether that is 0.5 or more."""
    new = {f.name for f in RESULT}
    kept = [f for f in docs.schema.fields if f.name != text and f.name not in new]
    schema = T.StructType(kept + RESULT)

    def work(batches: Iterator[pa.RecordBatch]):
        for batch, data, offsets in common.blocks(batches, text):
            above = model.exceeds(model.line(*text_features(data, offsets), batch.num_rows))
            padded = np.column_stack([np.ones(len(above)), above, np.zeros(len(above))])
            columns = [batch.column(f.name) for f in kept]
            columns += [
                pa.array(above.sum(axis=1)),
                pa.array(np.argmax(padded[:, :-1] - padded[:, 1:], axis=1).astype(np.int32)),
                pa.array(above[:, 0]),
                pa.array(above[:, 0] >= 0.5),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(work, schema)
