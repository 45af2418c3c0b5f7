"""Runs: stretches of words that repeat with a period, and texts without their repetitions.

A run is a stretch with smallest period q (words q apart are the same) that has at least
``TIMES`` periods and ``LEAST`` words, and that neither neighbour extends.

Where a period q holds is found from pairs of places q apart: how far the texts from both places
agree to the right and to the left gives the whole stretch. A run of four periods contains a pair
whose first place is a multiple of 3q, so the places of a period are a grid, and all grids of a
document together are a harmonic sum, n log n pairs. Most pairs differ in their first word; the
others are compared for a few words.

Pairs that agree further are answered by a difference cover: of 31 consecutive places, 6 are
sampled, chosen so that any two places are at some common distance below 31 from two samples.
Only the suffixes at samples are sorted, by their blocks of 31 words and then by doubling, and the
common prefixes of neighbours in that order go to a sparse table. An extension compares the words
before the common samples, and one range minimum gives the rest. The same over the reversed words
gives the extension to the left. Stretches found with a multiple of their period are the same
stretches, so of each only the smallest period stays.

Words are numbered by their bytes in each block, so equality is exact. A task takes one block of
texts at a time; no rows are moved.

Defined cases: null and empty texts have no words and no runs; texts are taken whole; repeated
rows and equal ids are treated each; a null ``doc_id`` stays null; an empty table gives no rows;
other columns are not carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folkmeter.llm import common

TIMES = 4  # periods that a run has at least
LEAST = 6  # words that a run has at least
NEAR = 8  # words compared to each side before the suffix order is asked
PAIRS = 1 << 20  # pairs of places looked at together
#: Every difference modulo 31 is one of two of these.
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)
FOUND = "doc_id bigint, n_words bigint, runs array<struct<start bigint, length bigint, period bigint>>, collapsed string"
RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _meeting() -> np.ndarray:
    """Least distance at which two places, by their residues, both have a sample."""
    sample = np.isin(np.arange(2 * MODULUS) % MODULUS, COVER)
    out = np.zeros((MODULUS, MODULUS), np.int64)
    for a in range(MODULUS):
        for b in range(MODULUS):
            out[a, b] = np.flatnonzero(sample[a : a + MODULUS] & sample[b : b + MODULUS])[0]
    return out


MEETING = _meeting()
_NUMBER = np.zeros(MODULUS, np.int64)  # of a residue of the cover among its like
_NUMBER[list(COVER)] = np.arange(len(COVER))


def _agree(codes: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray | int, step: int = 1) -> np.ndarray:
    """Equal numbers from ``i`` and ``j`` on in direction ``step``, up to ``most`` of them."""
    out = np.broadcast_to(np.asarray(most, np.int64), i.shape).copy()
    alive = np.flatnonzero(out > 0)
    t = 0
    while len(alive):
        same = codes[i[alive] + step * t] == codes[j[alive] + step * t]
        out[alive[~same]] = t
        alive, t = alive[same], t + 1
        alive = alive[out[alive] > t]
    return out


class CoverLCE:
    """Longest common extensions to the right in a list of numbers, by a difference cover.

    ``codes``: positive numbers of words, with 0 on both sides of each document; ``longest``:
    words of the longest document. Pairs of places lie in one document each.
    """

    def __init__(self, codes: np.ndarray, longest: int):
        n, c = len(codes), len(COVER)
        self.codes = np.concatenate([codes, np.zeros(2 * MODULUS, codes.dtype)])
        base = np.arange(0, n, MODULUS)[:, None] + np.array(COVER)
        self.places = base.ravel()
        self.places = self.places[self.places < n]
        m = self.m = len(self.places)
        windows = np.lib.stride_tricks.sliding_window_view(self.codes, MODULUS)[self.places]
        blocks = np.ascontiguousarray(windows.astype(">u4")).view(f"S{4 * MODULUS}").ravel()
        ranks = [np.unique(blocks, return_inverse=True)[1].astype(np.int64)]
        # Samples a block apart are c samples apart, so doubling the length shifts by whole blocks.
        while (MODULUS << (len(ranks) - 1)) < longest and ranks[-1].max() < m - 1:
            shift = c << (len(ranks) - 1)
            after = np.zeros(m, np.int64)
            after[: max(0, m - shift)] = ranks[-1][shift:] + 1
            ranks.append(np.unique(ranks[-1] * (m + 1) + after, return_inverse=True)[1])
        order = np.argsort(ranks[-1], kind="stable")
        self.rank = np.empty(m, np.int64)
        self.rank[order] = np.arange(m)
        self.table = self._minima(self._neighbours(order, ranks))

    def _neighbours(self, order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of suffixes that are next to each other in the order."""
        a, b = order[:-1].copy(), order[1:].copy()
        out = np.zeros(len(a), np.int64)
        for k in reversed(range(len(ranks))):
            inside = np.flatnonzero((a < self.m) & (b < self.m))
            same = inside[ranks[k][a[inside]] == ranks[k][b[inside]]]
            out[same] += MODULUS << k
            a[same] += len(COVER) << k
            b[same] += len(COVER) << k
        inside = np.flatnonzero((a < self.m) & (b < self.m))
        out[inside] += _agree(self.codes, self.places[a[inside]], self.places[b[inside]], MODULUS)
        return out

    @staticmethod
    def _minima(values: np.ndarray) -> list[np.ndarray]:
        table = [values]
        while (1 << len(table)) <= len(values):
            last, half = table[-1], 1 << (len(table) - 1)
            table.append(np.minimum(last[:-half], last[half:]))
        return table

    def extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        apart = MEETING[i % MODULUS, j % MODULUS]
        out = _agree(self.codes, i, j, apart)
        far = np.flatnonzero(out == apart)
        a, b = i[far] + apart[far], j[far] + apart[far]
        a, b = (self.rank[x // MODULUS * len(COVER) + _NUMBER[x % MODULUS]] for x in (a, b))
        low, high = np.minimum(a, b), np.maximum(a, b)
        height = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(height):
            at = np.flatnonzero(height == k)
            row = self.table[k]
            out[far[at]] += np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        return out


class _Extensions:
    """Extensions to both sides within some documents of a block; sorted when first asked."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, docs: np.ndarray):
        self.shift = np.zeros(len(starts), np.int64)
        parts, at = [np.zeros(1, codes.dtype)], 1
        for d in docs:
            parts.append(codes[starts[d] : starts[d] + sizes[d] + 1])  # with the 0 behind it
            self.shift[d] = at - starts[d]
            at += sizes[d] + 1
        own, longest = np.concatenate(parts), int(sizes[docs].max())
        self.last = len(own) - 1
        self.right, self.left = CoverLCE(own, longest), CoverLCE(own[::-1], longest)

    def forward(self, doc, i, j):
        return self.right.extend(i + self.shift[doc], j + self.shift[doc])

    def backward(self, doc, i, j):
        """Of the words before both places."""
        i, j = i + self.shift[doc], j + self.shift[doc]
        return self.left.extend(self.last - i + 1, self.last - j + 1)


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def _runs_of(codes, starts, sizes, docs) -> np.ndarray:
    """Rows (document, start, end, period) of the stretches found in some documents of a block."""
    most = sizes[docs] // TIMES
    doc, q = np.repeat(docs, most), _within(most) + 1
    counts = (sizes[doc] - 1 - q) // ((TIMES - 1) * q) + 1
    ends, low, found, deep = np.cumsum(counts), 0, [], None
    while low < len(doc):
        done = ends[low - 1] if low else 0
        high = len(doc) if len(docs) > 1 else max(low + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
        d, p = np.repeat(doc[low:high], counts[low:high]), np.repeat(q[low:high], counts[low:high])
        i = starts[d] + (TIMES - 1) * p * _within(counts[low:high])
        low = high
        same = np.flatnonzero(codes[i] == codes[i + p])
        d, p, i = d[same], p[same], i[same]
        j = i + p
        right, left = _agree(codes, i, j, NEAR), _agree(codes, i - 1, j - 1, NEAR, -1)
        far = (right == NEAR) | (left == NEAR)
        keep = np.flatnonzero(far | (right + left + p >= np.maximum(LEAST, TIMES * p)))
        d, p, i, j, right, left = (x[keep] for x in (d, p, i, j, right, left))
        if far.any():
            if deep is None:
                deep = _Extensions(codes, starts, sizes, np.unique(d[(right == NEAR) | (left == NEAR)]))
            at = np.flatnonzero(right == NEAR)
            right[at] = deep.forward(d[at], i[at], j[at])
            at = np.flatnonzero(left == NEAR)
            left[at] = deep.backward(d[at], i[at], j[at])
        whole = np.flatnonzero(right + left + p >= np.maximum(LEAST, TIMES * p))
        rows = np.stack([d, i - left, j + right, p], axis=1)[whole]
        found.append(_smallest(rows))
    return _smallest(np.concatenate(found)) if found else np.zeros((0, 4), np.int64)


def _smallest(rows: np.ndarray) -> np.ndarray:
    """Of equal stretches the one of the smallest period, in order of document, start and period."""
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def runs_in(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows (document, start, end, period): all runs of the documents of a block.

    ``codes``: positive numbers of words, one 0 before each document and ``NEAR`` at the end;
    ``starts``: place of the first word of each document.
    """
    docs = np.flatnonzero(sizes >= LEAST)
    if not len(docs):
        return np.zeros((0, 4), np.int64)
    n = sizes[docs].astype(np.float64)
    pairs = np.cumsum(n * (np.log(n) + 1) / (TIMES - 1))  # an upper estimate, to form groups
    group = (pairs // PAIRS).astype(np.int64)
    cut = np.flatnonzero(np.diff(group)) + 1
    return np.concatenate([_runs_of(codes, starts, sizes, some) for some in np.split(docs, cut)])


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of a block, and for each row (and once more at the end) the number of its first."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.concatenate([[False], inside]), np.concatenate([inside, [False]])
    start = np.flatnonzero(after & (~before | edge))
    end = np.flatnonzero(before & (~after | edge))
    ends = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=ends[1:])
    kept = np.ascontiguousarray(data[inside])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(kept)]
    )
    return words, np.searchsorted(start, offsets)


def _found(batches: Iterator[pa.RecordBatch]):
    common.release()
    for batch, data, offsets in common.blocks(batches):
        words, first = _words(data, offsets)
        sizes = np.diff(first)
        n, rows = len(words), len(sizes)
        numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int32)
        codes = np.zeros(n + rows + NEAR + 1, np.int32)
        place = np.arange(n) + np.repeat(np.arange(rows), sizes) + 1
        codes[place] = numbers + 1
        starts = first[:-1] + np.arange(rows) + 1
        runs = runs_in(codes, starts, sizes)
        doc, start, end, period = runs.T
        change = np.zeros(n + 1, np.int64)
        shift = np.arange(rows) + 1  # from places to numbers of words in the block
        np.add.at(change, start + period - shift[doc], 1)
        np.add.at(change, end - shift[doc], -1)
        stays = np.cumsum(change[:-1]) == 0
        kept_first = np.concatenate([[0], np.cumsum(stays)])[first]
        left = words.filter(pa.array(stays)) if not stays.all() else words
        lines = pa.LargeListArray.from_arrays(pa.array(kept_first, pa.int64()), left)
        collapsed = pc.binary_join(lines, pa.scalar(b" ", pa.large_binary()))
        values = pa.StructArray.from_arrays(
            [pa.array(start - starts[doc]), pa.array(end - start), pa.array(period)], fields=list(RUN.value_type)
        )
        bounds = np.searchsorted(doc, np.arange(rows + 1))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values),
                collapsed.cast(pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )


def find(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, runs by start and period, and ``collapsed``, the words that no
    run holds after its first period, joined by single spaces."""
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return own.mapInArrow(_found, FOUND)


def split_words(text: str) -> Column:
    """The words between white space (blank and U+0009 to U+000D)."""
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def repeat_tail(words: str, start: Column, period: Column) -> Column:
    """A list of words whose part from ``start`` on repeats its first ``period`` words."""
    n = F.size(words)
    times = F.ceil((n - start) / period).cast("int")
    head = F.slice(words, F.lit(1), start)
    tail = F.flatten(F.array_repeat(F.slice(words, start + 1, period), times))
    return F.concat(head, F.slice(tail, F.lit(1), n - start))
