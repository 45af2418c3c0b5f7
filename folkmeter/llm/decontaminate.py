"""Benchmark decontamination by a generalised suffix automaton of the test items.

Words are runs of ASCII digits, ASCII letters (lower-cased) and characters other than ASCII.
A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is
one window. The items become one automaton over word numbers. Training words are streamed
through it, which gives at each word the longest match that ends there; where it reaches a
window, all words of the window are hit. A run of words whose neighbours never follow each other
in an item cannot hold a window, so only the other runs are streamed; no run is left out
because of its length or number.

The items are sent to the tasks in blocks of bounded size. With several blocks the documents
pass them one after the other in the same job, carrying the hits found so far, so the benchmark
has no limit.

Defined cases: a null or empty text has no words and no hits; an item that is null or without
words has no window; a null ``item_id`` counts as the empty name; items that share an id count
once; repeated document rows are judged each; other columns of the documents pass unchanged
unless they bear the name of a result column, which then replaces them. Empty tables give no
rows, or rows without hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folkmeter.llm import common

WINDOW = 10
MAX_SHARE = 0.8  # a document with a larger share of hit words is dropped by ``clean``
BLOCK_WORDS = 200_000  # items in one automaton
_PAIR = 1 << 32

CARRIED = [
    T.StructField("_hit_words", T.ArrayType(T.LongType())),  # first, end, first, end, ...
    T.StructField("_hit_items", T.ArrayType(T.StringType())),
    T.StructField("_longest", T.LongType()),
]
RESULT = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
    T.StructField("longest_match", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.LongType())),  # byte places, in pairs
]


class SuffixAutomaton:
    """All factors of several sequences of word numbers."""

    def __init__(self, sequences: list[list[int]], window: int, names: list[str]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.window = [-1], [0], window
        for words in sequences:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.windows: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for words, name in zip(sequences, names):
            state = matched = 0
            for word in words:
                state, matched = self.step(state, matched, word)
                if matched >= window:
                    self.windows.setdefault(self.cut(state), set()).add(name)
            if 0 < len(words) < window:
                self.short.setdefault(state, {}).setdefault(len(words), set()).add(name)

    def _new(self, length: int, after: dict[int, int], link: int) -> int:
        self.next.append(after)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The state of the strings of ``target`` that are one word longer than ``state``."""
        if self.length[target] == self.length[state] + 1:
            return target
        clone = self._new(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return self._split(last, word, known)
        new = self._new(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word, self.next[state][word])
        return new

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        while state and word not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        after = self.next[state].get(word)
        return (0, 0) if after is None else (after, matched + 1)

    def cut(self, state: int) -> int:
        """The state of the last ``window`` words of a longer match."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def stream(self, words: list[int | None]) -> tuple[list[tuple[int, int]], set[str], int]:
        """Hit stretches (first, end), the items hit, and the longest match."""
        hits: list[tuple[int, int]] = []
        items: set[str] = set()
        state = matched = longest = 0
        for place, word in enumerate(words):
            if word is None:
                state = matched = 0
                continue
            state, matched = self.step(state, matched, word)
            longest = max(longest, matched)
            if matched >= self.window:
                hits.append((place + 1 - self.window, place + 1))
                items |= self.windows[self.cut(state)]
            if self.short:
                above = state
                while above > 0:
                    for size, names in self.short.get(above, {}).items():
                        if size <= matched:
                            hits.append((place + 1 - size, place + 1))
                            items |= names
                    above = self.link[above]
        return hits, items, longest


class Block:
    """A bounded number of items, ready to be searched for."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        names = [name for name, _ in items]
        data, offsets = common.utf8(pa.array([text for _, text in items], pa.string()))
        found = common.Words(data, offsets)
        plain = common.WORD_BYTES[data]
        self.numbers: dict[bytes, int] = {}
        sequences: list[list[int]] = [[] for _ in items]
        for start, end, row in zip(found.start, found.end, found.doc):
            word = plain[start:end].tobytes()
            sequences[row].append(self.numbers.setdefault(word, len(self.numbers)))
        self.automaton = SuffixAutomaton(sequences, window, names)
        self.shortest = min([window, *(len(s) for s in sequences if s)])
        words = [np.array(s, np.int64) for s in sequences]
        self.known, place = np.unique(found.hash, return_index=True)
        flat = np.concatenate([np.zeros(0, np.int64), *words])
        self.ids = flat[place]  # number of the word with each known hash
        pairs = [s[:-1] * _PAIR + s[1:] for s in words if len(s) > 1]
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *pairs]))

    def runs(self, found: common.Words) -> list[tuple[int, int]]:
        """Stretches of words (first, end) in which a window may lie."""
        n = len(found.hash)
        if not n or not len(self.known):
            return []
        at = np.minimum(np.searchsorted(self.known, found.hash), len(self.known) - 1)
        ids = np.where(self.known[at] == found.hash, self.ids[at], -1)
        code = ids[:-1] * _PAIR + ids[1:]
        ok = (ids[:-1] >= 0) & (ids[1:] >= 0) & (found.doc[:-1] == found.doc[1:])
        if len(self.pairs):
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            ok &= self.pairs[at] == code
        else:
            ok[:] = False
        starts = np.flatnonzero((ids >= 0) & ~np.concatenate([[False], ok]))
        ends = np.flatnonzero((ids >= 0) & ~np.concatenate([ok, [False]])) + 1
        long = ends - starts >= self.shortest
        return list(zip(starts[long].tolist(), ends[long].tolist()))


def _block(sent, window: int) -> Block:
    items = sent.value
    key = ("items", hashlib.sha256(repr(items).encode()).hexdigest(), window)
    return common.resident(key, lambda: Block(items, window))


def _merged(flat: np.ndarray) -> np.ndarray:
    """Pairs (first, end) with those that touch made one."""
    pairs = flat.reshape(-1, 2)
    if not len(pairs):
        return pairs
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.concatenate([[True], pairs[1:, 0] > reach[:-1]])
    return np.stack([pairs[new, 0], reach[np.concatenate([new[1:], [True]])]], axis=1)


def _search(block: Block, data: np.ndarray, found: common.Words, rows: int):
    """Per row: flat hit words, items, longest match."""
    hits: list[list[int]] = [[] for _ in range(rows)]
    items: list[set[str]] = [set() for _ in range(rows)]
    longest = [0] * rows
    for first, end in block.runs(found):
        row = int(found.doc[first])
        words = [
            block.numbers.get(common.WORD_BYTES[data[found.start[i] : found.end[i]]].tobytes())
            for i in range(first, end)
        ]
        places, names, best = block.automaton.stream(words)
        base = first - int(found.first[row])
        for a, b in places:
            hits[row] += (base + a, base + b)
        items[row] |= names
        longest[row] = max(longest[row], best)
    return hits, items, longest


def _put(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if n not in columns}
    kept.update(columns)
    return pa.RecordBatch.from_arrays(list(kept.values()), names=list(kept))


def _scan(batches: Iterator[pa.RecordBatch], sent, window: int, text: str, first: bool, last: bool):
    block = _block(sent, window)
    for batch, data, offsets in common.blocks(batches, text):
        rows = batch.num_rows
        found = common.Words(data, offsets)
        hits, items, longest = _search(block, data, found, rows)
        if not first:
            before = [batch.column(f.name).to_pylist() for f in CARRIED]
            hits = [a + b for a, b in zip(before[0], hits)]
            items = [set(a) | b for a, b in zip(before[1], items)]
            longest = [max(a, b) for a, b in zip(before[2], longest)]
        if not last:
            yield _put(
                batch,
                {
                    "_hit_words": pa.array(hits, pa.list_(pa.int64())),
                    "_hit_items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    "_longest": pa.array(longest, pa.int64()),
                },
            )
            continue
        n_words = np.diff(found.first)
        spans, n_hit = [], []
        for row in range(rows):
            merged = _merged(np.array(hits[row], np.int64))
            n_hit.append(int((merged[:, 1] - merged[:, 0]).sum()))
            merged = merged + found.first[row]
            ends = np.stack([found.start[merged[:, 0]], found.end[merged[:, 1] - 1]], axis=1)
            spans.append((ends - offsets[row]).ravel())
        keep = [n for n in batch.schema.names if n not in {f.name for f in CARRIED}]
        yield _put(
            batch.select(keep),
            {
                "n_words": pa.array(n_words, pa.int64()),
                "n_hit": pa.array(n_hit, pa.int64()),
                "n_items": pa.array([len(x) for x in items], pa.int64()),
                "items_sha256": pa.array(
                    [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items],
                    pa.string(),
                ),
                "contaminated": pa.array([n > 0 for n in n_hit], pa.bool_()),
                "longest_match": pa.array(longest, pa.int64()),
                "hit_spans": pa.array(spans, pa.list_(pa.int64())),
            },
        )


def _item_blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str, str]]]:
    block: list[tuple[str, str]] = []
    size = 0
    for row in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        if row["text"]:
            block.append((row["item_id"] or "", row["text"]))
            size += len(row["text"]) // 2 + 1  # at least the number of its words
        if size >= block_words:
            yield block
            block, size = [], 0
    yield block


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    block_words: int = BLOCK_WORDS,
    then=None,
) -> DataFrame:
    """``docs`` with the columns of RESULT. One pass over the texts for each block, no shuffle.

    ``then``: (function of the resulting batches, schema) that is to run in the last pass.
    """
    context = docs.sparkSession.sparkContext
    sent = [context.broadcast(block) for block in _item_blocks(benchmark, block_words)]
    out = docs
    for k, block in enumerate(sent):
        first, last = k == 0, k == len(sent) - 1
        new = RESULT if last else CARRIED
        drop = {f.name for f in [*new, *CARRIED]}
        fields = [f for f in out.schema.fields if f.name not in drop] + new
        schema = T.StructType(fields)
        if last and then is not None:
            work, schema = then
            out = out.mapInArrow(
                lambda it, b=block, f=first: work(_scan(it, b, window, text, f, True)), schema
            )
            continue
        out = out.mapInArrow(
            lambda it, b=block, f=first, z=last: _scan(it, b, window, text, f, z), schema
        )
    return out


def _without(batches: Iterator[pa.RecordBatch], text: str, columns: list[str], max_share: float):
    for batch, data, offsets in common.blocks(batches, text):
        share = max_share * batch.column("n_words").to_numpy()
        keep = pa.array(batch.column("n_hit").to_numpy() <= share)
        spans = batch.column("hit_spans").to_pylist()
        texts = batch.column(text).to_pylist()
        for row, cut in enumerate(spans):
            if cut:
                raw, at, parts = data[offsets[row] : offsets[row + 1]].tobytes(), 0, []
                for a, b in zip(cut[::2], cut[1::2]):
                    parts.append(raw[at:a])
                    at = b
                texts[row] = b"".join([*parts, raw[at:]]).decode()
        yield _put(batch, {text: pa.array(texts, pa.string())}).select(columns).filter(keep)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    max_share: float = MAX_SHARE,
    text: str = "text",
) -> DataFrame:
    """The columns of ``docs``: hit stretches are cut out of the texts, and documents with more
    than ``max_share`` of their words hit are dropped. Texts without a hit stay as they are."""
    marked = docs.withColumns({f"_in_{c}": F.col(c) for c in docs.columns if c != text})
    marked = marked.select(text, *[c for c in marked.columns if c.startswith("_in_")])
    names = [text if c == text else f"_in_{c}" for c in docs.columns]
    fields = [T.StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields)]
    then = (lambda it: _without(it, text, names, max_share), T.StructType(fields))
    return find(marked, benchmark, window, text, then=then).toDF(*docs.columns)
