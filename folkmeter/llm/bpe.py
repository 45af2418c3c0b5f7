"""Byte-level BPE by backtracking over longest matches, and decoding.

The bytes of a piece are mapped to Latin-1 so that an Aho-Corasick automaton of the vocabulary
(pyahocorasick works on text) finds the longest token at each place. The encoder takes the
longest token, goes on, and falls back to the next shorter one where two neighbours would not
stay apart under the merges; a place from which no end is reached is never tried again, so the
work is linear in the length of the piece. Two tokens stay apart if merging their joined bytes
gives just these two, which is remembered per pair. The result equals the merges exactly: a
sequence is what the merges give if and only if all its neighbours are.

Texts are cut into pieces by the tokenizer's pattern. Since words come again and again, the ids
of a stretch between spaces are kept in a cache of bounded size per worker.

Defined cases: a null text counts as empty and has no tokens; repeated rows are encoded each;
pieces of any length are taken whole; other columns pass unchanged unless they bear the name of
a result column, which then replaces them. Only the rank file decides; there are no special tokens.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from folkmeter.llm import common

CACHE_CHUNKS = 150_000  # remembered stretches, per generation
CACHE_PAIRS = 300_000  # remembered pairs of tokens

#: White space as the tokenizer's pattern sees it (Unicode property White_Space).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A stretch that no match of the pattern leaves: a space before a non-space that follows a
#: non-space always starts a match.
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


class Generations:
    """A cache that keeps what was used lately: two generations of at most ``size`` entries."""

    def __init__(self, make, size: int):
        self.make, self.size, self.young, self.old = make, size, {}, {}

    def __getitem__(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is None:
                found = self.make(key)
            if len(self.young) >= self.size:
                self.old, self.young = self.young, {}
            self.young[key] = found
        return found


class Codec:
    """Encodes and decodes by one rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.pattern = regex.compile(pattern)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.halves: dict[int, tuple[int, int]] = {}  # the last merge of each token
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            if self.merged(token) == [rank]:  # others are never made by the merges
                self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.shorter: dict[int, int | None] = {}
        self.pairs: dict[int, bool] = {}
        self.chunks = Generations(self._chunk, CACHE_CHUNKS)
        sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.sizes, self.places = sizes, np.concatenate([[0], np.cumsum(sizes)])
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.decimal = [str(i) for i in range(len(self.tokens))]

    def merged(self, piece: bytes) -> list[int]:
        """The merges carried out one by one: lowest rank first, then leftmost. For short input."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            found = [self.ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            best = min(found)
            if best == 1 << 60:
                break
            if len(parts) == 2:
                self.halves[best] = (self.ranks[parts[0]], self.ranks[parts[1]])
            at = found.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def apart(self, left: int, right: int) -> bool:
        """Whether the merges of the joined bytes give these two tokens; remembered per pair."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._never_joined(left, right)
        return known

    def _never_joined(self, a: int, b: int) -> bool:
        """Goes back in time from the two tokens along the seam. The two parts that meet there
        would have joined if their own merge came before the next merge of either part; of merges
        of one rank the left one comes first."""
        halves, tokens, ranks = self.halves, self.tokens, self.ranks
        until_a = until_b = 1 << 60
        while True:
            joined = ranks.get(tokens[a] + tokens[b])
            if joined is not None and joined < until_a and joined <= until_b:
                return False
            made_a, made_b = (a if a in halves else -1), (b if b in halves else -1)
            if made_a > made_b:
                until_a, a = a, halves[a][1]
            elif made_b >= 0:
                until_b, b = b, halves[b][0]
            else:
                return True

    def next_shorter(self, rank: int) -> int | None:
        """The longest other token that starts this one."""
        if rank not in self.shorter:
            token = self.tokens[rank].decode("latin-1")
            cuts = (token[:n] for n in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next(
                (self.automaton.get(c)[1] for c in cuts if c in self.automaton), None
            )
        return self.shorter[rank]

    def piece(self, piece: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest, length = [-1] * n, [0] * n
        for end, (size, rank) in self.automaton.iter(piece.decode("latin-1")):
            start = end - size + 1
            if size > length[start]:
                length[start], longest[start] = size, rank
        out: list[int] = []
        open_ = bytearray(b"\1" * (n + 1))  # 0: no end is reached from here
        at, token = 0, longest[0]
        while at < n:
            end = at + len(self.tokens[token])
            if open_[end] and (not out or self.apart(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
                continue
            shorter = self.next_shorter(token)
            if shorter is not None:
                token = shorter
                continue
            open_[at] = 0
            token = out.pop()
            at -= len(self.tokens[token])
        return out

    def _chunk(self, chunk: str) -> bytes:
        ids = [i for m in self.pattern.findall(chunk) for i in self.piece(m.encode())]
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        chunks = self.chunks
        return np.frombuffer(b"".join([chunks[c] for c in CHUNK.findall(text)]), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.places[ids] - (ends - sizes), sizes)
        return self.bytes[shift + np.arange(ends[-1])].tobytes()


def codec(path: str, pattern: str) -> Codec:
    return common.resident(("bpe", path, pattern), lambda: Codec(path, pattern))


def _replaced(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if n not in new}
    kept.update(new)
    return pa.RecordBatch.from_arrays(list(kept.values()), names=list(kept))


def _run(df: DataFrame, work, new: list[T.StructField]) -> DataFrame:
    names = {f.name for f in new}
    fields = [f for f in df.schema.fields if f.name not in names] + new
    return df.mapInArrow(work, T.StructType(fields))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of each text as an array."""

    def work(batches: Iterator[pa.RecordBatch]):
        tool = codec(path, pattern)
        for batch, *_ in common.blocks(batches, text):
            lists = [tool.encode(t or "").astype(np.int32) for t in batch.column(text).to_pylist()]
            yield _replaced(batch, {ids: pa.array(lists, pa.list_(pa.int32()))})

    return _run(df, work, [T.StructField(ids, T.ArrayType(T.IntegerType()))])


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids stand for."""

    def work(batches: Iterator[pa.RecordBatch]):
        tool = codec(path, pattern)
        for batch in batches:
            lists = [np.array(i or [], np.int64) for i in batch.column(ids).to_pylist()]
            yield _replaced(batch, {to: pa.array([tool.decode(i) for i in lists], pa.binary())})

    return _run(df, work, [T.StructField(to, T.BinaryType())])


ROUND_TRIP = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
]


def round_trip(
    df: DataFrame, path: str, pattern: str, text: str = "text", ids: str | None = None
) -> DataFrame:
    """``df`` without the text, with the digests of its ids and of the bytes decoded from them,
    and with the ids themselves in column ``ids`` if that is named.

    Encoding and decoding happen in one pass over the rows; no shuffle.
    """
    new_fields = ROUND_TRIP + ([T.StructField(ids, T.ArrayType(T.IntegerType()))] if ids else [])
    new_names = [f.name for f in new_fields]
    kept = [f for f in df.schema.fields if f.name != text and f.name not in new_names]
    names = [f.name for f in kept] + new_names

    def work(batches: Iterator[pa.RecordBatch]):
        tool = codec(path, pattern)
        say, sha = tool.decimal.__getitem__, hashlib.sha256
        for batch, *_ in common.blocks(batches, text):
            lists = [tool.encode(t or "") for t in batch.column(text).to_pylist()]
            said = [sha(",".join(map(say, i.tolist())).encode()).hexdigest() for i in lists]
            back = [sha(tool.decode(i)).hexdigest() for i in lists]
            new = {
                "n_tokens": pa.array([len(i) for i in lists], pa.int64()),
                "ids_sha256": pa.array(said, pa.string()),
                "decoded_sha256": pa.array(back, pa.string()),
            }
            if ids:
                new[ids] = pa.array([i.astype(np.int32) for i in lists], pa.list_(pa.int32()))
            yield _replaced(batch, new).select(names)

    return df.mapInArrow(work, T.StructType(kept + new_fields))
