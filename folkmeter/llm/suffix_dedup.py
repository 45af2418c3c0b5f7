"""Exact removal of repeated passages by a sparse suffix array, built by deep-shallow sorting.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts earlier: in a document of
smaller id, or in the same document further left. All is judged on the texts as they came in.

1. Anchors. In every window the 24-byte string of the least hash is its anchor, the leftmost if
   several are equal. Equal windows have equal anchors at equal places, and neighbouring windows
   mostly share theirs, so one row stands for a run of windows: a *fragment*, the bytes that the
   run covers. Some 2.6 % of all places are anchors, so only these suffixes are sorted.
2. Grouping. Rows go to ranges of (anchor, digest of the fragment). A fragment that occurred
   earlier word for word is settled there; what is alone in its anchor has no equal. For the rest
   the first of each kind of fragment has to be compared with the others of its anchor.
3. Texts. These fragments are cut out of the documents.
4. Sorting. Within an anchor, the suffixes that begin at the anchor and the reversed prefixes that
   end before it are ordered: multikey quicksort to a shallow depth, eight bytes a step, then
   blind tries for the groups that still agree. The common-prefix lengths of neighbours give, for
   every split of a window around the anchor, the classes of equal windows; all but the first of
   a class are repeats.
5. Removal. The byte ranges found meet their document.

Hot strings. Equal fragments are reduced to the first within each block of texts before any
shuffle. Ranges of (anchor, digest) split an anchor that a third of the table holds over many
tasks; the anchors at the borders of the ranges, and so all that span several, are compared by
single windows, dealt out by the window, and reduced within each block once more. No group is
capped.

Defined cases: a null text counts as empty; texts shorter than the window stay whole; a null id
comes before all others; rows that share an id but not the text are documents in the order of a
digest of the text; rows that repeat id and text are one document and get the same result; texts
are taken whole; other columns pass unchanged unless they bear the name of a result column. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folkmeter.llm import common

WINDOW = 100
ANCHOR = 24
SPLITS = WINDOW - ANCHOR + 1  # places of an anchor in a window
SHALLOW = 3  # steps of eight bytes before blind tries take over
PLACE_BITS = 21  # a segment of text is shorter than 2^21
SEGMENT = (1 << PLACE_BITS) - 2 * WINDOW
GROUP_ROWS = 200_000  # anchor rows taken at once in a task
CUT_ROWS = 2000  # documents from which fragments are cut at once
SORT_ROWS = 20_000  # fragments sorted at once in a task
_U = np.uint64
_LEAST = -(1 << 63)

ANCHORS = "anchor bigint, digest bigint, doc bigint, tag int, at int, place int, size int, settled boolean"
FOUND = "kind int, anchor bigint, doc bigint, tag int, at int, place int, size int"
FRAGMENTS = "kind int, key bigint, doc bigint, tag int, at int, place int, size int, bytes binary"
RANGES = "doc bigint, tag int, low int, high int"


def _identity(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, id_: str):
    """Two numbers by which a document is known: its id, and a digest of the text."""
    ids = batch.column(batch.schema.get_field_index(id_)).cast(pa.int64()).fill_null(_LEAST)
    view = memoryview(np.ascontiguousarray(data))
    tags = [
        xxhash.xxh32_intdigest(view[a:b]) - (1 << 31) for a, b in zip(offsets[:-1], offsets[1:])
    ]
    return ids.to_numpy(zero_copy_only=False), np.array(tags, np.int64)


def _hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 24 bytes from each place on."""
    base = common._BASE

    def join(x, y, shift):
        n = len(y) - shift
        return x[:n] * _U(pow(base, shift, 1 << 64)) + y[shift:]

    one = common.BYTE_CODES[data]
    two = join(one, one, 1)
    four = join(two, two, 2)
    eight = join(four, four, 4)
    sixteen = join(eight, eight, 8)
    n = len(data) - ANCHOR + 1
    return common.mix(sixteen[:n] * _U(pow(base, 8, 1 << 64)) + eight[16 : 16 + n])


def fragments(data: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Runs of windows with one anchor: (first window, last window, anchor place, anchor).

    ``low``, ``high``: places between which windows may start, per document, ``high`` excluded.
    """
    none = np.zeros(0, np.int64)
    if not (high > low).any():
        return none, none, none, none.astype(_U)
    hashes = _hashes(data)
    mask = _U((1 << PLACE_BITS) - 1)
    least = (hashes & ~mask) | np.arange(len(hashes), dtype=_U)
    width = 1
    while width * 2 <= SPLITS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = SPLITS - width
    least = np.minimum(least[: len(least) - rest], least[rest:])
    allowed = np.zeros(len(data) + 1, np.int64)
    use = high > low
    np.add.at(allowed, low[use], 1)
    np.add.at(allowed, high[use], -1)
    window = np.flatnonzero(np.cumsum(allowed)[: len(least)])
    place = (least[window] & mask).astype(np.int64)
    new = np.ones(len(window), bool)
    new[1:] = (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    place = place[first]
    return window[first], window[last], place, hashes[place]


def _segments(data: np.ndarray, offsets: np.ndarray):
    """(bytes, first byte, window limits, rows) of pieces short enough for PLACE_BITS."""
    low, high = offsets[:-1], offsets[1:] - WINDOW + 1
    if len(data) <= SEGMENT:
        yield data, 0, low, high, np.arange(len(low))
        return
    for row in range(len(low)):
        for at in range(int(low[row]), max(int(high[row]), int(low[row])), SEGMENT):
            to = min(at + SEGMENT, int(high[row]))
            piece = data[at : to + WINDOW - 1]
            yield piece, at, np.array([0]), np.array([to - at]), np.array([row])


def _anchors(batches: Iterator[pa.RecordBatch], id_: str, text: str):
    common.release()
    for batch, data, offsets in common.blocks(batches, text):
        doc, tag = _identity(batch, data, offsets, id_)
        parts = []
        for piece, base, low, high, rows in _segments(data, offsets):
            a, b, place, anchor = fragments(piece, low, high)
            if not len(a):
                continue
            view = memoryview(np.ascontiguousarray(piece))
            digest = np.fromiter(
                (xxhash.xxh3_64_intdigest(view[x : y + WINDOW]) for x, y in zip(a.tolist(), b.tolist())),
                _U,
                len(a),
            )
            row = rows[np.searchsorted(low, a, side="right") - 1]
            parts.append((anchor, digest, row, a + base - offsets[row], place - a, b - a + 1))
        if not parts:
            continue
        anchor, digest, row, at, place, size = (np.concatenate(x) for x in zip(*parts))
        anchor, digest = anchor.astype(np.int64), digest.astype(np.int64)
        order = np.lexsort((at, tag[row], doc[row], digest, anchor))
        anchor, digest, row, at, place, size = (
            x[order] for x in (anchor, digest, row, at, place, size)
        )
        twin = np.zeros(len(row), bool)
        twin[1:] = (anchor[1:] == anchor[:-1]) & (digest[1:] == digest[:-1])
        same = np.zeros(len(row), bool)  # the same document once more
        same[1:] = twin[1:] & (at[1:] == at[:-1])
        same[1:] &= (doc[row[1:]] == doc[row[:-1]]) & (tag[row[1:]] == tag[row[:-1]])
        # What is settled here needs no group any more: it goes to a range by chance, so a string
        # that fills the table reaches the task of its anchor once per block.
        stray = common.mix(anchor.astype(_U) ^ common.mix(doc[row].astype(_U) + (at.astype(_U) << _U(40))))
        anchor = np.where(twin, stray.astype(np.int64), anchor)
        columns = [anchor, digest, doc[row], tag[row], at, place, size, twin]
        kinds = [np.int64] * 3 + [np.int32] * 4 + [bool]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[~same].astype(k)) for c, k in zip(columns, kinds)],
            names=["anchor", "digest", "doc", "tag", "at", "place", "size", "settled"],
        )


def _tables(batches: Iterator[pa.RecordBatch], rows: int, by: str) -> Iterator[tuple[dict, bool]]:
    """Runs of about ``rows`` sorted rows that end where ``by`` changes; and whether it is the last."""
    held: list[pa.RecordBatch] = []
    size = 0

    def columns(table: pa.Table) -> dict:
        return {n: c.combine_chunks() for n, c in zip(table.schema.names, table.columns)}

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            table = pa.Table.from_batches(held)
            value = table.column(by).to_numpy()
            cut = int(np.searchsorted(value, value[-1]))
            if cut:
                yield columns(table.slice(0, cut)), False
                held = table.slice(cut).combine_chunks().to_batches()
                size = table.num_rows - cut
    if held:
        yield columns(pa.Table.from_batches(held)), True


def _group(batches: Iterator[pa.RecordBatch]):
    """Rows in the order of (anchor, digest, doc, tag, at): settle what is equal, ask for the rest.

    Kind 0: a repeat. Kind 1: to be compared within its anchor. Kind 2: the same, window by window,
    because the anchor may go on in another task.
    """
    begun = False
    for columns, last in _tables(batches, GROUP_ROWS, "anchor"):
        c = {n: columns[n].to_numpy(zero_copy_only=False) for n in columns}
        n = len(c["anchor"])
        first = np.ones(n, bool)
        first[1:] = c["anchor"][1:] != c["anchor"][:-1]
        kind_first = first.copy()
        kind_first[1:] |= c["digest"][1:] != c["digest"][:-1]
        same = np.zeros(n, bool)
        same[1:] = ~kind_first[1:]
        for name in ("doc", "tag", "at"):
            same[1:] &= c[name][1:] == c[name][:-1]
        group = np.cumsum(first) - 1
        kinds = np.bincount(group, kind_first)
        kind = np.where(kind_first, np.where(kinds[group] > 1, 1, -1), 0)
        border = np.zeros(kinds.shape, bool)
        border[0] |= not begun
        border[-1] |= last
        begun = True
        kind = np.where(border[group] & kind_first, 2, kind)
        kind = np.where(c["settled"], 0, kind)
        use = (kind >= 0) & ~same
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind[use].astype(np.int32))]
            + [pa.array(c[x][use]) for x in ("anchor", "doc", "tag", "at", "place", "size")],
            names=["kind", "anchor", "doc", "tag", "at", "place", "size"],
        )


def _packed(batches: Iterator[pa.RecordBatch], id_: str, text: str, names: list[str]):
    """The rows with their identity, and the text compressed for the way."""
    tool = zstandard.ZstdCompressor(3)
    for batch, data, offsets in common.blocks(batches, text):
        doc, tag = _identity(batch, data, offsets, id_)
        packed = [tool.compress(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        own = [batch.column(batch.schema.get_field_index(n)) for n in names]
        yield pa.RecordBatch.from_arrays(
            [*own, pa.array(doc), pa.array(tag.astype(np.int32)), pa.array(packed, pa.binary())],
            names=[*names, "_doc", "_tag", "_packed"],
        )


def _mark(docs: DataFrame, id_: str, text: str, names: list[str]) -> DataFrame:
    fields = [docs.schema[n] for n in names]
    schema = T.StructType(
        [
            *fields,
            T.StructField("_doc", T.LongType()),
            T.StructField("_tag", T.IntegerType()),
            T.StructField("_packed", T.BinaryType()),
        ]
    )
    return docs.mapInArrow(lambda it: _packed(it, id_, text, names), schema)


def _cut(batches: Iterator[pa.RecordBatch]):
    """Fragments of the documents; windows of border anchors one by one, each once per batch."""
    tool = zstandard.ZstdDecompressor()
    for batch in (b.slice(at, CUT_ROWS) for b in batches for at in range(0, b.num_rows, CUT_ROWS)):
        rows: list[tuple] = []
        windows: dict[bytes, tuple] = {}
        docs = zip(*(batch.column(n).to_pylist() for n in ("_doc", "_tag", "_packed", "asked")))
        for doc, tag, packed, asked in docs:
            raw = tool.decompress(packed)
            for want in asked:
                at, place, size = want["at"], want["place"], want["size"]
                if want["kind"] == 1:
                    rows.append((1, want["anchor"], doc, tag, at, place, size, raw[at : at + size + WINDOW - 1]))
                    continue
                for j in range(size):
                    window = raw[at + j : at + j + WINDOW]
                    mine = (doc, tag, at + j, place - j)
                    held = windows.setdefault(window, mine)
                    if held[:3] != mine[:3]:
                        windows[window], late = min(held, mine), max(held, mine)
                        rows.append((0, xxhash.xxh3_64_intdigest(window) - (1 << 63), *late, 1, b""))
        for window, (doc, tag, at, place) in windows.items():
            rows.append((1, xxhash.xxh3_64_intdigest(window) - (1 << 63), doc, tag, at, place, 1, window))
        if rows:
            kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.binary()]
            names = ["kind", "key", "doc", "tag", "at", "place", "size", "bytes"]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            whole = pa.RecordBatch.from_arrays(arrays, names=names)
            for low in range(0, len(rows), 10_000):
                yield whole.slice(low, 10_000)


# ---- deep-shallow sorting ---------------------------------------------------------------


def _quicksort(steps: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of rows by their first SHALLOW steps, all ranges side by side.

    Each round splits every open range into the rows whose step at the range's depth is smaller
    than, equal to and greater than a pivot; the middle part goes one step deeper. Returns the
    order, and the range of each place; a range that still has several rows agrees in all steps.
    """
    n = len(group)
    order = np.argsort(group, kind="stable")
    range_ = np.cumsum(np.concatenate([[False], np.diff(group[order]) != 0]).astype(int))
    depth = np.zeros(n, np.int64)
    open_ = np.arange(n)
    while True:
        size = np.bincount(range_)
        open_ = open_[(size[range_[open_]] > 1) & (depth[open_] < SHALLOW)]
        if not len(open_):
            return order, range_
        mine = range_[open_]
        starts = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
        count = np.diff(np.append(starts, len(mine)))
        local = np.repeat(np.arange(len(starts)), count)
        value = steps[order[open_], depth[open_]]
        pivot = value[starts + count // 2][local]
        side = np.where(value < pivot, 0, np.where(value == pivot, 1, 2))
        moved = np.argsort(local * 3 + side, kind="stable")
        order[open_] = order[open_[moved]]
        code = (local * 3 + side)[moved]
        depth[open_] += side[moved] == 1
        step = np.zeros(n, np.int64)
        step[open_[1:]] = (code[1:] != code[:-1]) & (local[1:] == local[:-1])
        edge = np.concatenate([[0], np.diff(range_)]) > 0
        range_ = np.cumsum(edge | (step > 0))


class BlindTrie:
    """Orders strings by inserting them under the places where they differ.

    A node holds a depth and children by byte. The way down looks only at the bytes at the depths
    of the nodes; one comparison with the string found there gives the depth of the new branch.
    """

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root = [0]  # a leaf is a list of numbers, a node a tuple (depth, children)
        for i in range(1, len(strings)):
            self._insert(i)

    def _insert(self, i: int) -> None:
        text, node = self.strings[i], self.root
        while isinstance(node, tuple):
            child = node[1].get(text[node[0]])
            node = child if child is not None else next(iter(node[1].values()))
        other = self.strings[node[0]]
        if other == text:
            node.append(i)
            return
        differ = int.from_bytes(text, "big") ^ int.from_bytes(other, "big")
        depth = len(text) - (differ.bit_length() + 7) // 8
        above, node = None, self.root
        while isinstance(node, tuple) and node[0] < depth:
            above, node = node, node[1][text[node[0]]]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][text[depth]] = [i]
            return
        new = (depth, {other[depth]: node, text[depth]: [i]})
        if above is None:
            self.root = new
        else:
            above[1][text[above[0]]] = new

    def order(self) -> list[int]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if isinstance(node, list):
                out += node
            else:
                todo += [node[1][b] for b in sorted(node[1], reverse=True)]
        return out


def deep_shallow(rows: np.ndarray, length: np.ndarray, group: np.ndarray):
    """Order of padded byte rows within groups, and with how many bytes each place agrees with
    the place before it (-1 at the start of a group)."""
    width = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), max(width, SHALLOW * 8)), np.uint8)
    padded[:, : rows.shape[1]] = rows
    order, range_ = _quicksort(padded.view(">u8").astype(_U), group)
    size = np.bincount(range_)
    starts = np.concatenate([[0], np.cumsum(size)])[:-1]
    for at, n in zip(starts[size > 1].tolist(), size[size > 1].tolist()):
        members = order[at : at + n]
        trie = BlindTrie([padded[i].tobytes() for i in members])
        order[at : at + n] = members[trie.order()]
    a, b = order[:-1], order[1:]
    differ = padded[a] != padded[b]
    common_ = np.where(differ.any(axis=1), differ.argmax(axis=1), padded.shape[1])
    common_ = np.minimum(common_, np.minimum(length[a], length[b]))
    return order, np.concatenate([[-1], np.where(group[a] == group[b], common_, -1)])


def _matrix(data: np.ndarray, start: np.ndarray, length: np.ndarray, width: int, step: int):
    """Rows of ``width`` bytes from ``start`` on (backwards for step -1), zero after ``length``."""
    inside = np.arange(width)[None, :] < length[:, None]
    place = start[:, None] + step * np.arange(width)[None, :]
    return np.where(inside, data[np.clip(place, 0, len(data) - 1)], 0).astype(np.uint8)


def repeats(data, start, group, place, size, rank) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeated windows of fragments: (fragment, first window, end of the windows).

    ``start``: of the fragment in ``data``; ``place``: of the anchor in it; ``size``: number of
    its windows; ``rank``: order of the fragments by (doc, tag, at).
    """
    n = len(start)
    right_length = size + WINDOW - 1 - place
    right = _matrix(data, start + place, np.minimum(right_length, WINDOW), WINDOW, 1)
    left = _matrix(data, start + place - 1, np.minimum(place, SPLITS - 1), SPLITS - 1, -1)
    r_order, r_common = deep_shallow(right, np.minimum(right_length, WINDOW), group)
    l_order, l_common = deep_shallow(left, np.minimum(place, SPLITS - 1), group)
    by_rank = np.argsort(rank, kind="stable")
    dup = np.zeros((n, SPLITS + 1), np.int8)
    l_class, r_class = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for before in range(SPLITS):  # bytes of the window before its anchor
        has = by_rank[(before <= place[by_rank]) & (before > place[by_rank] - size[by_rank])]
        if len(has) < 2:
            continue
        l_class[l_order] = np.cumsum(l_common < before)
        r_class[r_order] = np.cumsum(r_common < WINDOW - before)
        code = l_class[has] * (n + 1) + r_class[has]
        order = np.argsort(code, kind="stable")
        again = np.zeros(len(has), bool)
        again[1:] = code[order][1:] == code[order][:-1]
        late = has[order[again]]
        dup[late, place[late] - before] = 1
    step = np.diff(dup, axis=1, prepend=0)
    row, low = np.nonzero(step == 1)
    _, high = np.nonzero(step == -1)
    return row, low, high


def _sort(batches: Iterator[pa.RecordBatch]):
    for columns, _ in _tables(batches, SORT_ROWS, "key"):
        kind = columns["kind"].to_numpy()
        raw, offsets = common.utf8(columns["bytes"])
        c = {n: columns[n].to_numpy().astype(np.int64) for n in ("key", "doc", "tag", "at", "place", "size")}
        order = np.lexsort((c["at"], c["tag"], c["doc"], c["key"]))
        order = order[kind[order] == 1]
        same = np.ones(len(order), bool)  # a repeated row of one document
        for name in ("key", "doc", "tag", "at"):
            same[1:] &= c[name][order][1:] == c[name][order][:-1]
        same[:1] = False
        order = order[~same]
        key = c["key"][order]
        count = np.bincount(np.cumsum(np.concatenate([[0], np.diff(key) != 0]).astype(int))) if len(key) else key
        several = np.repeat(count > 1, count) if len(key) else np.zeros(0, bool)
        order, key = order[several], key[several]
        done = kind == 0
        out = [[c[n][done] for n in ("doc", "tag")] + [c["at"][done], c["at"][done] + WINDOW]]
        if len(order):
            group = np.cumsum(np.concatenate([[0], np.diff(key) != 0]).astype(int))
            row, low, high = repeats(
                raw, offsets[order], group, c["place"][order], c["size"][order], np.arange(len(order))
            )
            who = order[row]
            at = c["at"][who]
            out.append([c["doc"][who], c["tag"][who], at + low, at + high - 1 + WINDOW])
        doc, tag, low, high = (np.concatenate(x) for x in zip(*out))
        if len(doc):
            kinds = (np.int64, np.int32, np.int32, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.astype(k)) for x, k in zip((doc, tag, low, high), kinds)],
                names=["doc", "tag", "low", "high"],
            )


def ranges(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """RANGES: byte ranges [low, high) of repeats per document; they may overlap."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(id_, text).mapInArrow(lambda it: _anchors(it, id_, text), ANCHORS)
    order = ["anchor", "digest", "doc", "tag", "at"]
    dealt = rows.repartitionByRange(parts, "anchor", "digest").sortWithinPartitions(*order)
    found = common.stored(dealt.mapInArrow(_group, FOUND), "anchors")
    asked = found.filter("kind > 0").groupBy("doc", "tag").agg(
        F.collect_list(F.struct("kind", "anchor", "at", "place", "size")).alias("asked")
    )
    asked = asked.select(F.col("doc").alias("_doc"), F.col("tag").alias("_tag"), "asked")
    texts = _mark(docs.select(id_, text), id_, text, []).join(asked.hint("shuffle_hash"), ["_doc", "_tag"])
    cut = texts.mapInArrow(_cut, FRAGMENTS)
    compared = cut.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_sort, RANGES)
    settled = found.filter("kind = 0").select(
        "doc", "tag", F.col("at").alias("low"), (F.col("at") + F.col("size") + (WINDOW - 1)).alias("high")
    )
    return settled.unionAll(compared)


def merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal ranges of a union of ranges."""
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > high[:-1]
    return low[new], high[np.append(np.flatnonzero(new)[1:] - 1, len(low) - 1)] if len(low) else high


def without(raw: bytes, low: np.ndarray, high: np.ndarray) -> bytes:
    parts, at = [], 0
    for a, b in zip(low.tolist(), high.tolist()):
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def whole_characters(raw: bytes, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges drawn in to the borders of UTF-8 characters, so that no character is torn."""
    data = np.frombuffer(raw, np.uint8)
    inner = np.append((data & 0xC0) == 0x80, False)  # a byte within a character
    outs = []
    for a, b in zip(low.tolist(), high.tolist()):
        while a < b and inner[a]:
            a += 1
        while b > a and inner[b]:
            b -= 1
        if a < b:
            outs.append((a, b))
    pairs = np.array(outs, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


RESULT = [
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("n_spans", T.LongType()),
    T.StructField("kept_sha256", T.StringType()),
]


def _remove(batches: Iterator[pa.RecordBatch], names: list[str], text: str | None, nulls: str | None):
    tool = zstandard.ZstdDecompressor()
    for batch in batches:
        packed, found = batch.column("_packed").to_pylist(), batch.column("_ranges").to_pylist()
        out, texts = [], []
        for blob, spans in zip(packed, found):
            raw = tool.decompress(blob)
            flat = np.array([(s["low"], s["high"]) for s in spans or []], np.int64).reshape(-1, 2)
            low, high = merged(flat[:, 0], flat[:, 1])
            if text is None:
                kept = without(raw, low, high)
                digest = hashlib.sha256(kept).hexdigest()
                out.append((len(raw), len(raw) - len(kept), len(low), digest))
            else:
                texts.append(without(raw, *whole_characters(raw, low, high)).decode())
        columns = {n: batch.column(n) for n in names if n != text}
        if text is None:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            columns |= {f.name: pa.array(v, k) for f, v, k in zip(RESULT, zip(*out), kinds)} if out else {}
        else:
            null = batch.column(nulls).to_pylist()
            columns[text] = pa.array([None if x else t for x, t in zip(null, texts)], pa.string())
        if batch.num_rows:
            wanted = names if text is not None else [*names, *(f.name for f in RESULT)]
            yield pa.RecordBatch.from_arrays([columns[n] for n in wanted], names=wanted)


def _joined(marked: DataFrame, found: DataFrame) -> DataFrame:
    spans = found.groupBy("doc", "tag").agg(F.collect_list(F.struct("low", "high")).alias("_ranges"))
    spans = spans.select(F.col("doc").alias("_doc"), F.col("tag").alias("_tag"), "_ranges")
    return marked.join(spans.hint("shuffle_hash"), ["_doc", "_tag"], "left")


def report(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the text, with RESULT: what is removed, and the digest of what is kept."""
    names = [c for c in docs.columns if c != text and c not in {f.name for f in RESULT}]
    schema = T.StructType([docs.schema[n] for n in names] + RESULT)
    joined = _joined(_mark(docs, id_, text, names), ranges(docs, id_, text))
    return joined.mapInArrow(lambda it: _remove(it, names, None, None), schema)


def clean(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the repeats cut out of the texts; a character goes if all its bytes go."""
    own = {c: f"_in{i}" for i, c in enumerate(docs.columns) if c != text}
    named = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in own.items()],
        F.col(f"`{text}`").alias("_text"),
        F.col(f"`{text}`").isNull().alias("_null"),
    )
    names = list(own.values())
    marked = _mark(named, own[id_], "_text", [*names, "_null"])
    order = [own.get(c, "_text") for c in docs.columns]
    schema = T.StructType([named.schema[n] for n in order])
    joined = _joined(marked, ranges(docs.select(id_, text), id_, text))
    out = joined.mapInArrow(lambda it: _remove(it, order, "_text", "_null"), schema)
    return out.toDF(*docs.columns)
