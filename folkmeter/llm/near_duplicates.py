"""Near-duplicates by BagMinHash: signatures of multisets of word shingles.

A text is the multiset of its runs of five words (of all its words, if it has fewer), and two
texts are alike if the weighted Jaccard similarity (sum of minima over sum of maxima of the
counts) is 0.8 or more. Classes are the connected components of likeness.

Signature. The weights are cut into the intervals [0,1), [1,2), [2,4), [4,8), ... Each shingle has
in each interval a Poisson process with the interval's length as its rate; a point of it falls on
one of the ``HASHES`` entries and, in a wider interval, on one of its unit steps. A point counts
if its step lies below the weight of the shingle, and an entry is the earliest point that falls
on it. So two signatures agree in an entry with the probability of the weighted Jaccard
similarity. Points come in order of time, and a process is left as soon as it is later than all
entries: the work is about one point per shingle plus a constant per text.

Candidates. Equal multisets are one node. Nodes that agree in one of ``BANDS`` bands of entries
are candidates; a pair of similarity 0.8 is missed by all bands with a chance below 1e-7. Pairs
whose signatures agree in less than ``LEAST_AGREEMENT`` of the entries are dropped; for a pair of
similarity 0.8 this is as improbable as a miss by the bands.

First pass. Within a bucket the nodes stand in an order of the band's own, and each is paired with
the first one. Each node's most promising pair is compared exactly first; then all pairs between
the components found so far.

Second pass. Each bucket that still holds several components goes to one place with the texts of
its nodes, each node once per such bucket, at most ``BANDS`` times. There all pairs of nodes of
different components whose first common bucket it is are looked at, and those that may be alike
are compared exactly, unless links of the place have joined them. A place puts out only the links
that join components. So no pair is left to luck, and what is moved grows with the nodes. Only a
bucket beyond ``CHUNK`` nodes or ``CHUNK_BYTES`` of text is cut into chunks whose pairs each get
a place.

Buckets and ranges are dealt out by (band value, order), so a bucket that holds a third of all
nodes is spread over tasks; neighbours across the border of two tasks are paired as well.

Defined cases: texts without words (null, empty, symbols) are alike only if they are equal, null
counting as empty; repeated rows belong to one class; texts are taken whole; an empty table
gives no rows; other columns are not needed and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folkmeter.llm import common
from folkmeter.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
LEAST_AGREEMENT = 0.6
CHUNK = 4096  # nodes of an open bucket compared at once with as many others
CHUNK_BYTES = 8 << 20  # and bytes of their texts, about
_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_PLACES = common.mix(np.arange(21, 21 + SHINGLE, dtype=_U)) | _U(1)


class Bags:
    """The multisets of a block: row, shingle and count, in the order of (row, shingle)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = common.Words(data, offsets)
        self.rows = len(offsets) - 1
        per_row = np.diff(words.first)
        size = np.clip(per_row, 0, SHINGLE)
        n = np.where(per_row > 0, per_row - size + 1, 0)
        row = np.repeat(np.arange(self.rows), n)
        start = words.first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        key = size[row].astype(_U)
        for k in range(SHINGLE if len(row) else 0):
            at = np.minimum(start + k, len(words.hash) - 1)
            key += np.where(k < size[row], words.hash[at] * _PLACES[k], _U(0))
        key = common.mix(key)
        order = np.lexsort((key, row))
        row, key = row[order], key[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
        first = np.flatnonzero(new)
        self.row, self.key = row[first], key[first]
        self.count = np.diff(np.append(first, len(row)))

    def nodes(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """128 bits per row, equal for equal multisets; of the text where there is no word."""
        marked = common.mix(self.key + self.count.astype(_U) * _GOLD)
        parts = []
        for salt in (_U(1), _U(2)):
            terms = common.mix(marked ^ salt)
            sums = np.concatenate([np.zeros(1, _U), np.cumsum(terms, dtype=_U)])
            at = np.searchsorted(self.row, np.arange(self.rows + 1))
            parts.append(sums[at[1:]] - sums[at[:-1]])
        bare = np.bincount(self.row, minlength=self.rows) == 0
        if bare.any():
            codes = common.BYTE_CODES[data]
            starts, ends = offsets[:-1][bare], offsets[1:][bare]
            for part, salt in zip(parts, (_U(3), _U(4))):
                part[bare] = common.mix(common.span_hashes(codes ^ salt, starts, ends) ^ salt)
        both = np.stack(parts, axis=1)
        return [line.tobytes() for line in both]


def signatures(bags: Bags) -> np.ndarray:
    """Earliest points per row and entry; rows without shingles have none (infinity)."""
    row, key, weight, level = [bags.row], [bags.key], [bags.count], [np.zeros(len(bags.row), np.int64)]
    j = 1
    while True:
        more = bags.count > 1 << (j - 1)  # the interval [2^(j-1), 2^j) lies below the weight
        if not more.any():
            break
        row.append(bags.row[more])
        key.append(bags.key[more])
        weight.append(bags.count[more])
        level.append(np.full(int(more.sum()), j))
        j += 1
    row, key, weight, level = (np.concatenate(a) for a in (row, key, weight, level))
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    width = np.maximum(low, 1)
    seed = common.mix(key ^ common.mix(level.astype(_U) + _U(7)))
    out = np.full(bags.rows * HASHES, np.inf)
    time = np.zeros(len(row))
    while len(row):
        seed = seed + _GOLD
        draw = common.mix(seed)
        time = time - np.log(((draw >> _U(11)).astype(float) + 0.5) * 2.0**-53) / width
        place = common.mix(draw ^ _GOLD)
        entry = (place & _U(0xFFFFFFFF)) % _U(HASHES)
        unit = low + ((place >> _U(32)).astype(np.int64) % width)
        hit = unit < weight
        np.minimum.at(out, row[hit] * HASHES + entry[hit].astype(np.int64), time[hit])
        there = np.unique(row)
        latest = np.zeros(bags.rows)
        latest[there] = out.reshape(-1, HASHES)[there].max(axis=1)
        stay = time < latest[row]
        row, weight, low, width, seed, time = (
            a[stay] for a in (row, weight, low, width, seed, time)
        )
    return out.reshape(-1, HASHES)


def _bands(signature: np.ndarray) -> np.ndarray:
    bits = signature.view(_U).reshape(len(signature), BANDS, ROWS)
    out = np.broadcast_to(np.arange(BANDS, dtype=_U), bits.shape[:2]).copy()
    for k in range(ROWS):
        out = common.mix(out * _U(3) + bits[:, :, k])
    return out


SIGNED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("node", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("bytes", T.BinaryType()),
        T.StructField("length", T.LongType()),
    ]
)


def _sign(batches: Iterator[pa.RecordBatch]):
    common.release()
    for batch, data, offsets in common.blocks(batches):
        bags = Bags(data, offsets)
        nodes = bags.nodes(data, offsets)
        signature = signatures(bags)
        some = np.isfinite(signature[:, 0])
        bands = _bands(signature).astype(np.int64)
        short = (common.mix(signature.view(_U).ravel()) & _U(255)).astype(np.uint8).reshape(-1, HASHES)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(nodes, pa.binary()),
                pa.array([b if s else [] for b, s in zip(bands, some)], pa.list_(pa.int64())),
                pa.array([s.tobytes() for s in short], pa.binary()),
                pa.array(np.diff(offsets), pa.int64()),
            ],
            names=SIGNED.names,
        )


def _with_node(batches: Iterator[pa.RecordBatch], text: str, names: list[str]):
    common.release()
    for batch, data, offsets in common.blocks(batches, text):
        nodes = pa.array(Bags(data, offsets).nodes(data, offsets), pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns, nodes], names=names)


def _compress(batches: Iterator[pa.RecordBatch]):
    tool = zstandard.ZstdCompressor(3)
    for batch in batches:
        texts = [tool.compress((t or "").encode()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(texts, pa.binary())], names=["doc_id", "packed"]
        )


def _matching(batches: Iterator[pa.RecordBatch]):
    """Only the rows whose text is the one of their node: ids may come more than once."""
    tool = zstandard.ZstdDecompressor()
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = [tool.decompress(p) for p in part.column("packed").to_pylist()]
            block = common.utf8(pa.array(texts, pa.large_binary()))
            same = [a == b for a, b in zip(Bags(*block).nodes(*block), part.column("node").to_pylist())]
            yield part.select(["id", "packed"]).filter(pa.array(same, pa.bool_()))


def _pairs(batches: Iterator[pa.RecordBatch]):
    """Rows in the order of (value, place): each with the first of its bucket. The first row and
    the last one of a task come as ends, to be paired with those of the tasks beside it."""
    part = TaskContext.get().partitionId()
    value, leader, last, head = None, None, None, None
    fields = ("a", "b", "part", "place", "value")

    def out(a, b, kind=-1, place=-1, of=0):
        columns = [a, b, np.full(len(a), kind), np.full(len(a), place), np.full(len(a), of)]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=fields)

    for batch in batches:
        if not batch.num_rows:
            continue
        v, n = (batch.column(c).to_numpy() for c in ("value", "node"))
        if head is None:
            head = v[0], n[:1]
        starts = np.concatenate([[v[0] != value], v[1:] != v[:-1]])
        first = np.maximum.accumulate(np.where(starts, np.arange(len(v)), -1))
        leaders = np.where(first < 0, leader if leader is not None else n[0], n[first])
        ok = n != leaders
        if ok.any():
            yield out(np.maximum(n, leaders)[ok], np.minimum(n, leaders)[ok])
        value, leader, last = v[-1], leaders[-1], n[-1:]
    if head is not None:
        yield out(head[1], head[1], part, 0, head[0])
        yield out(last, last, part, 1, value)


def candidates(placed: DataFrame) -> DataFrame:
    """Pairs (a > b) of nodes that meet in a bucket; ``placed``: node, value. Stored."""
    parts = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.xxhash64("node", "value").alias("_order")
    dealt = placed.select("value", "node", order).repartitionByRange(parts, "value", "_order")
    fields = "a bigint, b bigint, part bigint, place bigint, value bigint"
    found = common.stored(dealt.sortWithinPartitions("value", "_order").mapInArrow(_pairs, fields), "pairs")
    ends = found.filter("part >= 0").orderBy("part", "place").collect()  # two rows per task
    joined = [
        (max(x["a"], y["a"]), min(x["a"], y["a"]))
        for x, y in zip(ends[1::2], ends[2::2])
        if x["value"] == y["value"]
    ]
    inner = found.filter("part < 0").select("a", "b")
    border = placed.sparkSession.createDataFrame(joined, "a bigint, b bigint")
    return common.stored(inner.unionAll(border).distinct(), "pairs")


def _agreement(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        x, y = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, HASHES)
            for c in ("x", "y")
        )
        share = (x == y).mean(axis=1)
        keep = pa.array(share >= LEAST_AGREEMENT)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(share)], names=["a", "b", "share"]
        ).filter(keep)


def similarities(left: tuple, right: tuple) -> np.ndarray:
    """Weighted Jaccard similarity of each left text with the right text in its row."""
    one, two = Bags(*left), Bags(*right)
    row, key = np.concatenate([one.row, two.row]), np.concatenate([one.key, two.key])
    count = np.concatenate([one.count, two.count])
    order = np.lexsort((key, row))
    row, key, count = row[order], key[order], count[order]
    both = np.flatnonzero((row[1:] == row[:-1]) & (key[1:] == key[:-1]))
    shared = np.bincount(row[both], np.minimum(count[both], count[both + 1]), minlength=one.rows)
    total = np.bincount(row, count, minlength=one.rows)
    return shared / np.maximum(total - shared, 1)


def _verify(batches: Iterator[pa.RecordBatch], similarity: float):
    tool = zstandard.ZstdDecompressor()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sides = []
            for name in ("x", "y"):
                texts = [tool.decompress(p) for p in part.column(name).to_pylist()]
                sides.append(common.utf8(pa.array(texts, pa.large_binary())))
            value = similarities(*sides)
            yield pa.RecordBatch.from_arrays(
                [part.column("a"), part.column("b")], names=["a", "b"]
            ).filter(pa.array(value >= similarity - 1e-9))


def _both(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """``pairs`` with the value of a node as x for ``a`` and y for ``b``."""
    x = values.select(F.col("id").alias("a"), F.col(name).alias("x"))
    y = values.select(F.col("id").alias("b"), F.col(name).alias("y"))
    return pairs.join(x, "a").join(y, "b")


def _texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, packed): the texts of the ``wanted`` nodes."""
    wanted = wanted.join(nodes.select("id", "node", "least"), "id").hint("shuffle_hash")
    packed = docs.mapInArrow(_compress, "doc_id bigint, packed binary")
    joined = packed.join(wanted, packed["doc_id"].eqNullSafe(wanted["least"])).select("id", "node", "packed")
    return common.stored(joined.mapInArrow(_matching, "id bigint, packed binary"), "texts")


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """The runs of rows that agree in ``keys``, of rows in the order of these."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy() for k in keys], axis=1)
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            key = tuple(values[low])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _bags(packed: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Shingles and counts of each text."""
    tool, bags = zstandard.ZstdDecompressor(), []
    for at in range(0, len(packed), 32):
        texts = pa.array([tool.decompress(x) for x in packed[at : at + 32]], pa.large_binary())
        part = Bags(*common.utf8(texts))
        cuts = np.searchsorted(part.row, np.arange(part.rows + 1))
        bags += [(part.key[c:d], part.count[c:d]) for c, d in zip(cuts[:-1], cuts[1:])]
    return bags


def _alike(x: tuple, others: list[tuple], similarity: float) -> np.ndarray:
    """Which of the multisets have at least this similarity with ``x``."""
    key, count = x
    theirs, counts = (np.concatenate([o[k] for o in others]) for k in (0, 1))
    row = np.repeat(np.arange(len(others)), [len(o[0]) for o in others])
    at = np.minimum(np.searchsorted(key, theirs), len(key) - 1)
    same = key[at] == theirs
    shared = np.bincount(row[same], np.minimum(count[at], counts)[same], minlength=len(others))
    total = np.bincount(row, counts, minlength=len(others)) + count.sum()
    return shared / (total - shared) >= similarity - 1e-9


def _joining(batches: Iterator[pa.RecordBatch], similarity: float):
    """Of places (bucket, chunk, chunk): links between their components.

    A pair is only taken in the first band in which it agrees.
    """
    for run in _runs(batches, ("value", "i", "j")):
        component = run.column("component").to_numpy()
        order = np.argsort(component, kind="stable")
        run = run.take(pa.array(order))
        component, node, chunk = (run.column(c).to_numpy() for c in ("component", "node", "chunk"))
        marks = np.frombuffer(b"".join(run.column("bytes").to_pylist()), np.uint8).reshape(-1, HASHES)
        bands = pc.list_flatten(run.column("bands")).to_numpy().reshape(-1, BANDS)
        band, i, j = (run.column(c)[0].as_py() for c in ("band", "i", "j"))
        bags = _bags(run.column("packed").to_pylist())
        total = np.array([count.sum() for _, count in bags])
        if i == j:
            left, right = np.arange(len(node)), np.arange(len(node))
            start = np.searchsorted(component, component, side="right")
        else:
            left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
            start = np.zeros(len(left), np.int64)
        label, links = component.copy(), []  # components as the links of this place join them
        for row, first in zip(left, start):
            later = right[first:]
            size = total[later]
            near = (size >= total[row] * (similarity - 1e-9)) & (total[row] >= size * (similarity - 1e-9))
            later = later[near & (label[later] != label[row])]
            if not len(later):
                continue
            later = later[(bands[later] == bands[row]).argmax(axis=1) == band]
            # Eight counts side by side in a number: each is 16 at most.
            same = (marks[later] == marks[row]).view(_U).sum(axis=1)
            agree = same.view(np.uint8).reshape(-1, 8).sum(axis=1)
            keep = agree >= LEAST_AGREEMENT * HASHES
            later, agree = later[keep], agree[keep]
            # The most promising first; once a component is met, its other nodes are left out.
            later = later[np.argsort(-agree.astype(np.int64), kind="stable")]
            while len(later):
                some, later = later[:64], later[64:]
                for y in some[_alike(bags[row], [bags[y] for y in some], similarity)]:
                    if label[y] != label[row]:
                        links.append((node[row], node[y]))
                        label[label == label[y]] = label[row]
                later = later[label[later] != label[row]]
        if links:
            ends = np.array(links, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])


def _settle(nodes: DataFrame, open_: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between all components that share an open bucket (value, band, node, component,
    size, bytes_in): each node goes once to each of its open buckets, with its text."""
    wanted = open_.select(F.col("node").alias("id")).distinct()
    payload = nodes.select("id", "bands", "bytes").join(wanted, "id", "left_semi").join(texts, "id")
    payload = common.stored(payload.withColumnRenamed("id", "node"), "payload")
    chunks = F.greatest(F.ceil(F.col("size") / CHUNK), F.ceil(F.col("bytes_in") / CHUNK_BYTES))
    rows = open_.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), chunks - 1)))
    rows = rows.withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")})
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.join(payload, "node").select(
        "value", "i", "j", "band", "chunk", "node", "component", "bands", "bytes", "packed"
    )
    rows = rows.repartition(parts, "value", "i", "j").sortWithinPartitions("value", "i", "j")
    return common.stored(rows.mapInArrow(lambda it: _joining(it, similarity), "a bigint, b bigint"), "links")


def linked(docs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """(node, component) of the nodes (id, node, least, bands, bytes, length) that have a link."""
    exploded = nodes.filter(F.size("bands") > 0).select(
        F.col("id").alias("node"), "length", F.posexplode("bands").alias("band", "value")
    )
    pairs = candidates(exploded)
    # Every node of a bucket with several nodes is in a pair: no other text is ever compared.
    texts = _texts(docs, nodes, pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")).distinct())
    pairs = _both(pairs, nodes, "bytes").mapInArrow(_agreement, "a bigint, b bigint, share double")
    pairs = common.stored(pairs, "candidates")

    def verified(some: DataFrame) -> DataFrame:
        compared = _both(some.select("a", "b"), texts, "packed").select("a", "b", "x", "y")
        return common.stored(compared.mapInArrow(lambda it: _verify(it, similarity), "a bigint, b bigint"), "links")

    ends = pairs.withColumn("id", F.col("a")).unionAll(pairs.withColumn("id", F.col("b")))
    best = ends.groupBy("id").agg(F.max(F.struct("share", "a", "b")).alias("p"))
    best = best.select("p.a", "p.b").distinct()
    label = common.stored(components(verified(best)), "components")
    label = _merged(label, verified(_cross(pairs, label).join(best, ["a", "b"], "left_anti")))
    # Buckets that still hold several components are settled exactly.
    named = _named(exploded.select("node", "band", "value", "length"), label)
    open_ = named.groupBy("value").agg(
        F.min("component").alias("p"), F.max("component").alias("q"),
        F.count("*").alias("size"), F.sum("length").alias("bytes_in"),
    )
    several = open_.filter("p <> q").select("value", "size", "bytes_in")
    open_ = common.stored(named.drop("length").join(several, "value"), "open")
    if open_.isEmpty():
        return label
    return _merged(label, _settle(nodes, open_, texts, similarity))


def _merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links (a, b): only the components that these join are worked on."""
    if links.isEmpty():
        return label
    a = label.select(F.col("node").alias("a"), F.col("component").alias("p"))
    b = label.select(F.col("node").alias("b"), F.col("component").alias("q"))
    joined = links.join(a, "a", "left").join(b, "b", "left")
    joined = joined.select(F.coalesce("p", "a").alias("a"), F.coalesce("q", "b").alias("b"))
    after = components(joined).select(F.col("node").alias("component"), F.col("component").alias("after"))
    after = common.stored(after, "joined")
    # Nodes that had no link before are components of their own name.
    alone = after.select(F.col("component").alias("node")).join(label, "node", "left_anti")
    every = label.unionByName(alone.withColumn("component", F.col("node")))
    every = every.join(after, "component", "left")
    return common.stored(every.select("node", F.coalesce("after", "component").alias("component")), "components")


def _named(rows: DataFrame, label: DataFrame) -> DataFrame:
    joined = rows.join(label, "node", "left")
    return joined.withColumn("component", F.coalesce("component", "node")).select("node", "component", "band", "value", "length")


def _cross(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose nodes are in different components so far."""
    a = label.select(F.col("node").alias("a"), F.col("component").alias("p"))
    b = label.select(F.col("node").alias("b"), F.col("component").alias("q"))
    joined = pairs.join(a, "a", "left").join(b, "b", "left")
    return joined.filter(F.coalesce("p", "a") != F.coalesce("q", "b")).select("a", "b")


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Of documents (doc_id, text): rows (doc_id, node, class_id), and per class the node and id
    of the document that stands for it, which is the one with the least id."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = common.stored(docs.mapInArrow(_sign, SIGNED), "signed")
    nodes = signed.groupBy("node").agg(
        F.min("doc_id").alias("least"), F.first("bands").alias("bands"), F.first("bytes").alias("bytes"),
        F.max("length").alias("length"),
    )
    nodes = common.stored(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    label = linked(docs, nodes, similarity).withColumnRenamed("node", "id")
    named = nodes.select("id", "node", "least").join(label, "id", "left")
    named = named.withColumn("component", F.coalesce("component", "id"))
    head = named.groupBy("component").agg(F.min(F.struct("least", "node")).alias("head"))
    named = common.stored(named.join(head, "component").select("node", F.col("head.least").alias("class_id")), "named")
    rows = signed.select("doc_id", "node").join(named, "node")
    heads = head.select(F.col("head.least").alias("doc_id"), F.col("head.node").alias("node"))
    return rows, heads


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The columns of ``docs`` (doc_id, text, ...): of each class the document of the least id.

    Of repeated rows one stays; columns of any names pass, whatever the names used inside.
    """
    node, head = common.unused(docs.columns, "node", "head")
    _, heads = classes(docs, similarity)
    heads = common.stored(heads.select(F.col("doc_id").alias(head), F.col("node").alias(node)), "heads")
    schema = T.StructType([*docs.schema.fields, T.StructField(node, T.BinaryType())])
    marked = docs.mapInArrow(lambda it: _with_node(it, "text", schema.names), schema)
    joined = marked.join(heads.hint("shuffle_hash"), node).filter(F.col("doc_id").eqNullSafe(F.col(head)))
    return joined.dropDuplicates([node]).select(*[F.col(f"`{c}`") for c in docs.columns])
