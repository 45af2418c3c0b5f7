"""A Merkle manifest of a dataset, by self-joins of siblings.

Rows become leaf digests. Leaves are put in trees by a key and numbered in their order there; the
roots of the trees, in the order of their keys, are the leaves of one more tree whose root stands
for the dataset. Every run of ``fanout`` consecutive nodes has one parent.

Numbers make siblings computable, so no level is grouped: a node with slot s in its run meets the
sibling o slots further by an equality join of the level with itself on (tree, run, slot), where
the wanted slot is ``(s + o) % fanout``, or ``s XOR 1`` for two. A level is dealt once by
(tree, run), which serves all its joins, as a run is never parted. Then the rows of slot zero
have all digests of their run side by side and emit the parent. Each level is stored; it has a
``fanout``-th of the rows of the one below.

The proof of a leaf, the digests beside it on its way to the root, comes down the tree: a node's
own siblings are known from its level, and those further up from its parent, joined on
(tree, run) again. So the key of a tree, which may hold most rows, is never joined on, but for
the one row per tree that links its root to the upper tree.

Order within trees is made without a sort in one task: rows go to ranges of (tree, order), and a
row per range and tree gives the offsets.

Defined cases: a null field is ``-``, so it differs from an empty one; a null key is a tree of its
own before all others; rows of equal order stand in the order of their leaves, so equal rows are
interchangeable; a single leaf is its own root; an empty table gives no rows; columns that are
not named by the caller are not read, whatever their names.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folkmeter.llm import common

FANOUT = 8
STEP = "array<struct<before string, after string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the joined parts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes, so that neighbours cannot be confused."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


@contextmanager
def _joins_by_part_of_the_keys(spark: SparkSession):
    """Rows dealt by some of the keys of a join are not dealt again for it."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with a column ``tree``) with ``idx``, the place in the tree, and ``n``, its size."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order)
    ranged = common.stored(ranged.withColumn("m", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumns(
        {"part": F.shiftright("m", 33), "row": F.col("m").bitwiseAND((1 << 33) - 1)}
    )
    # One row per range and tree in it: at most as many as there are ranges and trees together.
    here = ranged.groupBy("part", "tree").agg(F.count("*").alias("here"), F.min("row").alias("first"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = here.select(
        "part",
        "tree",
        (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("here").over(tree).alias("n"),
    )
    placed = ranged.join(offsets, ["part", "tree"]).withColumn("idx", F.col("row") + F.col("shift"))
    return placed.drop("m", "part", "row", "shift")


def _beside(slot: Column, offset: int, fanout: int) -> Column:
    """The slot of the sibling at an offset."""
    if fanout == 2:
        return slot.bitwiseXOR(F.lit(offset))
    return F.pmod(slot + F.lit(offset), F.lit(fanout))


def _offset(slot: Column, sibling: int, fanout: int) -> Column:
    """The offset at which a slot of the run was met."""
    if fanout == 2:
        return slot.bitwiseXOR(F.lit(sibling))
    return F.pmod(F.lit(sibling) - slot, F.lit(fanout))


def _siblings(nodes: DataFrame, carry: list[str], fanout: int) -> DataFrame:
    """Nodes of one level (tree, idx, n, hash), each with the digests of the siblings at every
    offset in its run."""
    inner = nodes.filter("n > 1")
    run, slot = F.expr(f"idx div {fanout}"), F.expr(f"int(idx % {fanout})")
    own = inner.select("tree", "idx", "n", "hash", *carry, run.alias("run"), slot.alias("slot"))
    own = own.repartition("tree", "run")
    siblings = inner.select("tree", run.alias("run"), slot.alias("beside"), "hash")
    siblings = siblings.repartition("tree", "run")
    for offset in range(1, fanout):
        other = siblings.withColumnRenamed("hash", f"hash{offset}")
        own = own.withColumn("beside", _beside(F.col("slot"), offset, fanout))
        own = own.join(other, ["tree", "run", "beside"], "left").drop("beside")
    return own


def _level(nodes: DataFrame, carry: list[str], fanout: int) -> DataFrame:
    """The level with the digests to the left and to the right in each node's run, and with the
    parent in the rows of slot zero; stored."""
    slot = F.col("slot")
    met = F.array("hash", *[f"hash{offset}" for offset in range(1, fanout)])
    digests = [F.coalesce(F.get(met, _offset(slot, j, fanout)), F.lit("")) for j in range(fanout)]
    before = F.concat(*[F.when(F.lit(j) < slot, d).otherwise("") for j, d in enumerate(digests)])
    after = F.concat(*[F.when(F.lit(j) > slot, d).otherwise("") for j, d in enumerate(digests)])
    met_all = _siblings(nodes, carry, fanout)
    out = met_all.select(
        "tree", "idx", "n", "run", "slot", "hash", *carry, before.alias("before"), after.alias("after")
    ).withColumn("parent", F.when(slot == 0, digest(F.col("hash"), F.col("after"))))
    with _joins_by_part_of_the_keys(nodes.sparkSession):
        return common.stored(out, "level")


def _levels(leaves: DataFrame, carry: list[str], fanout: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """The stored levels from the leaves up, and the roots that each height has."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, nodes = [], leaves
    roots = [leaves.filter("n = 1")]
    while most > 1:
        levels.append(_level(nodes, carry, fanout))
        carry, most = [], -(-most // fanout)
        nodes = levels[-1].filter("slot = 0").select(
            "tree", F.col("run").alias("idx"),
            F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"), F.col("parent").alias("hash"),
        )
        roots.append(nodes.filter("n = 1"))
    return levels, roots


def _paths(levels: list[DataFrame], roots: list[DataFrame], carry: list[str]) -> DataFrame:
    """Leaves with all that comes down from their roots; ``roots`` have path, subroot and root."""
    down = ["path", "subroot", "root"]
    rows = roots[-1]
    for height in reversed(range(len(levels))):
        keep = carry if height == 0 else []
        above = rows.select("tree", F.col("idx").alias("run"), *[F.col(c).alias(f"up_{c}") for c in down])
        step = F.array(F.struct("before", "after"))
        rows = levels[height].join(above, ["tree", "run"]).select(
            "tree", "idx", "hash", *keep, F.concat(step, "up_path").alias("path"),
            F.col("up_subroot").alias("subroot"), F.col("up_root").alias("root"),
        )
        rows = rows.unionByName(roots[height].select("tree", "idx", "hash", *keep, *down))
    return rows


def manifest(
    docs: DataFrame, columns: list[str], by: str, order: list[str], keep: dict[str, Column], fanout: int = FANOUT
) -> DataFrame:
    """Per row: the columns of ``keep``, leaf, subroot, root, and path.

    ``columns``: what a leaf covers, in this order; ``by``: key of the trees; ``order``: order
    inside a tree; ``path``: from the leaf up, the digests to the left and right of each node on
    the way, joined. ``keep`` may not use the names of the results.
    """
    key = F.coalesce(F.concat(F.lit("1"), F.col(by).cast("string")), F.lit("0"))
    own = docs.select(
        key.alias("tree"), F.struct(*order).alias("pos"),
        leaf(*[F.col(c) for c in columns]).alias("hash"),
        F.struct(*[c.alias(n) for n, c in keep.items()]).alias("extra"),
    )
    own = common.stored(own, "leaves")  # texts are digested once, not again to find the ranges
    leaves = _numbered(own, ["pos", "hash"]).drop("pos")
    levels, roots = _levels(leaves, ["extra"], fanout)

    subroots = roots[0].select("tree", "hash")
    for found in roots[1:]:
        subroots = subroots.unionByName(found.select("tree", "hash"))
    upper = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash")
    upper = _numbered(upper, ["name"])
    upper_levels, tops = _levels(upper, ["name"], fanout)
    for height, top in enumerate(tops):
        name = ["name"] if height == 0 else []
        tops[height] = top.select(
            "tree", "idx", "hash", *name, F.array().cast(STEP).alias("path"),
            F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"),
        )
    linked = _paths(upper_levels, tops, ["name"]).select(
        F.col("name").alias("tree"), "path", F.col("hash").alias("subroot"), "root"
    )
    linked = common.stored(linked, "roots")  # a row per tree
    roots = [r.select("tree", "idx", "hash", *(["extra"] if h == 0 else [])).join(linked, "tree") for h, r in enumerate(roots)]
    rows = _paths(levels, roots, ["extra"])
    return rows.select("extra.*", F.col("hash").alias("leaf"), "subroot", "root", "path")


def proof(path: str = "path") -> Column:
    """Digest of all siblings on the way to the root."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p.before, p.after)), ""))


def fold(start: str, path: str = "path") -> Column:
    """The root that follows from a leaf and the siblings on its way."""
    return F.aggregate(path, F.col(start), lambda h, p: digest(p.before, h, p.after))
