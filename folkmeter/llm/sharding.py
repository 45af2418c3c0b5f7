"""Sharding along a Hilbert curve, in DataFrame operations only.

Metadata columns are quantised to ``1 << BITS`` cells each at approximate quantiles (which only
place the cells), the cells give the index on the curve, and the rows are put in the order of
(index, tie-breaking columns). Runs of equal length along that order are the shards, so a shard
covers a small box of the metadata and a reader can skip files by the minima and maxima of any
of the columns. Law ``rows``: the sizes of the shards differ by one row at most.

The order is global without a global sort in one task: the rows go to ranges of the curve with
the tie-breakers as a part of the range key, so a cell that holds a third of the rows is split;
the place within a range comes from the sorted partition, and a row per range gives the offsets.
The ranges are stored before they are counted, so a repeated task cannot move rows between them.

Defined cases: null metadata fall into the first cell; a null text has size 1 and the checksum of
the empty text; rows that agree in all ordering columns are interchangeable; an empty table gives
no rows; columns of the input that bear the name of a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folkmeter.llm import common

SHARDS = 16
BITS = 6
ACCURACY = 10_000


def curve_tables(n: int) -> tuple[list[int], list[int]]:
    """Per (state, cell of one level): the digit of the index, and the next state.

    A state is the corner in which the curve enters a cube and the axis along which it leaves.
    """
    size = 1 << n

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    place = {gray(i): i for i in range(size)}

    def turn(x: int, by: int) -> int:
        by %= n
        return ((x << by) | (x >> (n - by))) & (size - 1)

    def entry(w: int) -> int:
        return 0 if w == 0 else gray(2 * ((w - 1) // 2))

    def axis(w: int) -> int:
        odd = w if w % 2 else max(w - 1, 0)
        return ((odd ^ (odd + 1)).bit_length() - 1) % n if odd else 0

    digits, states = [], []
    for state in range(size * n):
        corner, along = state % size, state // size
        for cell in range(size):
            w = place[turn(cell ^ corner, -(along + 1))]
            after = corner ^ turn(entry(w), along + 1)
            digits.append(w)
            states.append((along + axis(w) + 1) % n * size + after)
    return digits, states


def curve_index(cells: list[str], bits: int = BITS) -> Column:
    """The Hilbert index of a row whose columns ``cells`` hold numbers below ``1 << bits``."""
    n = len(cells)
    digits, states = (f"array({','.join(map(str, t))})" for t in curve_tables(n))
    level = " + ".join(f"(shiftright({c}, b) & 1) * {1 << i}" for i, c in enumerate(cells))
    at = f"a.s * {1 << n} + {level}"
    return F.expr(
        f"aggregate(sequence({bits - 1}, 0, -1), named_struct('s', 0, 'h', 0L), (a, b) -> "
        f"named_struct('s', {states}[{at}], 'h', a.h * {1 << n}L + {digits}[{at}]), a -> a.h)"
    )


def string_rank(column: str) -> Column:
    """A number in the order of the first seven bytes of a string."""
    head = F.substring(F.encode(F.coalesce(F.col(column), F.lit("")), "UTF-8"), 1, 7)
    return F.conv(F.rpad(F.hex(head), 14, "0"), 16, 10).cast("bigint")


def with_ranks(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` with a number per column (name of the new column to string column) that is in the
    order of the whole strings; null counts as empty. The number of values has no bound: the
    distinct ones go to ranges, and the place in the stored ranges is the rank."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for rank, column in columns.items():
        value = F.coalesce(F.col(column), F.lit(""))
        values = df.select(value.alias("_value")).distinct()
        ranged = values.repartitionByRange(parts, "_value").sortWithinPartitions("_value")
        ranged = common.stored(ranged.withColumn(rank, F.monotonically_increasing_id()), "ranks")
        df = df.withColumn("_value", value).join(ranged, "_value").drop("_value")
    return df


def _cell(column: str, edges: list[int]) -> Column:
    """The number of edges below the value; null is in the first cell."""
    above = F.filter(F.lit(edges), lambda edge: edge < F.col(column)) if edges else F.array()
    return F.coalesce(F.size(above), F.lit(0))


def assign(
    df: DataFrame, dimensions: dict[str, Column], ties: list[str], shards: int = SHARDS
) -> DataFrame:
    """``df`` with law, shard, slot and the curve index.

    ``dimensions``: numbers by which rows are to lie together; ``ties``: columns that order rows
    of one cell. Keep only the columns in ``df`` that the result needs: all of them are moved.
    """
    names = [f"_d{i}" for i in range(len(dimensions))]
    df = df.drop("law", "shard", "slot", "curve")
    placed = df.withColumns(dict(zip(names, dimensions.values())))
    placed = common.stored(placed, "placed")
    marks = F.lit([i / (1 << BITS) for i in range(1, 1 << BITS)])
    edges = placed.agg(
        *[F.array_distinct(F.percentile_approx(n, marks, ACCURACY)).alias(n) for n in names]
    ).first()  # one row of at most 63 numbers per dimension
    cells = {n: _cell(n, edges[n] or []) for n in names}
    curved = placed.withColumns(cells).withColumn("curve", curve_index(names)).drop(*names)
    order = ["curve", *ties]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = curved.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = common.stored(ranged.withColumn("_m", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumns(
        {"_part": F.shiftright("_m", 33), "_row": F.col("_m").bitwiseAND((1 << 33) - 1)}
    )
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))  # a row per range
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_all"),
    )
    ranked = ranged.join(F.broadcast(offsets), "_part").withColumn(
        "_rank", F.col("_before") + F.col("_row")
    )
    shard = F.expr(f"_rank * {shards} div _all")
    first = F.expr(f"(shard * _all + {shards - 1}) div {shards}")
    return (
        ranked.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("_rank") - first)
        .withColumn("law", F.lit("rows"))
        .drop("_m", "_part", "_row", "_before", "_all", "_rank")
    )


def text_size(text: str = "text") -> Column:
    return F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint") + F.lit(1)


def text_crc32(text: str = "text") -> Column:
    return F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8"))


def write(assigned: DataFrame, folder: str) -> None:
    """One folder of files per shard, in curve order inside each file."""
    parts = int(assigned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = assigned.repartitionByRange(parts, "shard", "slot")
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
