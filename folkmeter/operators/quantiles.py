"""Exact quantiles by refinement: only the ranges that hold a wanted rank are looked at again.

Equal values collapse first. While the distinct values that may hold a wanted rank are too many
for one task, they are cut at approximate quantiles and counted per range, and only the ranges
with a wanted rank are kept; the cuts balance the work, the counts keep the ranks exact. What is
left is a small sorted run per rank. The driver sees counts and cuts, never values in bulk; its
tables grow with the number of groups and probabilities alone.
"""

from __future__ import annotations

import math
from bisect import bisect_left

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folkmeter.session import stored_once

CUTS = 256
ACCURACY = 10_000
RANGE_ROWS = 100_000  # distinct values that are ranked in one task


def _targets(prob: float, method: str, n: int) -> tuple[int, int, float]:
    """0-based ranks (low, high) of a quantile of ``n`` values, and the weight of high."""
    if method == "nearest":
        low = math.floor((n - 1) * prob + 0.5)
        return low, low, 0.0
    if method == "disc":
        low = max(math.ceil(n * prob) - 1, 0)
        return low, low, 0.0
    if method == "linear":
        place = (n - 1) * prob
        return math.floor(place), math.ceil(place), place - math.floor(place)
    raise ValueError(f"unknown quantile method: {method}")


class _Run:
    """Distinct values in (low, high] of one group; ``below`` rows are smaller."""

    def __init__(self, group, low, high, below, rows, distinct):
        self.group, self.low, self.high = group, low, high
        self.below, self.rows, self.distinct = below, rows, distinct

    def holds(self, ranks: set[int]) -> bool:
        return any(self.below <= r < self.below + self.rows for r in ranks)


def _within(counted: DataFrame, runs: list[_Run]) -> DataFrame:
    """The values of the runs, each with the number of its run."""
    rows = [(i, r.group, r.low, r.high) for i, r in enumerate(runs)]
    schema = f"_run int, _g {counted.schema['_g'].dataType.simpleString()}, _low double, _high double"
    table = F.broadcast(counted.sparkSession.createDataFrame(rows, schema))
    above = F.col("_low").isNull() | (F.col("_v") > F.col("_low"))
    under = F.col("_high").isNull() | (F.col("_v") <= F.col("_high"))
    return counted.join(table, "_g").filter(above & under).select("_run", "_v", "_c")


def _refined(counted: DataFrame, runs: list[_Run], ranks: dict, cuts: int) -> list[_Run]:
    """The runs cut at approximate quantiles, as far as they hold a wanted rank."""
    inside = _within(counted, runs)
    marks = F.lit([i / cuts for i in range(1, cuts)])
    edges = inside.groupBy("_run").agg(
        F.array_sort(F.array_distinct(F.percentile_approx("_v", marks, ACCURACY))).alias("e")
    )
    edges = {r["_run"]: r["e"] for r in edges.collect()}  # at most ``cuts`` numbers per run
    table = counted.sparkSession.createDataFrame(list(edges.items()), "_run int, _e array<double>")
    placed = inside.join(F.broadcast(table), "_run")
    bucket = F.size(F.filter("_e", lambda e: e < F.col("_v"))).alias("_b")
    sizes = placed.groupBy("_run", bucket).agg(F.sum("_c").alias("n"), F.count("*").alias("d"))
    out = []
    below = {i: r.below for i, r in enumerate(runs)}
    for row in sorted(sizes.collect(), key=lambda r: (r["_run"], r["_b"])):
        i, b, run = row["_run"], row["_b"], runs[row["_run"]]
        cut = edges[i]
        low = cut[b - 1] if b > 0 else run.low
        high = cut[b] if b < len(cut) else run.high
        part = _Run(run.group, low, high, below[i], row["n"], row["d"])
        below[i] += row["n"]
        if part.holds(ranks[run.group]):
            out.append(part)
    return out


def _values(counted: DataFrame, wanted: list[tuple[float, str]], cuts: int, rows: int) -> dict:
    """(group, prob, method) to the value."""
    totals = counted.groupBy("_g").agg(F.sum("_c").alias("n"), F.count("*").alias("d")).collect()
    targets = {
        (t["_g"], p, m): _targets(p, m, t["n"]) for t in totals for p, m in wanted
    }
    ranks: dict = {t["_g"]: set() for t in totals}
    for (group, _, _), (low, high, _) in targets.items():
        ranks[group] |= {low, high}
    runs = [_Run(t["_g"], None, None, 0, t["n"], t["d"]) for t in totals]
    while any(r.distinct > rows for r in runs):
        small = [r for r in runs if r.distinct <= rows]
        cut = _refined(counted, [r for r in runs if r.distinct > rows], ranks, cuts)
        stuck = max((r.distinct for r in cut), default=0) >= max(r.distinct for r in runs)
        runs = small + cut
        if stuck:  # a value cannot be cut; every run holds distinct values, so this ends
            break
    ordered = Window.partitionBy("_run").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    places = {i: sorted(r - run.below for r in ranks[run.group]) for i, run in enumerate(runs)}
    asked = counted.sparkSession.createDataFrame(list(places.items()), "_run int, _ranks array<bigint>")
    ranked = _within(counted, runs).withColumn("_to", F.sum("_c").over(ordered))
    ranked = ranked.join(F.broadcast(asked), "_run")
    meets = F.exists("_ranks", lambda r: (r < F.col("_to")) & (r >= F.col("_to") - F.col("_c")))
    hits = ranked.filter(meets).select("_run", "_v", "_to").collect() if runs else []
    found: dict = {}
    for hit in sorted(hits, key=lambda h: (h["_run"], h["_to"])):
        run = runs[hit["_run"]]
        found.setdefault(run.group, []).append((run.below + hit["_to"], hit["_v"]))
    out = {}
    for (group, p, m), (low, high, weight) in targets.items():
        ends = sorted(found[group])
        at = [ends[bisect_left(ends, (r + 1,))][1] for r in (low, high)]
        out[group, p, m] = at[0] + (at[1] - at[0]) * weight
    return out


def _named(df: DataFrame, value: str, by: str | None, *more: Column) -> DataFrame:
    group = F.lit("") if by is None else F.col(by)
    named = df.select(group.alias("_g"), F.col(value).cast("double").alias("_v"), *more)
    return named.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))


def _exact(
    df: DataFrame, value: str, wanted: list, by: str | None, cuts: int, rows: int, times: str | None = None
) -> dict:
    if times is None:
        counted = _named(df, value, by).groupBy("_g", "_v").agg(F.count("*").alias("_c"))
    else:
        counted = _named(df, value, by, F.col(times).alias("_n")).groupBy("_g", "_v")
        counted = counted.agg(F.sum("_n").alias("_c")).filter("_c > 0")
    counted.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _values(counted, wanted, cuts, rows)
    finally:
        counted.unpersist()


def quantiles(
    df: DataFrame,
    value: str,
    probs: list[float],
    by: str | None = None,
    method: str = "nearest",
    cuts: int = CUTS,
    range_rows: int = RANGE_ROWS,
    times: str | None = None,
) -> DataFrame:
    """Rows (``by``, prob, value): exact quantiles of a numeric column.

    ``times`` is a column that says how many rows one stands for (exact methods only).

    Methods: ``nearest`` rank, ``linear`` interpolation, ``disc`` and the sketch ``approx``.
    ``by`` must be a column of few values, such as the name of a variable: the driver holds a
    few ranges for each of them. Exact methods run when called.
    """
    keep = [] if by is None else [F.col("_g").alias(by)]
    if method == "approx":
        named = _named(df, value, by)
        sketch = F.percentile_approx("_v", F.lit([float(p) for p in probs]), ACCURACY)
        pairs = F.arrays_zip(F.lit([float(p) for p in probs]).alias("p"), F.col("q"))
        lines = named.groupBy("_g").agg(sketch.alias("q")).select("_g", F.explode(pairs).alias("z"))
        return lines.select(*keep, F.col("z.p").alias("prob"), F.col("z.q").alias("value"))
    found = _exact(df, value, [(float(p), method) for p in probs], by, cuts, range_rows, times)
    kind = "string" if by is None else df.schema[by].dataType.simpleString()
    rows = [(g, p, v) for (g, p, _), v in found.items()]
    table = df.sparkSession.createDataFrame(rows, f"_g {kind}, prob double, value double")
    return table.select(*keep, "prob", "value")


def quantile_row(
    df: DataFrame,
    value: str,
    named: dict[str, float],
    method: str = "nearest",
    more: dict[str, tuple[float, str]] | None = None,
) -> DataFrame:
    """One row with a column per named probability; ``more`` has columns by other methods."""
    if method == "approx":
        rows = quantiles(df, value, sorted(set(named.values())), method=method)
        picks = [F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for n, p in named.items()]
        return rows.agg(*picks)
    wanted = {n: (float(p), method) for n, p in named.items()} | (more or {})
    found = _exact(df, value, list(set(wanted.values())), None, CUTS, RANGE_ROWS)
    row = tuple(found.get(("", *w)) for w in wanted.values())
    return df.sparkSession.createDataFrame([row], ", ".join(f"`{n}` double" for n in wanted))


def cap_at_quantile(
    df: DataFrame, column: str, prob: float = 0.99, method: str = "nearest"
) -> DataFrame:
    """Remove (not clamp) the rows above the quantile of ``column``.

    The quantile and the result read the same stored rows: what gives them runs once.
    """
    df = stored_once(df)
    if method == "approx":
        limit = quantile_row(df, column, {"cap": prob}, method).scalar()
    else:
        limit = F.lit(quantile_row(df, column, {"cap": prob}, method).first()["cap"])
    return df.filter(F.col(column) <= limit)
