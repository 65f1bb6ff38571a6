"""Exact per-group quantiles by selection, without gathering or sorting a group.

Spark's exact ``percentile`` aggregate keeps all of a group's values in one
task's memory, which breaks when one group holds a large share of the rows.
Here each rank that the quantiles need is searched for instead:

1. count the rows of each group and take its smallest and largest value; the
   ranks needed are floor and ceil of p * (n - 1);
2. cut the range that holds a rank into ``BINS`` equal parts and count the rows
   of each (partial aggregates, so a large group costs its rows once and
   shuffles counts); the running sums of the counts say which part holds the
   rank, and that part's smallest and largest value are the next range;
3. repeat until a range holds one value or at most ``SORT_ROWS`` rows; only
   these rows are sorted, each range by itself;
4. interpolate linearly at position p * (n - 1), as ``percentile`` /
   ``quantile_cont`` do.

Both ends of a range fall into different parts, so every pass narrows it. The
input is checkpointed to the shared checkpoint folder, and so are the ranges
after each pass (a few rows per group): no value depends on sampling or on how
rows are dealt to tasks. Groups are joined null-safe: rows without a group are
a group. Infinite values and NaN (the largest) have parts of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

BINS = 4096               # parts of a range
SORT_ROWS = 20_000        # rows of a range that are sorted
PASSES = 40               # of narrowing, at most; what is left then is sorted
BROADCAST_RANGES = 100_000


def _summary() -> list[Column]:
    v = F.col("v")
    finite = F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)
    return [F.count(F.lit(1)).alias("size"), F.min(v).alias("lo"), F.max(v).alias("hi"),
            F.min(finite).alias("least"), F.max(finite).alias("most")]


def _bin() -> Column:
    """The part of its range that a value falls into, rising with the value."""
    v, least = F.col("v"), F.col("least")
    width = F.col("most") / 2 - least / 2           # halves: no overflow
    part = F.least(F.floor(F.try_divide(v / 2 - least / 2, width) * BINS), F.lit(BINS - 1))
    return (F.when(F.isnan(v), BINS + 1).when(v == F.lit(float("inf")), BINS)
            .when(v == F.lit(float("-inf")), -1).otherwise(F.coalesce(part, F.lit(0))).cast("int"))


def _rows_in(vals: DataFrame, ranges: DataFrame) -> DataFrame:
    """Values with the range (of ``ranges``: g, before, lo, hi) they lie in; a
    group's ranges do not overlap."""
    mine = ranges.withColumnRenamed("g", "_g")
    if ranges.count() <= BROADCAST_RANGES:
        mine = F.broadcast(mine)
    return vals.join(mine, F.col("g").eqNullSafe(F.col("_g")) & F.col("v").between(F.col("lo"), F.col("hi"))).drop("_g")


def _picked(vals: DataFrame, ranges: DataFrame) -> DataFrame:
    """(g, rank, v): the value at each rank of ``ranges`` (g, rank, before, size,
    lo, hi, least, most), where ``before`` rows precede the range."""
    bounds = ["g", "before", "lo", "hi", "least", "most"]
    unsettled = (F.col("size") > SORT_ROWS) & (F.col("lo") != F.col("hi"))
    for _ in range(PASSES):
        ranges = ranges.checkpoint(eager=True)
        wide = ranges.where(unsettled)
        if wide.isEmpty():
            break
        parts = (_rows_in(vals, wide.select(bounds).distinct())
                 .groupBy("g", "before", _bin().alias("bin")).agg(*_summary()))
        below = Window.partitionBy("g", "before").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(below), F.lit(0)))
        parts = parts.select(F.col("g").alias("_g"), F.col("before").alias("_b"), "start", "size", "lo", "hi", "least", "most")
        holds = ((F.col("before") == F.col("_b")) & F.col("g").eqNullSafe(F.col("_g"))
                 & (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("size")))
        narrowed = (wide.select("g", "rank", "before").join(parts, holds)
                    .select("g", "rank", F.col("start").alias("before"), "size", "lo", "hi", "least", "most"))
        ranges = ranges.where(~unsettled).unionByName(narrowed)
    one = F.col("lo") == F.col("hi")
    short = ranges.where(~one)
    nth = F.row_number().over(Window.partitionBy("g", "before").orderBy("v"))
    ranked = (_rows_in(vals, short.select("g", "before", "lo", "hi").distinct())
              .select("g", "v", (F.col("before") + nth - 1).alias("rank")))
    wanted = short.select(F.col("g").alias("_g"), F.col("rank").alias("_r"))
    sorted_out = ranked.join(wanted, (F.col("rank") == F.col("_r")) & F.col("g").eqNullSafe(F.col("_g")), "left_semi")
    return ranges.where(one).select("g", "rank", F.col("lo").alias("v")).unionByName(sorted_out.select("g", "rank", "v"))


def exact_quantiles(df: DataFrame, group: str, value: str, probs: list[float],
                    materialize: bool = True) -> DataFrame:
    """One row per group: ``group``, ``n`` and ``q0..q{k-1}`` (double) for
    ``probs``. NULL values are ignored, as in ``percentile``.
    ``materialize=False`` when ``df`` is already checkpointed or read from
    files."""
    checkpoint_root(df.sparkSession)
    vals = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    if materialize:
        # Every pass reads the values: these files instead of the input's plan.
        vals = vals.checkpoint(eager=True)
    groups = vals.groupBy("g").agg(*_summary()).checkpoint(eager=True)
    asked = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("size") - 1).cast("double")
        asked.append(F.struct(F.lit(i).alias("qi"), pos.alias("pos"), F.floor(pos).cast("long").alias("low"),
                              F.ceil(pos).cast("long").alias("high")))
    wanted = groups.select("g", F.col("size").alias("n"), F.explode(F.array(*asked)).alias("q")).select("g", "n", "q.*")
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(a["low"], a["high"]) for a in asked])))
    ranges = groups.select("g", F.explode(ranks).alias("rank"), F.lit(0).cast("long").alias("before"),
                           "size", "lo", "hi", "least", "most")
    picked = _picked(vals, ranges)
    # All values of a group's ranks in one short row: at most two a quantile.
    found = picked.groupBy(F.col("g").alias("_g")).agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))
    low, high = F.element_at("at", F.col("low")), F.element_at("at", F.col("high"))
    step = F.when(F.col("low") == F.col("high"), F.lit(0.0)).otherwise((high - low) * (F.col("pos") - F.col("low")))
    interp = (wanted.join(found, F.col("g").eqNullSafe(F.col("_g")))
              .select("g", "n", "qi", (low + step).alias("qv")))
    return (interp.groupBy("g", "n").pivot("qi", list(range(len(probs)))).agg(F.first("qv"))
            .select(F.col("g").alias(group), "n", *[F.col(str(i)).alias(f"q{i}") for i in range(len(probs))]))
