"""Build comparison and volume monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def relation_count_diff(a: DataFrame, b: DataFrame, name_a: str = "a", name_b: str = "b") -> DataFrame:
    """Row counts of two relations and their difference (b - a), as one
    aggregate over the union of both (only a side marker is read)."""
    sides = a.select(F.lit(0).alias("_side")).unionByName(b.select(F.lit(1).alias("_side")))
    counts = sides.agg(F.count_if(F.col("_side") == 0).alias("count_a"),
                       F.count_if(F.col("_side") == 1).alias("count_b"))
    return counts.select(
        F.lit(name_a).alias("relation_a"), F.lit(name_b).alias("relation_b"),
        "count_a", "count_b", (F.col("count_b") - F.col("count_a")).alias("diff"))


def volume_anomaly(df: DataFrame, date_col: str, window_days: int = 7,
                   z_threshold: float = 3.0) -> DataFrame:
    """Daily row counts against the mean and sample standard deviation
    of the previous ``window_days`` days that have rows.

    The window runs over the daily counts (one row per day). Mean and
    variance come from exact integer sums (sum, sum of squares), so the
    result does not depend on summation order. z is NULL until the window
    holds two days or when the spread is 0. Statistics are rounded to 6
    decimals.
    """
    daily = df.groupBy(F.to_date(date_col).alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    w = Window.orderBy("day").rowsBetween(-window_days, -1)
    x = F.col("rows")
    s1, s2, n = F.sum(x).over(w), F.sum(x * x).over(w), F.count(x).over(w)
    daily = daily.select("day", "rows", s1.alias("s1"), s2.alias("s2"), n.alias("n"))
    mean = F.col("s1").cast("double") / F.col("n").cast("double")
    var_num = F.col("n") * F.col("s2") - F.col("s1") * F.col("s1")
    var = var_num.cast("double") / (F.col("n") * (F.col("n") - 1)).cast("double")
    sd = F.sqrt(var)
    z = F.when((F.col("n") >= 2) & (var_num > 0), (x.cast("double") - mean) / sd)
    dec = "decimal(18,6)"
    return daily.select(
        "day", "rows", F.col("n").alias("window_days"),
        F.when(F.col("n") > 0, mean).cast(dec).cast("double").alias("trailing_mean"),
        F.when(F.col("n") >= 2, sd).cast(dec).cast("double").alias("trailing_stddev"),
        z.cast(dec).cast("double").alias("z_score"),
        F.coalesce(F.abs(z) > z_threshold, F.lit(False)).alias("is_anomaly"))
