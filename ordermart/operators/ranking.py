"""Row numbers within a key, without gathering a hot key's rows in one task.

``row_number().over(Window.partitionBy(key).orderBy(...))`` sorts each key's
rows in one task; AQE can split skewed joins but not skewed windows. So the
keys with more than ``HOT_ROWS`` rows are found first, from the key column
alone (a partial aggregate). All other keys are numbered by the window: one
shuffle of the rows. The rows of hot keys are ranked by a distributed sort:

1. range-partition on (key, order columns) with an explicit partition count
   (AQE never coalesces it) and sort within partitions: a key holding a
   large share of the rows spreads over many partitions;
2. number rows inside each partition (``monotonically_increasing_id``
   restarts its low bits per partition) and checkpoint, so ids are fixed;
3. per (partition, key) run: the first local id and the row count, and, by
   a window over the runs of one key (at most one run per partition), the
   number of the key's rows in earlier partitions;
4. row number = rows in earlier partitions + position in the run + 1. The runs
   are few: a key that is hot spans partitions, so there is about one run a
   partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root, scratch_path

HOT_ROWS = 100_000
_LOW_BITS = (1 << 33) - 1


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """(hot_key): the keys with more than ``hot_rows`` rows, stored; None if
    there are none. NULL counts as a key."""
    spark = df.sparkSession
    hot = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
           .select(F.col(key).alias("hot_key")))
    path = scratch_path(spark, "hot-keys")
    hot.write.parquet(path)
    hot = spark.read.schema(hot.schema).parquet(path)
    return None if hot.isEmpty() else hot


def row_number_within(df: DataFrame, key: str, order: list[str], out: str = "row_number",
                      hot_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` plus ``out`` = row_number within ``key`` ordered by ``order``,
    however many rows a key has."""
    hot = hot_keys(df, key, hot_rows)
    w = Window.partitionBy(key).orderBy(*order)
    if hot is None:
        return df.withColumn(out, F.row_number().over(w).cast("int"))
    same = F.col(key).eqNullSafe(F.col("hot_key"))
    few = df.join(hot, same, "left_anti").withColumn(out, F.row_number().over(w).cast("int"))
    return few.unionByName(row_number_by_sort(df.join(hot, same, "left_semi"), key, order, out))


def row_number_by_sort(df: DataFrame, key: str, order: list[str], out: str = "row_number",
                       partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = row_number within ``key`` ordered by ``order``.

    ``order`` must be a total order within a key (ties get an arbitrary
    but fixed order, as with ``row_number``)."""
    spark = df.sparkSession
    checkpoint_root(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = df.columns
    ranked = (df.repartitionByRange(n, key, *order).sortWithinPartitions(key, *order)
              .withColumn("_id", F.monotonically_increasing_id()))
    ranked = ranked.select(*cols, F.shiftright("_id", 33).alias("_part"),
                           F.col("_id").bitwiseAND(F.lit(_LOW_BITS)).alias("_local"))
    ranked = ranked.checkpoint(eager=True)
    runs = ranked.groupBy("_part", key).agg(F.min("_local").alias("_first"),
                                            F.count(F.lit(1)).alias("_cnt"))
    # One row per partition a key spans: a bounded group per key.
    w = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_base", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    runs = runs.select(F.col("_part").alias("_run_part"), F.col(key).alias("_run_key"), "_first", "_base")
    joined = ranked.join(runs, (F.col("_part") == F.col("_run_part")) & F.col(key).eqNullSafe(F.col("_run_key")))
    rn = (F.col("_base") + F.col("_local") - F.col("_first") + 1).cast("int")
    return joined.select(*cols, rn.alias(out))
