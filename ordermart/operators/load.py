"""Sinks and load strategies: B1-B7, E2, E8.

Tables are versions (``operators.versions``): a write puts its files beside those
that are there and becomes visible as a whole by one pointer file. The fact is
parquet, partitioned by order month, and has no MERGE, so the keyed upsert (B3)
is: the months that a batch touches are written anew (their rows without the
batch's keys, and the batch), and the next version of the table names the new
folders of these months and the old ones of all others. However many months a
batch touches, they change together.
"""

from __future__ import annotations

import datetime as _dt
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType

from ..session import (STORED_CODEC, delete_path, drop_unused_shuffles, folder_names, in_slices, scratch_path,
                       slice_count)
from . import versions
from .quality import Check, observed

PARTITION_COL = "order_month"
CLUSTER_COLS = ("order_date", "market_segment")
TOGETHER_COL = "order_key"        # lines of an order beside each other: what they share is stored once
FAILURE_DISPLAY_LIMIT = 500


def register_view(df: DataFrame, name: str) -> DataFrame:
    """B1: a view materialization is a named lazy plan."""
    df.createOrReplaceTempView(name)
    return df


def write_table(df: DataFrame, path: str, checks: list[Check] | None = None) -> dict[str, int]:
    """B2: full rebuild of a table, as its next version. A failed job leaves the
    table as it was, and the new rows may be built from those they replace.
    The failures of row-local ``checks`` are counted by the write and returned."""
    spark = df.sparkSession
    before = versions.current(spark, path)
    rows, counted = observed(df, checks or [])
    name, parts = versions.write_parts(rows, path, None)
    versions.publish(spark, path, before, df.schema, None, {p: [name] for p in parts})
    return counted()


def write_history(closed: DataFrame, open_: DataFrame, path: str, based_on: versions.Version | None,
                  flag: str = "is_open", most_folders: int = 30) -> None:
    """The next version of a history in two parts. Rows of ``closed`` are
    added to the closed part, whose files stay as they are; ``open_`` replaces
    the open part. So a day writes what it closed and what is open, not the
    history. Once the closed part has ``most_folders`` folders they are written
    together, which costs each closed row one more write in that many days."""
    spark = closed.sparkSession
    rows = closed.withColumn(flag, F.lit(0)).unionByName(open_.withColumn(flag, F.lit(1)))
    parts = dict(based_on.parts) if based_on else {}
    shut, live = versions.part_name(flag, 0), versions.part_name(flag, 1)
    if len(parts.get(shut, [])) >= most_folders:
        rows = rows.unionByName(versions.read(spark, path, based_on, [shut]).select(*rows.columns))
        parts[shut] = []
    name, written = versions.write_parts(rows, path, flag)
    parts[live] = [name] if live in written else []
    if shut in written:
        parts[shut] = [*parts.get(shut, []), name]
    versions.publish(spark, path, based_on, rows.schema, flag, parts)


def with_order_month(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    return df.withColumn(PARTITION_COL,
                         (F.year(date_col) * 100 + F.month(date_col)).cast("int"))


def clustered(df: DataFrame) -> DataFrame:
    """Rebalance on the month and sort within tasks by (month, date, segment),
    an order's lines together.

    ``rebalance`` is a shuffle by month that AQE adjusts at run time: a month
    holding a large share of rows is split into several tasks of the
    advisory size, and small months are packed together. No sampling pass is
    needed (range partitioning would compute the input twice). Each task
    writes sorted files, so row-group min/max statistics skip data for date
    and segment filters. Rows are best dealt before columns are computed from
    them (``Models.fact_by_month``): the shuffle then moves a part of their bytes.
    """
    return df.hint("rebalance", PARTITION_COL).sortWithinPartitions(*_sort_columns(df, PARTITION_COL))


def _sort_columns(df: DataFrame, partition_col: str) -> list[str]:
    return [partition_col, *CLUSTER_COLS, *[c for c in (TOGETHER_COL,) if c in df.columns]]


def write_fact(df: DataFrame | list[DataFrame], path: str, key: str | None = None, dealt: bool = False) -> None:
    """Full write of the fact, partitioned by month, clustered, as the next
    version of the table (months it lacks are gone). With ``key`` the written
    rows are checked for NULL or repeated keys before they become the table.
    ``dealt`` says that the rows come ``clustered`` by their month already. A list
    holds the rows in slices, which are written one by one: the disks hold the
    shuffle of one."""
    slices = df if isinstance(df, list) else [df]
    spark, name = slices[0].sparkSession, None
    before = versions.current(spark, path)
    for rows in slices:
        fact = with_order_month(rows) if PARTITION_COL not in rows.columns else rows
        name, parts = versions.write_parts(fact if dealt else clustered(fact), path, PARTITION_COL, name)
        drop_unused_shuffles(spark)
    folders = {p: [name] for p in parts}
    if key is not None:
        written = versions.Version(0, fact.schema, PARTITION_COL, folders)
        try:
            assert_unique_keys(versions.read(spark, path, written), key)
        except ValueError:
            versions.discard(spark, path, name, parts)
            raise
    versions.publish(spark, path, before, fact.schema, PARTITION_COL, folders)
    drop_unused_shuffles(spark)


def read_target(spark: SparkSession, path: str, version: versions.Version | None = None) -> DataFrame | None:
    """The table, or None if it does not exist yet. Files written before a
    column was added read as NULL there (B5): the version's schema says
    which columns there are. Reading changes nothing, and goes on with the
    version it began with while others write. A plain parquet folder, which has
    no versions, is read as it is."""
    version = version or versions.current(spark, path)
    if version is not None:
        return versions.read(spark, path, version)
    if _is_plain(spark, path):
        return spark.read.option("mergeSchema", "true").parquet(path)
    return None


def _is_plain(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds parquet files that no table version names."""
    names = folder_names(spark, path)
    return "data" not in names and any(n.endswith(".parquet") or "=" in n for n in names)


@contextmanager
def _footer_reader(spark: SparkSession):
    """Parquet read so that minima, maxima and counts are taken from footers."""
    keys = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    saved = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def footer_max(spark: SparkSession, paths: list[str], col: str) -> DataFrame:
    """E2 over parquet files: one row with the max ``m`` of a column. For dates
    and numbers it comes from the files' footers and no column is read. The plan
    is fixed here, so that the caller's session keeps its settings."""
    with _footer_reader(spark):
        df = spark.read.parquet(*paths)
        plain = isinstance(df.schema[col].dataType, (DateType, NumericType))
        top = df.select(F.max(col if plain else F.col(col).cast("date")).alias("m"))
        top._jdf.queryExecution().executedPlan()
    return top


def target_max(spark: SparkSession, path: str, col: str = "order_date"):
    """The newest date of a fact that is partitioned by its month: the last
    month alone is asked, and only its footers."""
    version = versions.current(spark, path)
    if version is None or not version.parts:
        return None
    dated = [p for p in version.parts if not p.endswith(versions.NULL_PART) and version.parts[p]]
    newest = max(dated, key=lambda p: int(p.split("=")[1]), default=None)
    return footer_max(spark, version.folders(path, [newest]), col).collect()[0]["m"] if newest else None


def max_value(df: DataFrame, col: str):
    """Scalar max of a column (one value to the driver)."""
    return df.agg(F.max(col).alias("m")).first()["m"]


def lookback_filter(src: DataFrame, target: DataFrame | None, days: int = 3,
                    date_col: str = "order_date") -> DataFrame:
    """Keep source rows with date >= max(target date) - ``days``.

    The max is computed first and applied as a literal, so the predicate is
    static: Catalyst pushes it through the order-line joins to the orders
    scan. A missing or empty target means a first load (no filter); the
    reference would load nothing from an existing empty target, which is a
    deliberate difference.
    """
    start = lookback_start(target, days, date_col)
    return src if start is None else src.where(F.col(date_col) >= F.lit(start))


def lookback_start(target: DataFrame | None, days: int = 3, date_col: str = "order_date") -> _dt.date | None:
    """First date of the look-back window, None for a first load."""
    return window_start(None if target is None else max_value(target, date_col), days)


def stored_lookback_start(spark: SparkSession, path: str, days: int = 3) -> _dt.date | None:
    """The same for a written fact, from the footers of its last month."""
    return window_start(target_max(spark, path), days)


def window_start(mx, days: int) -> _dt.date | None:
    if isinstance(mx, _dt.datetime):
        mx = mx.date()
    return None if mx is None else mx - _dt.timedelta(days=days)


def assert_unique_keys(df: DataFrame, key: str) -> None:
    """Reject NULL or repeated keys in a batch of updates (an ambiguous merge).

    Equal keys have equal hashes, so keys are told apart only where their
    hashes meet: the shuffle moves 8 bytes a row in place of the keys."""
    hashes = F.xxhash64(key)
    met = (df.groupBy(hashes.alias("_hash")).agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("keys"))
           .where((F.col("n") > 1) | (F.col("keys") < F.col("n"))).select("_hash"))
    if not met.limit(1).collect():
        return
    bad = (df.join(met, hashes == F.col("_hash"), "left_semi").groupBy(key).count()
           .where(F.col(key).isNull() | (F.col("count") > 1)).limit(1).collect())
    if bad:
        raise ValueError(f"updates have a NULL or repeated {key}: {bad[0][key]!r}")


def _months_of_orders(target: DataFrame, updates: DataFrame, locator: str, partition_col: str) -> DataFrame:
    """Partitions of the target that hold rows of the updates' ``locator``
    values: the narrow locator column only, and only row groups within the
    values' range."""
    ends = updates.agg(F.min(locator).alias("lo"), F.max(locator).alias("hi")).first()
    near = target.where(F.col(locator).between(F.lit(ends["lo"]), F.lit(ends["hi"])))
    return (near.select(locator, partition_col)
            .join(updates.select(locator).distinct(), locator, "left_semi").select(partition_col))


def _replaced(target: DataFrame, updates: DataFrame, key: str, partition_col: str, locator: str | None = None,
              inserted: DataFrame | None = None) -> DataFrame:
    """The rows of ``target`` without those whose key is in ``updates``, and the
    updates (or those of them that are to be ``inserted``), clustered as by
    ``clustered``. A whole row is shuffled once, to its place in the table, beside
    rows of its ``locator``. Where a replaced row lies is found from key hashes and
    dates alone; the key is sent to that place, and there rows of equal key are
    dropped. A hash that meets by chance sends a key where it finds no row."""
    places = [partition_col, CLUSTER_COLS[0], *([locator] if locator not in (None, key) else [])]
    at = (target.select(F.xxhash64(key).alias("_hash"), *places)
          .join(updates.select(F.xxhash64(key).alias("_hash"), key), "_hash").select(key, *places))
    updates = updates if inserted is None else inserted
    kind = "_kind"                                    # 0: old row, 1: new row, 2: key of an old row to drop
    merged = target.withColumn(kind, F.lit(0)).unionByName(updates.withColumn(kind, F.lit(1)), allowMissingColumns=True)
    columns = [c for c in merged.columns if c != kind]
    dealt = (merged.unionByName(at.withColumn(kind, F.lit(2)), allowMissingColumns=True)
             .withColumn("_hash", F.xxhash64(key)).repartitionByRange(*places, "_hash"))
    met = F.max(kind).over(Window.partitionBy(*places, "_hash", key))
    kept = (dealt.withColumn("_met", met)
            .where((F.col(kind) == 1) | ((F.col(kind) == 0) & (F.col("_met") < 2))).select(*columns))
    return kept.sortWithinPartitions(*_sort_columns(kept, partition_col))


def upsert(spark: SparkSession, updates: DataFrame | list[DataFrame], target_path: str,
           key: str = "order_line_sk", partition_col: str = PARTITION_COL,
           locator: str = "order_key", staged: bool = False, dealt: bool = False) -> dict:
    """B3 + B5: keyed upsert of ``updates`` into the table at ``target_path``;
    matches are replaced, new keys inserted, nothing deleted.

    Touched partitions are the partitions of the updates plus the current
    partitions of updated keys: a corrected date can move a row to another
    month, and its old copy must go. All of them change in one version; a
    partition that ends up empty is in it no more. New columns are added (NULL
    in old rows); columns missing from the updates are kept (NULL in new rows).
    Returns a small summary (partitions touched/removed).

    ``locator`` is a column the key is made from (equal keys have equal
    locators). Moved rows are found by it: 8 bytes a row, skipped by row-group
    ranges, instead of the key hashes of the whole target. It loses nothing: it
    can only touch partitions too many. Without such a column on both sides the
    key itself is used. ``staged`` says that the updates are read from files,
    so that they need no copy; ``dealt`` and a list of slices are for a first load, as
    in ``write_fact``. Touched partitions are written in slices, too.
    """
    version = versions.current(spark, target_path)
    if version is None and _is_plain(spark, target_path):
        raise ValueError(f"{target_path} is a plain folder: write its rows as a table (write_fact) elsewhere first")
    if version is None or not any(version.parts.values()):
        write_fact(updates, target_path, key=key, dealt=dealt)
        return {"first_load": True, "touched": None, "removed": []}
    if isinstance(updates, list):
        raise ValueError(f"{target_path} holds rows: slices are for a first load")
    if partition_col not in updates.columns:
        updates = with_order_month(updates)
    # Compute the batch once: it usually comes from the order-line pipeline,
    # and it is read several times below (key check, touched partitions,
    # merge). The staged copy also fixes its content if a task has to be
    # recomputed.
    batch_path = None if staged else scratch_path(spark, "upsert-batch")
    if batch_path:
        schema = updates.schema
        updates.write.mode("overwrite").option("compression", STORED_CODEC).parquet(batch_path)
        updates = spark.read.schema(schema).parquet(batch_path)
    assert_unique_keys(updates, key)
    target = versions.read(spark, target_path, version)
    if locator not in updates.columns or locator not in target.columns:
        locator = key
    # One value per partition: bounded by the number of months, not rows.
    touched = sorted((r[0] for r in updates.select(partition_col)
                      .union(_months_of_orders(target, updates, locator, partition_col))
                      .distinct().collect()), key=lambda v: (v is None, v or 0))
    names = [versions.part_name(partition_col, v) for v in touched]
    # Only the touched months' folders are read, and of a slice only its months'.
    held = versions.part_bytes(spark, target_path, version, names)
    sizes = {(v, p): held[p] for v, p in zip(touched, names)}
    slices, name = in_slices(sizes, slice_count(sum(held.values()))) or [[]], None
    for months in slices:
        inserted = updates if len(slices) == 1 else updates.where(is_one_of(partition_col, [v for v, _ in months]))
        merged = _replaced(versions.read(spark, target_path, version, [p for _, p in months]), updates, key,
                           partition_col, locator, inserted)
        name, written = versions.write_parts(merged, target_path, partition_col, name)
        drop_unused_shuffles(spark)
    parts = {p: f for p, f in version.parts.items() if p not in names} | {p: [name] for p in written}
    versions.publish(spark, target_path, version, merged.schema, partition_col, parts, version.notes)
    if batch_path:                  # read by nothing after the write
        delete_path(spark, batch_path)
    drop_unused_shuffles(spark)
    return {"first_load": False, "touched": touched,
            "removed": [v for v, p in zip(touched, names) if p not in written and p in version.parts]}


def is_one_of(col: str, values: list) -> Column:
    """Whether a column holds one of ``values``, None among them or not."""
    known = F.col(col).isin([v for v in values if v is not None])
    return known | F.col(col).isNull() if None in values else known


def store_failures(failures: DataFrame, root: str, check_name: str) -> str:
    """Keep a check's failing rows, one folder per check (overwritten)."""
    path = f"{root.rstrip('/')}/{check_name}"
    failures.write.mode("overwrite").option("compression", STORED_CODEC).parquet(path)
    return path


def sample_failures(failures: DataFrame, limit: int = FAILURE_DISPLAY_LIMIT) -> DataFrame:
    """The first ``limit`` failing rows, for display only; counts are
    always taken on the full failure set."""
    return failures.limit(limit)
