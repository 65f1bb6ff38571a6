"""Look-back filter and keyed upsert into partitioned parquet (FIXTURES §4: upsert_cases)."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ordermart.operators import load, versions
from tests.conftest import rows

d = dt.date
SCHEMA = "order_line_sk string, order_date date, market_segment string, net_revenue double"


def fact(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def months_of(spark, path):
    return sorted(versions.current(spark, path).parts)


def test_first_load_and_update_insert(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    base = fact(spark, [("a", d(2000, 1, 5), "BUILDING", 1.0), ("b", d(2000, 2, 5), "BUILDING", 2.0)])
    info = load.upsert(spark, base, path)
    assert info["first_load"]
    assert months_of(spark, path) == ["order_month=200001", "order_month=200002"]
    upd = fact(spark, [("a", d(2000, 1, 5), "BUILDING", 10.0), ("c", d(2000, 3, 1), "MACHINERY", 3.0)])
    info = load.upsert(spark, upd, path)
    assert info["touched"] == [200001, 200003]
    got = rows(load.read_target(spark, path), "order_line_sk", "net_revenue", "order_month")
    assert got == [("a", 10.0, 200001), ("b", 2.0, 200002), ("c", 3.0, 200003)]


def test_moved_key_empties_partition(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    load.upsert(spark, fact(spark, [("a", d(2000, 1, 5), "B", 1.0), ("b", d(2000, 2, 5), "B", 2.0)]), path)
    # 'a' moves to February: January becomes empty and must disappear
    info = load.upsert(spark, fact(spark, [("a", d(2000, 2, 9), "B", 1.5)]), path)
    assert info["touched"] == [200001, 200002] and info["removed"] == [200001]
    assert months_of(spark, path) == ["order_month=200002"]
    got = rows(load.read_target(spark, path), "order_line_sk", "order_date", "net_revenue")
    assert got == [("a", d(2000, 2, 9), 1.5), ("b", d(2000, 2, 5), 2.0)]


def test_upsert_is_idempotent_and_slices_equal_full_load(spark, tmp_dir):
    data = [(f"k{i}", d(2000, 1 + i % 6, 1 + i % 27), "B", float(i)) for i in range(60)]
    full = f"{tmp_dir}/full"
    load.upsert(spark, fact(spark, data), full)
    sliced = f"{tmp_dir}/sliced"
    for m in range(1, 7):
        part = [r for r in data if r[1].month <= m and r[1].month > m - 2]   # overlapping slices
        load.upsert(spark, fact(spark, part), sliced)
    a = rows(load.read_target(spark, full), "order_line_sk", "order_date", "net_revenue")
    b = rows(load.read_target(spark, sliced), "order_line_sk", "order_date", "net_revenue")
    assert a == b and len(a) == 60
    load.upsert(spark, fact(spark, data), sliced)
    assert rows(load.read_target(spark, sliced), "order_line_sk", "order_date", "net_revenue") == a


def test_duplicate_or_null_keys_rejected(spark, tmp_dir):
    with pytest.raises(ValueError):
        load.upsert(spark, fact(spark, [("a", d(2000, 1, 1), "B", 1.0), ("a", d(2000, 1, 2), "B", 2.0)]),
                    f"{tmp_dir}/f")
    with pytest.raises(ValueError):
        load.upsert(spark, fact(spark, [(None, d(2000, 1, 1), "B", 1.0)]), f"{tmp_dir}/g")


def test_schema_drift(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    load.upsert(spark, fact(spark, [("a", d(2000, 1, 5), "B", 1.0), ("b", d(2000, 2, 5), "B", 2.0)]), path)
    # new column added, net_revenue dropped from the updates
    upd = fact(spark, [("b", d(2000, 2, 5), "B", 7)], "order_line_sk string, order_date date, "
                                                     "market_segment string, tax_amount int")
    load.upsert(spark, upd, path)
    t = load.read_target(spark, path)
    assert {"net_revenue", "tax_amount"} <= set(t.columns)
    got = rows(t, "order_line_sk", "net_revenue", "tax_amount")
    assert got == [("a", 1.0, None), ("b", None, 7)]


def test_empty_target_is_first_load(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    empty = fact(spark, [])
    load.write_fact(empty.withColumn("order_month", F.lit(1).cast("int")), path)
    src = fact(spark, [("a", d(2000, 1, 5), "B", 1.0)])
    # look-back against an empty target keeps everything (deliberate deviation)
    assert load.lookback_filter(src, load.read_target(spark, path)).count() == 1
    load.upsert(spark, src, path)
    assert load.read_target(spark, path).count() == 1


def test_lookback_edges(spark):
    target = fact(spark, [("t", d(2000, 3, 10), "B", 1.0)])
    src = fact(spark, [("on_edge", d(2000, 3, 7), "B", 1.0), ("outside", d(2000, 3, 6), "B", 1.0),
                       ("newer", d(2000, 3, 12), "B", 1.0)])
    got = sorted(r.order_line_sk for r in load.lookback_filter(src, target, days=3).collect())
    assert got == ["newer", "on_edge"]
    assert load.lookback_filter(src, None).count() == 3


def test_lookback_predicate_reaches_orders_scan(spark):
    from ordermart.plans.models import Models
    from tests.conftest import SF_SMALL
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        m = Models(spark, SF_SMALL, renumber_lines=True)
        src = load.lookback_filter(m.enriched, m.stg_orders.select("order_date"), days=3)
        plan = src._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = [ln for ln in plan.splitlines() if "orders.parquet" in ln]
    # the date literal reaches the scan's data filters as a plain column comparison
    assert scan and all("(o_orderdate#" in ln and ">= 2001-07-29" in ln for ln in scan), plan


def test_sample_failures_is_display_only(spark):
    failing = spark.range(2000)
    assert load.sample_failures(failing).count() == 500
    assert failing.count() == 2000


def test_write_table_replaces_all_rows(spark, tmp_dir):
    path = f"{tmp_dir}/dim"
    assert load.read_target(spark, path) is None
    load.write_table(spark.range(3), path)
    # the new version may be computed from the table it replaces
    load.write_table(load.read_target(spark, path).union(spark.range(10, 12)), path)
    assert sorted(r.id for r in load.read_target(spark, path).collect()) == [0, 1, 2, 10, 11]
    load.write_table(spark.range(0), path)
    assert load.read_target(spark, path).count() == 0 and load.read_target(spark, path).columns == ["id"]


def test_a_reader_disturbs_no_write_and_a_write_no_reader(spark, tmp_dir):
    path = f"{tmp_dir}/dim"
    load.write_table(spark.range(3), path)
    before = versions.current(spark, path)
    opened = load.read_target(spark, path)
    name, parts = versions.write_parts(spark.range(9), path, None)         # a write goes on
    assert load.read_target(spark, path).count() == 3
    versions.publish(spark, path, before, opened.schema, None, {p: [name] for p in parts})
    assert load.read_target(spark, path).count() == 9
    assert opened.count() == 3                                             # opened before, still whole


def three_months(spark):
    return fact(spark, [(1, "a", d(2000, 1, 5), "B", 1.0), (2, "b", d(2000, 2, 5), "B", 2.0),
                        (3, "c", d(2000, 3, 5), "B", 3.0)], "order_key long, " + SCHEMA)


@pytest.mark.parametrize("step", ["assert_unique_keys", "write_parts", "publish", "rename_path"])
def test_crash_at_each_step_leaves_the_old_table(spark, tmp_dir, monkeypatch, step):
    """A batch that touches three months, and moves a row between two: the
    table has all of it or nothing."""
    path = f"{tmp_dir}/fact"
    load.upsert(spark, three_months(spark), path)
    old = rows(load.read_target(spark, path))
    batch = fact(spark, [(1, "a", d(2000, 2, 9), "B", 9.0), (3, "c", d(2000, 3, 5), "B", 9.0)], "order_key long, " + SCHEMA)
    module = load if step == "assert_unique_keys" else versions
    real = getattr(module, step)

    def crash(*args, **kwargs):
        if step == "write_parts":
            real(*args, **kwargs)               # the files are there, nothing more
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(module, step, crash)
        with pytest.raises(RuntimeError, match="lost"):
            load.upsert(spark, batch, path)
    assert rows(load.read_target(spark, path)) == old
    info = load.upsert(spark, batch, path)
    assert info["touched"] == [200001, 200002, 200003] and info["removed"] == [200001]
    assert rows(load.read_target(spark, path), "order_line_sk", "net_revenue") == [("a", 9.0), ("b", 2.0), ("c", 9.0)]


def test_plain_folders_are_read_but_not_merged_into(spark, tmp_dir):
    plain = f"{tmp_dir}/plain"
    load.with_order_month(three_months(spark)).write.partitionBy("order_month").parquet(plain)
    assert load.read_target(spark, plain).count() == 3
    with pytest.raises(ValueError, match="plain folder"):
        load.upsert(spark, three_months(spark), plain)


def test_second_of_two_writers_is_told(spark, tmp_dir):
    path = f"{tmp_dir}/dim"
    load.write_table(spark.range(3), path)
    before = versions.current(spark, path)
    load.write_table(spark.range(4), path)
    with pytest.raises(versions.WriteConflict):
        versions.publish(spark, path, before, before.schema, None, before.parts)
    assert load.read_target(spark, path).count() == 4


def test_vacuum_keeps_what_kept_versions_name(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    load.upsert(spark, three_months(spark), path)
    for revenue in (5.0, 6.0, 7.0):
        load.upsert(spark, fact(spark, [(2, "b", d(2000, 2, 5), "B", revenue)], "order_key long, " + SCHEMA), path)
    versions.write_parts(load.with_order_month(three_months(spark)), path, "order_month")        # never published
    now = rows(load.read_target(spark, path))
    assert versions.vacuum(spark, path, keep=2) == []                       # too young
    removed = versions.vacuum(spark, path, keep=2, older_than_seconds=-60)
    assert len(removed) == 2 + 3                # two old Februaries, three months without a version
    assert rows(load.read_target(spark, path)) == now
    assert len(os.listdir(f"{path}/data/order_month=200002")) == 2


def test_rows_without_a_date_have_a_month_of_their_own(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    load.upsert(spark, fact(spark, [("a", None, "B", 1.0), ("b", d(2000, 2, 5), "B", 2.0)]), path)
    load.upsert(spark, fact(spark, [("a", None, "B", 5.0), ("c", None, None, 7.0)]), path)
    assert rows(load.read_target(spark, path), "order_line_sk", "net_revenue") == [("a", 5.0), ("b", 2.0), ("c", 7.0)]
    assert load.target_max(spark, path) == d(2000, 2, 5)
    info = load.upsert(spark, fact(spark, [("a", d(2000, 2, 1), "B", 6.0), ("c", d(2000, 2, 2), "B", 6.0)]), path)
    assert info["touched"] == [200002, None] and info["removed"] == [None]
    assert load.read_target(spark, path).count() == 3


def test_newest_date_comes_from_footers(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    assert load.target_max(spark, path) is None
    load.upsert(spark, three_months(spark), path)
    version = versions.current(spark, path)
    plan = load.footer_max(spark, version.folders(path), "order_date")
    assert "PushedAggregation: [MAX(order_date)]" in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.collect()[0].m == d(2000, 3, 5) == load.target_max(spark, path)
    assert load.stored_lookback_start(spark, path, 3) == d(2000, 3, 2)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"        # the session is as it was


def test_closed_history_is_not_written_again(spark, tmp_dir):
    path = f"{tmp_dir}/history"
    for day in range(4):
        load.write_history(spark.range(day * 10, day * 10 + 2), spark.range(100, 103 + day), path,
                           versions.current(spark, path), most_folders=3)
        got = load.read_target(spark, path)
        assert sorted(r.id for r in got.where("is_open = 0").collect()) == [x for i in range(day + 1) for x in (i * 10, i * 10 + 1)]
        assert got.where("is_open = 1").count() == 3 + day
        # the third folder is the last: on the fourth day all are written together
        assert len(versions.current(spark, path).parts["is_open=0"]) == (day + 1 if day < 3 else 1)


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_full_write_leaves_no_stale_month(spark, tmp_dir, mode):
    path = f"{tmp_dir}/fact"
    saved = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        both = [("a", d(2000, 1, 5), "B", 1.0), ("b", d(2000, 2, 5), "B", 2.0)]
        load.write_fact(fact(spark, both), path)
        load.write_fact(fact(spark, both[:1]), path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", saved)
    assert load.read_target(spark, path).count() == 1 and months_of(spark, path) == ["order_month=200001"]


def test_first_load_with_repeated_keys_leaves_nothing(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    with pytest.raises(ValueError):
        load.upsert(spark, fact(spark, [("a", d(2000, 1, 5), "B", 1.0), ("a", d(2000, 2, 5), "B", 2.0)]), path)
    assert load.read_target(spark, path) is None


def test_moved_line_is_found_by_order_key(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    schema = "order_key long, " + SCHEMA
    load.upsert(spark, fact(spark, [(1, "a", d(1995, 1, 5), "B", 1.0), (2, "b", d(2000, 6, 5), "B", 2.0)], schema), path)
    info = load.upsert(spark, fact(spark, [(1, "a", d(2000, 6, 9), "B", 1.5)], schema), path)
    assert info["removed"] == [199501]
    assert rows(load.read_target(spark, path), "order_line_sk", "net_revenue") == [("a", 1.5), ("b", 2.0)]
