"""SCD2 versions, capture and the gap check (FIXTURES §4: scd2_history, scd2_bad)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ordermart.functions import core as fn
from ordermart.operators import quality, scd2
from tests.conftest import rows

T = dt.datetime
SNAP = ("c_custkey long, c_name string, c_address string, c_phone string, c_mktsegment string, "
        "c_comment string, n_name string, r_name string, c_acctbal decimal(12,2), scd_id string, "
        "updated_at timestamp, valid_to timestamp")


def snap_row(key, bal, upd, valid_to, sid=None):
    return (key, f"C{key}", None, None, "BUILDING", None, "NATION_1", "AMERICA", Decimal(bal),
            sid or f"h{key}-{upd:%Y%m%d%H}", upd, valid_to)


def history(spark):
    return spark.createDataFrame([
        snap_row(1, "100", T(1992, 1, 1), None),                                   # one version
        snap_row(2, "3000", T(1992, 1, 1), T(1996, 6, 15)),                        # two versions
        snap_row(2, "6000", T(1996, 6, 15), None),
        snap_row(3, "-5", T(1992, 1, 1), T(1996, 6, 15)),                          # three versions
        snap_row(3, "100", T(1996, 6, 15), T(1998, 3, 1)),
        snap_row(3, "8000", T(1998, 3, 1), None),
        snap_row(4, "100", T(1995, 1, 1, 8), T(1995, 1, 1, 17)),                  # two changes on one day
        snap_row(4, "200", T(1995, 1, 1, 17), None),
        snap_row(5, "100", T(1993, 1, 1), T(1994, 1, 1)),                          # deleted: no open row
    ], SNAP)


def test_versions(spark):
    dim = scd2.dim_customer(scd2.read_customer_history(history(spark)))
    got = rows(dim, "customer_key", "effective_from", "effective_to", "is_current", "account_tier")
    d = dt.date
    assert got == [
        (1, d(1992, 1, 1), d(9999, 12, 31), True, "Bronze"),
        (2, d(1992, 1, 1), d(1996, 6, 14), False, "Silver"),
        (2, d(1996, 6, 15), d(9999, 12, 31), True, "Gold"),
        (3, d(1992, 1, 1), d(1996, 6, 14), False, "Negative"),
        (3, d(1996, 6, 15), d(1998, 2, 28), False, "Bronze"),
        (3, d(1998, 3, 1), d(9999, 12, 31), True, "Platinum"),
        (4, d(1995, 1, 1), d(1994, 12, 31), False, "Bronze"),   # same-day change: inverted range
        (4, d(1995, 1, 1), d(9999, 12, 31), True, "Bronze"),
        (5, d(1993, 1, 1), d(9999, 12, 31), False, "Bronze"),   # deleted: open end, not current
    ]
    # exactly one current version per live customer
    cur = dim.where("is_current").groupBy("customer_key").count()
    assert cur.where("count <> 1").count() == 0
    # same-day versions collide on customer_sk, as in the reference
    assert dim.where("customer_key = 4").select("customer_sk").distinct().count() == 1


def test_collapse_same_day(spark):
    dim = scd2.dim_customer(scd2.read_customer_history(history(spark), collapse_same_day=True))
    k4 = rows(dim.where("customer_key = 4"), "effective_from", "effective_to", "account_balance")
    assert k4 == [(dt.date(1995, 1, 1), dt.date(9999, 12, 31), 200.0)]


def test_gap_check_boundaries(spark):
    dim = scd2.dim_customer(scd2.read_customer_history(history(spark)))
    inclusive = quality.scd2_gaps(dim, "inclusive")
    # the same-day pair is contiguous by the inclusive rule but its first range is inverted
    assert rows(inclusive, "customer_key", "failure_reason") == [
        (4, "effective_to before effective_from")]
    as_written = quality.scd2_gaps(dim, "as_written")
    assert sorted({r.customer_key for r in as_written.collect()}) == [2, 3, 4]


def test_gap_check_bad_ranges(spark):
    d = dt.date
    dim = spark.createDataFrame([
        (1, "a", d(2000, 1, 1), d(2000, 1, 10)), (1, "b", d(2000, 1, 15), d(9999, 12, 31)),   # gap
        (2, "c", d(2000, 1, 1), d(2000, 1, 20)), (2, "d", d(2000, 1, 15), d(9999, 12, 31)),   # overlap
        (3, "e", d(2000, 1, 10), d(2000, 1, 1)),                                               # inverted
        (4, "f", d(2000, 1, 1), d(2000, 1, 9)), (4, "g", d(2000, 1, 10), d(9999, 12, 31)),    # contiguous
        (5, "h", d(2000, 1, 1), d(2000, 1, 10)), (5, "i", d(2000, 1, 10), d(9999, 12, 31)),   # touching
    ], "customer_key long, customer_sk string, effective_from date, effective_to date")
    got = rows(quality.scd2_gaps(dim, "inclusive"), "customer_key", "customer_sk", "failure_reason")
    assert got == [(1, "a", "GAP or OVERLAP between versions"),
                   (2, "c", "GAP or OVERLAP between versions"),
                   (3, "e", "effective_to before effective_from"),
                   (5, "h", "GAP or OVERLAP between versions")]
    lit = rows(quality.scd2_gaps(dim, "as_written"), "customer_key", "customer_sk")
    assert lit == [(1, "a"), (2, "c"), (3, "e"), (4, "f")]


def test_capture(spark):
    snap = history(spark).where("c_custkey in (1, 2)")
    inc_schema = ("c_custkey long, c_name string, c_address string, c_phone string, c_mktsegment string, "
                  "c_comment string, n_name string, r_name string, c_acctbal decimal(12,2), updated_at timestamp")
    now = T(2001, 8, 1)
    # snapshot hashes must be the real row hashes for the unchanged test
    snap = snap.withColumn("scd_id", fn.row_hash("c_custkey", "c_name", "c_mktsegment", "n_name", "c_acctbal"))
    inc = spark.createDataFrame([
        (1, "C1", None, None, "BUILDING", None, "NATION_1", "AMERICA", Decimal("100"), now),    # unchanged
        (2, "C2", None, None, "BUILDING", None, "NATION_1", "AMERICA", Decimal("9000"), now),   # changed
        (6, "C6", None, None, "BUILDING", None, "NATION_1", "AMERICA", Decimal("1"), now),      # new key
    ], inc_schema)
    out = scd2.scd2_capture(snap, inc)
    got = rows(out, "c_custkey", "c_acctbal", "updated_at", "valid_to")
    assert got == [
        (1, Decimal("100.00"), T(1992, 1, 1), None),
        (2, Decimal("3000.00"), T(1992, 1, 1), T(1996, 6, 15)),
        (2, Decimal("6000.00"), T(1996, 6, 15), now),
        (2, Decimal("9000.00"), now, None),
        (6, Decimal("1.00"), now, None),
    ]
    # applying the same batch again changes nothing
    again = scd2.scd2_capture(out, inc)
    assert rows(again, "c_custkey", "c_acctbal", "updated_at", "valid_to") == got


def test_history_switch_by_path(spark, tmp_dir):
    stg = spark.createDataFrame([(1, "C1", None, None, "BUILDING", None, "NATION_1", "AMERICA", 10.0)],
                                "customer_key long, customer_name string, customer_address string, "
                                "customer_phone string, market_segment string, customer_comment string, "
                                "nation_name string, region_name string, account_balance double")
    missing = scd2.customer_history(stg, f"{tmp_dir}/no_such_history")
    assert rows(missing, "customer_key", "effective_from") == [(1, dt.date(1992, 1, 1))]
    history(spark).write.parquet(f"{tmp_dir}/hist")
    stored = scd2.customer_history(stg, f"{tmp_dir}/hist")
    assert stored.count() == 9


def test_capture_sees_every_attribute(spark):
    """Each stored attribute alone makes a new version, NULLs included."""
    base = (1, "C", "street", "phone", "BUILDING", None, "NATION_1", "AMERICA", Decimal("1.00"))
    changes = {"c_name": "D", "c_address": "road", "c_phone": None, "c_mktsegment": None, "c_comment": "x",
               "n_name": "NATION_2", "r_name": None, "c_acctbal": Decimal("2.00")}
    names = ["c_custkey", "c_name", "c_address", "c_phone", "c_mktsegment", "c_comment", "n_name", "r_name", "c_acctbal"]
    schema = ("c_custkey long, c_name string, c_address string, c_phone string, c_mktsegment string, "
              "c_comment string, n_name string, r_name string, c_acctbal decimal(12,2), updated_at timestamp")
    old, new = [], []
    for i, (col, value) in enumerate([*changes.items(), ("none", None)]):
        row = dict(zip(names, base)) | {"c_custkey": i}
        old.append((*row.values(), T(1992, 1, 1)))
        new.append((*(row | ({col: value} if col in row else {})).values(), T(2001, 8, 1)))
    snap = spark.createDataFrame(old, schema).withColumn("scd_id", F.lit("h")).withColumn(
        "valid_to", F.lit(None).cast("timestamp"))
    out = scd2.scd2_capture(snap, spark.createDataFrame(new, schema))
    versions = {r.c_custkey: r["count"] for r in out.groupBy("c_custkey").count().collect()}
    assert versions == {**{i: 2 for i in range(len(changes))}, len(changes): 1}
    always = scd2.scd2_capture(snap, spark.createDataFrame(new, schema), require_change=False)
    assert always.count() == 2 * (len(changes) + 1)
