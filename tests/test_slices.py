"""Line-sized data shuffled slice by slice: the same rows, and no step left out."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ordermart import session
from ordermart.operators import check_state, load, quality, versions
from ordermart.plans.models import Models
from tests.conftest import SF_SMALL, rows

COLS = ("order_line_sk", "customer_sk", "product_sk", "order_date", "net_revenue", "clerk_name", "is_late_delivery")


@pytest.fixture()
def sliced(monkeypatch):
    monkeypatch.setattr(session, "SLICE_BYTES", 1)
    monkeypatch.setattr(session, "MOST_SLICES", 3)


def test_slices_grow_with_the_files_up_to_a_number():
    assert session.slice_count(0) == session.slice_count(session.SLICE_BYTES) == 1
    assert session.slice_count(session.SLICE_BYTES + 1) == 2
    assert session.slice_count(1 << 50) == session.MOST_SLICES
    assert session.in_slices({"a": 5, "b": 0, "c": 1, "d": 9, None: 3}, 3) == [["a", "b", "c"], ["d"], [None]]
    assert session.in_slices({"a": 0, "b": 0}, 1) == [["a", "b"]] and session.in_slices({}, 3) == []


@pytest.mark.parametrize("renumber", ["stored", "skew_safe"])
def test_orders_are_joined_in_slices(spark, sliced, renumber):
    """F1, F2-F8: a slice is cut before its lines are numbered, joined or shuffled."""
    m = Models(spark, SF_SMALL, renumber_lines=renumber)
    plan = m.joined_lines.where(F.pmod(F.xxhash64("order_key"), F.lit(3)) == 1)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join", 1)
    assert "xxhash64" not in above
    if renumber == "skew_safe":
        assert "xxhash64" not in below.split("Window", 1)[0].rsplit("Join", 1)[1] and "xxhash64(l_orderkey" in below
    want, lines = rows(m.fact, *COLS), m.enriched.count()
    checks = [c for c in quality.DECLARED_CHECKS if c.table == "int_orders_enriched"] + [
        quality.Check("int_orders_enriched", "quantity", "expression_is_true", "> 20")]
    few = m.enriched.where("quantity <= 20").count()
    whole = Models(spark, SF_SMALL, renumber_lines=renumber)
    counts = m.stored_order_lines(checks)
    assert m.slices == 3 and counts == whole.stored_order_lines(checks, 1) and counts[checks[-1].name] == few > 0
    assert rows(m.fact, *COLS) == want and m.enriched.count() == lines


def test_the_fact_is_written_in_slices_of_months(spark, sliced, tmp_dir):
    """F2-F8"""
    m = Models(spark, SF_SMALL, renumber_lines=True)
    until = m.stg_orders.agg(F.max("order_date")).first()[0] - dt.timedelta(days=400)
    moved = F.when(F.col("order_key") % 7 == 0, F.date_add("order_date", 40)).otherwise(F.col("order_date"))
    for args in ({}, {"until": until}, {"date": moved}, {"until": dt.date(1900, 1, 1)}):
        slices = m.fact_in_slices(**args)
        path = f"{tmp_dir}/{len(slices)}-{'-'.join(args)}-{args.get('until', '')}"
        load.write_fact(slices, path, key="order_line_sk", dealt=True)
        want = m.fact_by_month(**args)
        assert rows(load.read_target(spark, path), *COLS, "order_month") == rows(want, *COLS, "order_month")
        months = [{r[0] for r in s.select("order_month").distinct().collect()} for s in slices]
        assert sum(map(len, months)) == len(set.union(*months)) == want.select("order_month").distinct().count()
    assert len(m.fact_in_slices()) == 3


def test_an_upsert_in_slices_moves_rows_between_them(spark, sliced, tmp_dir):
    """A row leaves a month of one slice for a month of another."""
    schema = "order_key long, order_line_sk string, order_date date, market_segment string, net_revenue double"
    old = [(i, f"k{i}", None if i == 9 else dt.date(2000, 1 + i, 5), "B", float(i)) for i in range(10)]
    new = [(0, "k0", dt.date(2000, 9, 9), "B", 100.0), (8, "k8", dt.date(2000, 1, 1), "B", 108.0), (9, "k9", dt.date(2000, 5, 5), "B", 109.0),
           (3, "k3", None, "B", 103.0), (77, "n", dt.date(2001, 5, 5), "B", 177.0), (4, "k4", dt.date(2000, 5, 6), "C", 104.0)]
    path = f"{tmp_dir}/fact"
    load.upsert(spark, spark.createDataFrame(old, schema), path)
    written = []
    with pytest.MonkeyPatch.context() as p:
        real = versions.write_parts
        p.setattr(versions, "write_parts", lambda *a: written.append(real(*a)) or written[-1])
        info = load.upsert(spark, spark.createDataFrame(new, schema), path)
    assert len(written) >= 3 and len({name for name, _ in written}) == 1
    assert rows(load.read_target(spark, path), "order_line_sk", "order_date", "net_revenue") == rows(spark.createDataFrame(
        [r for r in old if r[1] not in {n[1] for n in new}] + new, schema), "order_line_sk", "order_date", "net_revenue")
    assert info["removed"] == [200004] and 200105 in info["touched"] and None in info["touched"]
    assert load.upsert(spark, spark.createDataFrame([], schema), path)["touched"] == []
    with pytest.raises(ValueError, match="first load"):
        load.upsert(spark, [spark.createDataFrame(new, schema)], path)


def test_orphans_and_repeated_keys_are_found_in_slices(spark, tmp_dir):
    """F1, F9, F10"""
    schema = ("order_line_sk string, order_key long, line_number int, order_date date, market_segment string, "
              "customer_sk string, product_sk string, order_date_sk int, ship_date_sk int")
    day = dt.date(2000, 1, 1)
    fact = spark.createDataFrame([(f"l{i % 50}", i, 1, day + dt.timedelta(days=3 * i), "B", None if i == 5 else f"c{i % 9}", f"p{i % 11}",
                                   20000101 + i % 4, -1 if i % 2 else 20000104) for i in range(60)], schema)
    dims = (spark.createDataFrame([(f"c{i}",) for i in range(7)], "customer_sk string"),
            spark.createDataFrame([(f"p{i}",) for i in range(10)], "product_sk string"),
            spark.createDataFrame([(20000101 + i,) for i in range(3)], "date_sk int"))
    want = rows(quality.orphan_fks(fact, *dims, check_ship_date=True, written=True))
    assert want and want == rows(quality.orphan_fks(fact, *dims, check_ship_date=True, slices=3))
    assert want == rows(quality.orphan_fks(fact, *dims, check_ship_date=True))
    by_month = [check_state._by_month(load.with_order_month(fact), [], "order_line_sk", "unique",
                                      dict(zip(("dim_customer", "dim_product", "dim_date"), dims)), n) for n in (1, 3)]
    assert by_month[0] == by_month[1] and sum(f.get("unique", 0) for _, f in by_month[0].values()) == 10


@pytest.mark.parametrize("name", ["fact_full_refresh", "maintained_top_customers"])
def test_queries_in_slices(spark, sliced, name):
    query = entry.queries()[name]
    got = rows(query(spark, SF_SMALL))
    with pytest.MonkeyPatch.context() as p:
        p.setattr(session, "MOST_SLICES", 1)
        assert got == rows(query(spark, SF_SMALL)) and got
