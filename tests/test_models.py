"""Staging, order-line model, dimensions and fact on hand-made tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ordermart.operators import dimensions, enrich, facts, scd2, staging
from tests.conftest import rows

D = dt.datetime


def orders_df(spark, data):
    return spark.createDataFrame(data, "o_orderkey long, o_custkey long, o_orderstatus string, "
                                       "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string, "
                                       "o_clerk string, o_shippriority int, o_comment string")


def customers_df(spark, data):
    return spark.createDataFrame(data, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                                       "c_mktsegment string, c_address string, c_phone string, c_comment string")


def geo(spark):
    nation = spark.createDataFrame([(0, "NATION_0", 0), (1, "NATION_1", 1)],
                                   "n_nationkey int, n_name string, n_regionkey int")
    region = spark.createDataFrame([(0, "AFRICA"), (1, "AMERICA")], "r_regionkey int, r_name string")
    return nation, region


def test_order_validity(spark):
    o = orders_df(spark, [
        (1, 10, "O", 5.0, D(2000, 1, 1), "1-URGENT", None, 0, None),
        (None, 10, "O", 5.0, D(2000, 1, 1), "1-URGENT", None, 0, None),
        (3, None, "O", 5.0, D(2000, 1, 1), "1-URGENT", None, 0, None),
        (4, 10, "O", 5.0, None, "1-URGENT", None, 0, None),
        (5, 10, "O", None, D(2000, 1, 1), "1-URGENT", None, 0, None),
        (6, 10, "O", -1.0, D(2000, 1, 1), "1-URGENT", None, 0, None),
        (7, 10, "O", 0.0, D(2000, 1, 1), "1-URGENT", None, 0, None),
        (8, 10, "X", 1.0, D(2000, 1, 1), "unknown", None, 0, None),
        (9, 10, None, 1.0, D(2000, 1, 1), None, None, 0, None),
    ])
    out = staging.stg_orders(o)
    assert rows(out, "order_key", "order_status_desc", "order_priority_rank") == [
        (1, "Open", 1), (7, "Open", 1), (8, "Unknown", 99), (9, "Unknown", 99)]
    assert dict(out.dtypes)["order_date"] == "date"


def test_customer_geography_left_joins(spark):
    nation, region = geo(spark)
    c = customers_df(spark, [(1, "a", 0, 10.0, "BUILDING", None, None, None),
                             (2, "b", 7, -5.0, "BUILDING", None, None, None)])
    out = staging.stg_customers(c, nation, region)
    assert rows(out, "customer_key", "nation_name", "region_name", "account_tier") == [
        (1, "NATION_0", "AFRICA", "Bronze"), (2, None, None, "Negative")]


def test_best_supplier_ties_and_missing(spark):
    ps = spark.createDataFrame([(1, 20, 5, 3.0), (1, 10, 6, 3.0), (1, 5, 7, 4.0), (2, 1, 1, 1.0)],
                               "ps_partkey long, ps_suppkey long, ps_availqty int, ps_supplycost double")
    best = staging.best_supplier(ps)
    assert rows(best, "part_key", "supplier_key", "available_qty") == [(1, 10, 6), (2, 1, 1)]
    part = spark.createDataFrame(
        [(1, "p1", "B#1", "STANDARD POLISHED TIN", 5, 100.0, "SM BOX", "M#1", None),
         (3, "p3", "B#3", "ECONOMY", 5, 100.0, "JUMBO", "M#3", None)],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double, p_container string, p_mfgr string, p_comment string")
    prod = staging.stg_products(part, ps)
    got = {r.product_key: r for r in prod.collect()}
    assert (got[1].product_size_segment, got[1].product_finish, got[1].product_material) == \
        ("STANDARD", "POLISHED", "TIN")
    assert got[1].estimated_margin_pct == (100.0 - 3.0) / 100.0
    assert (got[3].product_finish, got[3].container_type) == ("", "")   # missing parts -> ''
    assert got[3].supply_cost is None and got[3].estimated_margin_pct is None


def _lines(spark, data):
    return spark.createDataFrame(data, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                                       "l_quantity double, l_extendedprice double, l_discount double, "
                                       "l_tax double, l_returnflag string, l_linestatus string, "
                                       "l_shipdate timestamp_ntz, l_commitdate date, l_receiptdate date, "
                                       "l_shipinstruct string, l_shipmode string, l_comment string")


def small_world(spark):
    nation, region = geo(spark)
    o = orders_df(spark, [(1, 10, "O", 5.0, D(2000, 1, 1), "1-URGENT", "c", 0, None),
                          (2, 99, "F", 5.0, D(2000, 1, 2), "2-HIGH", "c", 0, None)])   # no customer 99
    c = customers_df(spark, [(10, "Customer#10", 0, 10.0, "BUILDING", None, None, None)])
    ps = spark.createDataFrame([(1, 1, 5, 1.0)], "ps_partkey long, ps_suppkey long, ps_availqty int, "
                                                 "ps_supplycost double")
    part = spark.createDataFrame([(1, "p1", "B#1", "STANDARD POLISHED TIN", 5, 100.0, "SM BOX", "M#1", None)],
                                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
                                 "p_retailprice double, p_container string, p_mfgr string, p_comment string")
    li = _lines(spark, [
        (1, 1, 1, 1, 2.0, 100.0, 0.05, 0.08, "R", "F", D(2000, 1, 3), dt.date(2000, 1, 3), dt.date(2000, 1, 5), "NONE", "AIR", None),
        (1, 7, 1, 2, 1.0, 50.0, 0.0, 0.0, "N", "O", D(2000, 1, 4), dt.date(2000, 1, 3), dt.date(2000, 1, 9), "NONE", "AIR", None),
        (2, 1, 1, 1, 1.0, 10.0, 0.0, 0.0, "N", "O", D(2000, 1, 4), dt.date(2000, 1, 3), dt.date(2000, 1, 9), "NONE", "AIR", None),
        (3, 1, 1, 1, 1.0, 10.0, 0.0, 0.0, "N", "O", D(2000, 1, 4), dt.date(2000, 1, 3), dt.date(2000, 1, 9), "NONE", "AIR", None),
    ])
    so = staging.stg_orders(o)
    sc = staging.stg_customers(c, nation, region)
    sp = staging.stg_products(part, ps)
    return so, sc, sp, enrich.line_items(li)


def test_join_edges_and_revenue(spark):
    so, sc, sp, lines = small_world(spark)
    e = enrich.orders_enriched(so, sc, sp, lines)
    got = {(r.order_key, r.line_number): r for r in e.collect()}
    # line without order (3) and order without customer (2) drop out; unknown part (7) stays
    assert set(got) == {(1, 1), (1, 2)}
    r = got[(1, 1)]
    assert (r.net_revenue, r.gross_revenue, r.discount_amount, r.tax_amount) == (95.0, 102.6, 5.0, 7.6)
    assert r.unit_price == 50.0 and r.net_unit_price == 47.5
    assert (r.days_to_ship, r.days_in_transit, r.total_fulfillment_days, r.days_late) == (2, 2, 4, 0)
    assert r.delivery_status == "On-Time" and r.fiscal_year == 2000 and r.fiscal_quarter == 2
    unknown = got[(1, 2)]
    assert unknown.product_key is None and unknown.product_name is None
    assert unknown.delivery_status == "Late" and unknown.days_late == 1
    assert len(e.columns) == 51


def test_fact_unknown_members_and_keys(spark):
    so, sc, sp, lines = small_world(spark)
    dc = scd2.dim_customer(scd2.single_version(sc))
    e = enrich.orders_enriched(so, sc, sp, lines, facts.current_customer_keys(dc))
    f = facts.fact_orders(e, "2001-01-01 00:00:00")
    got = {r.line_number: r for r in f.collect()}
    assert got[1].product_sk != "-1" and got[2].product_sk == "-1"
    assert got[1].customer_sk == dc.first().customer_sk
    assert got[1].order_date_sk == 20000101 and got[1].ship_date_sk == 20000103
    assert (got[1].is_returned, got[1].has_discount, got[1].is_multi_unit, got[1].is_late_delivery) == \
        (True, True, True, False)
    # the join-free product key equals a real join to dim_product
    dp = dimensions.dim_product(sp)
    f2 = facts.fact_orders(e, "2001-01-01 00:00:00", dim_product=dp)
    assert rows(f, "order_line_sk", "product_sk") == rows(f2, "order_line_sk", "product_sk")
    assert len(f.columns) == 50


def test_fact_date_outside_spine_is_unknown(spark):
    so, sc, sp, lines = small_world(spark)
    dc = scd2.dim_customer(scd2.single_version(sc))
    e = enrich.orders_enriched(so, sc, sp, lines, facts.current_customer_keys(dc))
    f = facts.fact_orders(e, None, date_start="2000-01-02", date_end="2030-12-31")
    assert {r.order_date_sk for r in f.collect()} == {-1}


def test_dim_date_contract(spark):
    dd = dimensions.dim_date(spark, "2001-08-01")
    assert dd.count() == 14245
    assert dimensions.date_spine(spark, end_inclusive=False).count() == 14244
    r = {x.full_date: x for x in dd.where(F.col("full_date").isin(
        dt.date(1992, 1, 1), dt.date(2001, 8, 1), dt.date(2001, 7, 31), dt.date(2030, 12, 31))).collect()}
    first = r[dt.date(1992, 1, 1)]
    assert (first.date_sk, first.day_of_week, first.day_name, first.month_name,
            first.quarter_label, first.fiscal_quarter_label, first.week_of_year) == \
        (19920101, 3, "Wed", "Jan", "Q1-1992", "FY1992-Q2", 1)
    assert r[dt.date(2001, 8, 1)].is_today and r[dt.date(2001, 7, 31)].is_yesterday
    assert r[dt.date(2001, 7, 31)].is_current_year and not r[dt.date(2001, 7, 31)].is_current_month
    assert r[dt.date(2030, 12, 31)].is_last_of_month and r[dt.date(1992, 1, 1)].is_first_of_month
    assert dd.select("date_sk").distinct().count() == 14245


def test_date_spine_cover_widens(spark):
    cover = spark.createDataFrame([(dt.date(1990, 1, 1),), (dt.date(1991, 1, 1),)], "d date")
    s = dimensions.date_spine(spark, "1992-01-01", "1992-01-10", cover=cover)
    got = [r.date_day for r in s.collect()]
    assert got[0] == dt.date(1990, 1, 1) and got[-1] == dt.date(1992, 1, 10)


def test_as_of_lookup_matches_brute_force(spark):
    """Point-in-time customer keys on sf0.001 against a pandas brute force."""
    from ordermart.plans.models import Models
    from tests.conftest import SF_SMALL
    m = Models(spark, SF_SMALL)
    keys = facts.as_of_customer_keys(m.dim_customer)
    got = facts.lookup_customer(m.stg_orders.select("order_key", "customer_key", "order_date"), keys)
    got = {r.order_key: r.customer_sk for r in got.collect()}
    orders = m.stg_orders.select("order_key", "customer_key", "order_date").toPandas()
    dim = m.dim_customer.select("customer_key", "customer_sk", "effective_from", "effective_to").toPandas()
    by_key = {k: g for k, g in dim.groupby("customer_key")}
    for o in orders.itertuples():
        g = by_key.get(o.customer_key)
        hit = None if g is None else g[(g.effective_from <= o.order_date) & (o.order_date <= g.effective_to)]
        want = None if hit is None or hit.empty else hit.customer_sk.iloc[0]
        assert got[o.order_key] == want
    assert len(got) == len(orders)
