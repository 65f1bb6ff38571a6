"""Dashboard measures and the distributed exact quantile."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordermart.operators import kpi, monitor
from ordermart.operators.quantiles import exact_quantiles
from tests.conftest import rows

d = dt.date
FACT = ("order_key long, order_date date, net_revenue double, is_late_delivery boolean, "
        "market_segment string, customer_sk string, days_late int, days_to_ship int, "
        "days_in_transit int, is_returned boolean, total_fulfillment_days int")


def fact(spark, data):
    return spark.createDataFrame(data, FACT)


def test_overview_and_on_time_denominator(spark):
    f = fact(spark, [
        (1, d(2000, 1, 1), 10.0, False, "A", "c1", 0, 1, 1, False, 2),
        (1, d(2000, 1, 1), 20.0, True, "A", "c1", 2, 1, 1, True, 2),
        (2, d(2000, 1, 2), 30.0, None, "B", "c2", None, 1, 1, False, 2),   # NULL flag still counts
    ])
    r = kpi.overview(f).first()
    assert (r.total_revenue, r.order_count, r.avg_order_value, r.line_count) == (60.0, 2, 30.0, 3)
    assert r.on_time_rate == 1 / 3


def test_shares_sum_to_one(spark):
    f = fact(spark, [(i, d(2000, 1, 1 + i % 28), float(i), False, "ABC"[i % 3], "c", 0, 0, 0, False, 1)
                     for i in range(1, 100)])
    s = kpi.revenue_share(f, "market_segment").collect()
    assert abs(sum(r.revenue_share for r in s) - 1.0) < 1e-12
    assert sum(r.revenue for r in s) == float(sum(range(1, 100)))


def test_month_grid_and_yoy(spark):
    f = fact(spark, [(1, d(2000, 1, 5), 10.0, False, "A", "c", 0, 0, 0, False, 1),
                     (2, d(2000, 3, 5), 30.0, False, "A", "c", 0, 0, 0, False, 1),
                     (3, d(2001, 3, 9), 45.0, False, "A", "c", 0, 0, 0, False, 1)])
    m = {r.year_month: r for r in kpi.revenue_by_month(f).collect()}
    assert m["2000-02"].revenue == 0.0 and m["2000-03"].mom_pct is None    # previous month 0 -> NULL
    assert m["2000-02"].mom_pct == -1.0
    y = {r.period_start: r for r in kpi.revenue_yoy(f).collect()}
    assert y[d(2001, 3, 1)].ly_revenue == 30.0 and y[d(2001, 3, 1)].yoy_pct == 0.5
    assert y[d(2000, 1, 1)].ly_revenue is None and y[d(2000, 1, 1)].yoy_pct is None


def test_yoy_leap_day(spark):
    f = fact(spark, [(1, d(2000, 2, 29), 10.0, False, "A", "c", 0, 0, 0, False, 1),
                     (2, d(2000, 2, 28), 5.0, False, "A", "c", 0, 0, 0, False, 1),
                     (3, d(2001, 2, 28), 30.0, False, "A", "c", 0, 0, 0, False, 1)])
    y = {r.period_start: r for r in kpi.revenue_yoy(f, "day").collect()}
    assert y[d(2001, 2, 28)].ly_revenue == 15.0     # 29 Feb maps to 28 Feb


def test_to_date_running_sums(spark):
    f = fact(spark, [(1, d(2000, 1, 30), 1.0, False, "A", "c", 0, 0, 0, False, 1),
                     (2, d(2000, 1, 31), 2.0, False, "A", "c", 0, 0, 0, False, 1),
                     (3, d(2000, 2, 1), 4.0, False, "A", "c", 0, 0, 0, False, 1)])
    mtd = rows(kpi.revenue_to_date(f, "month"), "order_date", "mtd_revenue")
    assert mtd == [(d(2000, 1, 30), 1.0), (d(2000, 1, 31), 3.0), (d(2000, 2, 1), 4.0)]
    qtd = rows(kpi.revenue_to_date(f, "quarter"), "order_date", "qtd_revenue")
    assert qtd[-1] == (d(2000, 2, 1), 7.0)


def test_histogram_buckets(spark):
    f = fact(spark, [(i, d(2000, 1, 1), 1.0, False, "A", "c", 0, 0, 0, False, v)
                     for i, v in enumerate([-3, 0, 1, 13, 14, 40, None])])
    got = rows(kpi.fulfillment_histogram(f), "bucket_label", "lines")
    assert got == [("1", 1), ("13", 1), ("14+", 2), ("<1", 2), (None, 1)]


def test_shipping_kpis(spark):
    f = fact(spark, [(1, d(2000, 1, 1), 1.0, True, "A", "c", 3, 2, 4, True, 6),
                     (2, d(2000, 1, 1), 1.0, False, "A", "c", -2, 4, 6, False, 10)])
    r = kpi.shipping_kpis(f).first()
    assert (r.avg_days_to_ship, r.avg_transit_days, r.late_rate, r.return_rate, r.avg_days_late) == \
        (3.0, 5.0, 0.5, 0.5, 3.0)


def test_top_customers_tie_break(spark):
    f = fact(spark, [(1, d(2000, 1, 1), 10.0, False, "A", "b", 0, 0, 0, False, 1),
                     (2, d(2000, 1, 1), 10.0, False, "A", "a", 0, 0, 0, False, 1),
                     (3, d(2000, 1, 1), 5.0, False, "A", "c", 0, 0, 0, False, 1)])
    dc = spark.createDataFrame([("a", 2, "A", "Gold", "BUILDING"), ("b", 1, "B", "Gold", "BUILDING"),
                                ("c", 3, "C", "Gold", "BUILDING")],
                               "customer_sk string, customer_key long, customer_name string, "
                               "account_tier string, market_segment string")
    got = rows(kpi.top_customers(f, dc, 2), "rank", "customer_key", "net_revenue")
    assert got == [(1, 1, 10.0), (2, 2, 10.0)]


def test_tier_migration(spark):
    dc = spark.createDataFrame([
        (1, "s1", d(1992, 1, 1), d(1996, 6, 14), "Bronze"), (1, "s2", d(1996, 6, 15), d(9999, 12, 31), "Silver"),
        (2, "s3", d(1992, 1, 1), d(1996, 6, 14), "Gold"), (2, "s4", d(1996, 6, 15), d(9999, 12, 31), "Gold"),
        (3, "s5", d(1992, 1, 1), d(9999, 12, 31), "Gold")],
        "customer_key long, customer_sk string, effective_from date, effective_to date, account_tier string")
    assert rows(kpi.tier_migration(dc)) == [("Bronze", "Silver", 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles_match_numpy_with_a_hot_group(spark, seed):
    rnd = random.Random(seed)
    data = [("hot", rnd.uniform(0, 1000)) for _ in range(3000)]          # one group holds most rows
    data += [(g, rnd.uniform(0, 1000)) for g in ("a", "b") for _ in range(rnd.randint(1, 40))]
    data += [("single", 7.0), ("tied", 1.0), ("tied", 1.0), ("tied", 2.0), ("nulls", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(7)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {r.g: r for r in exact_quantiles(df, "g", "v", probs).collect()}
    for g in {x[0] for x in data} - {"nulls"}:
        vals = np.array([v for k, v in data if k == g and v is not None])
        want = np.percentile(vals, [p * 100 for p in probs], method="linear")
        assert got[g].n == len(vals)
        for i, w in enumerate(want):
            assert got[g][f"q{i}"] == pytest.approx(w, rel=1e-12, abs=1e-9)
    assert "nulls" not in got
    spark_exact = {r.g: r.m for r in df.groupBy("g").agg(F.percentile("v", 0.5).alias("m")).collect()}
    assert got["hot"].q2 == pytest.approx(spark_exact["hot"], rel=1e-12)


def test_volume_anomaly(spark):
    days = [d(2000, 1, 1) + dt.timedelta(days=i) for i in range(10)]
    counts = [10, 12, 11, 10, 12, 11, 10, 100, 11, 10]
    data = [(i, day, 1.0, False, "A", "c", 0, 0, 0, False, 1)
            for day, c in zip(days, counts) for i in range(c)]
    out = {r.day: r for r in monitor.volume_anomaly(fact(spark, data), "order_date", 7).collect()}
    assert out[d(2000, 1, 8)].is_anomaly and not out[d(2000, 1, 7)].is_anomaly
    assert out[d(2000, 1, 1)].z_score is None and out[d(2000, 1, 1)].window_days == 0


def test_relation_count_diff(spark):
    r = monitor.relation_count_diff(spark.range(7), spark.range(4), "a", "b").first()
    assert (r.count_a, r.count_b, r.diff) == (7, 4, -3)


def test_slicers_apply_to_every_measure(spark):
    f = fact(spark, [(1, d(2000, 1, 1), 10.0, False, "A", "c1", 0, 1, 1, False, 2),
                     (2, d(2000, 1, 2), 30.0, True, "B", "c2", 2, 1, 1, False, 2)])
    f = f.withColumns({"market_segment": F.col("market_segment"), "region_name": F.lit("EUROPE"),
                       "fiscal_year": F.lit(2000), "fiscal_quarter": F.lit(2),
                       "ship_mode": F.lit("AIR"), "product_material": F.lit("TIN")})
    assert [r.revenue for r in kpi.revenue_share(f, "market_segment", segment="B").collect()] == [30.0]
    assert kpi.revenue_by_month(f, segment="A").first().revenue == 10.0
    assert kpi.on_time_by(f, segment="B").first().late_lines == 1
    assert kpi.late_by(f, segment="A").first().late_lines == 0
    assert kpi.fulfillment_histogram(f, region="ASIA").count() == 0


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_exact_quantiles_do_not_rest_on_exchange_reuse(spark, reuse):
    """A million rows, one group of 90 % and one without a name: the ranks hold
    whether or not Spark reuses the sorting exchange."""
    n = 1_000_000
    key = F.pmod(F.xxhash64("id"), F.lit(1000))
    df = spark.range(n).select(F.when(key < 900, "a").when(key < 970, "b").alias("g"),
                               F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**9)).cast("double").alias("v"))
    saved = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = {r.g: (r.n, r.q0, r.q1, r.q2) for r in exact_quantiles(df, "g", "v", [0.25, 0.5, 0.75]).collect()}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", saved)
    want = {r.g: (r.n, *r.q) for r in df.groupBy("g").agg(
        F.count("*").alias("n"), F.percentile("v", F.lit([0.25, 0.5, 0.75])).alias("q")).collect()}
    assert got == want and None in got


def test_box_plot_counts_customers_without_a_segment(spark):
    fact = spark.createDataFrame([(f"c{i % 9}", i, float(i)) for i in range(40)],
                                 "customer_sk string, order_key long, net_revenue double")
    dim = spark.createDataFrame([(f"c{i}", "BUILDING") for i in range(6)], "customer_sk string, market_segment string")
    got = {r.market_segment: r.n_customers for r in kpi.segment_box_plot(fact, dim).collect()}
    assert got == {"BUILDING": 6, "Unknown": 3}


@pytest.mark.parametrize("sort_rows", [1, 50])
def test_exact_quantiles_by_selection(spark, monkeypatch, sort_rows):
    """Ranges narrow over several passes: outliers far apart, ties, one value,
    infinities, a group without a name."""
    from ordermart.operators import quantiles
    monkeypatch.setattr(quantiles, "SORT_ROWS", sort_rows)
    monkeypatch.setattr(quantiles, "BINS", 16)
    rng = np.random.default_rng(4)
    inf = float("inf")
    groups = {"wide": [*rng.normal(size=300), 1e300, -1e300, 1e-300], "ties": [1.0] * 200 + [2.0] * 3, "one": [7.5],
              None: rng.integers(0, 9, 150).astype(float).tolist(), "ends": [-inf, *rng.normal(size=40), inf, inf]}
    rows = [(g, float(v)) for g, some in groups.items() for v in some] + [("one", None)]
    probs = [0.1, 0.25, 0.5, 0.9]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in quantiles.exact_quantiles(df, "g", "v", probs).collect()}
    assert set(got) == set(groups)
    for g, some in groups.items():
        assert got[g].n == len(some)
        for i, p in enumerate(probs):
            assert got[g][f"q{i}"] == pytest.approx(np.quantile(some, p), rel=1e-12)


def test_exact_quantiles_sort_no_whole_group(spark):
    """With more rows than are sorted, the plan has no range exchange, and the
    sort gets the rows of the last ranges only."""
    from ordermart.operators import quantiles
    df = spark.range(60_000).selectExpr("id % 2 g", "cast((id * 7919) % 60000 as double) v")
    out = quantiles.exact_quantiles(df, "g", "v", [0.5])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    want = df.groupBy("g").agg(F.expr("percentile(v, 0.5)").alias("q0"))
    assert sorted(map(tuple, out.select("g", "q0").collect())) == sorted(map(tuple, want.collect()))
