"""Dashboard measures (K1-K23) over the fact table.

Money is summed as decimal(12,2) (exact, so independent of summation order
and of how rows are spread over tasks) and turned into double at the end.
Rates are ratios of exact sums. Windows only ever run on small aggregates
(per day, month or group), never on fact rows.

Measures that add up take an aggregate kept by ``operators.aggregates`` in place
of the fact, too: its columns hold what they would sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import core as fn


def money_sum(c: str) -> Column:
    """Exact sum of a money column (decimal inside)."""
    return F.sum(fn.money(c))


def _late_days() -> Column:
    return F.when(F.col("days_late") > 0, F.col("days_late")).cast("long")


#: What adds up over fact rows: column of an aggregate -> its value over lines.
_ADDITIVE = {
    "_lines": lambda: F.count(F.lit(1)),
    "_revenue": lambda: money_sum("net_revenue"),
    "_on_time": lambda: F.count_if(~F.col("is_late_delivery")),
    "_late": lambda: F.count_if(F.col("is_late_delivery")),
    "_returned": lambda: F.count_if(F.col("is_returned")),
    "_sum_to_ship": lambda: F.sum(F.col("days_to_ship").cast("long")),
    "_n_to_ship": lambda: F.count("days_to_ship"),
    "_sum_in_transit": lambda: F.sum(F.col("days_in_transit").cast("long")),
    "_n_in_transit": lambda: F.count("days_in_transit"),
    "_sum_late_days": lambda: F.sum(_late_days()),
    "_n_late_days": lambda: F.count(_late_days()),
}
ORDERS = "_orders"


def is_aggregate(df: DataFrame) -> bool:
    return "_lines" in df.columns


def added(df: DataFrame, name: str) -> Column:
    """One of the additive values over rows of the fact or of an aggregate."""
    if not is_aggregate(df):
        return _ADDITIVE[name]()
    if name == "_revenue":
        return F.sum(name).cast("decimal(22,2)")
    # A sum of no value is NULL, a count of nothing 0.
    return F.sum(name) if name.startswith("_sum") else F.coalesce(F.sum(name), F.lit(0).cast("long"))


def additive_columns(fact: DataFrame) -> list[Column]:
    return [added(fact, n).alias(n) for n in _ADDITIVE]


def order_number(df: DataFrame) -> Column:
    """Number of orders: distinct keys over lines, a sum over an aggregate whose
    groups share no order."""
    if not is_aggregate(df):
        return F.countDistinct("order_key")
    if ORDERS not in df.columns:
        raise ValueError("orders do not add up over this aggregate")
    return F.coalesce(F.sum(ORDERS), F.lit(0).cast("long"))


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL when den is 0 or NULL."""
    return fn.safe_divide(num.cast("double"), den.cast("double"))


def slice_fact(fact: DataFrame, fiscal_year=None, fiscal_quarter=None, region=None,
               segment=None) -> DataFrame:
    """The dashboard slicers as optional filters (pushed to the scan).
    Every fact-based measure below takes them as keyword arguments."""
    conds = []
    if fiscal_year is not None:
        conds.append(F.col("fiscal_year") == fiscal_year)
    if fiscal_quarter is not None:
        conds.append(F.col("fiscal_quarter") == fiscal_quarter)
    if region is not None:
        conds.append(F.col("region_name") == region)
    if segment is not None:
        conds.append(F.col("market_segment") == segment)
    for c in conds:
        fact = fact.where(c)
    return fact


def overview(fact: DataFrame, **slicers) -> DataFrame:
    """K1-K4 in one aggregate: total net revenue, orders, average order value
    (mean of per-order sums = total / orders) and on-time rate (lines not
    late over all lines; a NULL flag counts in the denominator)."""
    f = slice_fact(fact, **slicers)
    agg = f.agg(added(f, "_revenue").alias("rev"), order_number(f).alias("order_count"),
                added(f, "_on_time").alias("on_time"), added(f, "_lines").alias("lines"))
    return agg.select(
        F.col("rev").cast("double").alias("total_revenue"),
        "order_count",
        ratio(F.col("rev"), F.col("order_count")).alias("avg_order_value"),
        ratio(F.col("on_time"), F.col("lines")).alias("on_time_rate"),
        F.col("lines").alias("line_count"))


def total_revenue(fact: DataFrame, **slicers) -> DataFrame:
    """K1."""
    return overview(fact, **slicers).select("total_revenue")


def order_count(fact: DataFrame, **slicers) -> DataFrame:
    """K2."""
    return overview(fact, **slicers).select("order_count")


def avg_order_value(fact: DataFrame, **slicers) -> DataFrame:
    """K3."""
    return overview(fact, **slicers).select("avg_order_value")


def on_time_rate(fact: DataFrame, **slicers) -> DataFrame:
    """K4."""
    return overview(fact, **slicers).select("on_time_rate")


def _month_start(c: str = "order_date") -> Column:
    return F.trunc(F.col(c), "month")


def revenue_by_month(fact: DataFrame, **slicers) -> DataFrame:
    """K5: revenue per month on a dense month grid (months without orders
    show 0) and month-over-month change. The grid and the lag run on the
    monthly aggregate: one row per month."""
    fact = slice_fact(fact, **slicers)
    monthly = fact.groupBy(_month_start().alias("month_start")).agg(added(fact, "_revenue").alias("rev"))
    grid = monthly.agg(F.min("month_start").alias("lo"), F.max("month_start").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month_start"))
    dense = grid.join(monthly, "month_start", "left").withColumn(
        "rev", F.coalesce(F.col("rev"), F.lit(0).cast("decimal(22,2)")))
    prev = F.lag("rev").over(Window.orderBy("month_start"))
    return dense.select(
        "month_start", F.date_format("month_start", "yyyy-MM").alias("year_month"),
        F.col("rev").cast("double").alias("revenue"),
        prev.cast("double").alias("prev_month_revenue"),
        ratio(F.col("rev") - prev, prev).alias("mom_pct"))


def revenue_yoy(fact: DataFrame, grain: str = "month", **slicers) -> DataFrame:
    """K6: revenue per period, the same period one year earlier and the
    year-over-year change (NULL without a base). A self-join on the shifted
    period, not lag, because periods can be missing. For days, 29 Feb maps
    to 28 Feb of the prior year (add_months)."""
    if grain == "month":
        period = _month_start()
    elif grain == "day":
        period = F.col("order_date")
    elif grain == "year":
        period = F.trunc(F.col("order_date"), "year")
    else:
        raise ValueError("grain must be day, month or year")
    per = slice_fact(fact, **slicers).groupBy(period.alias("period_start")).agg(added(fact, "_revenue").alias("rev"))
    ly = per.select(F.add_months("period_start", 12).alias("period_start"),
                    F.col("rev").alias("ly_rev"))
    if grain == "day":
        # Several prior days may map to one day (29 Feb); add them up.
        ly = ly.groupBy("period_start").agg(F.sum("ly_rev").alias("ly_rev"))
    j = per.join(ly, "period_start", "left")
    return j.select("period_start", F.col("rev").cast("double").alias("revenue"),
                    F.col("ly_rev").cast("double").alias("ly_revenue"),
                    ratio(F.col("rev") - F.col("ly_rev"), F.col("ly_rev")).alias("yoy_pct"))


def revenue_to_date(fact: DataFrame, period: str = "month", **slicers) -> DataFrame:
    """K7/K8: daily revenue and the running total within the calendar month
    or quarter. The window runs on daily sums (at most 92 rows per group)."""
    if period not in ("month", "quarter"):
        raise ValueError("period must be month or quarter")
    daily = slice_fact(fact, **slicers).groupBy("order_date").agg(added(fact, "_revenue").alias("rev"))
    start = F.trunc("order_date", "month" if period == "month" else "quarter")
    w = (Window.partitionBy(start).orderBy("order_date")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily.select("order_date", start.alias("period_start"),
                        F.col("rev").cast("double").alias("daily_revenue"),
                        F.sum("rev").over(w).cast("double").alias(f"{period[0]}td_revenue"))


def revenue_share(fact: DataFrame, by: str, **slicers) -> DataFrame:
    """Revenue per group and its share of the total.

    The total is a one-row aggregate broadcast to the grouped rows (its size
    is exactly one row), so the share needs no single-partition window even
    when ``by`` has many values."""
    g = slice_fact(fact, **slicers).groupBy(by).agg(added(fact, "_revenue").alias("rev"))
    total = g.agg(F.sum("rev").alias("total")).withColumn("_one", F.lit(1))
    j = g.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")
    return j.select(by, F.col("rev").cast("double").alias("revenue"),
                    ratio(F.col("rev"), F.col("total")).alias("revenue_share"))


def shipping_kpis(fact: DataFrame, **slicers) -> DataFrame:
    """Average days to ship / in transit, late share, return rate,
    and average days late over late lines (days_late > 0)."""
    f = slice_fact(fact, **slicers)
    a = f.agg(*[added(f, n).alias(name) for name, n in (
        ("s_ship", "_sum_to_ship"), ("n_ship", "_n_to_ship"), ("s_transit", "_sum_in_transit"),
        ("n_transit", "_n_in_transit"), ("late", "_late"), ("returned", "_returned"),
        ("s_late_days", "_sum_late_days"), ("n_late_days", "_n_late_days"), ("lines", "_lines"))])
    return a.select(
        ratio(F.col("s_ship"), F.col("n_ship")).alias("avg_days_to_ship"),
        ratio(F.col("s_transit"), F.col("n_transit")).alias("avg_transit_days"),
        ratio(F.col("late"), F.col("lines")).alias("late_rate"),
        ratio(F.col("returned"), F.col("lines")).alias("return_rate"),
        ratio(F.col("s_late_days"), F.col("n_late_days")).alias("avg_days_late"),
        "lines")


def on_time_by(fact: DataFrame, by: str = "ship_mode", **slicers) -> DataFrame:
    """On-time and late lines per group."""
    g = slice_fact(fact, **slicers).groupBy(by).agg(
        added(fact, "_lines").alias("lines"), added(fact, "_on_time").alias("on_time_lines"),
        added(fact, "_late").alias("late_lines"))
    return g.withColumn("on_time_rate", ratio(F.col("on_time_lines"), F.col("lines")))


def fulfillment_histogram(fact: DataFrame, cap: int = 14, **slicers) -> DataFrame:
    """Lines per fulfillment-day bucket: '<1', '1' ... 'cap-1', 'cap+'."""
    d = F.col("total_fulfillment_days")
    bucket_no = (F.when(d.isNull(), None).when(d < 1, 0).when(d >= cap, cap).otherwise(d)).cast("int")
    label = (F.when(bucket_no == 0, "<1").when(bucket_no == cap, f"{cap}+")
             .otherwise(bucket_no.cast("string")))
    return (slice_fact(fact, **slicers).groupBy(bucket_no.alias("bucket"), label.alias("bucket_label"))
            .agg(F.count(F.lit(1)).alias("lines")))


def late_by(fact: DataFrame, by: str = "product_material", **slicers) -> DataFrame:
    """Total lines, late lines, late share and average days late (late
    lines with days_late > 0) per group."""
    g = slice_fact(fact, **slicers).groupBy(by).agg(
        added(fact, "_lines").alias("total_lines"), added(fact, "_late").alias("late_lines"),
        added(fact, "_sum_late_days").alias("s"), added(fact, "_n_late_days").alias("n"))
    return g.select(by, "total_lines", "late_lines",
                    ratio(F.col("late_lines"), F.col("total_lines")).alias("late_rate"),
                    ratio(F.col("s"), F.col("n")).alias("avg_days_late"))


def tier_revenue_by_quarter(fact: DataFrame, dim_customer: DataFrame, **slicers) -> DataFrame:
    """Revenue per calendar quarter and account tier.

    The fact carries no tier, so it is joined to the customer dimension on
    customer_sk. The fact is aggregated to (customer_sk, quarter) first, so
    the join sees one row per customer and quarter instead of every line.
    """
    q = F.trunc("order_date", "quarter")
    pre = slice_fact(fact, **slicers).groupBy("customer_sk", q.alias("quarter_start")).agg(added(fact, "_revenue").alias("rev"))
    dc = dim_customer.select("customer_sk", "account_tier")
    j = pre.join(dc, "customer_sk", "left").withColumn(
        "account_tier", F.coalesce(F.col("account_tier"), F.lit("Unknown")))
    return (j.groupBy("quarter_start", "account_tier").agg(F.sum("rev").alias("rev"))
            .select(F.year("quarter_start").cast("int").alias("calendar_year"),
                    F.quarter("quarter_start").cast("int").alias("calendar_quarter"),
                    "account_tier", F.col("rev").cast("double").alias("revenue")))


def customer_revenue(fact: DataFrame) -> DataFrame:
    """Net revenue and orders per customer key of the fact (partial aggregate)."""
    return fact.groupBy("customer_sk").agg(added(fact, "_revenue").alias("rev"),
                                           order_number(fact).alias("order_count"))


def segment_box_plot(fact: DataFrame, dim_customer: DataFrame, **slicers) -> DataFrame:
    """Per market segment, the quartiles of revenue per customer,
    1.5 x IQR fences and the number of customers outside them.

    Quartiles are exact (linear interpolation) and computed by
    ``exact_quantiles``, which narrows value ranges by counts, so a segment
    holding most customers is neither gathered nor sorted. Values are
    rounded to 4 decimals (decimal(18,4)) and output as double.
    """
    from ..session import checkpoint_root
    from .quantiles import exact_quantiles
    per_cust = customer_revenue(slice_fact(fact, **slicers)).join(
        dim_customer.select("customer_sk", "market_segment"), "customer_sk", "left").select(
        F.coalesce("market_segment", F.lit("Unknown")).alias("market_segment"),
        F.col("rev").cast("double").alias("customer_revenue"))
    # Used twice (quartiles, outlier count): materialize the per-customer
    # revenues once instead of aggregating the fact twice.
    checkpoint_root(fact.sparkSession)
    per_cust = per_cust.checkpoint(eager=True)
    qs = exact_quantiles(per_cust, "market_segment", "customer_revenue", [0.25, 0.5, 0.75],
                         materialize=False)
    dec = "decimal(18,4)"
    q = qs.select("market_segment", "n",
                  F.col("q0").cast(dec).alias("q1"), F.col("q1").cast(dec).alias("median"),
                  F.col("q2").cast(dec).alias("q3"))
    q = q.withColumn("iqr", (F.col("q3") - F.col("q1")).cast(dec))
    k = F.lit(1.5).cast("decimal(2,1)")      # exact: the fences stay decimal arithmetic
    q = q.withColumns({"lower_fence": (F.col("q1") - F.col("iqr") * k).cast(dec),
                       "upper_fence": (F.col("q3") + F.col("iqr") * k).cast(dec)})
    fences = q.select("market_segment", "lower_fence", "upper_fence")
    out = per_cust.join(fences, "market_segment")
    outside = (F.col("customer_revenue").cast(dec) < F.col("lower_fence")) | \
              (F.col("customer_revenue").cast(dec) > F.col("upper_fence"))
    n_out = out.groupBy("market_segment").agg(F.count_if(outside).alias("n_outliers"))
    stats = ["q1", "median", "q3", "iqr", "lower_fence", "upper_fence"]
    return q.join(n_out, "market_segment").select(
        "market_segment", F.col("n").alias("n_customers"),
        *[F.col(c).cast("double").alias(c) for c in stats], "n_outliers")


def top_customers(fact: DataFrame, dim_customer: DataFrame, n: int = 20, **slicers) -> DataFrame:
    """The n customers with the highest net revenue (ties: lower
    customer key first), with name, tier, segment, revenue and orders.
    Revenue is aggregated per customer first; the ordered limit is a
    distributed top-n; the rank is numbered on those n rows only."""
    dc = dim_customer.select("customer_sk", "customer_key", "customer_name", "account_tier",
                             "market_segment")
    per = customer_revenue(slice_fact(fact, **slicers)).join(dc, "customer_sk", "left")
    top = per.orderBy(F.col("rev").desc(), F.col("customer_key").asc()).limit(n)
    rank = F.row_number().over(Window.orderBy(F.col("rev").desc(), F.col("customer_key").asc()))
    return top.select(rank.alias("rank"), "customer_key", "customer_name", "account_tier",
                      "market_segment", F.col("rev").cast("double").alias("net_revenue"),
                      "order_count")


def tier_migration(dim_customer: DataFrame) -> DataFrame:
    """Customers moving from one tier to another between consecutive
    versions (window per customer over its few versions)."""
    w = Window.partitionBy("customer_key").orderBy("effective_from", "effective_to", "customer_sk")
    moves = dim_customer.select("customer_key", F.col("account_tier").alias("from_tier"),
                                F.lead("account_tier").over(w).alias("to_tier"))
    return (moves.where(F.col("to_tier").isNotNull() & (F.col("to_tier") != F.col("from_tier")))
            .groupBy("from_tier", "to_tier").agg(F.countDistinct("customer_key").alias("customers")))


_MARGIN = "decimal(18,12)"   # decimal sums do not depend on task layout


def weighted_rates(fact: DataFrame, by: str = "market_segment", **slicers) -> DataFrame:
    """Weighted averages of the non-additive rates: discount rate
    weighted by extended price (exact), margin weighted by net revenue (lines
    with a margin; rounded to 6 decimals)."""
    w_disc = fn.rate("discount_rate") * fn.money("extended_price")
    has_m = F.col("estimated_margin_pct").isNotNull()
    g = slice_fact(fact, **slicers).groupBy(by).agg(
        F.sum(w_disc).alias("wd"), money_sum("extended_price").alias("ext"),
        F.sum(F.when(has_m, F.col("estimated_margin_pct").cast(_MARGIN) * fn.money("net_revenue"))).alias("wm"),
        F.sum(F.when(has_m, fn.money("net_revenue"))).alias("net_m"))
    return g.select(by, ratio(F.col("wd"), F.col("ext")).alias("weighted_discount_rate"),
                    ratio(F.col("wm"), F.col("net_m")).cast("decimal(18,6)").cast("double")
                    .alias("weighted_margin_pct"))
