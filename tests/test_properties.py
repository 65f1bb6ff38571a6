"""Property tests: Column helpers against plain-Python definitions.

Each test draws a batch of random inputs with hypothesis and checks them in
a single Spark job.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermart.functions import core as fn

SETTINGS = settings(max_examples=5, deadline=None)


def py_fiscal(d: dt.date):
    fy = d.year + (1 if d.month >= 10 else 0)
    fq = {10: 1, 11: 1, 12: 1, 1: 2, 2: 2, 3: 2, 4: 3, 5: 3, 6: 3, 7: 4, 8: 4, 9: 4}[d.month]
    fm = d.month - 9 if d.month >= 10 else d.month + 3
    return fy, fq, fm, f"FY{fy}-Q{fq}"


def py_tier(b):
    if b is None:
        return "Platinum"
    if b < 0:
        return "Negative"
    if b <= 2500:
        return "Bronze"
    if b <= 5000:
        return "Silver"
    if b <= 7500:
        return "Gold"
    return "Platinum"


@SETTINGS
@given(st.lists(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31)),
                min_size=1, max_size=200))
def test_fiscal_matches_python(spark, dates):
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    out = df.select("d", fn.fiscal_year("d").alias("fy"), fn.fiscal_quarter("d").alias("fq"),
                    fn.fiscal_month("d").alias("fm"), fn.fiscal_period_label("d").alias("label"),
                    fn.date_key("d").alias("k"))
    for r in out.collect():
        assert (r.fy, r.fq, r.fm, r.label) == py_fiscal(r.d)
        assert r.k == int(r.d.strftime("%Y%m%d"))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.decimals(min_value=-20000, max_value=20000, places=2,
                                                 allow_nan=False, allow_infinity=False)),
                min_size=1, max_size=200))
def test_tier_matches_python(spark, balances):
    df = spark.createDataFrame([(b,) for b in balances], "b decimal(12,2)")
    for r in df.select("b", fn.account_tier("b").alias("t")).collect():
        assert r.t == py_tier(r.b)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-10**12, 10**12)),
                          st.one_of(st.none(), st.text(max_size=12))), min_size=1, max_size=100))
def test_surrogate_key_matches_hashlib(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b string")
    for r in df.select("a", "b", fn.surrogate_key("a", "b").alias("k")).collect():
        text = "|".join("@@NULL@@" if v is None else str(v) for v in (r.a, r.b))
        assert r.k == hashlib.md5(text.encode("utf-8")).hexdigest()


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-1000, 1000)),
                          st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=100))
def test_safe_divide_matches_python(spark, pairs):
    df = spark.createDataFrame(pairs, "n int, d int")
    out = df.select("n", "d", fn.safe_divide(F.col("n").cast("double"), F.col("d").cast("double"))
                    .alias("q"), fn.safe_divide(F.col("n").cast("double"), F.col("d").cast("double"),
                                                default=-1.0).alias("q2"))
    for r in out.collect():
        if r.d in (None, 0):
            assert r.q is None and r.q2 == -1.0
        elif r.n is None:
            assert r.q is None and r.q2 is None
        else:
            assert r.q == r.n / r.d == r.q2


@SETTINGS
@given(st.lists(st.tuples(st.decimals(min_value=1, max_value=99999, places=2, allow_nan=False),
                          st.sampled_from([Decimal(x) / 100 for x in range(0, 11)]),
                          st.sampled_from([Decimal(x) / 100 for x in range(0, 9)])),
                min_size=1, max_size=100))
def test_revenue_rounding_is_exact_half_up(spark, rows):
    from ordermart.operators import enrich
    df = spark.createDataFrame(rows, "extended_price decimal(12,2), discount_rate decimal(4,2), "
                                     "tax_rate decimal(4,2)")
    out = enrich.with_revenue(df).collect()
    q = Decimal("0.01")
    for r in out:
        net = r.extended_price * (1 - r.discount_rate)
        assert r.net_revenue == net.quantize(q, rounding="ROUND_HALF_UP")
        assert r.gross_revenue == (net * (1 + r.tax_rate)).quantize(q, rounding="ROUND_HALF_UP")
        assert r.discount_amount == (r.extended_price * r.discount_rate).quantize(q, rounding="ROUND_HALF_UP")
        assert r.tax_amount == (net * r.tax_rate).quantize(q, rounding="ROUND_HALF_UP")
