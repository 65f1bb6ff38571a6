"""What is shuffled, sorted and stored: narrow rows, small buckets, no layout without lines."""

from __future__ import annotations

import datetime as dt
import glob
import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ordermart.operators import load, quality
from ordermart.plans.models import Models
from ordermart.sources import colocate
from tests.conftest import SF_SMALL, rows

COLS = ("order_line_sk", "customer_sk", "product_sk", "order_date", "net_revenue", "unit_price", "fiscal_year",
        "is_late_delivery", "quantity")


@pytest.fixture()
def models(spark):
    return Models(spark, SF_SMALL, renumber_lines=True)


def test_staged_orders_need_no_layout(spark, tmp_dir):
    """orders alone are read where they are."""
    folder = f"{tmp_dir}/source"
    shutil.copytree(SF_SMALL, folder)
    got = entry.queries()["stg_orders"](spark, folder)
    assert got.count() == Models(spark, folder).stg_orders.count() > 0
    assert not any(folder in key for key in colocate._KNOWN)


def test_a_bucket_is_sorted_in_memory(spark):
    """one of 256 MB of source files held some 20 million lines."""
    assert colocate.bucket_count(spark, 1 << 30) >= 100
    assert colocate.bucket_count(spark, 1) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_the_fact_is_dealt_before_its_columns_are_made(models):
    """F8: no key hash of a line is shuffled by month."""
    plan = models.fact_by_month()._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RebalancePartitions")
    assert "AS order_line_sk" in above and "order_line_sk" not in below and "product_sk" not in below
    assert rows(models.fact_by_month(), *COLS) == rows(models.fact, *COLS)
    until = dt.date(1996, 1, 1)
    assert rows(models.fact_by_month(until=until), *COLS) == rows(models.fact.where(models.fact.order_date <= until), *COLS)


def test_joined_lines_are_stored_not_the_whole_record(spark, models):
    """the record is computed again from what is stored, and checked as a whole."""
    want, lines = rows(models.fact, *COLS), rows(models.enriched)
    checks = [c for c in quality.DECLARED_CHECKS if c.table == "int_orders_enriched"]
    known = models.stored_order_lines(checks)
    assert set(known) == {c.name for c in checks if c.kind in quality.ROW_LOCAL}
    stored = models.joined_lines.columns
    assert "order_line_sk" not in stored and "net_revenue" not in stored
    assert glob.glob(f"{models._scratch[-1].removeprefix('file:')}/*.zstd.parquet")
    assert rows(models.fact, *COLS) == want and rows(models.enriched) == lines
    assert rows(models.fact_by_month(), *COLS) == want


def test_dealt_rows_are_written_as_they_come(spark, models, tmp_dir):
    one, two = f"{tmp_dir}/one", f"{tmp_dir}/two"
    load.write_fact(models.fact, one, key="order_line_sk")
    load.write_fact(models.fact_by_month(), two, key="order_line_sk", dealt=True)
    assert rows(load.read_target(spark, one)) == rows(load.read_target(spark, two))


def test_keys_are_told_apart_by_hash_then_by_key(spark):
    load.assert_unique_keys(spark.range(1000).selectExpr("cast(id as string) k"), "k")
    for bad in ([("a",), (None,)], [("a",), ("b",), ("a",)]):
        with pytest.raises(ValueError, match="NULL or repeated k"):
            load.assert_unique_keys(spark.createDataFrame(bad, "k string"), "k")


def test_lines_are_typed_after_the_joins(models):
    """what a line's own columns give is computed above both joins."""
    plan = models.enriched._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join LeftOuter", 1)
    for made in ("commit_date", "receipt_date", "ship_mode", "ship_instructions", "discount_rate"):
        assert f"AS {made}#" in above and f"AS {made}#" not in below, made


def test_lines_typed_before_the_joins_give_the_same(spark, models):
    from ordermart.operators import enrich
    before = enrich.orders_enriched(models.stg_orders, models.stg_customers, models.stg_products, models.lines)
    assert before.schema == models.enriched.schema
    assert rows(before) == rows(models.enriched)


@pytest.mark.parametrize("kind", ["not_null", "accepted_values", "expression_is_true", "unique"])
def test_checks_of_a_kind_store_no_lines(spark, monkeypatch, kind):
    """Counted on the way, with the columns that the checks name."""
    from ordermart.plans import catalog

    def stored(*_):
        raise AssertionError("lines were stored")

    monkeypatch.setattr(Models, "stored_order_lines", stored)
    got = catalog._suite(spark, SF_SMALL, kind)
    want = quality.run_checks(catalog._m(spark, SF_SMALL).check_tables(), quality.checks_of(kind))
    assert rows(got) == rows(want) and got.count() == len(quality.checks_of(kind))


def test_failures_of_lines_and_fact_are_counted_in_one_pass(models):
    checks = [quality.Check("int_orders_enriched", "quantity", "expression_is_true", "> 20"),
              quality.Check("fact_orders", "quantity", "expression_is_true", "> 30"),
              quality.Check("int_orders_enriched", "ship_mode", "accepted_values", ["AIR"])]
    quantity, mode = F.col("quantity"), F.col("ship_mode")
    assert models.line_failures(checks) == dict(zip(
        [c.name for c in checks if c.table != "fact_orders"] + [checks[1].name],
        [models.enriched.where(quantity <= 20).count(), models.enriched.where(mode != "AIR").count(),
         models.fact.where(quantity <= 30).count()]))


def test_an_upsert_shuffles_whole_rows_once(spark, tmp_dir):
    """equal keys are dropped where the row belongs, not in a shuffle by key."""
    schema = "order_line_sk string, order_date date, market_segment string, net_revenue double, order_month int"
    old = spark.createDataFrame([("a", dt.date(2000, 1, 5), "B", 1.0, 200001), ("a", dt.date(2000, 1, 5), "C", 1.5, 200001),
                                 ("b", None, None, 2.0, None), (None, dt.date(2000, 1, 5), "B", 3.0, 200001),
                                 ("c", dt.date(2000, 2, 5), "B", 4.0, 200002), ("d", dt.date(2000, 2, 5), "B", 5.0, 200002)], schema)
    new = spark.createDataFrame([("a", dt.date(2000, 1, 5), "B", 6.0, 200001), ("b", dt.date(2000, 3, 1), "B", 7.0, 200003),
                                 ("d", dt.date(2000, 1, 6), "B", 8.0, 200001), ("e", None, "B", 9.0, None)], schema)
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = load._replaced(old, new, "order_line_sk", "order_month")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert rows(got, "order_line_sk", "net_revenue") == rows(
            old.where("order_line_sk is null or order_line_sk = 'c'").union(new), "order_line_sk", "net_revenue")
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange rangepartitioning") == 1
    assert plan.count("Exchange hashpartitioning(_hash") == plan.count("Exchange hash") == 2     # hashes and dates only
    assert got.columns == old.columns


def test_values_are_told_apart_where_hashes_meet(spark, monkeypatch):
    """unique values themselves are not shuffled, and lines not read again for them."""
    t = spark.createDataFrame([(1, "a"), (1, "b"), (None, "b"), (None, "b"), (2, None)], "k long, s string")
    u = spark.createDataFrame([("x",), ("y",), (None,), (None,)], "s string")
    checks = [quality.Check("u", "s", "unique"), quality.Check("t", "k", "unique"), quality.Check("t", "s", "unique")]
    asked, stacked = [], quality._stacked_values
    monkeypatch.setattr(quality, "_stacked_values", lambda c, t, only=None: asked.append(only) or stacked(c, t, only))
    got = quality.repeated_values(checks, {"t": t, "u": u})
    assert got == {"unique__u__s": 0, "unique__t__k": 1, "unique__t__s": 1} and asked == [None, {1, 2}]
    asked.clear()
    assert quality.repeated_values(checks[:1], {"u": u}) == {"unique__u__s": 0} and asked == [None]


@pytest.mark.parametrize("kind", ["accepted_values", "expression_is_true"])
def test_lines_that_pass_are_not_shuffled_to_products(models, kind):
    """No check of the kind names a product's column."""
    tables = ("int_orders_enriched", "fact_orders")
    _, failing, _ = models.failing_lines([c for c in quality.checks_of(kind) if c.table in tables])
    above, below = failing._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter, (product_key", 1)
    with_orders = below.split("Join Inner", 1)[1].splitlines()[0]
    assert "Filter (" not in above and with_orders.count(" OR ") > 2


def test_key_hashes_are_shuffled_as_bytes(spark, models):
    """the 32 hex digits of a customer key are 16 bytes below the joins; other keys stay."""
    plan = models.fact._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join LeftOuter, (product_key", 1)
    assert "lower(hex(" in above and "unhex(customer_sk" in below
    want = models.dim_customer.where("is_current").select("customer_key", "customer_sk")
    assert rows(models.enriched_with_sk.select("customer_key", "customer_sk").distinct()) == rows(
        want.join(models.enriched.select("customer_key").distinct(), "customer_key"))
    sks = ["nobody", "0" * 32, "AB" * 16, "abc", "", None, "\u00e9" * 32, "0b" * 16, "a" * 40]
    pick = F.element_at(F.array(*map(F.lit, sks)), (F.col("customer_key") % len(sks) + 1).cast("int"))
    keys = models.stg_customers.select("customer_key", pick.alias("customer_sk"))
    got = models.order_lines(keys)
    assert got.columns[-1] == "customer_sk" and got.where(~got.customer_sk.eqNullSafe(pick)).count() == 0
    assert set(sks) == {r[0] for r in got.select("customer_sk").distinct().collect()}
