"""Physical-plan properties: no Python in any query, pruned scans."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ordermart.plans.catalog import QUERIES
from ordermart.plans.models import Models
from ordermart.sources import tables
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF", "FlatMapCoGroupsInPandas")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Queries that load tables before they plan: their parts are planned by others.
LOADS = ("fact_upsert", "daily_build_fact", "maintained_revenue_by_month", "maintained_late_by_material",
         "maintained_top_customers", "fact_schema_drift")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in LOADS))
def test_no_python_in_plan(spark, name):
    text = plan_text(entry.queries()[name](spark, SF_SMALL))
    assert not any(node in text for node in PYTHON_NODES), name


def test_kpi_scan_is_pruned(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        text = plan_text(entry.queries()["kpi_overview"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    orders = [ln for ln in text.splitlines() if "ordermart_orders_" in ln and "ReadSchema" in ln]
    assert orders
    for ln in orders:
        schema = ln[ln.index("ReadSchema"):]
        assert "o_orderpriority" not in schema and "o_orderstatus" not in schema


def test_fact_has_no_date_dimension_join(spark):
    """Date keys come from a range test, not a join against the 14,245-day spine."""
    text = plan_text(entry.queries()["fact_orders"](spark, SF_SMALL))
    assert "sequence" not in text


@pytest.fixture()
def large_input_plans(spark):
    """No broadcasts and no AQE: the shape a very large input gets."""
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                            "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in saved.items():
        spark.conf.set(k, v)


def test_fact_shuffles_line_data_twice(spark, large_input_plans):
    """Line-level rows are shuffled once by order key and once by product key;
    the customer key is resolved on the orders side, so no line-level exchange
    on customer keys exists; line numbers are the source's own, no window."""
    text = plan_text(Models(spark, SF_SMALL).fact)
    assert text.count("Exchange hashpartitioning(order_key#") == 2   # lines, orders
    assert text.count("Exchange hashpartitioning(product_key") == 1
    assert "Exchange hashpartitioning(customer_sk" not in text
    assert "Window" not in text and "l_orderkey" not in "".join(
        ln for ln in text.splitlines() if "Exchange hash" in ln)


def test_lookback_cuts_lines_before_anything_is_shuffled(spark):
    """The window's orders are stored, so their keys are broadcast and the line
    scan is cut by a semi join before any exchange, projection or window."""
    m = Models(spark, SF_SMALL)
    plan = m.fact_since(dt.date(1998, 7, 1))._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    at = next(i for i, ln in enumerate(lines) if "Join LeftSemi" in ln)
    below = lines[at + 1:at + 5]
    assert any("Relation" in ln and "l_orderkey" in ln for ln in below), plan
    assert "Window" not in plan
    semi = [ln for ln in plan_text(m.fact_since(dt.date(1998, 7, 1))).splitlines() if "LeftSemi" in ln]
    assert semi and all("BroadcastHashJoin" in ln for ln in semi)


def test_report_scans_are_bounded(spark):
    """The whole suite: order lines are computed once, so every source table is
    scanned a few times only."""
    text = plan_text(entry.queries()["dq_report"](spark, SF_SMALL))
    tree = text[:text.index("\n\n\n")] if "\n\n\n" in text else text
    print(tree.count("Scan parquet"), "scans")
    assert tree.count("Scan parquet") <= 32
    assert tree.count("SortMergeJoin") <= 6      # the order lines are not joined again


def test_source_line_numbers_are_kept(spark, tmp_dir):
    """Lines 1 and 3 of an order stay 1 and 3."""
    line = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(1)
    two = line.withColumn("l_linenumber", F.lit(1)).unionByName(line.withColumn("l_linenumber", F.lit(3)))
    two.write.parquet(f"{tmp_dir}/lineitem.parquet")
    assert sorted(r.l_linenumber for r in tables.lineitem(spark, tmp_dir).collect()) == [1, 3]
    only = line.select("l_orderkey")
    assert tables.lineitem(spark, tmp_dir, orders=only).count() == 2
    assert tables.lineitem(spark, tmp_dir, orders=only.limit(0)).count() == 0
