"""Check results kept by month: equal to checking the whole fact, at the cost of what changed."""

from __future__ import annotations

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from ordermart.operators import check_state, load, quality, versions
from ordermart.plans.models import Models
from tests.conftest import ROOT, SF_SMALL
from tests.test_plans import plan_text

ROW_CHECKS = [*[c for c in quality.DECLARED_CHECKS if c.table == "fact_orders" and c.kind != "unique"],
              *quality.FACT_ROW_CHECKS]


@pytest.fixture()
def marts(spark, tmp_dir):
    m = Models(spark, SF_SMALL, renumber_lines="stored")
    dims = {n: f"{tmp_dir}/{n}" for n in ("dim_customer", "dim_product", "dim_date")}
    for name, path in dims.items():
        load.write_table(getattr(m, name), path)
    path = f"{tmp_dir}/fact"
    load.write_fact(m.fact, path, key="order_line_sk")
    return path, dims


def by_hand(spark, path, dims):
    """The same counts over the whole fact."""
    fact = load.read_target(spark, path)
    tables = {n: load.read_target(spark, p) for n, p in dims.items()}
    out = {c.name: quality.check_failures(c, {"fact_orders": fact}).count() for c in ROW_CHECKS
           if c.kind in ("row_condition", "expression_is_true")}
    out[check_state.unique_name("order_line_sk")] = quality.unique(fact, "order_line_sk").count()
    out[check_state.KEYS_CHECK] = quality.orphan_fks(fact, *tables.values(), written=True).count()
    return out


def same(spark, kept, path, dims):
    for name, n in by_hand(spark, path, dims).items():
        assert kept.failures[name] == n, name
    assert kept.rows == load.read_target(spark, path).count()


def test_only_what_changed_is_read(spark, marts):
    path, dims = marts
    first = check_state.refresh(spark, path, dims, ROW_CHECKS)
    assert first.read == sorted(versions.current(spark, path).parts)
    same(spark, first, path, dims)
    number = versions.current(spark, path).number
    assert check_state.refresh(spark, path, dims, ROW_CHECKS).read == []          # nothing to do
    assert versions.current(spark, path).number == number
    # A batch with bad amounts in two months.
    fact = load.read_target(spark, path).drop("order_month")
    some = fact.where("order_date between '1998-03-01' and '1998-04-30'").withColumn("net_revenue", F.lit(-1.0))
    info = load.upsert(spark, some, path)
    second = check_state.refresh(spark, path, dims, ROW_CHECKS)
    assert second.read == [f"order_month={m}" for m in info["touched"]] == ["order_month=199803", "order_month=199804"]
    same(spark, second, path, dims)
    assert second.failing_parts["positive_order_amounts"] == second.read
    files = versions.read(spark, path, versions.current(spark, path), second.read).inputFiles()
    assert files and all("order_month=199803" in f or "order_month=199804" in f for f in files)


def test_lost_dimension_keys_bring_their_months_back(spark, marts):
    path, dims = marts
    check_state.refresh(spark, path, dims, ROW_CHECKS)
    products = load.read_target(spark, dims["dim_product"])
    load.write_table(products, dims["dim_product"])                       # the same keys
    assert check_state.refresh(spark, path, dims, ROW_CHECKS).read == []
    fact = load.read_target(spark, path)
    lost = fact.select("product_sk").distinct().orderBy("product_sk").first()[0]
    load.write_table(products.where(F.col("product_sk") != lost), dims["dim_product"])
    found = check_state.refresh(spark, path, dims, ROW_CHECKS)
    used = {r[0] for r in fact.where(F.col("product_sk") == lost).select("order_month").distinct().collect()}
    assert found.read == sorted(f"order_month={m}" for m in used)
    assert found.failures[check_state.KEYS_CHECK] == fact.where(F.col("product_sk") == lost).count()
    same(spark, found, path, dims)
    # It comes back: the failing months are looked at again.
    load.write_table(products, dims["dim_product"])
    again = check_state.refresh(spark, path, dims, ROW_CHECKS)
    assert again.read == found.read and again.failures[check_state.KEYS_CHECK] == 0
    # Versions that are gone are no ground to stand on: all months are checked.
    for _ in range(3):
        load.write_table(products, dims["dim_product"])
    versions.vacuum(spark, dims["dim_product"], keep=1, older_than_seconds=-60)
    assert len(check_state.refresh(spark, path, dims, ROW_CHECKS).read) == len(versions.current(spark, path).parts)


def test_repeated_keys_across_months(spark, tmp_dir, marts):
    path, dims = marts
    check_state.refresh(spark, path, dims, ROW_CHECKS)
    version = versions.current(spark, path)
    twice = load.read_target(spark, path).where("order_month = 199803").limit(5)
    twice = load.with_order_month(twice.drop("order_month").withColumn("order_date", F.lit(dt.date(1998, 3, 2))))
    moved = twice.withColumn("order_month", F.lit(199804))
    name, parts = versions.write_parts(moved, path, "order_month")         # past the keyed load
    folders = {p: f + ([name] if p in parts else []) for p, f in version.parts.items()}
    folders["order_month=199803"] = [*folders["order_month=199803"]]
    versions.publish(spark, path, version, version.schema, "order_month", folders, version.notes)
    load.upsert(spark, twice.drop("order_month"), path)                    # touches both months
    found = check_state.refresh(spark, path, dims, ROW_CHECKS)
    assert found.read == ["order_month=199803", "order_month=199804"]
    same(spark, found, path, dims)


def test_counts_of_a_write_equal_a_scan(spark, tmp_dir):
    m = Models(spark, SF_SMALL, renumber_lines="stored")
    bad = m.dim_product.withColumn("retail_price", F.when(F.col("product_key") % 7 == 0, -1.0)
                                   .when(F.col("product_key") % 11 == 0, None).otherwise(F.col("retail_price")))
    checks = [c for c in quality.DECLARED_CHECKS if c.table == "dim_product"]
    counts = load.write_table(bad, f"{tmp_dir}/p", checks)
    assert set(counts) == {c.name for c in checks if c.kind in quality.ROW_LOCAL}
    table = {"dim_product": load.read_target(spark, f"{tmp_dir}/p")}
    for c in checks:
        if c.name in counts:
            assert counts[c.name] == quality.check_failures(c, table).count()
    assert sum(counts.values()) > 0
    report = quality.run_checks(table, checks, known=counts)
    scans = [ln for ln in plan_text(report).splitlines() if "ReadSchema" in ln]
    assert len(scans) == 1 and "retail_price" not in scans[0].split("ReadSchema")[1]      # for the unique keys alone
    assert {r.check_name: r.failures for r in report.collect()}.items() >= counts.items()


RETRIED = """
import sys, os
sys.path.insert(0, {root!r})
from ordermart.session import get_session
from ordermart.operators import load, quality
spark = get_session("local[2,3]", 2)
def fails_once(batches):
    for b in batches:
        yield b
    if not os.path.exists({mark!r}):
        open({mark!r}, "w").close()
        raise RuntimeError("first attempt of a task")
df = spark.range(0, 1000, 1, 2).mapInPandas(fails_once, "id long")
check = quality.Check("t", "id", "expression_is_true", ">= 100")
print("COUNTED", load.write_table(df, {out!r}, [check])[check.name], load.read_target(spark, {out!r}).count())
"""


def test_a_retried_task_does_not_count_twice(tmp_dir):
    script = RETRIED.format(root=ROOT, mark=f"{tmp_dir}/failed", out=f"{tmp_dir}/out")
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert os.path.exists(f"{tmp_dir}/failed") and "COUNTED 100 1000" in done.stdout, done.stdout + done.stderr[-2000:]
