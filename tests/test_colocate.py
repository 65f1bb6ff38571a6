"""Order lines stored by order key: joined in place, numbered once, hot orders apart."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from ordermart.operators.ranking import hot_keys, row_number_within
from ordermart.plans.models import Models
from ordermart.sources import colocate, tables as src
from tests.conftest import SF_SMALL, rows
from tests.test_plans import plan_text
from tests.test_ranking import window_numbers

COLS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_commitdate", "l_shipmode")


def test_layout_holds_the_source(spark):
    layout = colocate.order_lines(spark, SF_SMALL, renumber=True)
    assert layout.hot_lines is None
    assert rows(layout.lines, *COLS) == rows(src.lineitem(spark, SF_SMALL, renumber_lines=True), *COLS)
    assert rows(layout.orders) == rows(src.orders(spark, SF_SMALL))
    assert rows(layout.partsupp) == rows(src.partsupp(spark, SF_SMALL))
    kept = colocate.order_lines(spark, SF_SMALL, renumber=False)
    assert rows(kept.lines, *COLS) == rows(src.lineitem(spark, SF_SMALL), *COLS)


@pytest.fixture()
def joined_by_sorting(spark):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in saved.items():
        spark.conf.set(k, v)


def under(plan: str, mark: str) -> list[str]:
    """Lines of the plan on the path from the root to the first line with a mark."""
    lines = plan.splitlines()
    at = next(i for i, ln in enumerate(lines) if mark in ln)
    depth, path = len(lines[at]) - len(lines[at].lstrip(" :+-*")), []
    for ln in reversed(lines[:at]):
        d = len(ln) - len(ln.lstrip(" :+-*"))
        if d < depth:
            path.append(ln)
            depth = d
    return path


def test_lines_are_joined_where_they_are_stored(spark, joined_by_sorting):
    """No exchange lies between the stored lines and their join with orders, and
    none between the stored orders and it where orders are joined alone."""
    plan = plan_text(Models(spark, SF_SMALL, renumber_lines="stored").fact)
    path = under(plan, "ordermart_lines_")
    joins = [i for i, ln in enumerate(path) if "Join" in ln]
    assert "order_key" in path[joins[0]]
    assert not any("Exchange" in ln for ln in path[:joins[0]])
    assert not any("Exchange" in ln and ("orderkey" in ln or "order_key" in ln) for ln in path)
    assert "Window" not in plan
    layout = colocate.order_lines(spark, SF_SMALL, renumber=True)
    both = layout.lines.join(layout.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    assert "Exchange" not in plan_text(both)


def test_fact_without_any_exchange_on_the_order_key(spark):
    """As planned here, where customers are broadcast."""
    assert "Exchange hashpartitioning(order_key" not in plan_text(Models(spark, SF_SMALL, renumber_lines="stored").fact)


def source_with_a_hot_order(spark, folder):
    for name in ("orders", "customer", "nation", "region", "part", "supplier"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    some = lines.agg(F.min("l_orderkey")).first()[0]
    half = F.when(F.col("l_partkey") % 3 == 0, some).when(F.col("l_partkey") % 50 == 1, None).otherwise(F.col("l_orderkey"))
    lines.withColumn("l_orderkey", half).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_hot_orders_stay_apart_and_count(spark, tmp_dir):
    folder = source_with_a_hot_order(spark, tmp_dir)
    layout = colocate.order_lines(spark, folder, renumber=True, hot_rows=50)
    n_hot = layout.hot_lines.count()
    assert n_hot > 1000 and layout.lines.groupBy("l_orderkey").count().agg(F.max("count")).first()[0] <= 50
    assert layout.hot_lines.where("l_orderkey is null").count() > 50          # no key is a key, too
    whole = src.lineitem(spark, folder, renumber_lines=True)
    assert rows(layout.all_lines, *COLS) == rows(whole, *COLS)
    models = Models(spark, folder, renumber_lines="stored")
    models.layout = layout
    cols = ("order_line_sk", "customer_sk", "product_sk", "net_revenue", "ship_mode")
    assert rows(models.fact, *cols) == rows(Models(spark, folder, renumber_lines=True).fact, *cols)


def test_row_numbers_whatever_the_keys(spark):
    data = [(None if i % 5 == 0 else 1 if i % 2 else i, i % 7, i) for i in range(3000)]
    df = spark.createDataFrame(data, "k long, a long, b long").repartition(5)
    assert hot_keys(df, "k", 5000) is None
    assert rows(hot_keys(df, "k", 100)) == [(1,), (None,)]
    for hot in (100, 10_000):
        got = row_number_within(df, "k", ["a", "b"], out="rn", hot_rows=hot)
        assert rows(got, "k", "a", "b", "rn") == rows(window_numbers(df, "k", ["a", "b"]), "k", "a", "b", "rn")
    plan = plan_text(row_number_within(df, "k", ["a", "b"], out="rn"))
    assert plan.count("Exchange hashpartitioning") == 1       # one shuffle of the rows


def test_layout_is_kept_until_the_source_changes(spark, tmp_dir, monkeypatch):
    folder, root = f"{tmp_dir}/source", f"{tmp_dir}/kept"
    shutil.copytree(SF_SMALL, folder)
    first = colocate.order_lines(spark, folder, renumber=True, root=root)
    assert colocate.order_lines(spark, folder, renumber=True, root=root) is first
    colocate._KNOWN.clear()                                    # as in a later session
    with monkeypatch.context() as m:
        m.setattr(colocate, "_write", None)
        again = colocate.order_lines(spark, folder, renumber=True, root=root)
    assert rows(again.lines, *COLS) == rows(first.lines, *COLS)
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    shutil.move(f"{folder}/lineitem.parquet", f"{tmp_dir}/was.parquet")
    lines.limit(100).write.parquet(f"{folder}/lineitem.parquet")
    assert colocate.order_lines(spark, folder, renumber=True, root=root).lines.count() == 100
