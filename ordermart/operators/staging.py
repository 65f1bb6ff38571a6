"""Staging models: typed, renamed source tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import core as fn


def audit_stamp(loaded_at: _dt.datetime | str | None) -> Column:
    """The `_loaded_at` audit column: a fixed timestamp when given (repeatable
    runs), else the query's current timestamp."""
    if loaded_at is None:
        return F.current_timestamp()
    return F.lit(str(loaded_at)).cast("timestamp")


def valid_orders(df: DataFrame) -> DataFrame:
    """C4: keys and date present, total >= 0 (a NULL total is dropped too)."""
    return df.where(F.col("order_key").isNotNull()
                    & F.col("customer_key").isNotNull()
                    & F.col("order_date").isNotNull()
                    & (F.col("order_total_price") >= 0))


def stg_orders(orders: DataFrame, loaded_at=None) -> DataFrame:
    """One row per valid order."""
    renamed = orders.select(
        F.col("o_orderkey").cast("long").alias("order_key"),
        F.col("o_custkey").cast("long").alias("customer_key"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("order_priority"),
        F.col("o_clerk").alias("clerk_name"),
        F.col("o_shippriority").cast("int").alias("ship_priority"),
        F.col("o_comment").alias("order_comment"),
        F.col("o_totalprice").cast("double").alias("order_total_price"),
        F.to_date("o_orderdate").alias("order_date"),
        fn.status_desc("o_orderstatus").alias("order_status_desc"),
        fn.priority_rank("o_orderpriority").alias("order_priority_rank"),
        audit_stamp(loaded_at).alias("_loaded_at"),
    )
    return valid_orders(renamed)


def with_geography(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Customer -> nation -> region, left joins.

    nation and region are fixed-size (25 and 5 rows in TPC-H); the planner's
    size estimate from the parquet footers puts them under the broadcast
    threshold, so the customer side is not shuffled. No hint is forced.
    """
    n = nation.select(F.col("n_nationkey"), F.col("n_regionkey"), F.col("n_name"))
    r = region.select(F.col("r_regionkey"), F.col("r_name"))
    return (customer.join(n, customer["c_nationkey"] == n["n_nationkey"], "left")
            .join(r, n["n_regionkey"] == r["r_regionkey"], "left"))


def stg_customers(customer: DataFrame, nation: DataFrame, region: DataFrame,
                  loaded_at=None) -> DataFrame:
    """One row per customer with geography and balance tier; no filter."""
    geo = with_geography(customer, nation, region)
    bal = fn.money("c_acctbal")
    return geo.select(
        F.col("c_custkey").cast("long").alias("customer_key"),
        F.col("c_nationkey").cast("int").alias("nation_key"),
        F.col("n_regionkey").cast("int").alias("region_key"),
        F.col("c_name").alias("customer_name"),
        F.col("c_address").alias("customer_address"),
        F.col("c_phone").alias("customer_phone"),
        F.col("c_mktsegment").alias("market_segment"),
        F.col("c_comment").alias("customer_comment"),
        F.col("n_name").alias("nation_name"),
        F.col("r_name").alias("region_name"),
        fn.out(bal).alias("account_balance"),
        fn.account_tier(bal).alias("account_tier"),
        audit_stamp(loaded_at).alias("_loaded_at"),
    )


def best_supplier(partsupp: DataFrame) -> DataFrame:
    """Cheapest supplier per part, ties broken by the lower supplier key.

    Written as a ``min_by`` aggregate instead of row_number()=1: it combines
    map-side, so a part with very many supplier rows is reduced before the
    shuffle instead of being sorted whole in one task.
    """
    best = F.min_by(
        F.struct(F.col("ps_suppkey").alias("s"), F.col("ps_availqty").alias("q"),
                 F.col("ps_supplycost").alias("c")),
        F.struct(fn.money("ps_supplycost"), F.col("ps_suppkey")))
    return (partsupp.groupBy(F.col("ps_partkey").cast("long").alias("part_key"))
            .agg(best.alias("b"))
            .select("part_key",
                    F.col("b.s").cast("long").alias("supplier_key"),
                    F.col("b.q").cast("int").alias("available_qty"),
                    fn.money("b.c").alias("supply_cost")))


def stg_products(part: DataFrame, partsupp: DataFrame, loaded_at=None) -> DataFrame:
    """C7-C9 + D2: one row per part with parsed type/container and the
    cheapest supplier's cost; margin is NULL without a supplier."""
    best = best_supplier(partsupp)
    joined = part.join(best, part["p_partkey"] == best["part_key"], "left")
    retail = fn.money("p_retailprice")
    cost = F.col("supply_cost")
    margin = fn.safe_divide((retail - cost).cast("double"), retail.cast("double"))
    return joined.select(
        F.col("p_partkey").cast("long").alias("product_key"),
        F.col("supplier_key"),
        F.col("p_name").alias("product_name"),
        F.col("p_mfgr").alias("manufacturer"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("product_type_raw"),
        fn.parse_part("p_type", 1).alias("product_size_segment"),
        fn.parse_part("p_type", 2).alias("product_finish"),
        fn.parse_part("p_type", 3).alias("product_material"),
        F.col("p_container").alias("container_raw"),
        fn.parse_part("p_container", 1).alias("container_size"),
        fn.parse_part("p_container", 2).alias("container_type"),
        F.col("p_size").cast("int").alias("product_size_units"),
        fn.out(retail).alias("retail_price"),
        fn.out(cost).alias("supply_cost"),
        F.col("available_qty"),
        margin.alias("estimated_margin_pct"),
        F.col("p_comment").alias("product_comment"),
        audit_stamp(loaded_at).alias("_loaded_at"),
    )
