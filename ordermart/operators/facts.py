"""The order-line fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import core as fn
from .dimensions import DATE_SPINE_END, DATE_SPINE_START
from .staging import audit_stamp

FACT_COLUMNS = [
    "order_line_sk",
    "customer_sk", "product_sk", "order_date_sk", "ship_date_sk",
    "order_key", "line_number", "order_status", "order_status_desc", "order_priority",
    "order_priority_rank", "ship_mode", "ship_instructions", "return_flag", "line_status",
    "delivery_status", "clerk_name",
    "market_segment", "nation_name", "region_name", "brand", "product_material",
    "product_size_segment", "container_size",
    "fiscal_year", "fiscal_quarter",
    "quantity", "extended_price", "discount_amount", "net_revenue", "gross_revenue",
    "tax_amount", "unit_price", "net_unit_price",
    "discount_rate", "tax_rate", "estimated_margin_pct",
    "days_to_ship", "days_in_transit", "total_fulfillment_days", "days_late",
    "is_late_delivery", "is_returned", "has_discount", "is_multi_unit",
    "order_date", "ship_date", "commit_date", "receipt_date", "_loaded_at",
]


def current_customer_keys(dim_customer: DataFrame) -> DataFrame:
    """Current version per customer: the lookup the reference's fact uses."""
    return dim_customer.where(F.col("is_current")).select("customer_key", "customer_sk")


def as_of_customer_keys(dim_customer: DataFrame, *extra: str) -> DataFrame:
    """All versions with their ranges, for point-in-time lookups."""
    return dim_customer.select("customer_key", "customer_sk", "effective_from",
                               "effective_to", *extra)


def lookup_customer(df: DataFrame, keys: DataFrame,
                    date_col: str = "order_date") -> DataFrame:
    """Add ``customer_sk`` (and any extra columns of ``keys``, the
    output of ``current_customer_keys`` or ``as_of_customer_keys``).

    Without effective dates this is an equi left join on customer_key (the
    current-row lookup). With ``effective_from``/``effective_to`` it is the
    point-in-time lookup: each customer's versions are folded into one row with
    a list, so the join on the key neither multiplies rows nor filters them
    afterwards, and the list is searched by the date (of ranges that overlap the
    last one counts). A customer has a version a capture run at most. A miss
    leaves NULL; the fact turns it into the unknown member.
    """
    ck = keys.withColumnRenamed("customer_key", "_ck_key")
    if "effective_from" not in ck.columns:
        return df.join(ck, F.col("customer_key") == F.col("_ck_key"), "left").drop("_ck_key")
    found = [c for c in ck.columns if c not in ("_ck_key", "effective_from", "effective_to")]
    lists = ck.groupBy("_ck_key").agg(F.array_sort(F.collect_list(
        F.struct("effective_from", "effective_to", *found))).alias("_versions"))
    valid = F.filter("_versions", lambda v: F.col(date_col).between(v["effective_from"], v["effective_to"]))
    at = F.try_element_at(valid, F.lit(-1))
    joined = df.join(lists, F.col("customer_key") == F.col("_ck_key"), "left").withColumn("_at", at)
    return joined.select(*df.columns, *[F.col("_at")[c].alias(c) for c in found])


def with_fact_flags(df: DataFrame) -> DataFrame:
    """Boolean flags; a NULL input gives a NULL flag."""
    return df.withColumns({
        "is_late_delivery": F.col("delivery_status") == "Late",
        "is_returned": F.col("return_flag") == "R",
        "has_discount": F.col("discount_rate") > 0,
        "is_multi_unit": F.col("quantity") > 1,
    })


def fact_orders(enriched: DataFrame, loaded_at=None, dim_customer: DataFrame | None = None,
                dim_product: DataFrame | None = None, date_start=DATE_SPINE_START,
                date_end=DATE_SPINE_END, kept: tuple[str, ...] = ()) -> DataFrame:
    """C17 + D4: the fact, 50 columns, and those of ``enriched`` that are ``kept``.

    Key lookups:
    - customer_sk: taken from ``enriched.customer_sk`` when the order-line
      model already resolved it at order grain (the cheap path: a join on
      the orders side instead of the line side); otherwise ``dim_customer``
      (current rows) is joined here.
    - product_sk: dim_product's key is md5(product_key) over the same staged
      products the order-line model joined, so a matched line's key is
      computed directly and an unmatched one (NULL product_key) is the
      unknown member. Pass ``dim_product`` to force a real join instead,
      e.g. when the dimension was built from a different product snapshot.
    - date keys: the date dimension is the full day spine with
      yyyymmdd keys, so the lookup is a range test, not a join.
    Misses become the unknown member: '-1' for string keys, -1 for date keys.
    """
    df = enriched
    if "customer_sk" not in df.columns:
        if dim_customer is None:
            raise ValueError("need enriched.customer_sk or dim_customer")
        df = lookup_customer(df, current_customer_keys(dim_customer))
    if dim_product is not None:
        dp = dim_product.select(F.col("product_key").alias("_pk"), "product_sk")
        df = df.join(dp, F.col("product_key") == F.col("_pk"), "left").drop("_pk")
    else:
        df = df.withColumn("product_sk", F.when(F.col("product_key").isNotNull(),
                                                fn.surrogate_key("product_key")))
    df = df.withColumns({
        "customer_sk": F.coalesce(F.col("customer_sk"), F.lit(fn.UNKNOWN_MEMBER_KEY)),
        "product_sk": F.coalesce(F.col("product_sk"), F.lit(fn.UNKNOWN_MEMBER_KEY)),
        "order_date_sk": fn.date_key_in_range("order_date", date_start, date_end),
        "ship_date_sk": fn.date_key_in_range("ship_date", date_start, date_end),
        "_loaded_at": audit_stamp(loaded_at),
    })
    return with_fact_flags(df).select(*FACT_COLUMNS, *kept)
