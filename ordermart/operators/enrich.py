"""The order-line model (C10-C15, D3): one wide row per order line.

Join order matters at scale. Catalyst keeps the written order of joins, so
the orders-sized joins (orders x customers, and the optional customer
dimension lookup) are done first, and only then are the line items joined.
That way the line-sized data is shuffled twice (by order key, then by part
key) instead of three times. AQE turns any side that turns out small at run
time into a broadcast and splits skewed join partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import core as fn
from ..sources.tables import with_line_columns

# Line-item columns of a source besides the keys that lines are joined by.
LINE_SOURCE_COLUMNS = ["l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                       "l_returnflag", "l_linestatus", "l_shipdate", "l_commitdate", "l_receiptdate",
                       "l_shipinstruct", "l_shipmode", "l_comment"]


def line_items(lineitem: DataFrame) -> DataFrame:
    """Typed projection of the line-item source (16 columns).

    Quantity and price stay decimal(12,2), rates decimal(4,2), so revenue is
    exact and rounds the same way in every engine.
    """
    return lineitem.select(*_line_item_columns())


def source_lines(lineitem: DataFrame) -> DataFrame:
    """Source lines under the keys they are joined by, for ``join_order_lines``.
    Typed columns and those that the source lacks are computed from a row alone,
    so ``line_columns`` makes them after the shuffles."""
    return lineitem.select(F.col("l_orderkey").cast("long").alias("order_key"),
                           F.col("l_partkey").cast("long").alias("product_key"),
                           *[c for c in LINE_SOURCE_COLUMNS if c in lineitem.columns])


def _typed(joined: DataFrame) -> DataFrame:
    """Joined lines with the columns of ``line_items`` in place of the source's."""
    if "l_linenumber" not in joined.columns:
        return joined                                # they were typed before the join
    others = [c for c in joined.columns if c not in ("order_key", "product_key", *LINE_SOURCE_COLUMNS)]
    lines = with_line_columns(joined.withColumns({"l_orderkey": F.col("order_key"), "l_partkey": F.col("product_key")}))
    return lines.select(*_line_item_columns(), *others)


def _line_item_columns() -> list[Column]:
    return [
        F.col("l_orderkey").cast("long").alias("order_key"),
        F.col("l_partkey").cast("long").alias("product_key"),
        F.col("l_suppkey").cast("long").alias("supplier_key"),
        F.col("l_linenumber").cast("int").alias("line_number"),
        fn.money("l_quantity").alias("quantity"),
        fn.money("l_extendedprice").alias("extended_price"),
        fn.rate("l_discount").alias("discount_rate"),
        fn.rate("l_tax").alias("tax_rate"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        F.to_date("l_shipdate").alias("ship_date"),
        F.to_date("l_commitdate").alias("commit_date"),
        F.to_date("l_receiptdate").alias("receipt_date"),
        F.col("l_shipinstruct").alias("ship_instructions"),
        F.col("l_shipmode").alias("ship_mode"),
        F.col("l_comment").alias("line_comment"),
    ]


def net_amount(ext, disc):
    return fn.col_(ext) * (F.lit(1) - fn.col_(disc))


def with_revenue(df: DataFrame) -> DataFrame:
    """C11: net, gross, discount and tax amounts, rounded to cents in decimal."""
    ext, disc, tax = F.col("extended_price"), F.col("discount_rate"), F.col("tax_rate")
    net = net_amount(ext, disc)
    return df.withColumns({
        "net_revenue": F.round(net, 2).cast(fn.MONEY),
        "gross_revenue": F.round(net * (F.lit(1) + tax), 2).cast(fn.MONEY),
        "discount_amount": F.round(ext * disc, 2).cast(fn.MONEY),
        "tax_amount": F.round(net * tax, 2).cast(fn.MONEY),
    })


def with_unit_prices(df: DataFrame) -> DataFrame:
    """Unit and net unit price, unrounded (NULL for zero quantity)."""
    ext, disc, qty = F.col("extended_price"), F.col("discount_rate"), F.col("quantity")
    return df.withColumns({
        "unit_price": fn.safe_divide(ext.cast("double"), qty.cast("double")),
        "net_unit_price": fn.safe_divide(net_amount(ext, disc).cast("double"), qty.cast("double")),
    })


def with_shipping_days(df: DataFrame) -> DataFrame:
    """Day counts and delivery status (days_late < 0 = early)."""
    return df.withColumns({
        "days_to_ship": fn.days_between("order_date", "ship_date"),
        "days_in_transit": fn.days_between("ship_date", "receipt_date"),
        "total_fulfillment_days": fn.days_between("order_date", "receipt_date"),
        "delivery_status": fn.delivery_status("ship_date", "commit_date"),
        "days_late": fn.days_between("commit_date", "ship_date"),
    })


ENRICHED_COLUMNS = [
    "order_line_sk",
    "order_key", "order_date", "order_status", "order_status_desc", "order_priority",
    "order_priority_rank", "clerk_name",
    "line_number", "quantity", "extended_price", "discount_rate", "tax_rate", "return_flag",
    "line_status", "ship_mode", "ship_instructions", "ship_date", "commit_date", "receipt_date",
    "net_revenue", "gross_revenue", "discount_amount", "tax_amount", "unit_price",
    "net_unit_price",
    "days_to_ship", "days_in_transit", "total_fulfillment_days", "delivery_status", "days_late",
    "fiscal_year", "fiscal_quarter",
    "customer_key", "customer_name", "market_segment", "nation_name", "region_name",
    "account_tier", "account_balance",
    "product_key", "product_name", "brand", "manufacturer", "product_material",
    "product_size_segment", "product_finish", "container_size", "retail_price",
    "estimated_margin_pct",
    "supplier_key",
]

_DOUBLE_OUT = {"quantity", "extended_price", "discount_rate", "tax_rate", "net_revenue",
               "gross_revenue", "discount_amount", "tax_amount"}


def order_headers(stg_orders: DataFrame, stg_customers: DataFrame,
                  customer_keys: DataFrame | None = None) -> DataFrame:
    """Orders joined to their customer (inner), at order grain.

    ``customer_keys`` (customer_key, customer_sk[, effective_from,
    effective_to]) resolves the customer dimension key here, on the orders
    side, instead of on the much larger line-level fact. With effective
    dates the lookup is point-in-time (D8), else current (D4).
    """
    o = stg_orders.select("order_key", "customer_key", "order_date", "order_status",
                          "order_status_desc", "order_priority", "order_priority_rank",
                          "clerk_name")
    c = stg_customers.select("customer_key", "customer_name", "market_segment", "nation_name",
                             "region_name", "account_tier", "account_balance")
    heads = o.join(c, "customer_key", "inner")
    if customer_keys is not None:
        from .facts import lookup_customer  # local import: facts imports this module
        heads = lookup_customer(heads, customer_keys)
    return heads


def join_order_lines(lines: DataFrame, headers: DataFrame, stg_products: DataFrame,
                     hot_lines: DataFrame | None = None) -> DataFrame:
    """D3: lines x order headers (inner), then products (left).

    ``lines`` are ``line_items`` or, at fewer bytes a shuffled line,
    ``source_lines``. They and the headers' orders may be bucketed by order key
    (``sources.colocate``): lines are then joined where they are stored.
    ``hot_lines`` are the lines of very large orders, kept apart there and
    joined on their own.

    Lines whose order failed validation or whose customer is missing drop
    out; lines with an unknown part stay, with NULL product columns
    (``product_key`` comes from the product side, as in the reference).
    """
    p = stg_products.select(
        F.col("product_key").alias("p_product_key"), "product_name", "brand", "manufacturer",
        "product_material", "product_size_segment", "product_finish", "container_size",
        "retail_price", "estimated_margin_pct")
    attributes = headers.columns
    headers = _short_keys(headers)
    joined = lines.join(headers, "order_key", "inner")
    if hot_lines is not None:
        joined = joined.unionByName(hot_lines.join(headers, "order_key", "inner"))
    columns = [*lines.columns, *[c for c in attributes if c != "order_key"], *p.columns]
    return (joined
            .join(p, F.col("product_key") == F.col("p_product_key"), "left")
            .select(*[_whole_key() if c == "customer_sk" else F.col(c) for c in columns]))


def _short_keys(headers: DataFrame) -> DataFrame:
    """Headers with a customer key's 32 hex digits as 16 bytes, for the shuffles;
    a key of another form stays text. ``_whole_key`` gives it back."""
    if "customer_sk" not in headers.columns:
        return headers
    in_bytes, as_text = fn.short_hex("customer_sk")
    return headers.withColumns({"_sk_bytes": in_bytes, "_sk_text": as_text}).drop("customer_sk")


def _whole_key() -> Column:
    return F.coalesce(F.lower(F.hex("_sk_bytes")), F.col("_sk_text")).alias("customer_sk")


def orders_enriched(stg_orders: DataFrame, stg_customers: DataFrame, stg_products: DataFrame,
                    lines: DataFrame, customer_keys: DataFrame | None = None,
                    hot_lines: DataFrame | None = None) -> DataFrame:
    """The order-line wide record (51 columns, + customer_sk when
    ``customer_keys`` is given)."""
    headers = order_headers(stg_orders, stg_customers, customer_keys)
    found = [] if customer_keys is None else lookup_columns(customer_keys)
    return line_columns(join_order_lines(lines, headers, stg_products, hot_lines), found)


def lookup_columns(customer_keys: DataFrame) -> list[str]:
    """customer_sk plus any extra lookup columns (named so they do not clash
    with the customer attributes already present)."""
    return [c for c in customer_keys.columns if c not in ("customer_key", "effective_from", "effective_to")]


def line_columns(joined: DataFrame, kept: list[str]) -> DataFrame:
    """The order-line record of joined lines, and their columns ``kept``. All of
    it is computed from a row alone, so joined rows, which are a third as wide,
    are what to store or to shuffle."""
    j = _typed(joined)
    j = with_shipping_days(with_unit_prices(with_revenue(j)))
    j = j.withColumns({
        "order_line_sk": fn.surrogate_key("order_key", "line_number"),
        "fiscal_year": fn.fiscal_year("order_date"),
        "fiscal_quarter": fn.fiscal_quarter("order_date"),
    })
    cols = [F.col("p_product_key").alias("product_key") if c == "product_key"
            else (fn.out(c).alias(c) if c in _DOUBLE_OUT else F.col(c))
            for c in ENRICHED_COLUMNS]
    return j.select(*cols, *kept)
