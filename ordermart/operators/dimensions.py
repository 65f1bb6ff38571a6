"""Date and product dimensions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import core as fn
from .staging import audit_stamp

# The documented date-dimension range.
DATE_SPINE_START = "1992-01-01"
DATE_SPINE_END = "2030-12-31"


def _as_date(d) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def spine_rows(start, end, end_inclusive: bool = True) -> int:
    """Row count of a spine, known from its parameters without running a job."""
    return (_as_date(end) - _as_date(start)).days + (1 if end_inclusive else 0)


def date_spine(spark: SparkSession, start=DATE_SPINE_START, end=DATE_SPINE_END,
               end_inclusive: bool = True, cover: DataFrame | None = None) -> DataFrame:
    """A3: one row (``date_day``) per calendar day.

    ``cover``: an optional one-column DataFrame of dates. The spine is then
    widened, if needed, to include every date in it, so no fact date falls
    outside the dimension; with ``start``/``end`` None it spans exactly the
    dates of ``cover``. The bounds are computed by an aggregate and fed to
    ``sequence`` inside the same plan; nothing goes through the driver.
    The spine has one row per day of the range (14,245 rows for the default
    range), and ``explode`` spreads it out.
    """
    lo = F.lit(str(start)).cast("date") if start is not None else None
    hi = F.lit(str(end)).cast("date") if end is not None else None
    if hi is not None and not end_inclusive:
        hi = F.date_sub(hi, 1)
    if cover is None:
        if lo is None or hi is None:
            raise ValueError("start and end are needed without cover")
        bounds = spark.range(1).select(lo.alias("lo"), hi.alias("hi"))
    else:
        c = cover.columns[0]
        dmin, dmax = F.col("dmin"), F.col("dmax")
        bounds = cover.agg(F.min(F.to_date(c)).alias("dmin"), F.max(F.to_date(c)).alias("dmax")).select(
            (dmin if lo is None else F.least(lo, F.coalesce(dmin, lo))).alias("lo"),
            (dmax if hi is None else F.greatest(hi, F.coalesce(dmax, hi))).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_day"))


def with_relative_flags(df: DataFrame, as_of, date_col: str = "full_date") -> DataFrame:
    """Flags relative to ``as_of`` (the run date)."""
    d = F.col(date_col)
    today = F.lit(str(as_of)).cast("date")
    return df.withColumns({
        "is_today": d == today,
        "is_yesterday": d == F.date_sub(today, 1),
        "is_current_month": (d >= F.trunc(today, "month")) & (d <= today),
        "is_current_year": (d >= F.trunc(today, "year")) & (d <= today),
    })


def date_attributes(d: Column) -> dict[str, Column]:
    dow = (F.dayofweek(d) - 1).cast("int")          # 0 = Sunday
    return {
        "date_sk": fn.date_key(d),
        "full_date": d,
        "calendar_year": F.year(d).cast("int"),
        "calendar_quarter": F.quarter(d).cast("int"),
        "calendar_month": F.month(d).cast("int"),
        "month_name": F.monthname(d),
        "month_name_short": F.left(F.monthname(d), F.lit(3)),
        "week_of_year": F.weekofyear(d).cast("int"),
        "day_of_year": F.dayofyear(d).cast("int"),
        "day_of_month": F.dayofmonth(d).cast("int"),
        "day_of_week": dow,
        "day_name": F.dayname(d),
        "day_name_short": F.left(F.dayname(d), F.lit(3)),
        "year_month": F.date_format(d, "yyyy-MM"),
        "quarter_label": F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit("-"),
                                  F.year(d).cast("string")),
        "fiscal_year": fn.fiscal_year(d),
        "fiscal_quarter": fn.fiscal_quarter(d),
        "fiscal_month": fn.fiscal_month(d),
        "fiscal_quarter_label": fn.fiscal_period_label(d),
        "is_weekend": dow.isin(0, 6),
        "is_weekday": ~dow.isin(0, 6),
    }


DIM_DATE_COLUMNS = [
    "date_sk", "full_date", "calendar_year", "calendar_quarter", "calendar_month", "month_name",
    "month_name_short", "week_of_year", "day_of_year", "day_of_month", "day_of_week", "day_name",
    "day_name_short", "year_month", "quarter_label", "fiscal_year", "fiscal_quarter",
    "fiscal_month", "fiscal_quarter_label", "is_weekend", "is_weekday", "is_today",
    "is_yesterday", "is_current_month", "is_current_year", "is_first_of_month",
    "is_last_of_month", "days_since_epoch",
]


def dim_date(spark: SparkSession, as_of, start=DATE_SPINE_START, end=DATE_SPINE_END,
             cover: DataFrame | None = None) -> DataFrame:
    """The date dimension, 28 columns, one row per day."""
    spine = date_spine(spark, start, end, cover=cover)
    d = F.col("date_day")
    attrs = date_attributes(d)
    attrs.update({
        "is_first_of_month": F.dayofmonth(d) == 1,
        "is_last_of_month": d == F.last_day(d),
        "days_since_epoch": F.datediff(d, F.lit("1970-01-01").cast("date")).cast("int"),
    })
    df = spine.select(*[v.alias(k) for k, v in attrs.items()])
    return with_relative_flags(df, as_of).select(*DIM_DATE_COLUMNS)


DIM_PRODUCT_COLUMNS = [
    "product_sk", "product_key", "product_name", "manufacturer", "brand", "product_type_raw",
    "product_size_segment", "product_finish", "product_material", "container_raw",
    "container_size", "container_type", "product_size_units", "retail_price", "supply_cost",
    "available_qty", "estimated_margin_pct", "_loaded_at",
]


def dim_product(stg_products: DataFrame, loaded_at=None) -> DataFrame:
    """C20: SCD1 product dimension with its surrogate key."""
    return (stg_products
            .withColumn("product_sk", fn.surrogate_key("product_key"))
            .withColumn("_loaded_at", audit_stamp(loaded_at))
            .select(*DIM_PRODUCT_COLUMNS))
