"""Column -> Column helpers: the reference's macros and inline CASE rules.

Everything here is a built-in Spark expression, so it stays inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
NULL_TOKEN = "@@NULL@@"          # placeholder for NULL parts of a surrogate key
KEY_DELIMITER = "|"              # separator between surrogate-key parts
FAR_FUTURE = "9999-12-31"        # open end of an SCD2 version
HISTORY_START = "1992-01-01"     # start of a single-version customer history
ORDER_STATUS_LABELS = {"O": "Open", "F": "Fulfilled", "P": "In Progress"}
UNKNOWN_STATUS = "Unknown"
ORDER_PRIORITY_RANKS = {
    "1-URGENT": 1,
    "2-HIGH": 2,
    "3-MEDIUM": 3,
    "4-NOT SPECIFIED": 4,
    "5-LOW": 5,
}
UNKNOWN_PRIORITY_RANK = 99
VALID_ORDER_STATUSES = ["O", "F", "P"]
MARKET_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
ACCOUNT_TIERS = ["Negative", "Bronze", "Silver", "Gold", "Platinum"]
DELIVERY_STATUSES = ["On-Time", "Late"]
FISCAL_YEAR_START_MONTH = 10     # fiscal year starts October 1
UNKNOWN_MEMBER_KEY = "-1"        # unknown member for string surrogate keys
UNKNOWN_DATE_KEY = -1            # unknown member for integer date keys

# Internal money and rate types (T1/T2 in the survey): decimals inside,
# double only at output.
MONEY = "decimal(12,2)"
RATE = "decimal(4,2)"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    return col_(c).cast(MONEY)


def rate(c) -> Column:
    return col_(c).cast(RATE)


def out(c) -> Column:
    """Output form of a money/rate value."""
    return col_(c).cast("double")


def safe_divide(num, den, default=None) -> Column:
    """num / den; ``default`` (NULL if None) when den is 0 or NULL.

    A NULL numerator still yields NULL: the default only replaces the
    division-by-zero/NULL-denominator case.
    """
    num, den = col_(num), col_(den)
    fallback = F.lit(None) if default is None else F.lit(default)
    return F.when((den == 0) | den.isNull(), fallback).otherwise(F.try_divide(num, den))


def surrogate_key(*cols) -> Column:
    """md5 of the '|'-joined text of the parts, NULL parts as '@@NULL@@'.

    The delimiter is not escaped, so ('a|b','c') and ('a','b|c') collide, as
    in the reference.
    """
    if not cols:
        raise ValueError("surrogate_key requires at least one column")
    parts = [F.coalesce(col_(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(KEY_DELIMITER, *parts))


def short_hex(c) -> tuple[Column, Column]:
    """A text's two short forms, one of them NULL: lower-case hex digits as bytes,
    any other text as it is. Equal texts and only they have equal forms."""
    text = col_(c)
    in_bytes = F.unhex(text)
    is_hex = F.lower(F.hex(in_bytes)) == text
    return F.when(is_hex, in_bytes), F.when(is_hex, F.lit(None)).otherwise(text)


def row_hash(customer_key, name, segment, nation, balance) -> Column:
    """Change-detection hash of a customer version's tracked attributes.

    The balance is hashed as decimal text so the hash does not depend on an
    engine's double formatting.
    """
    return surrogate_key(customer_key, name, segment, nation,
                         col_(balance).cast("decimal(18,2)").cast("string"))


def account_tier(balance) -> Column:
    """Balance band. Bands overlap at 2500/5000/7500 and the first match wins;
    a NULL balance falls through to 'Platinum', as in the reference."""
    b = col_(balance)
    return (F.when(b < 0, "Negative")
            .when(b.between(0, 2500), "Bronze")
            .when(b.between(2500, 5000), "Silver")
            .when(b.between(5000, 7500), "Gold")
            .otherwise("Platinum"))


def status_desc(status) -> Column:
    s = col_(status)
    expr = None
    for code, label in ORDER_STATUS_LABELS.items():
        expr = F.when(s == code, label) if expr is None else expr.when(s == code, label)
    return expr.otherwise(UNKNOWN_STATUS)


def priority_rank(priority) -> Column:
    p = col_(priority)
    expr = None
    for text, rank in ORDER_PRIORITY_RANKS.items():
        expr = F.when(p == text, rank) if expr is None else expr.when(p == text, rank)
    return expr.otherwise(UNKNOWN_PRIORITY_RANK)


def delivery_status(ship, commit) -> Column:
    """On-Time when shipped on or before the commit date; NULL dates are Late."""
    return F.when(col_(ship) <= col_(commit), "On-Time").otherwise("Late")


def fiscal_year(d) -> Column:
    d = col_(d)
    return (F.year(d) + F.when(F.month(d) >= FISCAL_YEAR_START_MONTH, 1).otherwise(0)).cast("int")


def fiscal_quarter(d) -> Column:
    m = F.month(col_(d))
    return (F.when(m.isin(10, 11, 12), 1)
            .when(m.isin(1, 2, 3), 2)
            .when(m.isin(4, 5, 6), 3)
            .when(m.isin(7, 8, 9), 4))


def fiscal_month(d) -> Column:
    m = F.month(col_(d))
    return F.when(m >= 10, m - 9).otherwise(m + 3).cast("int")


def fiscal_period_label(d) -> Column:
    """'FY2024-Q1' style label."""
    return F.concat(F.lit("FY"), fiscal_year(d).cast("string"),
                    F.lit("-Q"), fiscal_quarter(d).cast("string"))


def date_key(d) -> Column:
    """yyyymmdd integer key of a date, by arithmetic (no string formatting)."""
    d = col_(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_key_in_range(d, start: str | _dt.date, end: str | _dt.date) -> Column:
    """Date-dimension key lookup without a join.

    The date dimension is the complete day spine [start, end] keyed by
    yyyymmdd, so a lookup hit is exactly "date inside the spine"; a miss
    (outside the spine, or NULL) is the unknown member -1.
    """
    d = col_(d)
    inside = d.between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    return F.when(inside, date_key(d)).otherwise(F.lit(UNKNOWN_DATE_KEY))


def parse_part(c, idx: int) -> Column:
    """1-based space-separated part of a text; '' when missing."""
    return F.split_part(col_(c), F.lit(" "), F.lit(idx))


def days_between(start, end) -> Column:
    """Whole days from ``start`` to ``end`` (negative if end is earlier)."""
    return F.datediff(col_(end), col_(start)).cast("int")
