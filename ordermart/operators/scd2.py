"""Versioned (SCD2) customer dimension: A5, A6, D5-D7, C21.

Windows here are partitioned by the natural key. A key's versions are one
customer's change history: ``scd2_capture`` adds at most one version per
customer per capture run, so a group holds at most as many rows as there
have been runs (a daily build: about 365 a year), however large the table
grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import core as fn
from .staging import audit_stamp

# Snapshot (source) names -> business names.
HISTORY_NAMES = {
    "c_custkey": "customer_key",
    "c_name": "customer_name",
    "c_address": "customer_address",
    "c_phone": "customer_phone",
    "c_mktsegment": "market_segment",
    "c_comment": "customer_comment",
    "n_name": "nation_name",
    "r_name": "region_name",
    "c_acctbal": "account_balance",
    "scd_id": "_row_hash",
}

DIM_CUSTOMER_COLUMNS = [
    "customer_sk", "customer_key", "customer_name", "customer_address", "customer_phone",
    "market_segment", "customer_comment", "nation_name", "region_name", "account_balance",
    "account_tier", "_row_hash", "effective_from", "effective_to", "is_current", "_loaded_at",
]


def scd2_versions(history: DataFrame, key: str, updated_at: str, valid_to: str,
                  tie_break: str | None = None, far_future: str = fn.FAR_FUTURE,
                  collapse_same_day: bool = False) -> DataFrame:
    """Effective date ranges from a change history.

    effective_from = date(updated_at); effective_to = the next version's
    effective_from minus one day, or ``far_future``; is_current = the
    version is still open (``valid_to`` NULL). A deleted key has no open
    version but keeps its open end date, so "current" must use is_current.

    Two changes on one day give effective_to < effective_from and equal
    surrogate keys, as in the reference; ``collapse_same_day`` keeps only
    the last version of each day instead.
    """
    order = [F.col(updated_at)] + ([F.col(tie_break)] if tie_break else [])
    df = history.withColumn("effective_from", F.to_date(updated_at))
    if collapse_same_day:
        w_day = Window.partitionBy(key, "effective_from").orderBy(*[c.desc() for c in order])
        df = df.withColumn("_rn", F.row_number().over(w_day)).where("_rn = 1").drop("_rn")
    w = Window.partitionBy(key).orderBy(*order)
    next_from = F.lead(F.to_date(updated_at)).over(w)
    return df.withColumns({
        "effective_to": F.coalesce(F.date_sub(next_from, 1), F.lit(far_future).cast("date")),
        "is_current": F.col(valid_to).isNull(),
    })


def read_customer_history(snapshot: DataFrame, collapse_same_day: bool = False) -> DataFrame:
    """A5: snapshot rows under business names, with effective ranges."""
    versions = scd2_versions(snapshot, "c_custkey", "updated_at", "valid_to",
                             tie_break="scd_id", collapse_same_day=collapse_same_day)
    return versions.select(
        *[F.col(src).alias(dst) for src, dst in HISTORY_NAMES.items()],
        "effective_from", "effective_to", "is_current")


def single_version(stg_customers: DataFrame, start: str = fn.HISTORY_START,
                   far_future: str = fn.FAR_FUTURE) -> DataFrame:
    """One open version per customer from ``start`` to ``far_future``."""
    return stg_customers.select(
        "customer_key", "customer_name", "customer_address", "customer_phone",
        "market_segment", "customer_comment", "nation_name", "region_name",
        fn.money("account_balance").alias("account_balance"),
        fn.row_hash("customer_key", "customer_name", "market_segment", "nation_name",
                    "account_balance").alias("_row_hash"),
        F.lit(start).cast("date").alias("effective_from"),
        F.lit(far_future).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"))


def customer_history(stg_customers: DataFrame, snapshot: DataFrame | str | None = None,
                     collapse_same_day: bool = False) -> DataFrame:
    """The change history when one exists, else a single version per
    customer from the current staging rows. ``snapshot`` is a DataFrame or
    the path of a stored history table (used when the path exists)."""
    if isinstance(snapshot, str):
        from .load import read_target  # local import: load does not need scd2
        snapshot = read_target(stg_customers.sparkSession, snapshot)
    if snapshot is None:
        return single_version(stg_customers)
    return read_customer_history(snapshot, collapse_same_day)


def dim_customer(history: DataFrame, loaded_at=None) -> DataFrame:
    """Tier recomputed per version, surrogate key per version."""
    bal = fn.money("account_balance")
    return history.select(
        fn.surrogate_key("customer_key", F.col("effective_from").cast("string")).alias("customer_sk"),
        "customer_key", "customer_name", "customer_address", "customer_phone",
        "market_segment", "customer_comment", "nation_name", "region_name",
        fn.out(bal).alias("account_balance"),
        fn.account_tier(bal).alias("account_tier"),
        "_row_hash", "effective_from", "effective_to", "is_current",
        audit_stamp(loaded_at).alias("_loaded_at"),
    )


SNAPSHOT_ATTRS = ["c_name", "c_address", "c_phone", "c_mktsegment", "c_comment",
                  "n_name", "r_name", "c_acctbal"]


def scd2_capture(snapshot: DataFrame, incoming: DataFrame, key: str = "c_custkey",
                 updated_at: str = "updated_at", require_change: bool = True) -> DataFrame:
    """Apply current source rows to a timestamp-strategy change history.

    For each incoming key: no open version -> a new open version; an open
    version with an older ``updated_at`` -> that version is closed at the
    incoming timestamp and a new open version is added. With
    ``require_change`` (the default, for sources that stamp every row with the
    capture time) at least one stored attribute must differ too, NULLs
    included. Keys absent from ``incoming`` are left as they are (source
    deletes do not close versions). All steps are joins on the key, so every
    key's work is a handful of rows.
    """
    cols = snapshot.columns
    closed_now, open_now = scd2_changes(snapshot.where(F.col("valid_to").isNull()), incoming, key, updated_at,
                                        require_change)
    return (snapshot.where(F.col("valid_to").isNotNull())
            .unionByName(closed_now.select(*cols)).unionByName(open_now.select(*cols)))


def scd2_changes(open_: DataFrame, incoming: DataFrame, key: str = "c_custkey", updated_at: str = "updated_at",
                 require_change: bool = True) -> tuple[DataFrame, DataFrame]:
    """D6 by parts: from the open versions alone, the versions that the incoming
    rows close and the versions open afterwards (see ``scd2_capture``)."""
    cols = open_.columns
    attrs = [c for c in SNAPSHOT_ATTRS if c in cols]
    inc = incoming.select(key, *attrs, updated_at).withColumn(
        "scd_id", fn.row_hash(key, "c_name", "c_mktsegment", "n_name", "c_acctbal"))
    cur = open_.select(key, F.col(updated_at).alias("_open_upd"), F.struct(*attrs).alias("_open"))
    j = inc.join(cur, key, "left")
    newer = F.col(updated_at) > F.col("_open_upd")
    if require_change:
        newer = newer & ~F.struct(*attrs).eqNullSafe(F.col("_open"))
    changed = j.where(F.col("_open_upd").isNull() | newer)
    new_versions = changed.select(key, *attrs, "scd_id", updated_at,
                                  F.lit(None).cast("timestamp").alias("valid_to"))
    closing = changed.where(F.col("_open_upd").isNotNull()).select(
        key, F.col(updated_at).alias("_close_at"))
    closed_now = (open_.join(closing, key, "inner")
                  .withColumn("valid_to", F.col("_close_at")).drop("_close_at"))
    still_open = open_.join(closing.select(key), key, "left_anti")
    return closed_now.select(*cols), still_open.select(*cols).unionByName(new_versions.select(*cols))
