"""Data-quality checks.

Each check returns its **failing rows** (empty = pass). ``run_checks``
builds the suite report: all row-local checks of one table (not_null,
accepted_values, expression_is_true) are fused into one aggregate, so a
table is scanned once for all of them; unique and relationships need their
own aggregate or anti join.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import core as fn
from ..session import STORED_CODEC, drop_unused_shuffles, scratch_path, slice_count, source_state


# ---------------------------------------------------------------------------
# Generic checks (Q1-Q6)
# ---------------------------------------------------------------------------

def not_null(df: DataFrame, col: str) -> DataFrame:
    """Q1: rows where ``col`` is NULL."""
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Q2: non-NULL values that occur more than once, with their counts.
    The count is a partial aggregate, so a hot value is combined map-side."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def _accepted(col: Column, values) -> Column:
    return col.isNull() | col.isin(list(values))


def accepted_values(df: DataFrame, col: str, values) -> DataFrame:
    """Q3: non-NULL values outside ``values`` (NULL passes)."""
    return df.where(~_accepted(F.col(col), values))


def relationships(df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Q4: non-NULL child values without a parent row (anti join)."""
    p = parent.select(F.col(parent_col).alias("_parent_key"))
    return (df.where(F.col(col).isNotNull())
            .join(p, F.col(col) == F.col("_parent_key"), "left_anti"))


def _expression(col: str, expression: str) -> Column:
    return F.expr(f"{col} {expression}")


def expression_is_true(df: DataFrame, col: str, expression: str) -> DataFrame:
    """Q5: rows where ``col <expression>`` is false; NULL passes. The
    expression may name another column (e.g. '>= net_revenue')."""
    return df.where(~_expression(col, expression))


def row_count(df: DataFrame) -> DataFrame:
    """Global count(*)."""
    return df.agg(F.count(F.lit(1)).alias("cnt"))


def row_count_validation(df: DataFrame, min_rows: int = 1, max_rows: int | None = None) -> DataFrame:
    """Q6 before filtering: count, bounds and the failure message (NULL = pass)."""
    cnt = F.col("cnt")
    reason = F.when(cnt < min_rows, F.concat(F.lit("FAIL: row count "), cnt.cast("string"),
                                             F.lit(f" below minimum {min_rows}")))
    if max_rows is not None:
        reason = reason.when(cnt > max_rows, F.concat(F.lit("FAIL: row count "), cnt.cast("string"),
                                                      F.lit(f" above maximum {max_rows}")))
    return row_count(df).select(
        "cnt", F.lit(min_rows).cast("long").alias("expected_min"),
        F.lit(max_rows).cast("long").alias("expected_max"), reason.alias("failure_reason"))


def row_count_between(df: DataFrame, min_rows: int = 1, max_rows: int | None = None) -> DataFrame:
    """Q6: one row when the count is out of bounds, else none."""
    return row_count_validation(df, min_rows, max_rows).where(F.col("failure_reason").isNotNull())


def column_values(df: DataFrame, col: str, max_records: int = 50) -> DataFrame:
    """Distinct non-NULL values, sorted, at most ``max_records``.
    The limit is the feature; the sort is a distributed top-k."""
    return (df.select(col).where(F.col(col).isNotNull()).distinct()
            .orderBy(col).limit(max_records))


def column_value_list(df: DataFrame, col: str, max_records: int = 50) -> list:
    """E3 as a Python list, for building IN lists; at most ``max_records``
    values reach the driver."""
    return [r[0] for r in column_values(df, col, max_records).collect()]


def freshness(df: DataFrame, col: str, as_of, warn_after_days: int = 1,
              error_after_days: int = 3, table_name: str = "orders") -> DataFrame:
    """Age of the newest ``col`` value against ``as_of``: warn after
    ``warn_after_days``, error after ``error_after_days``. A report, never a
    gate."""
    today = F.lit(str(as_of)).cast("date")
    newest = df.agg(F.max(F.to_date(col)).alias("max_loaded_at"))
    age = F.datediff(today, F.col("max_loaded_at"))
    return newest.select(
        F.lit(table_name).alias("table_name"), F.lit(col).alias("loaded_at_field"),
        "max_loaded_at", today.alias("as_of"), age.cast("int").alias("age_days"),
        F.when(age > error_after_days, "error").when(age > warn_after_days, "warn")
        .otherwise("pass").alias("status"))


# ---------------------------------------------------------------------------
# Hand-written checks on the marts (Q7-Q10)
# ---------------------------------------------------------------------------

_AMOUNT_RULES = [
    ("net_revenue", "<", 0), ("gross_revenue", "<", 0), ("quantity", "<=", 0),
    ("extended_price", "<=", 0), ("discount_amount", "<", 0), ("tax_amount", "<", 0),
]


def positive_amounts(fact: DataFrame) -> DataFrame:
    """Q7: lines with a negative amount or non-positive quantity/price; the
    first failing rule, in the listed order, is the reason. NULL passes."""
    def test(c, op, v):
        return F.col(c) < v if op == "<" else F.col(c) <= v
    reason = None
    for c, op, v in _AMOUNT_RULES:
        text = f"{c} {op} {v}"
        reason = F.when(test(c, op, v), text) if reason is None else reason.when(test(c, op, v), text)
    any_fail = None
    for c, op, v in _AMOUNT_RULES:
        any_fail = test(c, op, v) if any_fail is None else (any_fail | test(c, op, v))
    return fact.where(any_fail).select(
        "order_line_sk", "order_key", "line_number", "net_revenue", "gross_revenue",
        "quantity", "extended_price", "discount_amount", reason.alias("failure_reason"))


def valid_values(spark: SparkSession, values, name: str = "status") -> DataFrame:
    """A4: an inline VALUES relation (a local relation of known size)."""
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def valid_order_status(fact: DataFrame, spark: SparkSession | None = None,
                       values=fn.VALID_ORDER_STATUSES) -> DataFrame:
    """Q8 via D9: left join to the valid list and keep misses; NULL fails
    (unlike accepted_values)."""
    spark = spark or fact.sparkSession
    vs = valid_values(spark, values)
    j = fact.join(vs, fact["order_status"] == vs["status"], "left")
    return j.where(vs["status"].isNull()).select(
        "order_line_sk", "order_key", "order_date", "order_status",
        F.concat(F.lit("Invalid order_status: "),
                 F.coalesce(F.col("order_status"), F.lit("NULL"))).alias("failure_reason"))


def next_start(col: str, key: str, *order: str) -> Column:
    """The next version's value of ``col`` within ``key``."""
    return F.lead(col).over(Window.partitionBy(key).orderBy(*order))


def scd2_gaps(dim: DataFrame, boundary: str = "inclusive") -> DataFrame:
    """Q9: versions that are not contiguous with the next one, or whose range
    is inverted; the gap reason wins over the range reason.

    ``boundary='inclusive'`` (default) expects next_from = effective_to + 1
    day, which is how the dimension is built. ``'as_written'`` applies the
    reference's literal rule (effective_to = next_from), which flags every
    multi-version customer.
    """
    if boundary not in ("inclusive", "as_written"):
        raise ValueError("boundary must be 'inclusive' or 'as_written'")
    nxt = F.col("next_version_from")
    expected = F.col("effective_to") if boundary == "as_written" else F.date_add("effective_to", 1)
    v = dim.select("customer_key", "customer_sk", "effective_from", "effective_to",
                   next_start("effective_from", "customer_key", "effective_from",
                              "effective_to", "customer_sk").alias("next_version_from"))
    gap = F.when(nxt.isNotNull() & (expected != nxt), "GAP or OVERLAP between versions")
    rng = F.when(F.col("effective_to") < F.col("effective_from"), "effective_to before effective_from")
    return (v.withColumns({"_gap": gap, "_rng": rng})
            .where(F.col("_gap").isNotNull() | F.col("_rng").isNotNull())
            .select("customer_key", "customer_sk", "effective_from", "effective_to",
                    "next_version_from", F.coalesce("_gap", "_rng").alias("failure_reason")))


def union_failures(*dfs: DataFrame) -> DataFrame:
    """UNION ALL of failure sets with the same columns."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def orphan_fks(fact: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
               dim_date: DataFrame, check_ship_date: bool = False, written: bool = False,
               carry: list[str] | None = None, slices: int | None = None) -> DataFrame:
    """Q10 (D10): orphan customer, product and order-date keys (unknown member
    allowed). Keys are compared as text (the string keys' unknown member is
    '-1', the date key's -1).

    All key columns are checked in one pass: the fact's keys are stacked
    into (key column, value) pairs, made distinct (a partial aggregate), and
    anti-joined with the dimensions' keys tagged the same way. Only orphan
    pairs are joined back to the fact rows; when there are none, AQE drops
    that join. ``carry`` names further columns of the fact to return.
    ``written`` says that the fact is read from files; otherwise its
    key columns are stored first, so that the fact is computed once. Where there
    are many, orphan keys are found in ``slices`` of the values and stored: the
    disks hold the shuffles of one slice.
    """
    specs = [("customer_sk", dim_customer, "customer_sk", "dim_customer"),
             ("product_sk", dim_product, "product_sk", "dim_product"),
             ("order_date_sk", dim_date, "date_sk", "dim_date")]
    if check_ship_date:
        specs.append(("ship_date_sk", dim_date, "date_sk", "dim_date"))
    carry = carry or []
    if not written:
        # The keys are read twice: compute the fact once and keep its keys.
        path = scratch_path(fact.sparkSession, "fact-keys")
        keys_only = fact.select("order_line_sk", *[fk for fk, *_ in specs], *carry)
        keys_only.write.option("compression", STORED_CODEC).parquet(path)
        drop_unused_shuffles(fact.sparkSession)
        slices = slices or slice_count(source_state(fact.sparkSession, [path])[1])
        fact = fact.sparkSession.read.schema(keys_only.schema).parquet(path)
    stack = F.expr("stack({}, {}) as (fk, fk_value)".format(
        len(specs), ", ".join(f"'{fk}', cast({fk} as string)" for fk, *_ in specs)))
    pairs = fact.select("order_line_sk", *carry, stack)
    # '-1' is the unknown member of every key (string keys '-1', date keys -1).
    known = F.col("fk_value") != F.lit(fn.UNKNOWN_MEMBER_KEY)
    keys = pairs.where(known).select("fk", "fk_value").distinct()
    dim_keys = union_failures(*[
        dim.select(F.lit(fk).alias("fk"), F.col(key).cast("string").alias("fk_value"))
        for fk, dim, key, _ in specs])
    orphan_keys = keys.join(dim_keys, ["fk", "fk_value"], "left_anti")
    if slices and slices > 1:
        path = scratch_path(fact.sparkSession, "orphan-keys")
        for i in range(slices):
            of_slice = F.pmod(F.xxhash64("fk_value"), F.lit(slices)) == i
            orphan_keys.where(of_slice).write.mode("append").option("compression", STORED_CODEC).parquet(path)
            drop_unused_shuffles(fact.sparkSession)
        orphan_keys = fact.sparkSession.read.schema(orphan_keys.schema).parquet(path)
    names = F.create_map(*[x for fk, _, _, name in specs for x in (F.lit(fk), F.lit(name))])
    rows = pairs.join(orphan_keys, ["fk", "fk_value"], "left_semi")
    dim_name = names[F.col("fk")]
    return rows.select(
        "order_line_sk", "fk_value", dim_name.alias("failed_dimension"),
        F.concat(F.col("fk"), F.lit(" "), F.col("fk_value"), F.lit(" not found in "), dim_name)
        .alias("reason"), *carry)


# ---------------------------------------------------------------------------
# Declared checks and the fused suite report (Q11, Q12)
# ---------------------------------------------------------------------------

_OPS = [(">=", " ge "), ("<=", " le "), ("<>", " ne "), ("!=", " ne "), (">", " gt "),
        ("<", " lt "), ("=", " eq ")]


def _slug(expression: str) -> str:
    for op, word in _OPS:
        expression = expression.replace(op, word)
    return "_".join(re.findall(r"[A-Za-z0-9.]+", expression)).replace(".", "p")


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    kind: str                     # not_null | unique | accepted_values | relationships |
                                  # expression_is_true | row_condition
    arg: object = None            # values / expression / (parent_table, parent_column) /
                                  # failing-row condition (SQL) for row_condition
    severity: str = "warn"        # Q11: warn by default, error to gate the build
    label: str | None = None      # a name of its own (hand-written checks)

    @property
    def name(self) -> str:
        if self.label:
            return self.label
        base = f"{self.kind}__{self.table}__{self.column}"
        if self.kind == "expression_is_true":
            # several expressions may test one column: keep names unique
            return f"{base}__{_slug(str(self.arg))}"
        return base

    @property
    def detail(self) -> str:
        if self.arg is None:
            return ""
        if self.kind == "accepted_values":
            return ",".join(str(v) for v in self.arg)
        if self.kind == "relationships":
            return f"{self.arg[0]}.{self.arg[1]}"
        return str(self.arg)


ROW_LOCAL = ("not_null", "accepted_values", "expression_is_true", "row_condition")


def row_failure(check: Check) -> Column:
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return ~_accepted(c, check.arg)
    if check.kind == "expression_is_true":
        return ~_expression(check.column, check.arg)
    if check.kind == "row_condition":
        return F.expr(check.arg)
    raise ValueError(check.kind)


def observed(df: DataFrame, checks: list[Check]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` that counts the failing rows of row-local checks while it is
    written, and the counts by check name, there once the write is done.

    To be applied right below the write: there a row passes once, and what a
    failed or repeated task has counted does not count. Below a shuffle a stage
    that runs again would count again.
    """
    checks = [c for c in checks if c.kind in ROW_LOCAL]
    if not checks:
        return df, dict
    seen = Observation(f"checks-{uuid.uuid4().hex[:12]}")
    named = df.observe(seen, *[F.count_if(row_failure(c)).alias(f"c{i}") for i, c in enumerate(checks)])
    return named, lambda: {c.name: seen.get[f"c{i}"] for i, c in enumerate(checks)}


def check_failures(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    """The failing rows of one declared check."""
    df = tables[check.table]
    if check.kind == "not_null":
        return not_null(df, check.column)
    if check.kind == "unique":
        return unique(df, check.column)
    if check.kind == "accepted_values":
        return accepted_values(df, check.column, check.arg)
    if check.kind == "expression_is_true":
        return expression_is_true(df, check.column, check.arg)
    if check.kind == "relationships":
        parent, pcol = check.arg
        return relationships(df, check.column, tables[parent], pcol)
    if check.kind == "row_condition":
        return df.where(F.expr(check.arg))
    raise ValueError(check.kind)


REPORT_SCHEMA = ("check_name string, table_name string, column_name string, kind string, "
                 "detail string, severity string, failures long")


def _report_rows(spark: SparkSession, checks: list[Check], counts: DataFrame,
                 singular: dict[str, DataFrame], singular_severity: str) -> DataFrame:
    meta = spark.createDataFrame(
        [(c.name, c.table, c.column, c.kind, c.detail, c.severity) for c in checks]
        + [(name, "marts", "", "singular", "", singular_severity) for name in singular],
        "check_name string, table_name string, column_name string, kind string, "
        "detail string, severity string")
    # A check without failing values may have no count.
    return (meta.join(counts, "check_name", "left")
            .withColumn("failures", F.coalesce("failures", F.lit(0).cast("long"))))


def _repeated_counts(checks: list[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """Number of repeated values of every unique check that has any, in one
    aggregate: each table's columns are stacked into (check, value) rows. Whole
    values are compared; hex digits of key hashes are shuffled as bytes."""
    in_bytes, as_text = fn.short_hex("value")
    values = _stacked_values(checks, tables).select("check_no", in_bytes.alias("in_bytes"), as_text.alias("as_text"))
    repeated = values.groupBy("check_no", "in_bytes", "as_text").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    names = F.array(*[F.lit(c.name) for c in checks])
    return (repeated.groupBy("check_no").agg(F.count(F.lit(1)).alias("failures"))
            .select(names[F.col("check_no")].alias("check_name"), "failures"))


def repeated_values(checks: list[Check], tables: dict[str, DataFrame]) -> dict[str, int]:
    """Number of repeated values of unique checks by name, for ``known`` of ``run_checks``.

    Equal values have equal hashes, so values are told apart only in checks where
    hashes meet: one aggregate over all checks moves a number and 8 bytes a row
    in place of the values. The hashes that meet are stored."""
    spark = tables[checks[0].table].sparkSession
    met = (_stacked_values(checks, tables).groupBy("check_no", F.xxhash64("value").alias("_hash"))
           .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("check_no", "_hash"))
    path = scratch_path(spark, "met-hashes")
    met.write.parquet(path)
    met = spark.read.schema(met.schema).parquet(path)
    unsure = {r.check_no for r in met.select("check_no").distinct().collect()}
    found = {c.name: 0 for c in checks}
    if unsure:
        values = _stacked_values(checks, tables, unsure).withColumn("_hash", F.xxhash64("value"))
        repeated = (values.join(met, ["check_no", "_hash"], "left_semi").groupBy("check_no", "value")
                    .agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        found |= {checks[r.check_no].name: r["count"] for r in repeated.groupBy("check_no").count().collect()}
    return found


def _stacked_values(checks: list[Check], tables: dict[str, DataFrame], only: set[int] | None = None) -> DataFrame:
    """The columns of unique checks (those numbered ``only``) as (check_no, value)
    rows, each table read once."""
    by_table: dict[str, list[tuple[int, Check]]] = {}
    for i, c in enumerate(checks):
        if only is None or i in only:
            by_table.setdefault(c.table, []).append((i, c))
    stacked = []
    for table, group in by_table.items():
        pairs = ", ".join(f"{i}, cast({c.column} as string)" for i, c in group)
        stacked.append(tables[table].select(F.expr(f"stack({len(group)}, {pairs}) as (check_no, value)")))
    return union_failures(*stacked).where(F.col("value").isNotNull())


# Failing-row conditions of Q7 and Q8, for fusing into the fact's aggregate.
POSITIVE_AMOUNTS_FAIL = " OR ".join(f"{c} {op} {v}" for c, op, v in _AMOUNT_RULES)
INVALID_STATUS_FAIL = ("order_status IS NULL OR order_status NOT IN ("
                       + ", ".join(f"'{v}'" for v in fn.VALID_ORDER_STATUSES) + ")")


FACT_ROW_CHECKS = [
    Check("fact_orders", "", "row_condition", POSITIVE_AMOUNTS_FAIL, label="positive_order_amounts"),
    Check("fact_orders", "", "row_condition", INVALID_STATUS_FAIL, label="valid_order_status"),
]


def mart_checks(fact: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
                dim_date: DataFrame, written: bool = False) -> tuple[list[Check], dict[str, DataFrame], dict[str, DataFrame]]:
    """The hand-written checks on the marts (Q7-Q10) for the suite report.

    Returns (row checks, singular, failing rows): Q7 and Q8 are row
    conditions on the fact, so ``run_checks`` counts them in the same
    aggregate as the fact's other row-local checks; Q9 and Q10 are
    failing-row sets counted on their own. ``failing rows`` maps every check
    to the operator's own output (with its reason column) for storing.
    """
    row_checks = FACT_ROW_CHECKS
    singular = {
        "scd2_no_gaps": scd2_gaps(dim_customer, "inclusive"),
        "fact_dimension_keys": orphan_fks(fact, dim_customer, dim_product, dim_date, written=written),
    }
    failing = {"positive_order_amounts": positive_amounts(fact),
               "valid_order_status": valid_order_status(fact), **singular}
    return row_checks, singular, failing


def run_checks(tables: dict[str, DataFrame], checks: list[Check],
               singular: dict[str, DataFrame] | None = None,
               singular_severity: str = "warn", known: dict[str, int] | None = None) -> DataFrame:
    """Q12: one row per check: failures (failing rows; for unique, repeated
    values) and status pass / warn / error.

    Row-local checks of a table are fused into one ``count_if`` aggregate, so
    each table is scanned once for all of them; the per-check counts are
    then unpivoted to rows. All unique checks share one stacked aggregate;
    relationship checks run as their own anti join. ``singular`` adds hand-written checks given as
    failing-row DataFrames (kind 'singular', table 'marts'). All parts are
    unioned into one small DataFrame.

    ``known`` holds the failures of checks that were counted while their table
    was written (``observed``) or are kept with it (``check_state``): no table is
    read for them.
    """
    spark = next(iter(tables.values())).sparkSession
    all_checks, known = checks, known or {}
    singular = {n: d for n, d in (singular or {}).items()}
    checks = [c for c in checks if c.name not in known]
    counts: list[DataFrame] = [
        failing.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")
        for name, failing in singular.items() if name not in known]
    if known:
        counts.append(spark.createDataFrame(list(known.items()), "check_name string, failures long"))
    by_table: dict[str, list[Check]] = {}
    uniques = [c for c in checks if c.kind == "unique"]
    if uniques:
        counts.append(_repeated_counts(uniques, tables))
    for c in checks:
        if c.kind in ROW_LOCAL:
            by_table.setdefault(c.table, []).append(c)
        elif c.kind != "unique":
            counts.append(check_failures(c, tables).agg(F.count(F.lit(1)).alias("failures"))
                          .select(F.lit(c.name).alias("check_name"), "failures"))
    for table, group in by_table.items():
        aggs = [F.count_if(row_failure(c)).alias(f"c{i}") for i, c in enumerate(group)]
        wide = tables[table].agg(*aggs)
        stack = F.expr("stack({}, {}) as (check_name, failures)".format(
            len(group), ", ".join(f"'{c.name}', c{i}" for i, c in enumerate(group))))
        counts.append(wide.select(stack))
    if not counts:
        counts = [spark.createDataFrame([], "check_name string, failures long")]
    rows = _report_rows(spark, all_checks, union_failures(*counts), singular, singular_severity)
    status = F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity"))
    return rows.select("check_name", "table_name", "column_name", "kind", "detail",
                       "severity", F.col("failures").cast("long").alias("failures"),
                       status.alias("status"))


_SEG = fn.MARKET_SEGMENTS


def _nn(table, *cols):
    return [Check(table, c, "not_null") for c in cols]


def _u(table, *cols, severity="warn"):
    return [Check(table, c, "unique", severity=severity) for c in cols]


def _av(table, col, values):
    return [Check(table, col, "accepted_values", list(values))]


def _ex(table, col, expression):
    return [Check(table, col, "expression_is_true", expression)]


DECLARED_CHECKS: list[Check] = [
    # sources
    *_nn("orders", "o_orderkey"), *_u("orders", "o_orderkey"),
    *_nn("orders", "o_custkey"),
    *_nn("orders", "o_totalprice"), *_ex("orders", "o_totalprice", ">= 0"),
    *_nn("orders", "o_orderdate"),
    *_nn("orders", "o_orderstatus"), *_av("orders", "o_orderstatus", fn.VALID_ORDER_STATUSES),
    *_nn("customer", "c_custkey"), *_u("customer", "c_custkey"),
    *_av("customer", "c_mktsegment", _SEG),
    *_nn("part", "p_partkey"), *_u("part", "p_partkey"),
    *_nn("part", "p_retailprice"), *_ex("part", "p_retailprice", "> 0"),
    *_ex("partsupp", "ps_availqty", ">= 0"),
    *_nn("supplier", "s_suppkey"), *_u("supplier", "s_suppkey"),
    *_nn("lineitem", "l_orderkey"), *_nn("lineitem", "l_linenumber"),
    *_ex("lineitem", "l_extendedprice", "> 0"),
    *_nn("nation", "n_nationkey"), *_u("nation", "n_nationkey"),
    *_nn("region", "r_regionkey"), *_u("region", "r_regionkey"),
    # stg_orders
    *_nn("stg_orders", "order_key"), *_u("stg_orders", "order_key"),
    *_nn("stg_orders", "customer_key"),
    Check("stg_orders", "customer_key", "relationships", ("stg_customers", "customer_key")),
    *_nn("stg_orders", "order_status"), *_av("stg_orders", "order_status", fn.VALID_ORDER_STATUSES),
    *_nn("stg_orders", "order_status_desc"),
    *_av("stg_orders", "order_status_desc", ["Open", "Fulfilled", "In Progress", "Unknown"]),
    *_nn("stg_orders", "order_total_price"), *_ex("stg_orders", "order_total_price", ">= 0"),
    *_nn("stg_orders", "order_date"), *_nn("stg_orders", "order_priority"),
    *_ex("stg_orders", "order_priority_rank", "between 1 and 99"),
    # stg_customers
    *_nn("stg_customers", "customer_key"), *_u("stg_customers", "customer_key"),
    *_nn("stg_customers", "customer_name"),
    *_nn("stg_customers", "market_segment"), *_av("stg_customers", "market_segment", _SEG),
    *_nn("stg_customers", "nation_name", "region_name", "account_balance"),
    *_nn("stg_customers", "account_tier"), *_av("stg_customers", "account_tier", fn.ACCOUNT_TIERS),
    # stg_products
    *_nn("stg_products", "product_key"), *_u("stg_products", "product_key"),
    *_nn("stg_products", "product_name"),
    *_nn("stg_products", "retail_price"), *_ex("stg_products", "retail_price", "> 0"),
    # int_orders_enriched
    *_nn("int_orders_enriched", "order_line_sk"), *_u("int_orders_enriched", "order_line_sk"),
    *_nn("int_orders_enriched", "order_key", "line_number", "order_date", "customer_key",
         "product_key"),
    *_nn("int_orders_enriched", "net_revenue"), *_ex("int_orders_enriched", "net_revenue", ">= 0"),
    *_nn("int_orders_enriched", "gross_revenue"),
    *_ex("int_orders_enriched", "gross_revenue", ">= net_revenue"),
    *_nn("int_orders_enriched", "discount_amount"),
    *_ex("int_orders_enriched", "discount_amount", ">= 0"),
    *_av("int_orders_enriched", "delivery_status", fn.DELIVERY_STATUSES),
    *_nn("int_orders_enriched", "fiscal_year", "fiscal_quarter"),
    *_av("int_orders_enriched", "market_segment", _SEG),
    # fact_orders
    *_nn("fact_orders", "order_line_sk"),
    *_u("fact_orders", "order_line_sk", severity="error"),
    *_nn("fact_orders", "customer_sk", "product_sk", "order_date_sk", "order_key", "line_number"),
    *_nn("fact_orders", "quantity"), *_ex("fact_orders", "quantity", "> 0"),
    *_nn("fact_orders", "net_revenue"), *_ex("fact_orders", "net_revenue", ">= 0"),
    *_nn("fact_orders", "gross_revenue"), *_ex("fact_orders", "gross_revenue", ">= net_revenue"),
    *_nn("fact_orders", "discount_amount"), *_ex("fact_orders", "discount_amount", ">= 0"),
    *_ex("fact_orders", "discount_rate", "between 0 and 1"),
    *_nn("fact_orders", "delivery_status"), *_av("fact_orders", "delivery_status", fn.DELIVERY_STATUSES),
    *_nn("fact_orders", "is_late_delivery", "is_returned"),
    *_av("fact_orders", "order_status", fn.VALID_ORDER_STATUSES),
    *_nn("fact_orders", "fiscal_year"),
    *_nn("fact_orders", "fiscal_quarter"), *_av("fact_orders", "fiscal_quarter", [1, 2, 3, 4]),
    *_ex("fact_orders", "days_to_ship", ">= 0"),
    *_nn("fact_orders", "_loaded_at"),
    # dim_customer
    *_nn("dim_customer", "customer_sk"), *_u("dim_customer", "customer_sk"),
    *_nn("dim_customer", "customer_key", "customer_name"),
    *_nn("dim_customer", "market_segment"), *_av("dim_customer", "market_segment", _SEG),
    *_nn("dim_customer", "account_tier"), *_av("dim_customer", "account_tier", fn.ACCOUNT_TIERS),
    *_nn("dim_customer", "effective_from", "effective_to", "is_current"),
    *_nn("dim_customer", "_row_hash"), *_u("dim_customer", "_row_hash"),
    # dim_date
    *_nn("dim_date", "date_sk"), *_u("dim_date", "date_sk"),
    *_nn("dim_date", "full_date"), *_u("dim_date", "full_date"),
    *_nn("dim_date", "calendar_year"), *_ex("dim_date", "calendar_year", "between 1992 and 2030"),
    *_nn("dim_date", "calendar_month"), *_ex("dim_date", "calendar_month", "between 1 and 12"),
    *_nn("dim_date", "day_of_week"), *_ex("dim_date", "day_of_week", "between 0 and 6"),
    *_nn("dim_date", "fiscal_year"),
    *_nn("dim_date", "fiscal_quarter"), *_av("dim_date", "fiscal_quarter", [1, 2, 3, 4]),
    *_nn("dim_date", "is_weekend", "is_weekday"),
    # dim_product
    *_nn("dim_product", "product_sk"), *_u("dim_product", "product_sk"),
    *_nn("dim_product", "product_key"), *_u("dim_product", "product_key"),
    *_nn("dim_product", "product_name"),
    *_nn("dim_product", "retail_price"), *_ex("dim_product", "retail_price", "> 0"),
]


# Money and rates are computed as two-decimal numbers; a source value with more
# would be rounded silently, so the staging gate rejects it.
_MONEY_COLUMNS = [("orders", "o_totalprice"), ("customer", "c_acctbal"), ("part", "p_retailprice"),
                  ("partsupp", "ps_supplycost"), ("lineitem", "l_extendedprice"), ("lineitem", "l_quantity"),
                  ("lineitem", "l_discount"), ("lineitem", "l_tax")]
SOURCE_GUARDS: list[Check] = [
    Check(t, c, "row_condition", f"abs(cast({c} as double) - round(cast({c} as double), 2)) > 0.000001",
          severity="error", label=f"two_decimals__{t}__{c}") for t, c in _MONEY_COLUMNS]


def checks_of(kind: str) -> list[Check]:
    return [c for c in DECLARED_CHECKS if c.kind == kind]
