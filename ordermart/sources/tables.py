"""Source tables (A1) and the source adapter for columns the driver data lacks.

``read_source`` is a plain parquet scan: column pruning and filter pushdown
happen in Catalyst, so callers select only what they use.

The adapter functions add a column **only when the real column is absent**,
so genuine TPC-H input passes through unchanged (line numbers too, unless a
caller asks for new ones). All derived values are
integer arithmetic on existing keys: deterministic, no randomness, and
identical when recomputed after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..functions.core import MONEY
from ..session import path_exists

TPCH_TABLES = ["region", "nation", "customer", "supplier", "part", "partsupp",
               "orders", "lineitem"]

# ---------------------------------------------------------------------------
# Fixed values of the source adapter (FIXTURES §3). Lists are indexed by the
# stated key arithmetic, in this order.
# ---------------------------------------------------------------------------
SHIP_MODES = ["AIR", "FOB", "MAIL", "RAIL", "REG AIR", "SHIP", "TRUCK"]
SHIP_INSTRUCTIONS = ["COLLECT COD", "DELIVER IN PERSON", "NONE", "TAKE BACK RETURN"]
PART_FINISHES = ["ANODIZED", "BRUSHED", "BURNISHED", "PLATED", "POLISHED"]
PART_MATERIALS = ["BRASS", "COPPER", "NICKEL", "STEEL", "TIN"]
CONTAINER_SIZES = ["JUMBO", "LG", "MED", "SM", "WRAP"]
CONTAINER_TYPES = ["BAG", "BOX", "CAN", "CASE", "DRUM", "JAR", "PACK", "PKG"]
HISTORY_STARTS = ["1992-01-01", "1996-06-15", "1998-03-01"]
HISTORY_BALANCE_STEP = 2500


def source_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one named source table (A1)."""
    return spark.read.parquet(source_path(sf_dir, name))


def try_read_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame | None:
    """The table if the source has it, else None."""
    if not path_exists(spark, source_path(sf_dir, name)):
        return None
    try:
        return read_source(spark, sf_dir, name)
    except AnalysisException:
        return None


def _pick(values: list[str], index) -> F.Column:
    """values[index] for a 0-based integer column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _null_str() -> F.Column:
    return F.lit(None).cast("string")


# ---------------------------------------------------------------------------
# Per-table readers with the adapter applied.
# ---------------------------------------------------------------------------

def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_order_columns(read_source(spark, sf_dir, "orders"))


def with_order_columns(df: DataFrame) -> DataFrame:
    """Order columns that the source lacks."""
    if "o_clerk" not in df.columns:
        df = df.withColumn("o_clerk", F.concat(
            F.lit("Clerk#"), F.lpad((F.col("o_orderkey") % 1000).cast("string"), 9, "0")))
    if "o_shippriority" not in df.columns:
        df = df.withColumn("o_shippriority", F.lit(0))
    if "o_comment" not in df.columns:
        df = df.withColumn("o_comment", _null_str())
    return df


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_source(spark, sf_dir, "customer")
    for c in ("c_address", "c_phone", "c_comment"):
        if c not in df.columns:
            df = df.withColumn(c, _null_str())
    return df


def nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, sf_dir, "nation")


def region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, sf_dir, "region")


def supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, sf_dir, "supplier")


def part(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_source(spark, sf_dir, "part")
    key = F.col("p_partkey")
    if "p_container" not in df.columns:
        df = df.withColumn("p_container", F.concat_ws(
            " ", _pick(CONTAINER_SIZES, key % 5), _pick(CONTAINER_TYPES, (key * 7 + 2) % 8)))
        # Driver data has a one-word p_type; extend it to the three-word form.
        df = df.withColumn("p_type", F.concat_ws(
            " ", F.col("p_type"), _pick(PART_FINISHES, key % 5),
            _pick(PART_MATERIALS, (key * 3 + 1) % 5)))
    if "p_mfgr" not in df.columns:
        df = df.withColumn("p_mfgr", F.concat(F.lit("Manufacturer#"),
                                              (key % 5 + 1).cast("string")))
    if "p_comment" not in df.columns:
        df = df.withColumn("p_comment", _null_str())
    return df


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


def lineitem(spark: SparkSession, sf_dir: str, renumber_lines: bool | str = False,
             orders: DataFrame | None = None, adapted: bool = True) -> DataFrame:
    """Line items with the adapter columns (not ``adapted``: without them).

    Line numbers are the source's own. The driver data repeats
    (l_orderkey, l_linenumber), which the order-line surrogate key needs
    unique, so its readers opt in to ``renumber_lines``: lines are numbered
    1..n per order in a total order. ``"skew_safe"`` numbers very large orders
    by a distributed sort (``operators.ranking``); True uses a window per order
    key alone, for sources with a bound on them. To number the lines once for
    many queries see ``sources.colocate``.

    ``orders`` (l_orderkey) keeps only the lines of these orders, before
    anything is shuffled or computed.
    """
    df = read_source(spark, sf_dir, "lineitem")
    if orders is not None:
        # Whole orders: their lines get the same numbers as in the full table.
        df = df.join(orders, "l_orderkey", "left_semi")
    if renumber_lines == "skew_safe":
        from ..operators.ranking import row_number_within
        df = (row_number_within(df, "l_orderkey", LINE_ORDER, out="_line")
              .withColumn("l_linenumber", F.col("_line")).drop("_line"))
    elif renumber_lines:
        w = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
        df = df.withColumn("l_linenumber", F.row_number().over(w).cast("int"))
    return with_line_columns(df) if adapted else df


def with_line_columns(df: DataFrame) -> DataFrame:
    """Line-item columns that the source lacks."""
    line = F.col("l_linenumber").cast("long")
    okey = F.col("l_orderkey")
    ship = F.to_date("l_shipdate")
    if "l_commitdate" not in df.columns:
        df = df.withColumn("l_commitdate", F.date_add(ship, ((okey * 7 + line * 13) % 61 - 30).cast("int")))
    if "l_receiptdate" not in df.columns:
        df = df.withColumn("l_receiptdate", F.date_add(ship, (1 + (okey * 3 + line * 5) % 30).cast("int")))
    if "l_shipmode" not in df.columns:
        df = df.withColumn("l_shipmode", _pick(SHIP_MODES, (okey + line) % 7))
    if "l_shipinstruct" not in df.columns:
        df = df.withColumn("l_shipinstruct", _pick(SHIP_INSTRUCTIONS, (F.col("l_partkey") + line) % 4))
    if "l_comment" not in df.columns:
        df = df.withColumn("l_comment", _null_str())
    return df


def partsupp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partsupp table, or a derived one when the source has none.

    Derived rows: the distinct (part, supplier) pairs that line items use.
    Distinct is a partial aggregate (map-side combine), so a hot part does not
    land whole in one task.
    """
    real = try_read_source(spark, sf_dir, "partsupp")
    if real is not None:
        return real
    pairs = (read_source(spark, sf_dir, "lineitem")
             .select(F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey"))
             .distinct())
    prices = read_source(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ps_partkey"), F.col("p_retailprice").cast(MONEY).alias("price"))
    pk, sk = F.col("ps_partkey"), F.col("ps_suppkey")
    factor = (500 + (pk * 31 + sk * 17) % 400).cast("decimal(10,0)")
    return (pairs.join(prices, "ps_partkey", "inner")
            .select(
                pk, sk,
                ((pk * 7 + sk * 11) % 10000).cast("int").alias("ps_availqty"),
                (F.col("price") * factor * F.lit(0.001).cast("decimal(4,3)"))
                .cast(MONEY).alias("ps_supplycost"),
                _null_str().alias("ps_comment")))


def customer_history(spark: SparkSession, sf_dir: str, with_upgrades: bool = True) -> DataFrame:
    """A customer change-history table shaped like a timestamp-strategy snapshot.

    The driver data has no history, so it is derived from the customer table:
    customer k has 1 + (k mod 3) versions starting on the fixed dates above;
    version v of n has balance current + (n - v) * 2500, so tiers move down
    over time. With ``with_upgrades`` the step is negative for odd keys, so
    those customers move up. The last version is open (valid_to NULL).
    Output columns: the snapshot's source names plus scd_id, updated_at,
    valid_to.
    """
    from ..functions.core import row_hash  # local import: avoids a cycle

    cust = customer(spark, sf_dir)
    nat = nation(spark, sf_dir)
    reg = region(spark, sf_dir)
    base = (cust.join(nat, cust.c_nationkey == nat.n_nationkey, "left")
            .join(reg, nat.n_regionkey == reg.r_regionkey, "left")
            .select("c_custkey", "c_name", "c_address", "c_phone", "c_mktsegment",
                    "c_comment", "n_name", "r_name",
                    F.col("c_acctbal").cast(MONEY).alias("c_acctbal")))
    n = (F.col("c_custkey") % 3 + 1).cast("int")
    starts = F.array(*[F.lit(s).cast("timestamp") for s in HISTORY_STARTS])
    step = F.lit(HISTORY_BALANCE_STEP)
    if with_upgrades:
        step = F.when(F.col("c_custkey") % 2 == 1, -HISTORY_BALANCE_STEP).otherwise(HISTORY_BALANCE_STEP)
    versions = base.select("*", n.alias("n_versions"), step.alias("step"),
                           F.posexplode(F.slice(starts, 1, n)).alias("pos", "updated_at"))
    v = F.col("pos") + 1
    bal = (F.col("c_acctbal") + (F.col("n_versions") - v) * F.col("step")).cast(MONEY)
    next_start = F.when(v < F.col("n_versions"), F.element_at(starts, (v + 1).cast("int")))
    return versions.select(
        "c_custkey", "c_name", "c_address", "c_phone", "c_mktsegment", "c_comment",
        "n_name", "r_name", bal.alias("c_acctbal"),
        row_hash("c_custkey", "c_name", "c_mktsegment", "n_name", bal).alias("scd_id"),
        "updated_at", next_start.alias("valid_to"))
