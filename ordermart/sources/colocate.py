"""Orders and line items stored by order key, once for all queries on a source.

The line-level join of the marts is lines x orders on the order key. Stored as
bucketed tables with equal bucket counts, both sides are read bucket by bucket
and joined without moving a line. Where line numbers have to be made, they are
made while the lines are dealt to the buckets anyway, so the numbering adds a
sort inside a task and no shuffle; queries then read numbered lines.

An order with more than ``HOT_ROWS`` lines would fill one bucket, so such orders
stay apart: their lines are numbered by a distributed sort and stored as a
plain table, which the planner joins as it sees fit. Usually there are none.

A layout belongs to a state of its source (sizes and modification time of the
files). It is kept per session, or under ``root`` for later sessions too; a
changed source gets a new one.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.ranking import HOT_ROWS, hot_keys, row_number_by_sort
from ..session import (STORED_CODEC, delete_path, drop_unused_shuffles, path_exists, scratch_path,
                       source_state)
from . import tables as src

BUCKET_BYTES = 8 << 20        # of source files for each bucket: its rows are sorted in memory
MOST_BUCKETS = 65_536

_KNOWN: dict[tuple, tuple[str, "OrderLines"]] = {}


@dataclass(frozen=True)
class OrderLines:
    """Source tables in the layout, with the adapter's columns."""
    orders: DataFrame
    stored_lines: DataFrame          # bucketed like ``orders``, without the adapter's columns
    stored_hot_lines: DataFrame | None      # lines of very large orders
    partsupp: DataFrame | None       # derived pairs, for sources without the table

    @property
    def lines(self) -> DataFrame:
        return src.with_line_columns(self.stored_lines)

    @property
    def hot_lines(self) -> DataFrame | None:
        return None if self.stored_hot_lines is None else src.with_line_columns(self.stored_hot_lines)

    @property
    def all_lines(self) -> DataFrame:
        return self.lines if self.hot_lines is None else self.lines.unionByName(self.hot_lines)


def bucket_count(spark: SparkSession, source_bytes: int) -> int:
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST_BUCKETS, max(parallel, -(-source_bytes // BUCKET_BYTES)))


def order_lines(spark: SparkSession, sf_dir: str, renumber: bool, root: str | None = None,
                hot_rows: int = HOT_ROWS) -> OrderLines:
    """The layout of a source, made if there is none of its present state.

    ``renumber`` numbers the lines of every order 1..n (see
    ``tables.lineitem``); else the source's numbers stay. ``root`` is a
    folder that outlives the session; without it the scratch folder is used.
    """
    paths = [src.source_path(sf_dir, t) for t in ("orders", "lineitem", "part", "partsupp")]
    state, size = source_state(spark, [p for p in paths if path_exists(spark, p)])
    state = sha256(json.dumps([state, paths, renumber, hot_rows]).encode()).hexdigest()[:16]
    known = _KNOWN.get((spark.sparkContext.applicationId, sf_dir, renumber, root, hot_rows))
    if known is not None and known[0] == state:
        return known[1]
    if root is None:
        folder = scratch_path(spark, "order-lines")
        described = _write(spark, sf_dir, folder, renumber, bucket_count(spark, size), hot_rows)
    else:
        folder = f"{root.rstrip('/')}/{state}"
        if not path_exists(spark, f"{folder}/layout"):
            delete_path(spark, folder)              # of a write that did not end
            described = _write(spark, sf_dir, folder, renumber, bucket_count(spark, size), hot_rows)
            # Written last: a layout without it is not used.
            (spark.createDataFrame([(json.dumps(described),)], "value string").coalesce(1)
             .write.mode("overwrite").text(f"{folder}/layout"))
        else:
            described = json.loads(spark.read.text(f"{folder}/layout", wholetext=True).first()[0])
    found = _read(spark, folder, described, renumber)
    _KNOWN[spark.sparkContext.applicationId, sf_dir, renumber, root, hot_rows] = state, found
    return found


def _write(spark: SparkSession, sf_dir: str, folder: str, renumber: bool, buckets: int, hot_rows: int) -> dict:
    orders = src.read_source(spark, sf_dir, "orders").withColumn("o_orderkey", F.col("o_orderkey").cast("long"))
    lines = src.read_source(spark, sf_dir, "lineitem").withColumn("l_orderkey", F.col("l_orderkey").cast("long"))
    hot = hot_keys(lines, "l_orderkey", hot_rows)
    described = {"buckets": buckets, "orders": orders.schema.json(), "lines": None, "hot": hot is not None}
    if hot is not None:
        same = lines.l_orderkey.eqNullSafe(hot.hot_key)
        large, lines = lines.join(hot, same, "left_semi"), lines.join(hot, same, "left_anti")
        if renumber:
            large = (row_number_by_sort(large, "l_orderkey", src.LINE_ORDER, out="_line")
                     .withColumn("l_linenumber", F.col("_line")).drop("_line"))
        large.write.option("compression", STORED_CODEC).parquet(f"{folder}/hot_lines")
    # The same hash deals rows to tasks and to buckets: a task writes one file.
    lines = lines.repartition(buckets, "l_orderkey")
    if renumber:
        w = Window.partitionBy("l_orderkey").orderBy(*src.LINE_ORDER)
        lines = lines.withColumn("l_linenumber", F.row_number().over(w).cast("int"))
    described["lines"] = lines.schema.json()
    for name, rows, key in (("orders", orders.repartition(buckets, "o_orderkey"), "o_orderkey"),
                            ("lines", lines, "l_orderkey")):
        table = f"ordermart_{name}_{uuid.uuid4().hex[:12]}"
        (rows.write.bucketBy(buckets, key).sortBy(key).option("compression", STORED_CODEC)
         .option("path", f"{folder}/{name}").saveAsTable(table))
        spark.sql(f"DROP TABLE {table}")            # of the catalog only; the files stay
    if src.try_read_source(spark, sf_dir, "partsupp") is None:
        src.partsupp(spark, sf_dir).write.option("compression", STORED_CODEC).parquet(f"{folder}/partsupp")
        described["partsupp"] = True
    drop_unused_shuffles(spark)
    return described


def _bucketed(spark: SparkSession, folder: str, name: str, key: str, schema: str, buckets: int) -> DataFrame:
    """A bucketed table of this session over files that are there."""
    table = f"ordermart_{name}_{sha256(folder.encode()).hexdigest()[:16]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(schema)).fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
              f"INTO {buckets} BUCKETS LOCATION '{folder}/{name}'")
    return spark.table(table)


def _read(spark: SparkSession, folder: str, described: dict, renumber: bool) -> OrderLines:
    n = described["buckets"]
    orders = src.with_order_columns(_bucketed(spark, folder, "orders", "o_orderkey", described["orders"], n))
    lines = _bucketed(spark, folder, "lines", "l_orderkey", described["lines"], n)
    hot = spark.read.parquet(f"{folder}/hot_lines") if described["hot"] else None
    pairs = spark.read.parquet(f"{folder}/partsupp") if described.get("partsupp") else None
    return OrderLines(orders, lines, hot, pairs)
