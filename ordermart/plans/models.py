"""All models of one build as lazy DataFrames.

``Models`` wires sources -> staging -> order lines -> dimensions -> fact.
Each property is a logical plan built once per object; nothing runs until a
caller acts on it. Audit timestamps and the run date are parameters, so a
build is repeatable.
"""

from __future__ import annotations

from collections import Counter
from functools import cached_property, reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dimensions, enrich, facts, load, quality, scd2, staging
from ..session import (STORED_CODEC, delete_path, drop_unused_shuffles, in_slices, path_exists, scratch_path,
                       slice_count, source_state)
from ..sources import colocate, tables as src

# Run date used wherever the reference uses the current date (driver data
# ends on 2001-08-01), and the audit timestamp of a build.
DEFAULT_AS_OF = "2001-08-01"
DEFAULT_LOADED_AT = "2001-08-01 04:00:00"


class Models:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF,
                 loaded_at: str | None = DEFAULT_LOADED_AT, renumber_lines: bool | str = False,
                 use_history: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.loaded_at = loaded_at
        self.renumber_lines = renumber_lines
        self.use_history = use_history
        self._scratch: list[str] = []

    def over_same_sources(self) -> "Models":
        """Models of their own over the source tables of this object."""
        new = Models(self.spark, self.sf_dir, self.as_of, self.loaded_at, self.renumber_lines, self.use_history)
        for name in ("layout", "orders_src", "stored_orders_src", "customer_src", "nation_src", "region_src", "part_src", "partsupp_src",
                     "supplier_src", "lineitem_src", "history_snapshot"):
            setattr(new, name, getattr(self, name))
        return new

    # sources -----------------------------------------------------------
    @cached_property
    def layout(self) -> colocate.OrderLines | None:
        """Orders and numbered lines stored by order key, with
        ``renumber_lines="stored"``."""
        if self.renumber_lines != "stored":
            return None
        return colocate.order_lines(self.spark, self.sf_dir, renumber=True)

    @cached_property
    def orders_src(self) -> DataFrame:
        return src.orders(self.spark, self.sf_dir)

    @cached_property
    def stored_orders_src(self) -> DataFrame:
        """Orders where their lines are joined; without lines the source itself
        is read, and no layout made for it."""
        return self.layout.orders if self.layout else self.orders_src

    @cached_property
    def customer_src(self) -> DataFrame:
        return src.customer(self.spark, self.sf_dir)

    @cached_property
    def nation_src(self) -> DataFrame:
        return src.nation(self.spark, self.sf_dir)

    @cached_property
    def region_src(self) -> DataFrame:
        return src.region(self.spark, self.sf_dir)

    @cached_property
    def part_src(self) -> DataFrame:
        return src.part(self.spark, self.sf_dir)

    @cached_property
    def partsupp_src(self) -> DataFrame:
        if self.layout and self.layout.partsupp is not None:
            return self.layout.partsupp
        return src.partsupp(self.spark, self.sf_dir)

    @cached_property
    def supplier_src(self) -> DataFrame:
        return src.supplier(self.spark, self.sf_dir)

    @cached_property
    def lineitem_src(self) -> DataFrame:
        return self.layout.all_lines if self.layout else src.with_line_columns(self.numbered_lines_src)

    @cached_property
    def numbered_lines_src(self) -> DataFrame:
        """Lines without the adapter's columns, for a build without a layout."""
        return src.lineitem(self.spark, self.sf_dir, renumber_lines=self.renumber_lines, adapted=False)

    @cached_property
    def history_snapshot(self) -> DataFrame:
        """The source's stored change history if it has one (A6), else one
        derived from the customer table."""
        stored = src.try_read_source(self.spark, self.sf_dir, "customer_history")
        return stored if stored is not None else src.customer_history(self.spark, self.sf_dir)

    # staging -----------------------------------------------------------
    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.orders_src, self.loaded_at)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.customer_src, self.nation_src, self.region_src,
                                     self.loaded_at)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.part_src, self.partsupp_src, self.loaded_at)

    @cached_property
    def lines(self) -> DataFrame:
        return enrich.line_items(self.lineitem_src)

    @cached_property
    def line_parts(self) -> tuple[DataFrame, DataFrame | None]:
        """Lines to join with orders: those stored like them, and those of very
        large orders (None: there are none)."""
        if self.layout is None:
            return enrich.source_lines(self.numbered_lines_src), None
        hot = self.layout.stored_hot_lines
        return enrich.source_lines(self.layout.stored_lines), None if hot is None else enrich.source_lines(hot)

    @cached_property
    def line_orders(self) -> DataFrame:
        """The staged orders to join with lines."""
        return staging.stg_orders(self.stored_orders_src, self.loaded_at) if self.layout else self.stg_orders

    def order_lines(self, customer_keys: DataFrame | None = None) -> DataFrame:
        """The order-line model with a customer key looked up at order grain."""
        lines, hot = self.line_parts
        return enrich.orders_enriched(self.line_orders, self.stg_customers, self.stg_products, lines,
                                      customer_keys, hot_lines=hot)

    # order lines -------------------------------------------------------
    @cached_property
    def enriched(self) -> DataFrame:
        """int_orders_enriched exactly (51 columns)."""
        return self.order_lines()

    @cached_property
    def enriched_with_sk(self) -> DataFrame:
        """The order-line model with the current customer_sk resolved at order grain."""
        return enrich.line_columns(self.joined_lines, ["customer_sk"])

    @cached_property
    def joined_lines(self) -> DataFrame:
        """What ``enriched_with_sk`` is computed from, row by row."""
        lines, hot = self.line_parts
        headers = enrich.order_headers(self.line_orders, self.stg_customers, self.customer_keys)
        return enrich.join_order_lines(lines, headers, self.stg_products, hot)

    # dimensions --------------------------------------------------------
    @cached_property
    def customer_history(self) -> DataFrame:
        snapshot = self.history_snapshot if self.use_history else None
        return scd2.customer_history(self.stg_customers, snapshot)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return scd2.dim_customer(self.customer_history, self.loaded_at)

    @cached_property
    def customer_keys(self) -> DataFrame:
        return facts.current_customer_keys(self.dim_customer)

    @cached_property
    def dim_customer_single(self) -> DataFrame:
        return scd2.dim_customer(scd2.customer_history(self.stg_customers, None), self.loaded_at)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dimensions.dim_product(self.stg_products, self.loaded_at)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.spark, self.as_of)

    # fact --------------------------------------------------------------
    @cached_property
    def fact(self) -> DataFrame:
        return facts.fact_orders(self.enriched_with_sk, self.loaded_at)

    @cached_property
    def slices(self) -> int:
        """Slices in which the lines of the source are shuffled."""
        paths = [src.source_path(self.sf_dir, t) for t in ("orders", "lineitem")]
        return slice_count(source_state(self.spark, [p for p in paths if path_exists(self.spark, p)])[1])

    def _lines_with_month(self, until, date) -> DataFrame:
        joined = self.joined_lines
        if until is not None:
            joined = joined.where(F.col("order_date") <= F.lit(until))
        return load.with_order_month(joined, date)

    def fact_by_month(self, until=None, date="order_date", months: list | None = None) -> DataFrame:
        """The fact for ``load.write_fact(..., dealt=True)``, with its month:
        joined lines (of orders up to a date) are dealt by month and sorted
        before the fact's columns, key hashes among them, are computed. ``date``
        is what the month is taken from; ``months`` are those wanted (None: all)."""
        month, joined = load.PARTITION_COL, self._lines_with_month(until, date)
        if months is not None:
            joined = joined.where(load.is_one_of(month, months))
        lines = enrich.line_columns(load.clustered(joined), ["customer_sk", month])
        return facts.fact_orders(lines, self.loaded_at, kept=(month,))

    def fact_in_slices(self, until=None, date="order_date") -> list[DataFrame]:
        """``fact_by_month`` in slices of whole months with about as many lines each,
        for joined lines that are stored (each slice reads them)."""
        if self.slices == 1:
            return [self.fact_by_month(until, date)]
        found = self._lines_with_month(until, date).groupBy(load.PARTITION_COL).count().collect()
        lines = {r[0]: r[1] for r in sorted(found, key=lambda r: (r[0] is None, r[0]))}
        slices = in_slices(lines, self.slices) or [[]]
        return [self.fact_by_month(until, date, months) for months in slices]

    def window_lines(self, start, customer_keys: DataFrame | None = None,
                     products: DataFrame | None = None) -> DataFrame:
        """The order lines (with customer_sk) of ``window_joined``."""
        return enrich.line_columns(self.window_joined(start, customer_keys, products), ["customer_sk"])

    def window_joined(self, start, customer_keys: DataFrame | None = None,
                      products: DataFrame | None = None) -> DataFrame:
        """The joined lines (with customer_sk) of orders from ``start`` on (None:
        all), at the cost of that window: its orders are stored first, so the
        planner knows how few they are, and the line items are cut to them by a
        semi join before any shuffle or computation. ``customer_keys`` and
        ``products`` may come from written dimensions."""
        keys = customer_keys if customer_keys is not None else facts.current_customer_keys(self.dim_customer)
        products = products if products is not None else self.stg_products
        orders, (lines, hot) = self.line_orders, self.line_parts
        if start is not None:
            path = self._scratch_path("window-orders")
            window = self.stg_orders.where(F.col("order_date") >= F.lit(start))
            window.write.option("compression", STORED_CODEC).parquet(path)
            orders = self.spark.read.schema(window.schema).parquet(path)
            wanted = orders.select(F.col("order_key").alias("l_orderkey"))
            if self.layout:
                lines, hot = enrich.source_lines(self.lineitem_src.join(wanted, "l_orderkey", "left_semi")), None
            else:
                lines, hot = enrich.source_lines(src.lineitem(
                    self.spark, self.sf_dir, renumber_lines=self.renumber_lines, orders=wanted, adapted=False)), None
        return enrich.join_order_lines(lines, enrich.order_headers(orders, self.stg_customers, keys), products, hot)

    def fact_since(self, start, customer_keys: DataFrame | None = None,
                   products: DataFrame | None = None) -> DataFrame:
        """The fact rows of ``window_lines``."""
        return facts.fact_orders(self.window_lines(start, customer_keys, products), self.loaded_at)

    def _scratch_path(self, name: str) -> str:
        self._scratch.append(scratch_path(self.spark, name))
        return self._scratch[-1]

    def release(self) -> None:
        """Delete what this object has stored; its models cannot be read after."""
        while self._scratch:
            delete_path(self.spark, self._scratch.pop())

    def store(self, name: str, checks: list[quality.Check] | None = None) -> dict[str, int]:
        """Compute one model once, in the shared scratch folder; models built on
        it from now on read it there. Row-local ``checks`` are counted by the way."""
        path = self._scratch_path(name)
        rows = getattr(self, name)
        counting, counted = quality.observed(rows, checks or [])
        counting.write.option("compression", STORED_CODEC).parquet(path)
        setattr(self, name, self.spark.read.schema(rows.schema).parquet(path))
        return counted()

    def stored_order_lines(self, checks: list[quality.Check] | None = None, slices: int | None = None) -> dict[str, int]:
        """Join the order lines once; the fact and the checks of this object then
        read them. What is stored are the joined lines, from which the record's
        other columns are computed again at less than the cost of reading them;
        ``checks`` are counted on the whole record. Orders are joined in ``slices``
        by their keys' hash, so that the disks hold the shuffles of one slice; what
        all slices join with the orders is stored first."""
        n = slices or self.slices
        if n > 1 and "joined_lines" not in self.__dict__:
            for name in ("stg_products", "customer_keys"):
                self.store(name)
            drop_unused_shuffles(self.spark)
        path, joined, failed = self._scratch_path("joined-lines"), self.joined_lines, Counter()
        as_joined = {c: f"_joined_{c}" for c in joined.columns}
        for i in range(n):
            # The planner moves the condition below the joins and the numbering.
            some = joined if n == 1 else joined.where(F.pmod(F.xxhash64("order_key"), F.lit(n)) == i)
            both = some.select("*", *[F.col(c).alias(j) for c, j in as_joined.items()])
            counting, counted = quality.observed(enrich.line_columns(both, ["customer_sk", *as_joined.values()]), checks or [])
            (counting.select(*[F.col(j).alias(c) for c, j in as_joined.items()])
             .write.mode("append").option("compression", STORED_CODEC).parquet(path))
            drop_unused_shuffles(self.spark)
            failed.update(counted())
        self.joined_lines = self.spark.read.schema(joined.schema).parquet(path)
        self.enriched_with_sk = enrich.line_columns(self.joined_lines, ["customer_sk"])
        self.enriched = self.enriched_with_sk.drop("customer_sk")
        return dict(failed)

    def line_failures(self, checks: list[quality.Check]) -> dict[str, int]:
        """Failures of row-local ``checks`` of the order lines and of the fact, both
        counted in one pass over the joined lines. Nothing is stored, and of a line
        only the columns that the checks name are shuffled."""
        names, rows, failures = self.failing_lines(checks)
        return dict(zip(names, rows.agg(*map(F.count_if, failures)).first()))

    def failing_lines(self, checks: list[quality.Check]) -> tuple[list[str], DataFrame, list[Column]]:
        """Names of ``checks``, the fact's rows that fail any, and the failures among
        their columns. Lines that pass go as soon as the columns are known: where no
        check names a product's column, before lines are shuffled to the products."""
        on_lines = [c for c in checks if c.table == "int_orders_enriched"]
        on_fact = [c for c in checks if c.table == "fact_orders"]
        failed = {f"_failed_{i}": quality.row_failure(c) for i, c in enumerate(on_lines)}
        rows = facts.fact_orders(self.enriched_with_sk.withColumns(failed), self.loaded_at, kept=tuple(failed))
        failures = [F.col(c) for c in failed] + [quality.row_failure(c) for c in on_fact]
        return [c.name for c in on_lines + on_fact], rows.where(reduce(or_, failures)), failures

    def check_tables(self) -> dict[str, DataFrame]:
        """Every table the declared checks name."""
        return {
            "orders": self.orders_src, "customer": self.customer_src, "part": self.part_src,
            "partsupp": self.partsupp_src, "supplier": self.supplier_src,
            "lineitem": self.lineitem_src, "nation": self.nation_src, "region": self.region_src,
            "stg_orders": self.stg_orders, "stg_customers": self.stg_customers,
            "stg_products": self.stg_products, "int_orders_enriched": self.enriched,
            "fact_orders": self.fact, "dim_customer": self.dim_customer,
            "dim_date": self.dim_date, "dim_product": self.dim_product,
        }
