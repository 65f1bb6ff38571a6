"""Benchmark of the headline queries.

Runs each headline query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] (default 8): $BENCH_WARMUPS (default 2) warm-up runs,
then the median of $BENCH_REPEATS (default 3) timed runs, per query. Every result is consumed in full
through the no-op sink (all rows computed, nothing collected). Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from ordermart.plans.catalog import QUERIES  # noqa: E402
from ordermart.plans.models import Models  # noqa: E402
from ordermart.operators import aggregates, facts, kpi, load  # noqa: E402
from ordermart.sources import colocate  # noqa: E402
from ordermart.session import get_session, scratch_path  # noqa: E402

# Registered queries run end to end from the source tables.
HEADLINE = [
    "order_lines_enriched", "fact_orders", "dim_customer_scd2", "dq_report",
    "kpi_overview", "revenue_by_month", "revenue_by_segment", "tier_revenue_by_quarter",
    "segment_box_plot", "top_customers", "shipping_kpis", "fact_customer_as_of",
]

# Dashboard measures over the materialized marts (how the dashboards read
# them), prefixed "mart_" in the output.
MART_MEASURES = {
    "kpi_overview": lambda f, dc: kpi.overview(f),
    "revenue_by_month": lambda f, dc: kpi.revenue_by_month(f),
    "revenue_yoy": lambda f, dc: kpi.revenue_yoy(f),
    "revenue_mtd": lambda f, dc: kpi.revenue_to_date(f, "month"),
    "revenue_by_region": lambda f, dc: kpi.revenue_share(f, "region_name"),
    "shipping_kpis": lambda f, dc: kpi.shipping_kpis(f),
    "late_by_material": lambda f, dc: kpi.late_by(f),
    "tier_revenue_by_quarter": lambda f, dc: kpi.tier_revenue_by_quarter(f, dc),
    "segment_box_plot": lambda f, dc: kpi.segment_box_plot(f, dc),
    "top_customers": lambda f, dc: kpi.top_customers(f, dc),
    "tier_migration": lambda f, dc: kpi.tier_migration(dc),
}


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


# The aggregate that a measure reads where one is kept.
KEPT = {"kpi_overview": "daily", "revenue_by_month": "daily", "revenue_yoy": "daily", "revenue_mtd": "daily",
        "revenue_by_region": "daily", "shipping_kpis": "daily", "late_by_material": "by_mode_and_material",
        "tier_revenue_by_quarter": "customer", "segment_box_plot": "customer", "top_customers": "customer"}


def build_marts(spark, sf_dir) -> tuple[str, str]:
    """The daily build: customer dimension and the fact table written to
    parquet (fact partitioned by month and clustered)."""
    m = Models(spark, sf_dir, renumber_lines="stored")
    dc_path, fact_path = scratch_path(spark, "bench-dim-customer"), scratch_path(spark, "bench-fact")
    load.write_table(m.dim_customer, dc_path)
    load.write_fact(m.fact, fact_path)
    return dc_path, fact_path


def incremental_load(spark, sf_dir, fact_path, dc_path) -> None:
    """The daily run against the written fact: look-back window (3 days
    before the newest fact date) re-derived from the sources, then the keyed
    upsert. Idempotent, so it can be repeated on the same target."""
    m = Models(spark, sf_dir, renumber_lines="stored")
    dc = load.read_target(spark, dc_path)
    rows = m.fact_since(load.stored_lookback_start(spark, fact_path, 3), facts.current_customer_keys(dc))
    load.upsert(spark, rows, fact_path)


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    warmups = int(os.environ.get("BENCH_WARMUPS", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session(f"local[{cpus}]", cpus, app_name="ordermart-bench",
                        extra={"spark.driver.memory": "16g"})
    jobs = {"build_marts_write": lambda: build_marts(spark, sf_dir)}
    jobs.update({name: (lambda n=name: consume(QUERIES[n](spark, sf_dir))) for name in HEADLINE})
    dc_path, fact_path = build_marts(spark, sf_dir)
    fact = load.read_target(spark, fact_path)
    dim_c = load.read_target(spark, dc_path)
    for name, f in MART_MEASURES.items():
        jobs[f"mart_{name}"] = (lambda f=f: consume(f(fact, dim_c)))
    # The same measures over the aggregates that the daily load keeps.
    kept_path = scratch_path(spark, "bench-aggregates")
    aggregates.refresh(spark, fact_path, kept_path)
    for name, shape in KEPT.items():
        kept = aggregates.read(spark, kept_path, shape)
        jobs[f"kept_{name}"] = (lambda f=MART_MEASURES[name], kept=kept: consume(f(kept, dim_c)))
    # What the layout costs that all other jobs read: made once a source.
    jobs["order_lines_layout"] = lambda: colocate.order_lines(spark, sf_dir, True, root=scratch_path(spark, "layout"))
    # The incremental load rewrites fact files, so it runs after every job
    # that reads the fact above.
    last = {"mart_incremental_load": lambda: incremental_load(spark, sf_dir, fact_path, dc_path)}
    if only:
        jobs = {k: v for k, v in jobs.items() if k in only}
        last = {k: v for k, v in last.items() if k in only}
    # Each job: warm-up runs right before its timed runs (the JVM compiles
    # the generated code over the first two executions of a plan).
    results = {}
    for name, job in {**jobs, **last}.items():
        for _ in range(warmups):
            job()
        results[name] = round(statistics.median(timed(job) for _ in range(repeats)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total_median_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else sf_dir,
        "master": f"local[{cpus}]",
        "spark": spark.version,
        "repeats": repeats,
        "warmups": warmups,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
