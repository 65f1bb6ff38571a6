"""Skew-safe row numbers equal the window's, with and without a hot key."""

from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermart.operators.ranking import row_number_by_sort
from ordermart.sources import tables as src
from tests.conftest import SF_SMALL, rows


def window_numbers(df, key, order):
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(*order)))


def test_hot_key_matches_window(spark):
    rnd = random.Random(7)
    data = [(1, rnd.randint(0, 10**6), i) for i in range(4000)]            # one hot key
    data += [(k, rnd.randint(0, 10**6), i) for k in range(2, 200) for i in range(rnd.randint(1, 5))]
    df = spark.createDataFrame(data, "k long, a long, b long").repartition(5)
    got = row_number_by_sort(df, "k", ["a", "b"], out="rn", partitions=9)
    assert rows(got, "k", "a", "b", "rn") == rows(window_numbers(df, "k", ["a", "b"]), "k", "a", "b", "rn")
    hot = got.where("k = 1").select("rn").distinct().count()
    assert hot == 4000


def test_skew_safe_line_renumbering_equals_window(spark):
    window = src.lineitem(spark, SF_SMALL, renumber_lines=True)
    skew = src.lineitem(spark, SF_SMALL, renumber_lines="skew_safe")
    cols = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_commitdate",
            "l_shipmode")
    assert rows(skew, *cols) == rows(window, *cols)


def test_fact_with_skew_safe_renumbering(spark):
    from ordermart.plans.models import Models
    a = Models(spark, SF_SMALL, renumber_lines=True).fact
    b = Models(spark, SF_SMALL, renumber_lines="skew_safe").fact
    cols = ("order_line_sk", "customer_sk", "product_sk", "net_revenue", "ship_mode")
    assert rows(a, *cols) == rows(b, *cols)
