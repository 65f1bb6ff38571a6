"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

A group (rows with equal texts) must stay together.  In the k-way differencing
method a partial partition is a row of k sums; every group starts as one (its
size and k - 1 zeros).  The two partial partitions of the largest spread are
combined, largest sum with smallest, until one is left.

At scale the method runs over a set of items of fixed size.  With T bytes in
all, every group of at least T / ITEMS is an item of its own (so at most ITEMS
of them); the smaller groups are bundled by hash into ITEMS bundles, each far
smaller than a shard.  Summing and bundling are Spark aggregations over all
groups; one task then differences the at most 2 * ITEMS items, whatever the
corpus, and a join carries each item's shard back to its groups.

Law ``bytes``: shards have nearly equal sums of size.  A group larger than a
shard's fair share cannot be divided and fills a shard of its own.

Rows are numbered within their shard without a gap: the stored rows are dealt
into buckets evenly (rows that repeat, too), numbered within (shard, bucket),
and moved on by the counts of the buckets before; no shard is ever sorted in one
task.  Shards depend on the rows alone, slots also on how they are stored.

Defined results: a null text has size 16 and all null texts are one group, the
empty text is another; rows that repeat share a shard and get slots of their
own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ordermart.llm.common import stored

ITEMS = 20_000            # bundles, and the bound of groups that stand alone
BUCKET_ROWS = 100_000     # rows of one slot-numbering bucket over all shards


def difference(sizes: np.ndarray, k: int) -> np.ndarray:
    """Place (0 to k - 1) of every item by k-way differencing.  Equal spreads
    are combined in the order of the items."""
    n = len(sizes)
    held: dict[int, np.ndarray] = {}
    for item, size in enumerate(sizes.tolist()):
        held[item] = np.zeros(k, dtype=np.int64)
        held[item][0] = size
    heap = [(-size, item) for item, size in enumerate(sizes.tolist())]
    heapq.heapify(heap)
    # Combinations are numbered from n; each knows its two parts and where each
    # place of a part went.
    parts: list[tuple[int, np.ndarray, int, np.ndarray]] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        down = np.argsort(-held[a], kind="stable")
        up = np.argsort(held[b], kind="stable")
        made = held.pop(a)[down] + held.pop(b)[up]
        at_a, at_b = np.empty(k, dtype=np.int32), np.empty(k, dtype=np.int32)
        at_a[down] = at_b[up] = np.arange(k, dtype=np.int32)
        row = n + len(parts)
        parts.append((a, at_a, b, at_b))
        held[row] = made
        heapq.heappush(heap, (int(made.min() - made.max()), row))
    out = np.zeros(n, dtype=np.int32)
    moved = {n + len(parts) - 1: np.arange(k, dtype=np.int32)}
    for r in range(len(parts) - 1, -1, -1):
        a, at_a, b, at_b = parts[r]
        mine = moved.pop(n + r)
        for part, at in ((a, at_a), (b, at_b)):
            if part < n:
                out[part] = mine[at[0]]     # an item's size is in place 0
            else:
                moved[part] = mine[at]
    return out


def balance(groups: DataFrame, shards: int, items: int = ITEMS) -> DataFrame:
    """(key, shard) for groups (key, size) by Karmarkar-Karp differencing."""
    total = groups.agg(F.sum("size")).first()[0] or 0
    alone = F.col("size") * F.lit(items) >= F.lit(total)
    bundle = F.pmod(F.xxhash64("key"), F.lit(items)).cast("string")
    named = groups.select("key", "size", F.when(alone, F.concat(F.lit("group "), F.hex("key")))
                          .otherwise(F.concat(F.lit("bundle "), bundle)).alias("item"))
    sizes = named.groupBy("item").agg(F.sum("size").alias("size"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            t = pa.Table.from_batches(got).sort_by([("size", "descending"), ("item", "ascending")])
            place = difference(t.column("size").to_numpy(), shards)
            yield pa.RecordBatch.from_arrays([t.column("item").combine_chunks(), pa.array(place, pa.int32())],
                                             names=["item", "shard"])

    placed = stored(sizes.coalesce(1).mapInArrow(run, "item string, shard int"), "shard-items")
    return named.join(placed, "item").select("key", "shard")


def sharded(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
            overhead: int = 16, items: int = ITEMS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(id_col, size, text_crc32, shard, slot) for every row of ``docs``: rows
    with equal texts share a shard, shards have nearly equal sums of size
    (UTF-8 bytes of the text plus ``overhead``)."""
    text = F.col(text_col)
    rows = stored(docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.unhex(F.sha2(text, 256)), F.lit("").cast("binary")).alias("key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row")), "shard-rows")
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    placed = stored(balance(groups, shards, items), "shard-of-group")
    buckets = max(1, -(-rows.count() // bucket_rows))
    located = stored(rows.join(placed, "key")
                     .withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets))), "located")
    here = Window.partitionBy("shard", "bucket").orderBy("id", "row")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = (located.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
              .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    numbered = located.withColumn("nth", F.row_number().over(here) - 1)
    return (numbered.join(counts, ["shard", "bucket"])
            .select(F.col("id").alias(id_col), "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                    (F.col("before") + F.col("nth")).cast("long").alias("slot")))
