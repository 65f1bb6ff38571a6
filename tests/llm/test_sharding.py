import itertools
import zlib

import numpy as np

from ordermart.llm import sharding
from tests.llm import edge


def test_differencing_is_tight():
    rng = np.random.default_rng(2)
    for n, k in ((2000, 40), (500, 7), (40, 40), (3, 5), (1, 4)):
        sizes = rng.integers(16, 5000, n)
        place = sharding.difference(sizes, k)
        sums = np.bincount(place, weights=sizes, minlength=k)
        assert place.min() >= 0 and place.max() < k and sums.sum() == sizes.sum()
        if n >= 500:
            assert sums.max() - sums.min() <= 50
    # Two-way differencing of 8 7 6 5 4 leaves a difference of 2.
    assert abs(np.diff(np.bincount(sharding.difference(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4])))[0] == 2


def test_differencing_beats_the_worst_and_nears_the_best():
    rng = np.random.default_rng(7)
    for _ in range(20):
        sizes = rng.integers(1, 100, 9)
        sums = np.bincount(sharding.difference(sizes, 3), weights=sizes, minlength=3)
        best = min(max(sum(s for s, p in zip(sizes, way) if p == q) for q in range(3))
                   for way in itertools.product(range(3), repeat=9))
        assert sums.max() <= 1.25 * best


def check(docs, shards, **options):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sharding.sharded(docs, shards, **options)
    out = got.collect()
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in out) == want
    by_shard = {}
    for r in out:
        by_shard.setdefault(r.shard, []).append(r)
    for s, members in by_shard.items():
        assert 0 <= s < shards and sorted(r.slot for r in members) == list(range(len(members)))
    homes = {}
    texts = {(str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())): t for i, t in rows}
    for r in out:
        homes.setdefault(texts[str(r.doc_id), r["size"], r.text_crc32], set()).add(r.shard)
    assert all(len(h) == 1 for h in homes.values())
    return {s: sum(r["size"] for r in m) for s, m in by_shard.items()}


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sums = check(docs, 40, bucket_rows=100)
    assert len(sums) == 40 and max(sums.values()) - min(sums.values()) <= 0.01 * max(sums.values())
    coarse = check(docs, 4, items=50)
    assert max(coarse.values()) - min(coarse.values()) <= 0.1 * max(coarse.values())


def test_edge_documents(spark):
    check(edge.documents(spark), 5)
    check(edge.documents(spark), 40)
    assert sharding.sharded(edge.documents(spark, []), 40).count() == 0


def test_result_does_not_depend_on_row_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = {tuple(r) for r in sharding.sharded(docs, 8).drop("slot").collect()}
    b = {tuple(r) for r in sharding.sharded(docs.repartition(7, "n_chars"), 8).drop("slot").collect()}
    assert a == b


def test_one_row_repeated_many_times(spark):
    docs = edge.documents(spark, [(1, "again and again")] * 300 + [(i, f"text {i}") for i in range(100)])
    sums = check(docs, 4, bucket_rows=20)
    assert max(sums.values()) == 300 * 31 and len(sums) == 4
