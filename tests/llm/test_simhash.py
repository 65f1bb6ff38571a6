import re

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st

from ordermart.llm import simhash
from ordermart.llm.components import connected_components
from tests.llm import edge


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for j in range(64):
            counts[j] += h >> j & 1
    return sum(1 << j for j in range(64) if 2 * counts[j] > len(shingles))


class Union:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def brute_components(rows, distance=3):
    """Row number -> smallest row number reachable."""
    fp = np.array([brute_fingerprint(t) for _, t in rows], dtype=np.uint64)
    sets = Union(range(len(rows)))
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= distance):
            sets.join(i, int(j))
    return fp, [sets.find(i) for i in range(len(rows))]


def expected(rows):
    fp, root = brute_components(rows)
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return sorted(((i, f"{int(f):016x}", least.get(r)) for (i, _), f, r in zip(rows, fp, root)), key=str)


def found(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_every_given_document(spark):
    docs = spark.read.parquet(f"{edge.SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(simhash.near_duplicates(docs)) == expected(rows)


def test_edge_documents(spark):
    docs = edge.documents(spark)
    assert found(simhash.near_duplicates(docs)) == expected(edge.texts())


def test_empty_table(spark):
    docs = edge.documents(spark, [])
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.one_of_each(docs).count() == 0


def test_one_of_each_group_keeps_all_columns(spark):
    docs = edge.documents(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = edge.texts()
    _, root = brute_components(rows)
    groups = {}
    for (i, t), r in zip(rows, root):
        groups.setdefault(r, []).append((i, t))
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(groups)
    for members in groups.values():
        ids = [i for i, _ in members if i is not None]
        mine = [g for g in got if g in members]
        assert len(mine) == 1 and mine[0][0] == (min(ids) if ids else None)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=3), st.integers(0, 3))
def test_pigeonring_never_loses_a_link(x, flips, distance):
    y = x
    for b in flips[:distance]:
        y ^= 1 << b
    masks = simhash.key_masks(distance)
    chains = simhash.chain_masks(distance)
    shared = [s for s, m in masks if (x ^ y) & m == 0]
    assert shared
    ok = simhash.chains_hold(np.full(len(shared), x ^ y, dtype=np.uint64), np.array(shared), chains, distance)
    assert ok.any()


def test_crowded_key_in_chunks(spark, monkeypatch):
    """Near copies that share keys: chunks and pairs of chunks lose no link
    and return fewer edges than rows."""
    monkeypatch.setattr(simhash, "CHUNK", 16)
    rng = np.random.default_rng(1)
    base = int(rng.integers(0, 2**63))
    fps = {base}
    while len(fps) < 300:
        a, b = rng.integers(0, 64, 2)
        fps.add(base ^ (1 << int(a)) ^ (1 << int(b)))
    far = int(np.uint64(base) ^ np.uint64(0xFFFF00FF00FF00FF))
    signed = [simhash._signed(x) for x in [*fps, far]]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    labels = connected_components(simhash.link_edges(df)).collect()
    assert {r.node for r in labels} == {simhash._signed(x) for x in fps}
    assert len({r.root for r in labels}) == 1


def test_components_of_paths_stars_and_loops(spark):
    edges = ([(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)]
             + [(7, 7), (2001, 2000), (2000, 2001), (2000, 2001)])
    df = spark.createDataFrame([*edges, (None, 5)], "a long, b long")
    got = {}
    for r in connected_components(df).collect():
        got.setdefault(r.root, set()).add(r.node)
    assert sorted(map(min, got.values())) == [0, 1000, 2000]
    assert sorted(map(len, got.values())) == [2, 50, 61]
    assert connected_components(df.limit(0)).count() == 0
