import numpy as np
import pytest

from ordermart.llm import nndescent as nn

SCHEMA = "vec_id long, embedding array<float>, label int, rid long, n long, root long, usable string"


def brute(rows, threshold=0.93):
    """(n_links, component_id) of each row, by comparing all pairs."""
    n = len(rows)
    links, parent = [0] * n, list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def usable(r):
        return (r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]))

    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.float32(a[1]).astype(float), np.float32(b[1]).astype(float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    p, q = find(i), find(j)
                    parent[max(p, q)] = min(p, q)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted(((r[0], links[i], least.get(find(i)), r[0] == least.get(find(i))) for i, r in enumerate(rows)), key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in nn.near_duplicates(df, **options).collect()), key=str)


def clustered(seed, sizes, dim=24, noise=0.06, labels=3):
    rng = np.random.default_rng(seed)
    rows = []
    for size in sizes:
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        label = int(rng.integers(labels))
        rows += [(centre + rng.normal(size=dim) * noise * (size > 1)).astype(np.float32).tolist() + [label]
                 for _ in range(size)]
    return [(i, r[:-1], r[-1]) for i, r in enumerate(rows)]


def test_clusters_larger_than_any_list(spark, monkeypatch):
    monkeypatch.setattr(nn, "BLOCK", 32)
    rows = clustered(1, [150, 40, 12, 3, 2, 2] + [1] * 120)
    want = brute(rows)
    assert max(w[1] for w in want) > nn.LONGEST
    assert found(spark, rows) == want


def test_edge_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1),
            (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (9, [2.0, 0.0], 1), (10, [1.0, 0.0], 2), (11, [1.0, 0.0], 1),
            (11, [1.0, 0.0], 1), (None, [0.0, 1.0], 1), (None, [0.0, 1.0], 1), (12, [1.0, 0.0, 0.0], 1),
            (13, [1e30, 1e30], 1), (14, [1e-30, 1e-30], 1), (15, [-1.0, 0.0], 1)]
    got = found(spark, rows)
    want = [(i, n, c, (i is None and c is None) or k) for i, n, c, k in brute(rows)]
    assert got == sorted(want, key=str)
    assert found(spark, []) == []


def test_audit_asks_for_more(spark, monkeypatch):
    """A start too poor to find the links fails loudly instead of passing."""
    rows = clustered(3, [2] * 40, labels=1)
    monkeypatch.setattr(nn, "_start", lambda vertices, seed, keep: spark.createDataFrame([], "u long, v long, s double"))
    monkeypatch.setattr(nn, "ROUNDS", 1)
    with pytest.raises(RuntimeError, match="recall"):
        found(spark, rows)


def test_audit_sees_links_beside_a_large_group(spark, monkeypatch):
    """Five pairs missed beside 150 near copies: 10 of 22,360 links, but all
    of five pairs of vectors."""
    rows = [(i, v, 1) for i, v, _ in clustered(5, [150])]
    rows += [(1000 + i, v, 2) for i, v, _ in clustered(6, [2] * 5)]
    start = nn._start

    def one_label(vertices, seed, keep):
        return start(vertices.where("label = 1"), seed, keep)

    monkeypatch.setattr(nn, "_start", one_label)
    monkeypatch.setattr(nn, "ROUNDS", 1)
    with pytest.raises(RuntimeError, match="recall"):
        found(spark, rows)


def test_audit_counts_vectors_not_copies(spark):
    """A vector that misses one of two linked vectors has half its recall,
    however many copies the found one stands for."""
    truth = spark.createDataFrame([(1, 2), (2, 0)], "rid long, true_peers long")
    degrees = spark.createDataFrame([(1, 5000, 1, False)], "rid long, links long, peers long, exact boolean")
    assert nn._recall(truth, degrees) == 0.5


def test_lists_longer_than_the_longest_saturated(spark):
    """With the list length of a fourth round, a group larger than a list is
    still counted in full."""
    rows = clustered(7, [150, 3, 2])
    want = brute(rows)
    assert max(w[1] for w in want) > 80
    assert found(spark, rows, neighbours=80) == want


def test_few_links_in_a_large_table_are_audited(spark, monkeypatch):
    """A start that misses 50 linked pairs among 20,000 vectors fails: vectors are
    drawn until those with links are enough, not until 400 are drawn."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(20_000, 32)).astype(np.float32)
    x[50:100] = x[:50] + rng.normal(size=(50, 32)).astype(np.float32) * 0.02
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    got = nn.near_duplicates(df).where("n_links > 0").select("vec_id", "n_links", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted((i, 1, i % 50) for i in range(100))
    monkeypatch.setattr(nn, "_start", lambda vertices, seed, keep: spark.createDataFrame([], "u long, v long, s double"))
    monkeypatch.setattr(nn, "ROUNDS", 1)
    with pytest.raises(RuntimeError, match="recall"):
        nn.near_duplicates(df)


def test_lower_bound():
    assert 0.97 < nn._lower_bound(1.0, 100) < 0.98 and nn._lower_bound(0.95, 100) < nn._lower_bound(0.95, 1000) < 0.95
    assert nn._lower_bound(1.0, 1) < 0.5


def test_audit_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nn, "ASKED_BYTES", 24 * 8 * 50)
    monkeypatch.setattr(nn, "CELLS", 500)
    monkeypatch.setattr(nn, "AUDIT", 20)
    rows = clustered(13, [30, 12, 3, 2, 2] + [1] * 150)
    assert found(spark, rows) == brute(rows)


def test_saturated_vectors_beside_others_of_their_component(spark, monkeypatch):
    """A chain from a group larger than any list out to vectors with one link."""
    monkeypatch.setattr(nn, "BLOCK", 32)
    rows = [(i, v, 1) for i, v, _ in clustered(17, [120], noise=0.03)]
    step = np.float32(rows[0][1])
    turn = np.random.default_rng(3).normal(size=24)
    for i in range(5):
        step = step + 0.06 * (i + 1) * turn / np.linalg.norm(turn) * np.linalg.norm(step)
        rows.append((1000 + i, step.astype(np.float32).tolist(), 1))
    want = brute(rows)
    assert max(w[1] for w in want) > nn.LONGEST and len({w[2] for w in want}) < len(rows) - 110
    assert found(spark, rows) == want
