import random

import pytest

from ordermart.llm import decontam as dc
from tests.llm import edge


def brute(text, items, similarity=0.8):
    """Best similarity of every item to any of its windows in the text."""
    words, out = dc.words_of(text or ""), {}
    held = {size: set(zip(*(words[i:] for i in range(size)))) for size in range(1, 6)}
    for k, item in enumerate(items):
        own = dc.words_of(item or "")
        if not own:
            continue
        size = min(5, len(own))
        best = 0.0
        if not held[size].isdisjoint(zip(*(own[i:] for i in range(size)))):    # else nothing is shared
            for start in range(max(1, len(words) - len(own) + 1)):
                window = words[start:start + len(own)]
                a, b = list(zip(*(window[i:] for i in range(size)))), list(zip(*(own[i:] for i in range(size))))
                low = sum(min(a.count(s), b.count(s)) for s in set(a))
                best = max(best, low / (len(a) + len(b) - low))
        if best >= similarity:
            out[k] = best
    return out


def test_random_passages():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(200)]
    pairs = 0
    for _ in range(60):
        items = [" ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 4, 5, 6, 12, 20, 40]))) for _ in range(10)]
        ready = dc.Items.build(list(enumerate(items)))
        for _ in range(4):
            text = []
            for _ in range(3):
                passage = rng.choice(items).split()
                if passage and rng.random() < 0.6:
                    for _ in range(rng.randint(0, 2)):
                        passage[rng.choice([0, -1, rng.randrange(len(passage))])] = "zz"
                text += passage + rng.choices(vocabulary, k=rng.randint(0, 15))
            found = dc.matches(" ".join(text), ready, 0.8, dc.RADIUS)
            want = brute(" ".join(text), items)
            assert {ready.ids[k]: round(v[0], 9) for k, v in found.items()} == {k: round(v, 9) for k, v in want.items()}
            pairs += len(want)
    assert pairs > 300


def test_multi_index_finds_all_within_the_radius():
    rng = random.Random(1)
    items = dc.Items.build([(i, " ".join(f"v{rng.randrange(50)}" for _ in range(20))) for i in range(40)])
    import numpy as np
    probes = np.array([rng.getrandbits(64) for _ in range(100)]
                      + [int(p) ^ sum(1 << b for b in rng.sample(range(64), 23)) for p in items.prints], dtype=np.uint64)
    windows, found = items.within(probes, 20, 23)
    want = {(w, i) for w, p in enumerate(probes) for i, q in enumerate(items.prints) if int(p ^ q).bit_count() <= 23}
    assert set(zip(windows.tolist(), found.tolist())) == want


def frame(spark, rows, *extra):
    return spark.createDataFrame(rows, "item_id long, text string" + "".join(extra))


def test_given_documents(spark):
    docs = spark.read.parquet(f"{edge.SF}/documents.parquet")
    bench = spark.read.parquet(f"{edge.SF}/benchmark.parquet")
    items = bench.collect()
    got = {(r.doc_id, r.item_id): r.similarity for r in dc.contaminated(docs, bench).collect()}
    want = {(d.doc_id, items[k].item_id): s for d in docs.collect()
            for k, s in brute(d.text, [i.text for i in items]).items()}
    assert got == pytest.approx(want) and want
    kept = {r.doc_id for r in dc.decontaminate(docs, bench).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {d for d, _ in want}


def test_edge_documents_and_items(spark):
    docs = edge.documents(spark)
    bench = frame(spark, [(1, None), (2, ""), (3, "one two three four five six seven eight nine ten"),
                          (3, "one two three four five six seven eight nine ten"), (None, "a"), (5, "!!"),
                          (6, edge.long_text())])
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, bench).collect()}
    rows, items = edge.texts(), [(r.item_id, r.text) for r in bench.collect()]
    assert got == {(i, items[k][0]) for i, t in rows for k in brute_short(t, items)}
    kept = dc.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not brute_short(t, items) for _, t in rows)


def brute_short(text, items):
    """As brute(), but whole long texts are compared as one window only."""
    if text and len(text) > 100_000:
        return [k for k, (_, t) in enumerate(items) if t == text] + [k for k, (i, t) in enumerate(items)
                                                                   if t == "a" and " a " in text]
    return list(brute(text, [t if not t or len(t) < 100_000 else None for _, t in items]))


def test_empty_tables(spark):
    docs, bench = edge.documents(spark), frame(spark, [(3, "a text without an id")])
    assert dc.contaminated(edge.documents(spark, []), bench).count() == 0
    assert dc.contaminated(docs, bench.limit(0)).count() == 0
    assert dc.decontaminate(docs, bench.limit(0)).count() == docs.count()


def test_blocks_of_the_benchmark(spark, monkeypatch):
    docs = spark.read.parquet(f"{edge.SF}/documents.parquet")
    bench = spark.read.parquet(f"{edge.SF}/benchmark.parquet")
    whole = sorted(map(str, dc.contaminated(docs, bench).collect()))
    monkeypatch.setattr(dc, "BLOCK_BYTES", 3000)
    assert len(list(dc._blocks(bench, "item_id", "text"))) > 2
    assert sorted(map(str, dc.contaminated(docs, bench).collect())) == whole
