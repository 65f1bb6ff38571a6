import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ordermart.llm import resample
from ordermart.llm.catalog import SQL, op12_resample
from tests.llm import edge

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text):
    words = WORDS.findall((text or "").translate(LOWER))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def expected(docs, target, percent=25):
    """The contract in plain Python."""
    def bucket(f):
        return zlib.crc32(f.encode()) % 10000

    s = Counter(bucket(f) for _, t in docs for f in features(t)[1])
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in s}
    rows = []
    for i, text in docs:
        words, mine = features(text)
        weight = sum(gain[bucket(f)] for f in mine) // len(mine) if mine else 0
        h = int(sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((len(words) >= 20, i, len(mine), weight, score))
    long_enough = sorted((r for r in rows if r[0]), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2], r[3]))
    most = percent * len(long_enough) // 100
    out = [(*r[1:], n if n <= most else None) for n, r in enumerate(long_enough, 1)]
    return sorted([*out, *((*r[1:], None) for r in rows if not r[0])], key=str)


def result(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=120))
def test_words_and_buckets_of_any_text(text):
    words, mine = features(text)
    own = resample.words_of(text.encode())
    assert own == [w.encode() for w in words]
    assert resample.buckets_of(own).tolist() == [zlib.crc32(f.encode()) % 10000 for f in mine]


def test_query_over_given_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{edge.SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{edge.SF}/benchmark.parquet").collect()]
    got = result(op12_resample(spark, edge.SF))
    assert got == expected(docs, target)
    assert sum(r[4] is not None for r in got) > 10


@pytest.mark.parametrize("target", [["one two three four", None, "x", ""], []])
def test_edge_documents(spark, target):
    benchmark = spark.createDataFrame([(t, "d", 1) for t in target], "text string, doc_id string, bucket int")
    rows = edge.texts() + [(20 + i, " ".join(["w"] * (18 + i))) for i in range(5)] + [(None, "a " * 25)] * 3
    for docs in (rows, []):
        assert result(resample.resampled(edge.documents(spark, docs), benchmark)) == expected(docs, target)


def test_many_segments_and_one_id_with_a_third_of_the_rows(spark, monkeypatch):
    """Ranks are exact however many segments there are, and rows of one id, one
    score and one text are split between segments."""
    monkeypatch.setattr(resample, "SEGMENT_ROWS", 200)
    rng = random.Random(8)
    rows = [(i, 5, 7, rng.randint(-50, 50)) for i in range(2000)] + [(9999, 5, 7, 3)] * 1000 + [(None, 5, 7, 3)] * 20
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, n_features long, weight long, score long").repartition(6)
    runs = resample.sorted_runs(frame, "doc_id")
    cuts = resample.splitters(runs, len(rows))
    assert len(cuts) > 10
    held = Counter(sum(c <= k for c in cuts) for k in (tuple(r) for r in runs.select(*resample._KEY).collect()))
    assert max(held.values()) <= 2 * -(-len(rows) // (len(cuts) + 1)) + 6
    in_order = sorted(rows, key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for most in (0, 1, 755, len(rows)):
        want = sorted(((*r, n if n <= most else None) for n, r in enumerate(in_order, 1)), key=str)
        assert result(resample.ranked(frame, most)) == want


def test_gains_follow_the_target():
    source, target = np.zeros(10, dtype=np.int64), np.zeros(10, dtype=np.int64)
    source[:2], target[1:3] = 90, 90
    gain = resample.gains(source, target)
    assert gain[0] < gain[1] < gain[2] and gain[1] == 0 and gain[5] == 0


def test_sql_says_the_same(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{edge.SF}/{name}.parquet'")
    assert sorted(con.sql(SQL["op12_resample"]).fetchall(), key=str) == result(op12_resample(spark, edge.SF))
