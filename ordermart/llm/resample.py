"""Target-distribution importance resampling with exact ranks.

Documents are drawn so that their hashed word n-grams look like those of a
target corpus.  Each n-gram falls into one of a fixed number of buckets; one
pass over both corpora counts the buckets, giving each a gain, the scaled log of
its smoothed share in the target over its smoothed share in the source.  A
document's weight is the mean gain of its n-grams, read from an array of gains;
its score adds Gumbel noise from a hash of its id, so that the highest scores
are a draw without replacement in proportion to the weights.

Ranks come from parallel sorting by regular sampling: every partition of scored
documents is sorted and stored as a run; rows at regular distances in all runs
give regular splitters; the runs are cut at the splitters and each segment's
pieces meet in one partition, where they are merged; prefix counts of the
segments turn places into ranks.  Rows are told apart by run and place at last,
so equal scores, ids and whole rows are split like any others, and a segment
holds at most about twice its share.  Segments behind the last rank drawn are
counted only.

The counts are the same few thousand numbers at any size; splitters come from
about SEGMENTS x RUNS sampled keys at most, of seven numbers each.

Defined results: a null or empty text has no words and weight 0; a null id has
the noise of an empty one and ranks after other ids of its score; ties go by id,
number of features and weight; repeated rows are rows of their own; texts of any
length are read whole; empty tables give empty results, an empty target gains
that only reflect the source; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

from ordermart.llm.common import lean, stored

BUCKETS = 10_000
SCALE = 1000
RUNS, SEGMENTS = 400, 400   # most sorted runs and most segments
SEGMENT_ROWS = 250_000      # rows of a segment, until there are SEGMENTS of them

#: A-Z become a-z; other ASCII characters but digits and a-z
#: part words.  In UTF-8 all other characters are bytes of 128 and more.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text."""
    # Only ASCII white space is left between words, and split() knows no other.
    return text.translate(_WORD_BYTES).split()


def buckets_of(words: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of every word and of every two words joined by a space: the CRC
    of the first word is carried on over the second."""
    single = list(map(crc32, words))
    double = map(crc32, map(b" ".__add__, words[1:]), single)
    hashed = np.fromiter([*single, *double], dtype=np.int64, count=max(2 * len(words) - 1, 0))
    return hashed % buckets


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Number of features in each bucket over all rows; every task sends its
    sums, not its features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.large_binary()):
                counts += np.bincount(buckets_of(words_of(text.as_py() or b""), buckets), minlength=buckets)
        there = np.flatnonzero(counts)
        yield pa.record_batch({"bucket": pa.array(there, pa.int32()), "n": pa.array(counts[there], pa.int64())})

    sums = (texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run), "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))
    counts = np.zeros(buckets, dtype=np.int64)
    for r in sums.collect():                 # a row a bucket at most
        counts[r.bucket] = r.n
    return counts


def gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Scaled, floored log ratio of the smoothed shares of every bucket."""
    s_all, t_all, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(scale * math.log(float(t + 1) * float(s_all + n) / (float(s + 1) * float(t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def noise(doc_id: int | None, seed: int, scale: int = SCALE) -> int:
    """Scaled, floored Gumbel noise from a hash of the id."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, n_features, weight, score) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    table = gain.astype("<i8").tobytes()     # 8 bytes a bucket, sent with the tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = np.frombuffer(table, dtype="<i8")
        for batch in batches:
            ids = batch.column("id").to_pylist()
            n_words, n_features, weights = [], [], []
            for text in batch.column("text").cast(pa.large_binary()):
                words = words_of(text.as_py() or b"")
                mine = by_bucket[buckets_of(words, len(by_bucket))]
                n_words.append(len(words))
                n_features.append(len(mine))
                weights.append(int(mine.sum()) // len(mine) if len(mine) else 0)
            scores = [w + noise(i, seed) for i, w in zip(ids, weights)]
            yield pa.record_batch({id_col: batch.column("id"), "n_words": pa.array(n_words, pa.int64()),
                                   "n_features": pa.array(n_features, pa.int64()),
                                   "weight": pa.array(weights, pa.int64()), "score": pa.array(scores, pa.int64())})

    return rows.mapInArrow(lean(run), f"`{id_col}` long, n_words long, n_features long, weight long, score long")


# -- parallel sorting by regular sampling --------------------------------------------

_KEY = ["down", "no_id", "id", "n_features", "weight", "run", "place"]


def _keys(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(batch.column(k).to_pylist() for k in _KEY))


def sorted_runs(rows: DataFrame, id_col: str) -> DataFrame:
    """Every partition sorted by descending score, stored, with the number of
    its run and each row's place in it."""
    keyed = rows.coalesce(RUNS).select((-F.col("score")).alias("down"), F.col(id_col).isNull().cast("int").alias("no_id"),
                       F.coalesce(id_col, F.lit(0).cast("long")).alias("id"), "n_features", "weight")
    row = F.monotonically_increasing_id()
    return stored(keyed.sortWithinPartitions(*_KEY[:5]).withColumn("run", F.spark_partition_id())
                  .withColumn("place", row.bitwiseAND(F.lit((1 << 33) - 1))), "resample-runs")


def splitters(runs: DataFrame, n: int) -> list[tuple]:
    """Keys that part all rows into segments of like size: every so many rows of
    every run are sampled, every so many samples are splitters."""
    segments = min(SEGMENTS, -(-n // SEGMENT_ROWS))
    if segments < 2:
        return []
    n_runs = min(RUNS, runs.select(F.max("run") + 1).first()[0])
    every = max(1, n // (segments * n_runs))
    samples = sorted(tuple(r) for r in runs.where(F.col("place") % every == every - 1).select(*_KEY).collect())
    step = len(samples) / segments
    return sorted({samples[int(i * step)] for i in range(1, segments)}) if samples else []


def ranked(rows: DataFrame, most: int, id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_features, weight, score, rank): rows by descending score, then
    ascending id, numbered from 1 as far as ``most``, null behind."""
    runs = sorted_runs(rows, id_col)
    cuts = splitters(runs, runs.count())

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bisect_right(cuts, key) for key in _keys(batch)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())],
                                             names=[*batch.schema.names, "segment"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in runs.schema.fields)
    cut = stored(runs.mapInArrow(segment, f"{fields}, segment int"), "resample-segments") if cuts else (
        runs.withColumn("segment", F.lit(0)))
    sizes = {r.segment: r["count"] for r in cut.groupBy("segment").count().collect()}    # SEGMENTS rows at most
    before = [0, *accumulate(sizes.get(i, 0) for i in range(len(cuts) + 1))]
    reached = sum(b < most for b in before[:-1])          # segments that hold a rank to be drawn
    mine = cut.where(F.col("segment") < reached)
    merged = mine.repartitionById(max(reached, 1), F.col("segment")).sortWithinPartitions("segment", *_KEY)
    first = F.element_at(F.array(*[F.lit(b).cast("long") for b in before[:max(reached, 1)]]), F.col("segment") + 1)
    in_order = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    numbered = merged.withColumn("at", in_order).withColumn("rank", F.col("at") + first)
    rest = cut.where(F.col("segment") >= reached).withColumn("rank", F.lit(None).cast("long"))

    def back(df: DataFrame) -> DataFrame:
        rank = F.when(F.col("rank") <= most, F.col("rank"))
        return df.select(F.when(F.col("no_id") == 0, F.col("id")).alias(id_col), "n_features", "weight",
                         (-F.col("down")).alias("score"), rank.alias("rank"))

    return back(numbered).unionByName(back(rest))


def resampled(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7,
              id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """(id_col, n_features, weight, score, rank) of every row of ``docs``: the
    rank of those drawn, ``percent`` of the documents of ``least_words`` or more
    words, and null for all others."""
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_text_col))
    rows = stored(scored(docs, gain, seed, id_col, text_col), "resample-scores")
    long_enough = rows.where(F.col("n_words") >= least_words)
    drawn = ranked(long_enough, percent * long_enough.count() // 100, id_col)
    short = rows.where(F.col("n_words") < least_words).select(
        id_col, "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(short)
