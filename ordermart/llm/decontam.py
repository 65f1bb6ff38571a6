"""Benchmark decontamination by SimHash windows.

Every benchmark item of n words is compared with the n-word windows of the
documents.  A window's 64-bit SimHash votes over its 5-word shingles.  The
fingerprint is cut into four blocks of 16 bits: if a window differs from an
item in at most ``radius`` bits, one block differs in at most radius // 4, so
looking up each block's near values (multi-index) finds every item within the
radius.  Candidates are then verified exactly: the weighted Jaccard similarity
of the two multisets of shingles (words compared as strings) must reach
``similarity``.

A window that shares no shingle with any item has similarity zero, so only
windows around shingles that some item of that length holds are fingerprinted;
nothing that could pass is skipped.  Whole texts are read, however long.

The benchmark is a stated query set: it is sent to the tasks in blocks of a
checked size, and every block is held against all documents.

Words are lower-cased runs of letters, digits and underscores.  Items of fewer
than 5 words are one shingle of all their words; items without a word match
nothing; a text shorter than an item is one window.  A null text matches
nothing.  Repeated items and documents each count; empty tables on either side
give no match; other columns are ignored (``decontaminate`` keeps them).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ordermart.llm.common import lean

WORD = re.compile(r"\w+")
SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23            # 4.5 standard deviations above what similarity 0.8 gives
BLOCK_BYTES = 32 << 20  # benchmark text sent to the tasks at once
FILTER_BITS = 1 << 22
KEPT_WORDS = 200_000     # bound of a worker's table of word hashes
WINDOWS = 1 << 14      # windows fingerprinted at once
MATCH = "doc_id long, item_id long, similarity double, distance int, start_word int, n_words int"

# Odd multipliers that tell the places of a shingle's words apart.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                   0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], dtype=np.uint64)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Mixed 64-bit hash of every run of ``size`` words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        h += hashes[j:j + n] * PLACES[j]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def _counts(words: list[str], size: int) -> Counter:
    return Counter(zip(*(words[i:] for i in range(size))))


def weighted_jaccard(a: Counter, b: Counter) -> float:
    """Sum of minima over sum of maxima of the weights."""
    if len(b) < len(a):
        a, b = b, a
    low = sum(min(n, b[k]) for k, n in a.items())
    high = sum(a.values()) + sum(b.values()) - low
    return low / high if high else 0.0


def _fingerprints(shingles: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """SimHash of ``width`` shingles from each start (ascending)."""
    out = np.empty(len(starts), dtype=np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = i + int(np.searchsorted(starts[i:], starts[i] + WINDOWS))
        part = shingles[starts[i]:starts[j - 1] + width]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.zeros((len(part) + 1, 64), dtype=np.int32)
        np.cumsum(bits, axis=0, out=sums[1:])
        at = starts[i:j] - starts[i]
        votes = 2 * (sums[at + width] - sums[at]) > width
        out[i:j] = (votes * weights).sum(axis=1, dtype=np.uint64)
        i = j
    return out


@dataclass
class Items:
    """One block of the benchmark, ready for lookup."""
    ids: list[int | None]
    counts: list[Counter]
    lengths: np.ndarray                    # words
    prints: np.ndarray
    #: shingle size -> sorted hashes of the items' shingles and a bit filter
    anchors: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    #: shingle hash -> lengths of the items that hold it
    lengths_of: dict[int, tuple[int, ...]] = field(default_factory=dict)
    near: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    words: dict[str, int] = field(default_factory=dict)

    @classmethod
    def build(cls, rows: list[tuple[int | None, str]]) -> Items:
        made = cls([], [], np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64))
        lengths, prints = [], []
        by_size: dict[int, set[int]] = {}
        holds: dict[int, set[int]] = {}
        for item_id, text in rows:
            words = words_of(text or "")
            if not words:
                continue
            size = min(SHINGLE, len(words))
            hashes = _shingles(made.hash_words(words), size)
            made.ids.append(item_id)
            made.counts.append(_counts(words, size))
            lengths.append(len(words))
            prints.append(_fingerprints(hashes, np.zeros(1, dtype=np.int64), len(hashes))[0])
            for h in hashes.tolist():
                by_size.setdefault(size, set()).add(h)
                holds.setdefault(h, set()).add(len(words))
        made.lengths, made.prints = np.array(lengths, dtype=np.int64), np.array(prints, dtype=np.uint64)
        made.lengths_of = {h: tuple(sorted(n)) for h, n in holds.items()}
        for size, hashes in by_size.items():
            exact = np.array(sorted(hashes), dtype=np.uint64)
            bits = np.zeros(FILTER_BITS, dtype=bool)
            bits[(exact & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
            made.anchors[size] = (exact, bits)
        return made

    def forget(self) -> None:
        """Empty the tables of word hashes and near block values."""
        self.words.clear()
        self.near.clear()

    def hash_words(self, words: list[str]) -> np.ndarray:
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        known = self.words
        out = np.empty(len(words), dtype=np.uint64)
        for i, w in enumerate(words):
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh64_intdigest(w)
            out[i] = h
        return out

    def hits(self, shingles: np.ndarray, size: int) -> np.ndarray:
        """Places whose shingle some item holds."""
        exact, bits = self.anchors[size]
        maybe = np.flatnonzero(bits[(shingles & np.uint64(FILTER_BITS - 1)).astype(np.int64)])
        found = exact[np.minimum(np.searchsorted(exact, shingles[maybe]), len(exact) - 1)]
        return maybe[found == shingles[maybe]]

    def within(self, prints: np.ndarray, length: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs of items of that length within the radius."""
        mine = np.flatnonzero(self.lengths == length)
        windows, items = [], []
        for w, p in enumerate(prints.tolist()):
            close = self._multi_index(p, length, mine, radius)
            hit = close[np.bitwise_count(self.prints[close] ^ np.uint64(p)) <= radius]
            windows += [w] * len(hit)
            items += hit.tolist()
        return np.array(windows, dtype=np.int64), np.array(items, dtype=np.int64)

    def _multi_index(self, p: int, length: int, mine: np.ndarray, radius: int) -> np.ndarray:
        """Items of a length with a block that is near this one's."""
        flags = np.zeros(len(mine), dtype=bool)
        for block in range(4):
            value = p >> 16 * block & 0xFFFF
            key = (length << 2 | block, value)
            near = self.near.get(key)
            if near is None:
                if len(self.near) > 100_000:
                    self.near.clear()
                theirs = (self.prints[mine] >> np.uint64(16 * block)) & np.uint64(0xFFFF)
                near = self.near[key] = np.bitwise_count(theirs ^ np.uint64(value)) <= radius // 4
            flags |= near
        return mine[flags]


def matches(text: str | None, items: Items, similarity: float, radius: int) -> dict[int, tuple[float, int, int]]:
    """Row of each matched item -> (similarity, distance, first word) of the
    best window, the first of equals."""
    found: dict[int, tuple[float, int, int]] = {}
    if not text or not items.ids:
        return found
    words = words_of(text)
    hashes = items.hash_words(words)
    for size in items.anchors:
        shingles = _shingles(hashes, size)
        if not len(shingles):
            continue
        hits = items.hits(shingles, size)
        by_length: dict[int, list[int]] = {}
        for at in hits.tolist():
            for n in items.lengths_of[int(shingles[at])]:
                if min(SHINGLE, n) == size:
                    by_length.setdefault(n, []).append(at)
        for n, places in by_length.items():
            width = min(n - size + 1, len(shingles))
            starts = _around(np.array(places), width, len(shingles))
            prints = _fingerprints(shingles, starts, width)
            for w, item in zip(*items.within(prints, n, radius)):
                start = int(starts[w])
                window = _counts(words[start:start + n], size)
                score = weighted_jaccard(window, items.counts[item])
                if score >= similarity and score > found.get(int(item), (0.0,))[0]:
                    distance = int(np.bitwise_count(prints[w] ^ items.prints[item]))
                    found[int(item)] = (score, distance, start)
    return found


def _around(places: np.ndarray, width: int, n: int) -> np.ndarray:
    """Starts of all windows of ``width`` shingles that hold one of the
    places (ascending)."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, np.maximum(places - width + 1, 0), 1)
    np.add.at(edges, np.minimum(places, n - width) + 1, -1)
    return np.flatnonzero(np.cumsum(edges)[:n - width + 1] > 0)


# -- Spark -------------------------------------------------------------------------

def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Items]:
    """The benchmark in blocks of at most BLOCK_BYTES of text (or one row)."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"),
                            F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    if not total["n"]:
        return
    n = -(-total["size"] // BLOCK_BYTES) or 1
    while True:
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n)))
        sizes = dealt.groupBy("block").agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("size"))
        if sizes.where((F.col("size") > BLOCK_BYTES) & (F.col("rows") > 1)).isEmpty() or n >= total["n"]:
            break
        n *= 2
    for block in range(n):
        found = dealt.where(F.col("block") == block).select("id", "text").toArrow()
        yield Items.build(list(zip(found.column("id").to_pylist(), found.column("text").to_pylist())))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity, distance, start_word, n_words) of every
    document and item that match, by their best window.  Rows that repeat an
    id give the pair once."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = docs.sparkSession.createDataFrame([], MATCH)
    for items in _blocks(benchmark, item_col, "text"):
        found = found.unionByName(rows.mapInArrow(_finder(docs, items, similarity, radius), MATCH))
    best = F.max_by(F.struct("similarity", "distance", "start_word", "n_words"),
                    F.struct("similarity", -F.col("distance"), -F.col("start_word")))
    return (found.groupBy("doc_id", "item_id").agg(best.alias("best"))
            .select(F.col("doc_id").alias(id_col), F.col("item_id").alias(item_col), "best.*"))


def _finder(docs: DataFrame, items: Items, similarity: float, radius: int):
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                for k, (score, distance, start) in matches(text, items, similarity, radius).items():
                    out.append((doc_id, items.ids[k], score, distance, start, int(items.lengths[k])))
            c = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.float64()),
                 pa.array(c[3], pa.int32()), pa.array(c[4], pa.int32()), pa.array(c[5], pa.int32())],
                names=["doc_id", "item_id", "similarity", "distance", "start_word", "n_words"])

    return lean(run, lambda: sent.value.forget())


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``docs`` (all columns) without the rows that match an item."""
    for items in _blocks(benchmark, item_col, "text"):
        docs = docs.mapInArrow(_cleaner(docs, items, text_col, similarity, radius), docs.schema)
    return docs


def _cleaner(docs: DataFrame, items: Items, text_col: str, similarity: float, radius: int):
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        for batch in batches:
            clean = [not matches(t, items, similarity, radius) for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return lean(run, lambda: sent.value.forget())
