"""SimHash near-dedup with pigeonring filtering.

A 64-bit fingerprint is cut into a ring of ``distance + 1`` segments.  If two
fingerprints differ in at most ``distance`` bits, some start segment exists
from which every chain of l consecutive segments differs in at most
floor(l * distance / (distance + 1)) = l - 1 bits.  So from that start the
first segment agrees exactly and the next one differs in at most one bit: of
its four parts at least three agree.  The start segment plus three parts is an
exact join key (28 bits for distance 3); the longer chains prune the
candidates before the full Hamming check.

Equal fingerprints are collapsed before the join.  A key shared by many
fingerprints is cut into chunks of a bounded number of rows, and every pair of
chunks is compared in a task of its own, which returns a spanning forest of the
links in it (at most one edge a row), not the pairs.  No key is capped.

Defined results: a null or wordless text has fingerprint zero and links like
any other; repeated rows each get a result row; a null id is never a
component id unless the whole component has none; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ordermart.llm.common import forest, group_starts, lean, stored, utf8, whole_groups
from ordermart.llm.components import connected_components

BITS = 64
PARTS = 4          # parts of the second segment, of which one may differ
CHUNK = 1000       # rows of a chunk; a comparison task holds two chunks
SMALL = 64         # groups up to this size are compared together by offsets


def shingle_hashes(data: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of all word shingles of a lower-cased text."""
    words = data.lower().split()   # bytes: A-Z and 0x20, 0x09-0x0D only
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) <= size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    return np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Majority vote of the hashes, bit by bit; as a signed 64-bit number."""
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """(id, text_key, fp) for every row of ``docs``; text_key hashes the text."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(shingle_hashes(t, shingle))
                   for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), pa.array(fps, pa.int64())],
                names=["id", "text_key", "fp"])

    return rows.mapInArrow(lean(run), "id long, text_key long, fp long")


# -- pigeonring candidates ---------------------------------------------------

def _ring(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment."""
    m = distance + 1
    cuts = [BITS * k // m for k in range(m + 1)]
    return [(cuts[k], cuts[k + 1] - cuts[k]) for k in range(m)]


def _mask(first: int, width: int) -> int:
    return ((1 << width) - 1) << first


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def key_masks(distance: int) -> list[tuple[int, int]]:
    """(start segment, bits that must agree) of every key table."""
    ring = _ring(distance)
    if len(ring) == 1:
        return [(0, _mask(0, BITS))]
    out = []
    for i in range(len(ring)):
        exact = _mask(*ring[i])
        first, width = ring[(i + 1) % len(ring)]
        cuts = [first + width * p // PARTS for p in range(PARTS + 1)]
        for p in range(PARTS):
            parts = [_mask(cuts[q], cuts[q + 1] - cuts[q]) for q in range(PARTS) if q != p]
            out.append((i, exact | sum(parts)))
    return out


def chain_masks(distance: int) -> np.ndarray:
    """[start, l - 1]: bits of the chain of l segments from a start."""
    ring = _ring(distance)
    m = len(ring)
    out = np.zeros((m, m), dtype=np.uint64)
    for i in range(m):
        bits = 0
        for n in range(m):
            bits |= _mask(*ring[(i + n) % m])
            out[i, n] = bits
    return out


def chains_hold(xor: np.ndarray, start: np.ndarray, chains: np.ndarray, distance: int) -> np.ndarray:
    """Which differences keep the budget of every chain from their start; the
    last chain is the whole ring, so this ends with the full Hamming check."""
    m = chains.shape[1]
    keep = np.ones(len(xor), dtype=bool)
    for n in range(m):
        live = np.flatnonzero(keep)
        over = np.bitwise_count(xor[live] & chains[start[live], n]) > (n + 1) * distance // m
        keep[live[over]] = False
    return keep


def _links_in(fp: np.ndarray, start: np.ndarray, starts: np.ndarray, chains: np.ndarray,
              distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked row pairs inside the groups that begin at ``starts``."""
    ends = np.append(starts[1:], len(fp))
    sizes = ends - starts
    group = np.repeat(np.arange(len(starts)), sizes)
    left, right = [], []
    small = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
    for d in range(1, min(SMALL, int(sizes.max(initial=1)))):
        i = small[:-d]
        j = small[d:]
        same = group[i] == group[j]
        if not same.any():
            break
        i, j = i[same], j[same]
        ok = chains_hold(fp[i] ^ fp[j], start[i], chains, distance)
        left.append(i[ok])
        right.append(j[ok])
    for g in np.flatnonzero(sizes > SMALL):
        a, b = starts[g], ends[g]
        for i in range(a, b - 1):
            j = np.arange(i + 1, b)
            ok = chains_hold(fp[j] ^ fp[i], start[j], chains, distance)
            left.append(np.full(int(ok.sum()), i))
            right.append(j[ok])
    if not left:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(left), np.concatenate(right)


def link_edges(fps: DataFrame, distance: int = 3) -> DataFrame:
    """Edges (a, b) whose components are those of all links between the
    distinct fingerprints of ``fps`` (column fp)."""
    masks = key_masks(distance)
    chains = chain_masks(distance)
    starts_of = np.array([s for s, _ in masks])
    keys = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for t, (_, m) in enumerate(masks)])
    rows = fps.select("fp", F.explode(keys).alias("k")).select("k.t", "k.key", "fp")
    crowded = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / F.lit(CHUNK)).cast("int")
    mine = F.pmod(F.xxhash64("fp", "t"), F.col("chunks")).cast("int")
    dealt = (rows.join(crowded, ["t", "key"])
             .withColumn("chunks", chunks).withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("t", "key", F.least("mine", "other").alias("lo"),
                     F.greatest("mine", "other").alias("hi"), "fp"))
    group = ["t", "key", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, group):
            fp = t.column("fp").to_numpy().view(np.uint64)
            left, right = _links_in(fp, starts_of[t.column("t").to_numpy()],
                                    group_starts(t, group), chains, distance)
            root = forest(len(fp), left, right)
            tied = np.flatnonzero(root != np.arange(len(fp)))
            signed = fp.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed[tied]), pa.array(signed[root[tied]])], names=["a", "b"])

    return (dealt.repartition(*group).sortWithinPartitions(*group)
            .mapInArrow(lean(run), "a long, b long"))


def grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, distance: int) -> DataFrame:
    """(id, text_key, fp, grp) for every row: grp is one fingerprint of the
    row's component, the same for all of its rows."""
    if not 0 <= distance < 16:
        raise ValueError("distance must be from 0 to 15")
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    labels = connected_components(link_edges(prints.select("fp").distinct(), distance))
    by_fp = labels.select(F.col("node").alias("fp"), F.col("root").alias("grp"))
    return (prints.join(by_fp, "fp", "left")
            .select("id", "text_key", "fp", F.coalesce("grp", "fp").alias("grp")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, distance: int = 3) -> DataFrame:
    """(id_col, fingerprint, component_id) for every row of ``docs``: the
    fingerprint in hexadecimal and the smallest id reachable over links of at
    most ``distance`` differing bits."""
    rows = stored(grouped(docs, id_col, text_col, shingle, distance).select("id", "fp", "grp"), "groups")
    least = stored(rows.groupBy("grp").agg(F.min("id").alias("component_id")), "least-ids")
    return (rows.join(least, "grp")
            .select(F.col("id").alias(id_col),
                    F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` (all its columns) with one row of each near-duplicate group:
    that of the smallest id, a missing id counting as the largest.  Rows that
    repeat its id and text are reduced to one; if one id names several texts
    of a group, the text of the smaller hash stays."""
    rows = grouped(docs, id_col, text_col, shingle, distance)
    order = F.struct(F.col("id").isNull().alias("nameless"), "id", "text_key")
    rows = rows.groupBy("grp", "id", "text_key").agg(F.count("*").alias("n"))
    kept = stored(rows.groupBy("grp").agg(F.min(order).alias("best"), F.min_by("n", order).alias("n"))
                  .select(F.col("best.id").alias("__kept_id"), F.col("best.text_key").alias("__kept_key"), "n"), "kept")
    marked = docs.withColumn("__text_key", F.xxhash64(F.col(text_col)))
    same = (marked[id_col].cast("long").eqNullSafe(F.col("__kept_id"))
            & (marked["__text_key"] == F.col("__kept_key")))
    # Texts cross the shuffle once; only rows that repeat id and text meet again.
    once = marked.join(kept.where("n = 1").hint("shuffle_hash"), same, "left_semi")
    again = kept.where("n > 1")
    if not again.isEmpty():
        once = once.unionByName(marked.join(again.hint("shuffle_hash"), same, "left_semi")
                                .dropDuplicates([id_col, "__text_key"]))
    return once.drop("__text_key")
