"""Near-duplicate embeddings by NN-descent.

Links are pairs of vectors of equal label whose cosine is at least a
threshold.  A neighbour graph is started from random hyperplane codes (vectors
next to each other in the order of their codes, for several sets of planes) and
refined by joining neighbours of neighbours: the lists that meet in a vector
are compared with each other, and better neighbours replace worse ones, until
hardly any list changes.  A list whose entries all are links is saturated and
grows to twice its links; a vector with more links than the longest list is
finished exactly, by comparing it with the members of its component block by
block and counting.  So no list cuts a link off.

The result is audited: vectors drawn by hash are compared with all vectors, and
while recall is below the target the search goes on with longer lists and other
planes.  Recall is the mean of the shares of each audited vector's linked vectors
that were found, so that a vector with one link weighs as much as one with
thousands; vectors counted block by block and all others are audited apart, and
the worse of the two decides.  Vectors without a link say nothing, so each part
is drawn from until LINKED vectors with links are audited, or all of its vectors.
The search ends when the mean reaches the target and its lower confidence bound
LEAST; it fails when the bound is lower after the last round.

Equal vectors are one vertex with a count.  A vector in many lists has its
reverse neighbours dealt into chunks, each compared with its whole own list.
All comparisons are numpy blocks of bounded size in Spark tasks; cosines are
computed in double precision.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and those without a label, link with nothing and are components of
their own; vectors of different lengths never link; rows that repeat are
vectors of their own that link with each other; a null id is never a component
id unless the whole component has none; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ordermart.llm.common import group_starts, stored, whole_groups
from ordermart.llm.components import connected_components

log = logging.getLogger(__name__)

NEIGHBOURS = 10       # list length of a vector that is not saturated
LONGEST = 64          # list length up to which saturated lists grow
TABLES = 6            # sets of hyperplanes of one start
PLANES = 32           # code bits
NEXT = 8              # places to either side compared in the order of codes
REVERSE_CHUNK = 64    # reverse neighbours compared at once
BLOCK = 2048          # rows of a block in the exact count
TURNS = 12            # refinement turns of one round, at most
SETTLED = 0.005       # share of changed entries at which a round ends
AUDIT = 400           # vectors drawn at first from each part, about
LINKED = 100          # audited vectors with links that a recall rests on
ASKED_BYTES = 16 << 20   # audited vectors sent to the tasks at once
CELLS = 1 << 22       # cosines a task holds at once in the audit
TARGET = 0.98         # audited recall at which the search ends
LEAST = 0.9           # lower bound of recall below which the job fails after all rounds
BOUND_Z = 1.645       # of the bound: one-sided, 95 %
ROUNDS = 5


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Unit rows, in double precision; all lists have one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)     # no overflow in the norm
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


# -- vertices ----------------------------------------------------------------------

def _usable(embedding: str) -> Column:
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    some = F.exists(embedding, lambda x: x != 0)
    return F.coalesce((F.size(embedding) > 0) & ~bad & some, F.lit(False))


def _vertices(rows: DataFrame) -> DataFrame:
    """(rid, label, dim, vec, n, first) of each distinct vector of a label."""
    distinct = (rows.where("usable").groupBy("label", "vec")
                .agg(F.count("*").alias("n"), F.min("id").alias("first")))
    return stored(distinct.select(F.monotonically_increasing_id().alias("rid"), "label",
                                  F.size("vec").alias("dim"), "vec", "n", "first"), "vertices")


# -- start -------------------------------------------------------------------------

def _start(vertices: DataFrame, seed: int, keep: int) -> DataFrame:
    """(u, v, s): for every set of planes, each vector's best ``keep`` of the
    vectors next to it in the order of the codes."""
    vec_type = dict(vertices.dtypes)["vec"]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            dims = whole.column("dim").to_numpy()
            for dim in np.unique(dims):
                batch = whole.filter(pa.array(dims == dim))
                x = _matrix(batch.column("vec"))
                for t in range(TABLES):
                    planes = np.random.default_rng([seed, t, int(dim)]).standard_normal((int(dim), PLANES + 1))
                    y = x @ planes
                    bits = (y[:, :PLANES] > 0) @ (1 << np.arange(PLANES - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), t, dtype=np.int32)), batch.column("label"),
                         batch.column("dim"), pa.array(bits), pa.array(y[:, PLANES]), batch.column("rid"),
                         batch.column("vec")], names=["t", "label", "dim", "code", "along", "rid", "vec"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*tail, batch]).combine_chunks()
            tail = table.slice(max(0, table.num_rows - NEXT)).combine_chunks().to_batches()
            starts = group_starts(table, ["t", "label", "dim"])
            for a, b in zip(starts, [*starts[1:], table.num_rows]):
                if b - a > 1:
                    some = table.slice(a, b - a)
                    yield _adjacent(some.column("rid").to_numpy(), _matrix(some.column("vec")), keep)

    keys = ["t", "label", "dim", "code", "along"]
    coded = vertices.select("rid", "label", "dim", "vec").mapInArrow(
        code, f"t int, label long, dim int, code long, along double, rid long, vec {vec_type}")
    return (coded.repartitionByRange(*keys).sortWithinPartitions(*keys)
            .mapInArrow(pairs, "u long, v long, s double"))


def _adjacent(rid: np.ndarray, x: np.ndarray, keep: int) -> pa.RecordBatch:
    n = len(rid)
    near = np.full((n, 2 * NEXT), -2.0)
    other = np.zeros((n, 2 * NEXT), dtype=np.int64)
    for d in range(1, min(NEXT, n - 1) + 1):
        s = np.einsum("ij,ij->i", x[:-d], x[d:])
        near[:-d, d - 1], other[:-d, d - 1] = s, rid[d:]
        near[d:, NEXT + d - 1], other[d:, NEXT + d - 1] = s, rid[:-d]
    best = np.argpartition(-near, min(keep, 2 * NEXT - 1), axis=1)[:, :keep]
    u = np.repeat(rid, best.shape[1])
    s = np.take_along_axis(near, best, axis=1).ravel()
    v = np.take_along_axis(other, best, axis=1).ravel()
    there = s > -2
    return pa.record_batch({"u": pa.array(u[there]), "v": pa.array(v[there]), "s": pa.array(s[there])})


# -- refinement --------------------------------------------------------------------

def _best(candidates: DataFrame, threshold: float, neighbours: int) -> DataFrame:
    """Lists (u, v, s, fresh, room) from candidate entries (u, v, s, fresh):
    distinct neighbours by falling cosine, as many as a list has room for -
    ``neighbours``, or twice the links of a saturated list up to LONGEST or, if
    that is more, ``neighbours``."""
    longest = max(LONGEST, neighbours)
    entries = candidates.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
    rank = Window.partitionBy("u").orderBy(F.desc("s"), "v")
    ranked = entries.withColumn("nth", F.row_number().over(rank)).where(F.col("nth") <= longest)
    links = F.sum((F.col("s") >= threshold).cast("int")).over(Window.partitionBy("u"))
    room = F.least(F.lit(longest), F.greatest(F.lit(neighbours), 2 * links))
    return ranked.withColumn("room", room).where("nth <= room").select("u", "v", "s", "fresh", "room")


def _turn(lists: DataFrame, vertices: DataFrame, threshold: float, neighbours: int) -> DataFrame:
    """One turn: neighbours that meet in a vector are compared."""
    # A list's worst entry bounds what can improve it; a list with room takes all.
    state = lists.groupBy("u").agg(F.when(F.count("*") >= F.max("room"), F.min("s")).otherwise(-2.0).alias("bound"))
    forward = lists.select(F.col("u").alias("mid"), F.col("v").alias("member"), "fresh")
    reverse = lists.select(F.col("v").alias("mid"), F.col("u").alias("member"), "fresh")
    counts = reverse.groupBy("mid").agg(F.ceil(F.count("*") / REVERSE_CHUNK).cast("int").alias("chunks"))
    in_chunks = F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1))
    mine = F.pmod(F.xxhash64("member"), "chunks").cast("int")
    meeting = (forward.join(counts, "mid", "left").select("mid", "member", "fresh", in_chunks.alias("chunk"))
               .unionByName(reverse.join(counts, "mid").select("mid", "member", "fresh", mine.alias("chunk")))
               .groupBy("mid", "chunk", "member").agg(F.max("fresh").alias("fresh")))
    active = meeting.groupBy("mid", "chunk").agg(F.max("fresh").alias("any"), F.count("*").alias("n")) \
        .where("any and n > 1").select("mid", "chunk")
    known = (vertices.select(F.col("rid").alias("member"), "vec")
             .join(state.withColumnRenamed("u", "member"), "member", "left")
             .select("member", "vec", F.coalesce("bound", F.lit(-2.0)).alias("bound")))
    group = ["mid", "chunk"]
    dealt = (meeting.join(active, group).join(stored(known, "known"), "member")
             .select("mid", "chunk", "member", "fresh", "bound", "vec")
             .repartition(*group).sortWithinPartitions(*group))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, group):
            starts = group_starts(t, group)
            member, fresh = t.column("member").to_numpy(), t.column("fresh").to_numpy(zero_copy_only=False)
            bound = t.column("bound").to_numpy()
            out = []
            for a, b in zip(starts, [*starts[1:], t.num_rows]):
                x = _matrix(t.column("vec").slice(a, b - a))
                s = x @ x.T
                new = fresh[a:b, None] | fresh[None, a:b]
                np.fill_diagonal(new, False)
                i, j = np.nonzero(new & (s > bound[a:b, None]))
                out.append((member[a + i], member[a + j], s[i, j]))
            u, v, s = (np.concatenate(c) for c in zip(*out))
            order = np.lexsort((v, u))          # a pair may meet in many vectors
            u, v, s = u[order], v[order], s[order]
            once = np.ones(len(u), dtype=bool)
            once[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
            u, v, s = u[once], v[once], s[once]
            yield pa.record_batch({"u": pa.array(u), "v": pa.array(v), "s": pa.array(s)})

    found = dealt.mapInArrow(run, "u long, v long, s double").withColumn("fresh", F.lit(True))
    old = lists.select("u", "v", "s", F.lit(False).alias("fresh"))
    return _best(old.unionByName(found), threshold, neighbours)


def _refine(lists: DataFrame, vertices: DataFrame, threshold: float, neighbours: int, n: int) -> DataFrame:
    for _ in range(TURNS):
        lists = stored(_turn(lists, vertices, threshold, neighbours), "lists")
        if lists.where("fresh").count() <= SETTLED * n * neighbours:
            break
    return lists


# -- links -------------------------------------------------------------------------

def _degrees(lists: DataFrame, vertices: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(rid, links, peers, exact) and (node, root): the links found of every
    vertex that has one, equal vectors apart, the vertices they lead to, and
    whether its component was counted in blocks; and the components."""
    ends = lists.where(F.col("s") >= threshold)
    both = (ends.select("u", "v").unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
            .distinct())
    both = stored(both, "links")
    roots = connected_components(both.select(F.col("u").alias("a"), F.col("v").alias("b")))
    weights = vertices.select(F.col("rid").alias("v"), "n")
    counted = (both.join(weights, "v").groupBy(F.col("u").alias("rid"))
               .agg(F.sum("n").alias("links"), F.count("*").alias("peers"), F.lit(False).alias("exact")))
    # Lists that are full of links may have cut some: what these vectors link with is
    # counted out, among themselves and with the rest of their components.
    full = stored(ends.groupBy("u").agg(F.count("*").alias("k"), F.max("room").alias("room")).where("k >= room")
                  .select(F.col("u").alias("node")), "full")
    if full.isEmpty():
        return counted, roots
    placed = roots.join(vertices.withColumnRenamed("rid", "node"), "node").select("root", "node", "n", "vec")
    crowded = stored(placed.join(full, "node", "left_semi"), "crowded")
    beside = stored(placed.join(crowded.select("root").distinct(), "root", "left_semi")
                    .join(full, "node", "left_anti"), "beside")
    listed = (both.join(full.withColumnRenamed("node", "u"), "u", "left_anti")
              .join(full.withColumnRenamed("node", "v"), "v", "left_anti").join(weights, "v")
              .groupBy(F.col("u").alias("rid")).agg(F.sum("n").alias("links"), F.count("*").alias("peers")))
    parts = (listed.withColumn("exact", F.lit(False))
             .unionByName(_count_in_blocks(crowded, threshold).withColumn("exact", F.lit(True)))
             .unionByName(_count_between(crowded, beside, threshold).withColumn("exact", F.lit(True))))
    return (parts.groupBy("rid").agg(F.sum("links").alias("links"), F.sum("peers").alias("peers"),
                                     F.max("exact").alias("exact")), roots)


def _count_in_blocks(members: DataFrame, threshold: float) -> DataFrame:
    """(rid, links, peers) of all members of components (root, node, n, vec):
    every pair of a component's blocks is compared in one task; only counts
    leave."""
    sizes = members.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    pairs = (members.join(sizes, "root").withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("root", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
                     "mine", "node", "n", "vec"))
    group = ["root", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, group):
            starts = group_starts(t, group)
            node, n = t.column("node").to_numpy(), t.column("n").to_numpy()
            mine, lo, hi = (t.column(c).to_numpy() for c in ("mine", "lo", "hi"))
            for a, b in zip(starts, [*starts[1:], t.num_rows]):
                x = _matrix(t.column("vec").slice(a, b - a))
                left = mine[a:b] == lo[a]
                right = mine[a:b] == hi[a]
                linked = (x[left] @ x[right].T) >= threshold
                if lo[a] == hi[a]:
                    np.fill_diagonal(linked, False)
                    ids, sums, peers = node[a:b], linked @ n[a:b], linked.sum(axis=1)
                else:
                    ids = np.concatenate([node[a:b][left], node[a:b][right]])
                    sums = np.concatenate([linked @ n[a:b][right], n[a:b][left] @ linked])
                    peers = np.concatenate([linked.sum(axis=1), linked.sum(axis=0)])
                yield pa.record_batch({"rid": pa.array(ids), "links": pa.array(sums.astype(np.int64)),
                                       "peers": pa.array(peers.astype(np.int64))})

    return (pairs.repartition(*group).sortWithinPartitions(*group)
            .mapInArrow(run, "rid long, links long, peers long")
            .groupBy("rid").agg(F.sum("links").alias("links"), F.sum("peers").alias("peers")))


def _count_between(crowded: DataFrame, beside: DataFrame, threshold: float) -> DataFrame:
    """(rid, links, peers) of the links between the vectors ``crowded`` and the
    vectors ``beside`` them in their components (both root, node, n, vec), by
    pairs of blocks."""
    blocks = F.ceil(F.count("*") / BLOCK).cast("int")
    sizes = (crowded.groupBy("root").agg(blocks.alias("left"))
             .join(beside.groupBy("root").agg(blocks.alias("right")), "root"))

    def dealt(rows: DataFrame, asks: bool) -> DataFrame:
        own, other = ("left", "right") if asks else ("right", "left")
        named = rows.join(sizes, "root").withColumn("own", F.pmod(F.xxhash64("node"), own).cast("int"))
        named = named.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        at = {"a": "own", "b": "other"} if asks else {"a": "other", "b": "own"}
        return named.select("root", *[F.col(c).alias(k) for k, c in at.items()], F.lit(asks).alias("asks"),
                            "node", "n", "vec")

    group = ["root", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, group):
            starts = group_starts(t, group)
            node, n = t.column("node").to_numpy(), t.column("n").to_numpy()
            asks = t.column("asks").to_numpy()
            for a, b in zip(starts, [*starts[1:], t.num_rows]):
                ask = asks[a:b]
                if ask.all() or not ask.any():
                    continue
                x = _matrix(t.column("vec").slice(a, b - a))
                linked = (x[ask] @ x[~ask].T) >= threshold
                ids = np.concatenate([node[a:b][ask], node[a:b][~ask]])
                sums = np.concatenate([linked @ n[a:b][~ask], n[a:b][ask] @ linked])
                peers = np.concatenate([linked.sum(axis=1), linked.sum(axis=0)])
                yield pa.record_batch({"rid": pa.array(ids), "links": pa.array(sums.astype(np.int64)),
                                       "peers": pa.array(peers.astype(np.int64))})

    return (dealt(crowded, True).unionByName(dealt(beside, False))
            .repartition(*group).sortWithinPartitions(*group)
            .mapInArrow(run, "rid long, links long, peers long"))


# -- audit -------------------------------------------------------------------------

def _true_peers(vertices: DataFrame, asked: pa.Table, threshold: float) -> DataFrame:
    """(rid, true_peers) of the vectors ``asked``, which are sent to the tasks:
    how many of all vertices they link with."""
    sent = vertices.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        a_dims, a_labels = asked.column("dim").to_numpy(), asked.column("label").to_numpy()
        a_rids = asked.column("rid").to_numpy()
        sums = np.zeros(len(a_rids), dtype=np.int64)
        queries = {int(d): (np.flatnonzero(a_dims == d),
                            _matrix(asked.column("vec").take(pa.array(np.flatnonzero(a_dims == d)))))
                   for d in np.unique(a_dims)}
        step = max(1, CELLS // max(1, len(a_rids)))
        for whole in batches:
            dims = whole.column("dim").to_numpy()
            for d, (rows, q) in queries.items():
                mine = whole.filter(pa.array(dims == d))
                for at in range(0, mine.num_rows, step):
                    batch = mine.slice(at, step)
                    same = a_labels[rows][:, None] == batch.column("label").to_numpy()[None, :]
                    same &= a_rids[rows][:, None] != batch.column("rid").to_numpy()[None, :]
                    linked = same & (q @ _matrix(batch.column("vec")).T >= threshold)
                    sums[rows] += linked.sum(axis=1)
        yield pa.record_batch({"rid": pa.array(a_rids), "peers": pa.array(sums)})

    counted = stored(vertices.select("rid", "label", "dim", "vec").mapInArrow(run, "rid long, peers long")
                     .groupBy("rid").agg(F.sum("peers").alias("true_peers")), "audit")
    sent.destroy()
    return counted


def _asked(chosen: DataFrame, vertices: DataFrame, truth: DataFrame | None, threshold: float) -> DataFrame:
    """``truth`` (rid, true_peers) with the ``chosen`` vectors it lacks.  They are
    read to the driver and compared in blocks of bounded size."""
    todo = chosen if truth is None else chosen.join(truth, "rid", "left_anti")
    todo = stored(vertices.join(todo, "rid", "left_semi").select("rid", "label", "dim", "vec"), "asked")
    n, dim = todo.agg(F.count("*"), F.coalesce(F.max("dim"), F.lit(1))).first()
    blocks = -(-n * dim * 8 // ASKED_BYTES)
    for b in range(blocks):
        mine = F.pmod(F.xxhash64("rid", F.lit("block")), F.lit(blocks)) == b
        found = _true_peers(vertices, todo.where(mine).toArrow(), threshold)
        truth = found if truth is None else truth.unionByName(found)
    return todo.selectExpr("rid", "0L true_peers") if truth is None else truth


def _lower_bound(mean: float, number: int) -> float:
    """Wilson's lower bound of a mean of ``number`` shares; shares between 0 and
    1 vary no more than hits and misses of the same mean."""
    z2 = BOUND_Z ** 2 / number
    half = BOUND_Z * (mean * (1 - mean) / number + z2 / (4 * number)) ** 0.5
    return (mean + z2 / 2 - half) / (1 + z2)


def _audit(vertices: DataFrame, degrees: DataFrame, truth: DataFrame | None,
           threshold: float) -> tuple[DataFrame, float, float]:
    """(truth, recall, bound): recall of the worse part and the lower of the
    parts' bounds.  A vector's place in the draw is a hash, so what was audited in
    an earlier round is not compared again."""
    lot = F.pmod(F.xxhash64("rid", F.lit("audit")), F.lit(1 << 30)) / (1 << 30)
    counted = degrees.where("exact").select("rid")
    recall = bound = 1.0
    for name, part in (("counted", counted), ("listed", vertices.select("rid").join(counted, "rid", "left_anti"))):
        part = stored(part, f"audit-{name}")
        n = part.count()
        share = min(1.0, AUDIT / max(1, n))
        while n:
            chosen = part.where(lot < share)
            truth = _asked(chosen, vertices, truth, threshold)
            linked = truth.where("true_peers > 0").join(chosen, "rid", "left_semi")
            k = linked.count()
            if k >= LINKED or share == 1.0:
                break
            share = min(1.0, share * min(16, max(2, 2 * LINKED / max(1, k))))
        if n and k:
            mean = _recall(linked, degrees)
            least = mean if share == 1.0 else _lower_bound(mean, k)
            log.info("recall of %s vectors: %.4f, at least %.4f, over %d of %d with links", name, mean, least, k, n)
            recall, bound = min(recall, mean), min(bound, least)
    return truth, recall, bound


def _recall(truth: DataFrame, degrees: DataFrame) -> float:
    """Mean share of an audited vector's linked vertices that were found, over
    the vectors that have one: of those counted in blocks or of the others,
    whichever is worse."""
    share = F.least("true_peers", F.coalesce("peers", F.lit(0))) / F.col("true_peers")
    means = (truth.where("true_peers > 0").join(degrees, "rid", "left")
             .groupBy(F.coalesce("exact", F.lit(False)).alias("exact")).agg(F.avg(share).alias("recall")))
    return min((r["recall"] for r in means.collect()), default=1.0)


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.93, neighbours: int = NEIGHBOURS, target: float = TARGET) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row of ``table``."""
    rows = stored(table.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                               F.col(vec_col).alias("vec"))
                  .withColumn("usable", F.col("label").isNotNull() & _usable("vec")), "vectors")
    vertices = _vertices(rows)
    n = vertices.count()
    truth = lists = None
    for r in range(ROUNDS):
        started = _start(vertices, r, neighbours).withColumn("fresh", F.lit(True))
        if lists is not None:
            started = started.unionByName(lists.select("u", "v", "s", F.lit(False).alias("fresh")))
        lists = stored(_best(started, threshold, neighbours), "lists")
        lists = _refine(lists, vertices, threshold, neighbours, n)
        degrees, roots = _degrees(lists, vertices, threshold)
        degrees = stored(degrees, "degrees")
        truth, recall, bound = _audit(vertices, degrees, truth, threshold)
        if recall >= target and bound >= LEAST:
            break
        neighbours *= 2
    if bound < LEAST:
        raise RuntimeError(f"audited recall {recall:.3f}, at least {bound:.3f}, is below {LEAST} after {ROUNDS} rounds")
    return _result(rows, vertices, degrees, roots, id_col)


def _result(rows: DataFrame, vertices: DataFrame, degrees: DataFrame, roots: DataFrame, id_col: str) -> DataFrame:
    named = vertices.join(roots.withColumnRenamed("node", "rid"), "rid", "left")
    least = stored(named.where("root is not null").groupBy("root").agg(F.min("first").alias("least")), "least-ids")
    known = stored(
        named.join(least, "root", "left").join(degrees, "rid", "left")
        .select(F.lit(True).alias("usable"), "label", "vec",
                (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                F.coalesce("least", "first").alias("component_id")), "vertex-results")
    return (rows.join(known, ["usable", "label", "vec"], "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))
