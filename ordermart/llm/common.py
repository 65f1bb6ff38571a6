"""Helpers shared by the operators: tables, scratch tables, Arrow streams."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from ordermart.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read through Spark so any store it supports will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage: later stages read files that survive a lost executor,
    and side results are computed once however often they are used.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_folder(folder: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a folder given by URI or local path, and the
    folder's path in it."""
    if folder.startswith("file:/"):
        folder = "file:///" + folder[len("file:"):].lstrip("/")
    elif "://" not in folder:
        folder = "file://" + folder
    return pafs.FileSystem.from_uri(folder)


SLICE_BYTES = 4 << 20


def sliced(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes (a row at least): Spark
    bounds a batch by its rows, whatever the length of their texts.  Slices share
    the batch's memory; what is made of them does not pile up."""
    for batch in batches:
        todo = [batch]
        while todo:
            part = todo.pop()
            if part.nbytes > most and part.num_rows > 1:
                half = part.num_rows // 2
                todo += [part.slice(half), part.slice(0, half)]
            else:
                yield part


def lean(run: Callable, forget: Callable[[], None] | None = None) -> Callable:
    """A mapInArrow function that works on slices of bounded bytes and gives its
    memory back when its task ends: Spark keeps Python workers, so what one
    stage leaves adds up with the next."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(sliced(batches))
        finally:
            if forget is not None:
                forget()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):   # only with the GNU C library
                ctypes.CDLL("libc.so.6").malloc_trim(0)
    return wrapped


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Re-cut a stream sorted by ``keys`` so that no group is split.

    Holds at most one incoming batch plus one unfinished group; the callers
    bound the size of a group before they shuffle.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        t = pa.Table.from_batches(held).combine_chunks()
        cut = _last_group_start(t, keys)
        if cut:
            yield t.slice(0, cut)
            held = t.slice(cut).combine_chunks().to_batches()
        else:
            held = t.to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _last_group_start(t: pa.Table, keys: list[str]) -> int:
    start = 0
    for k in keys:
        v = t.column(k).to_numpy()
        other = np.flatnonzero(v != v[-1])
        start = max(start, int(other[-1]) + 1 if len(other) else 0)
    return start


def group_starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a new group begins in a sorted table."""
    new = np.zeros(t.num_rows, dtype=bool)
    if len(new):
        new[0] = True
    for k in keys:
        v = t.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each of ``n`` rows over the given links.

    Turns all links found inside one bounded block into at most n - 1 edges.
    """
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        np.minimum.at(label, before, label)
        label = label[label]
        if np.array_equal(label, before):
            return label
