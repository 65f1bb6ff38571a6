"""Token ids in seekable binary files.

A file is a row of independent zstandard frames, then two skippable frames: a
document index and the seek table.

    data frame *        ids as little-endian unsigned 32-bit integers
    skippable 184D2A50  Arrow stream: doc_id, n_tokens of each document in order
    skippable 184D2A5E  seek table of the public zstandard seekable format:
                        (compressed size, size, XXH64 checksum's low 32 bits)
                        of each data frame, frame count, descriptor, 8F92EAB1

Any zstandard tool decompresses the file to the plain ids.  A reader of some
documents reads the tail, then only the frames their ids lie in.  Long
documents run over several frames, so neither side holds a file's ids at once.

Tasks write under a name of their own attempt and rename when complete, so a
lost executor leaves no half file under a final name; the manifest of the
finished attempts decides which files are read.  The folder is any store that
Arrow's file systems open by URI.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ordermart.llm.common import lean, open_folder, stored
from ordermart.session import scratch_path

# Magic numbers of the zstandard formats.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_BYTES = 1 << 18     # ids of one frame, before compression
KEPT_CHUNKS = 1_500_000     # bound of a worker's table of encoded chunks
LONG_CHUNK = 200          # longer chunks are encoded but not kept
# Marks behind letters that begin no contraction and no special token: the
# tokenizer's own pre-tokenizer parts these.
MARKS = r"""!"#$%&()*+,-./:;=>?@[\]^_`{}~"""
MANIFEST = "file string, part int, n_docs long, n_ids long, n_frames long, bytes long"


# -- tokenizer -----------------------------------------------------------------

class ChunkEncoder:
    """The tokenizers library's encode, one blank-separated chunk at a time.

    Only for tokenizers whose normalizer and pre-tokenizer never join what
    stands on both sides of a blank (word_bpe_49k drops white space), so that a
    text's ids are those of its chunks in a row.  Each chunk's ids come from
    the library and are kept in a bounded table.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        suffix = self.tokenizer.model.end_of_word_suffix
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends_word[i] = bool(suffix) and token.endswith(suffix)
        self.kept: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}      # words and marks of chunks

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text. A chunk that texts repeat is looked up once:
        Arrow numbers the chunks and numpy gathers their ids."""
        parts = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        numbered = parts.flatten().dictionary_encode()
        packed = self._packed(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        known = np.frombuffer(b"".join(packed), dtype="<u4")
        chunk = numbered.indices.to_numpy()
        n = sizes[chunk]
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat((np.cumsum(sizes) - sizes)[chunk] - ends[:-1], n)
        at += np.arange(len(at))
        ids = known[at]
        cuts = ends[parts.offsets.to_numpy()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def _packed(self, chunks: list[str]) -> list[bytes]:
        """Packed ids of different chunks, kept or new."""
        if len(self.kept) > KEPT_CHUNKS:
            self.kept.clear()
        kept, long = self.kept, {}
        for c, ids in self._encode_chunks({c for c in chunks if c not in kept}):
            (kept if len(c) <= LONG_CHUNK else long)[c] = ids
        if long:
            return [long[c] if c in long else kept[c] for c in chunks]
        return [*map(kept.__getitem__, chunks)]

    def _encode_chunks(self, chunks: set[str]) -> Iterator[tuple[str, bytes]]:
        """A word with marks behind it is two words to the library, and a
        capital is a small letter; so few of the chunks not met before hold a
        word not met before."""
        parted, rest = [], []
        for c in chunks:
            w = c.rstrip(MARKS)
            if w.isalpha():
                parted.append((c, w.lower() if w.isascii() else w, c[len(w):]))
            else:
                rest.append(c)
        if len(self.words) > KEPT_CHUNKS // 4:
            self.words.clear()
        words = self.words
        words.update(self._encode_words({w for _, w, _ in parted}.difference(words)))
        marks = {m for _, _, m in parted if m}
        words.update(self._encode_each(list(marks.difference(words))))
        words[""] = b""
        yield from ((c, words[w] + words[m]) for c, w, m in parted)
        yield from self._encode_each(rest)

    def _encode_words(self, words: set[str]) -> Iterator[tuple[str, bytes]]:
        """Words of letters go to the library many at a time, joined by blanks:
        each is one word to it, and the marks of word ends tell them apart again."""
        words = list(words)
        for i in range(0, len(words), 500):
            some = words[i:i + 500]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, dtype="<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(some):
                packed = ids.tobytes()
                yield from zip(some, (packed[4 * a:4 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())))
            else:
                yield from self._encode_each(some)

    def _encode_each(self, chunks: list[str]) -> Iterator[tuple[str, bytes]]:
        for c, e in zip(chunks, self.tokenizer.encode_batch(chunks, add_special_tokens=False)):
            yield c, np.array(e.ids, dtype="<u4").tobytes()


@lru_cache(maxsize=4)
def encoder(path: str) -> ChunkEncoder:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs one task per core
    return ChunkEncoder(path)


# -- format --------------------------------------------------------------------

class Writer:
    """Appends documents to one file."""

    def __init__(self, sink, level: int = 3, frame_bytes: int = FRAME_BYTES):
        self.sink, self.frame_bytes = sink, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.held = bytearray()
        self.frames: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        self.written = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.held += ids
        while len(self.held) >= self.frame_bytes:
            self._frame(bytes(self.held[:self.frame_bytes]))
            del self.held[:self.frame_bytes]

    def _frame(self, data: bytes) -> None:
        packed = self.packer.compress(data)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self._put(packed)

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.written += len(data)

    def close(self) -> None:
        if self.held:
            self._frame(bytes(self.held))
        index = pa.record_batch({"doc_id": pa.array(self.doc_ids, pa.int64()),
                                 "n_tokens": pa.array(self.counts, pa.int64())})
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, index.schema) as stream:
            stream.write_batch(index)
        body = self.packer.compress(out.getvalue().to_pybytes())
        body += struct.pack("<I", xxhash.xxh64_intdigest(body) & 0xFFFFFFFF)
        self._put(struct.pack("<II", SKIPPABLE_INDEX, len(body)) + body)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self._put(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table)) + table)


class Reader:
    """Random access to one file (an object with seek, read and size)."""

    def __init__(self, source, size: int):
        self.source = source
        self.unpacker = zstandard.ZstdDecompressor()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("not a token file")
        table = self._at(size - 9 - 12 * n - 8, 8 + 12 * n)
        if struct.unpack("<II", table[:8]) != (SKIPPABLE_SEEK_TABLE, 12 * n + 9):
            raise ValueError("damaged seek table")
        self.frames = np.frombuffer(table[8:], dtype="<u4").reshape(n, 3)
        self.file_at = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(self.frames[:, 0], out=self.file_at[1:])
        self.data_at = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(self.frames[:, 1], out=self.data_at[1:])
        at = int(self.file_at[-1])
        magic, length = struct.unpack("<II", self._at(at, 8))
        body = self._at(at + 8, length)
        if magic != SKIPPABLE_INDEX or struct.unpack("<I", body[-4:])[0] != xxhash.xxh64_intdigest(body[:-4]) & 0xFFFFFFFF:
            raise ValueError("damaged document index")
        index = pa.ipc.open_stream(self.unpacker.decompress(body[:-4])).read_all()
        self.doc_ids: list[int | None] = index.column("doc_id").to_pylist()
        self.starts = np.zeros(index.num_rows + 1, dtype=np.int64)
        np.cumsum(index.column("n_tokens").to_numpy(), out=self.starts[1:])
        self.decompressed: list[int] = []   # frames read so far, in order
        self._last: tuple[int, bytes] = (-1, b"")

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(n)

    def _frame(self, k: int) -> bytes:
        if self._last[0] != k:
            data = self.unpacker.decompress(self._at(int(self.file_at[k]), int(self.frames[k, 0])),
                                            max_output_size=int(self.frames[k, 1]))
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != int(self.frames[k, 2]):
                raise ValueError(f"checksum of frame {k} differs")
            self.decompressed.append(k)
            self._last = (k, data)
        return self._last[1]

    def pieces(self, row: int) -> Iterator[bytes]:
        """The packed ids of the document in the given row, frame by frame."""
        at, end = 4 * int(self.starts[row]), 4 * int(self.starts[row + 1])
        k = int(np.searchsorted(self.data_at, at, side="right")) - 1
        while at < end:
            stop = min(end, int(self.data_at[k + 1]))
            base = int(self.data_at[k])
            yield self._frame(k)[at - base:stop - base]
            at, k = stop, k + 1

    def ids(self, row: int) -> np.ndarray:
        return np.frombuffer(b"".join(self.pieces(row)), dtype="<u4")


# -- Spark ---------------------------------------------------------------------

def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, append ``end_id`` and write the ids in ascending
    order of id (no id first, equal ids by XXH64 of the text) to files below
    ``folder``.  Returns the manifest: one row a file, ``part`` in that order.
    An id that many rows share is split over files by that hash.

    A null text is empty (its only id is ``end_id``); repeated rows repeat; an
    empty table gives no file.  Other columns are ignored.
    """
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("key"),
                        F.col(text_col).alias("text"))
            .repartitionByRange("id", "key").sortWithinPartitions("id", "key", "text"))
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        fs, base = open_folder(folder)
        name = f"part-{part:06d}-{attempt}.tok"
        hidden = f"{base}/_writing-{name}"
        writer = sink = None
        for some in batches:
            if writer is None:
                fs.create_dir(base, recursive=True)
                sink = fs.open_output_stream(hidden, compression=None)
                writer = Writer(sink)
            texts = [t or "" for t in some.column("text").to_pylist()]
            for doc_id, ids in zip(some.column("id").to_pylist(), encoder(tokenizer_path).encode(texts)):
                writer.add(doc_id, ids + end)
        if writer is not None:
            writer.close()
            sink.close()
            fs.move(hidden, f"{base}/{name}")
            yield pa.record_batch({"file": [name], "part": pa.array([part], pa.int32()),
                                   "n_docs": [len(writer.counts)], "n_ids": [sum(writer.counts)],
                                   "n_frames": [len(writer.frames)], "bytes": [writer.written]})

    return stored(rows.mapInArrow(lean(run), MANIFEST), "token-manifest")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files:
    ids are read frame by frame, each frame's checksum checked.  ``start`` is
    the number of ids before the document in all files."""
    total = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("file", "part", F.coalesce(total, F.lit(0)).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist()):
                fs, base = open_folder(folder)
                with fs.open_input_file(f"{base}/{name}") as source:
                    reader = Reader(source, source.size())
                    crcs = []
                    for row in range(len(reader.doc_ids)):
                        crc = 0
                        for piece in reader.pieces(row):
                            crc = zlib.crc32(piece, crc)
                        crcs.append(crc)
                    yield pa.record_batch({
                        "doc_id": pa.array(reader.doc_ids, pa.int64()),
                        "start": pa.array(reader.starts[:-1] + before),
                        "n_tokens": pa.array(np.diff(reader.starts)),
                        "ids_crc32": pa.array(crcs, pa.int64())})

    return (_one_file_a_task(spark, files)
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def read_documents(spark: SparkSession, folder: str, manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids) of the documents whose ids are in ``wanted`` (doc_id);
    only the frames that hold them are decompressed."""
    index = read_index(spark, folder, manifest)
    ask = (index.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
           .select("file", "row").repartition("file").sortWithinPartitions("file", "row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, reader, source = None, None, None
        for batch in batches:
            ids, docs = [], []
            for file, row in zip(batch.column("file").to_pylist(), batch.column("row").to_pylist()):
                if file != name:
                    if source is not None:
                        source.close()
                    fs, base = open_folder(folder)
                    source = fs.open_input_file(f"{base}/{file}")
                    name, reader = file, Reader(source, source.size())
                docs.append(reader.doc_ids[row])
                ids.append(reader.ids(row).tolist())
            yield pa.record_batch({"doc_id": pa.array(docs, pa.int64()),
                                   "ids": pa.array(ids, pa.list_(pa.int64()))})
        if source is not None:
            source.close()

    return ask.mapInArrow(run, "doc_id long, ids array<long>")


def read_index(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(file, row, doc_id, n_tokens) from the files' document indexes; no data
    frame is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                fs, base = open_folder(folder)
                with fs.open_input_file(f"{base}/{name}") as source:
                    reader = Reader(source, source.size())
                n = len(reader.doc_ids)
                yield pa.record_batch({"file": pa.array([name] * n, pa.string()),
                                       "row": pa.array(np.arange(n)),
                                       "doc_id": pa.array(reader.doc_ids, pa.int64()),
                                       "n_tokens": pa.array(np.diff(reader.starts))})

    return (_one_file_a_task(spark, manifest.select("file", "part"))
            .mapInArrow(run, "file string, row long, doc_id long, n_tokens long"))


def _one_file_a_task(spark: SparkSession, files: DataFrame) -> DataFrame:
    return files.repartitionByRange(max(1, files.count()), "part")


def token_folder(spark: SparkSession) -> str:
    """A new folder below the shared scratch folder."""
    return scratch_path(spark, "token-files")
