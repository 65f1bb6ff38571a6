import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
import zstandard
from tokenizers import Tokenizer

from ordermart.llm import tokenfiles as tf
from tests.llm import edge

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, dtype="<u4")


def test_chunks_give_the_library_ids(library):
    own = tf.ChunkEncoder(PATH)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 997):
        text = "".join("a" + chr(c) + " " + chr(c) + "1\n" for c in points[i:i + 997])
        assert own.encode([text])[0] == ids_of(library, text).tobytes()
    rng = random.Random(2)
    parts = ["a", "B", "the", "Σ", "́", " ", "  ", "\n", "'s", "9", "İ", "日本", "<|endoftext|>", "\x00", "\t", "\x1c"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    assert own.encode(texts) == [ids_of(library, t).tobytes() for t in texts]


def test_a_chunk_that_texts_repeat_is_looked_up_once(library):
    """op2: a look-up for each of a text's chunks took most of the time."""
    class Counting(dict):
        looked_up = 0

        def __getitem__(self, key):
            self.looked_up += 1
            return super().__getitem__(key)

    own = tf.ChunkEncoder(PATH)
    own.kept = Counting()
    long = "z" * (tf.LONG_CHUNK + 1)
    texts = ["ab cd, ab\nab", "", long, "cd, " + long] * 300 + [" "]
    for _ in range(2):
        assert own.encode(texts) == [ids_of(library, t).tobytes() for t in texts]
    assert own.kept.looked_up <= 10 and long not in own.kept
    assert own.encode([]) == []


def write(docs, frame_bytes):
    sink = io.BytesIO()
    w = tf.Writer(sink, frame_bytes=frame_bytes)
    for i, ids in docs:
        w.add(i, np.array(ids, dtype="<u4").tobytes())
    w.close()
    return sink.getvalue()


def test_reader_decompresses_only_what_is_asked_for():
    docs = [(i, list(range(i * 100, i * 100 + 100))) for i in range(50)] + [(None, []), (99, [7])]
    data = write(docs, 400 * 3)     # three documents a frame
    r = tf.Reader(io.BytesIO(data), len(data))
    assert r.doc_ids == [d for d, _ in docs]
    assert r.ids(31).tolist() == docs[31][1] and r.decompressed == [10]
    assert r.ids(50).tolist() == [] and r.decompressed == [10]
    assert [r.ids(k).tolist() for k in range(len(docs))] == [ids for _, ids in docs]
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain == np.array([x for _, ids in docs for x in ids], dtype="<u4").tobytes()


def test_damage_is_found():
    data = bytearray(write([(1, list(range(1000))), (2, list(range(500)))], 1000))
    r = tf.Reader(io.BytesIO(bytes(data)), len(data))
    at = int(r.file_at[1]) + 12
    data[at] ^= 1
    broken = tf.Reader(io.BytesIO(bytes(data)), len(data))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        for k in range(2):
            broken.ids(k)


def expected(library, rows):
    start, out = 0, []
    def order(row):
        h = 42 if row[1] is None else xxhash.xxh64_intdigest(row[1].encode(), 42)
        return row[0] is not None, row[0] or 0, h - (1 << 64) if h >> 63 else h

    for i, t in sorted(rows, key=order):
        ids = np.append(ids_of(library, t), 1).astype("<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_given_and_edge_documents(spark, library):
    given_docs = spark.read.parquet(f"{edge.SF}/documents.parquet")
    for docs in (given_docs, edge.documents(spark), edge.documents(spark, [])):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        folder = tf.token_folder(spark)
        manifest = tf.write_token_files(docs, folder, PATH)
        got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32)
               for r in tf.read_token_files(spark, folder, manifest).collect()]
        assert sorted(got, key=lambda r: r[1]) == expected(library, rows)


def test_wanted_documents(spark, library):
    docs = spark.read.parquet(f"{edge.SF}/documents.parquet")
    folder = tf.token_folder(spark)
    manifest = tf.write_token_files(docs, folder, PATH)
    wanted = spark.createDataFrame([(3,), (77,), (3,), (-5,)], "doc_id long")
    got = {r.doc_id: r.ids for r in tf.read_documents(spark, folder, manifest, wanted).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got == {i: [*ids_of(library, texts[i]).tolist(), 1] for i in (3, 77)}
