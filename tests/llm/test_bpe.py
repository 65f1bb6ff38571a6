import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ordermart.llm import bpe
from tests.llm import edge

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    library = Tokenizer.from_file(PATH) if not hasattr(test_any_text, "t") else test_any_text.t
    test_any_text.t = library
    ids = bpe.load(PATH).encode(text)
    assert ids == ids_of(library, text)
    assert bpe.load(PATH).decode(np.frombuffer(ids, "<u4")) == library.decode(
        library.encode(text, add_special_tokens=False).ids, skip_special_tokens=False)


def test_every_code_point(library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    own = bpe.load(PATH)
    for i in range(0, len(points), 997):
        text = "".join("a" + chr(c) + " " + chr(c) + "1" for c in points[i:i + 997])
        assert own.encode(text) == ids_of(library, text)


def test_runs_and_special_strings(library):
    own = bpe.load(PATH)
    rng = random.Random(4)
    parts = ["a", "aa", "aaaa", "the", "in", " ", "  ", "\n", "'s", "9", "é", "日本", "<|endoftext|>", "\x00", "!!"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert own.encode(text) == ids_of(library, text)
    for text in ("ab" * 20_000, "a" * 30_000, " " * 5000, "<|endoftext|>" * 3):
        assert own.encode(text) == ids_of(library, text)


def test_damaged_ids_decode_as_the_library_does(library):
    ids = [223, 447, 220, 50256, 12520, 97]
    assert bpe.load(PATH).decode(np.array(ids, "<u4")) == library.decode(ids, skip_special_tokens=False)


def test_pair_table_equals_merging(library):
    """Two tokens may be neighbours exactly if encoding their bytes gives them."""
    own = bpe.load(PATH)
    rng = random.Random(9)
    tried = 0
    while tried < 2000:
        a, b = rng.randrange(256, 50256), rng.randrange(256, 50256)
        try:
            piece = (own.bytes_of[a] + own.bytes_of[b]).decode()
        except UnicodeDecodeError:
            continue
        if own.split(piece) != [piece]:
            continue
        tried += 1
        assert own.compatible(a, b) == (library.encode(piece).ids == [a, b])


def expected(library, rows):
    out = []
    for i, t in rows:
        ids = ids_of(library, t or "")
        out.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_given_and_edge_documents(spark, library):
    given_docs = spark.read.parquet(f"{edge.SF}/documents.parquet")
    for docs in (given_docs, edge.documents(spark), edge.documents(spark, [])):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                      for r in bpe.round_trip(docs, PATH).collect()), key=str)
        assert got == expected(library, rows)


def test_encode_then_decode(spark):
    docs = edge.documents(spark)
    back = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH)
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=str) == sorted(
        ((i, t or "") for i, t in edge.texts()), key=str)
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert bpe.decode_documents(nothing, PATH).collect()[0].text == ""
