import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as cp
from ordermart.llm import decontam, langid, pii
from ordermart.llm.common import stored
from tests.llm import edge, test_decontam, test_simhash


def test_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names
    assert [name for name, _ in cp.STAGES] == ["language_id", "simhash_dedup", "decontamination", "pii_removal",
                                               "bpe_encoding"]


@pytest.mark.parametrize("which", ["given", "edge", "empty"])
def test_each_stage_by_hand(spark, which):
    given = spark.read.parquet(f"{edge.SF}/documents.parquet")
    docs = {"given": given, "edge": given.withColumn("doc_id", F.col("doc_id") + 1000).unionByName(edge.documents(spark), allowMissingColumns=True),
            "empty": edge.documents(spark, [])}[which]
    bench = [r.text for r in spark.read.parquet(f"{edge.SF}/benchmark.parquet").collect()]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = stored(docs, "pipeline-test")
    for name, stage in cp.STAGES:
        out = stored(stage(spark, docs, edge.SF), f"pipeline-test-{name}")
        before, after = docs.collect(), out.collect()
        pairs = sorted(((r.doc_id, r.text) for r in before), key=str)
        if name == "language_id":
            model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
            lang, share = langid._predict([t or "" for _, t in pairs], model, langid.SWITCH_PENALTY)
            want = [p for p, x, s in zip(pairs, lang, share) if x != "und" and s >= 0.3]
            assert sorted(((r.doc_id, r.text) for r in after), key=str) == want
        elif name == "simhash_dedup":
            _, root = test_simhash.brute_components(pairs)
            assert len(after) == len(set(root))
            of = {}
            for p, r in zip(pairs, root):
                of.setdefault(r, []).append(p)
            kept = [(r.doc_id, r.text) for r in after]
            for members in of.values():
                ids = [i for i, _ in members if i is not None]
                assert [k[0] for k in kept if k in members] == [min(ids) if ids else None]
        elif name == "decontamination":
            want = [p for p in pairs if len(p[1] or "") > 100_000 or not test_decontam.brute(p[1], bench)]
            assert sorted(((r.doc_id, r.text) for r in after), key=str) == want
        elif name == "pii_removal":
            assert len(after) == len(before)
            texts = {(r.doc_id, r.source): r.text for r in before if not repeated(r, before)}
            for r in after:
                assert r.n_chars == len(r.text)
                old = texts.get((r.doc_id, r.source))
                if old is not None and not pii.base_spans(old):
                    assert r.text == old
                elif old is not None:
                    assert r.text != old and not pii.base_spans(r.text)
        else:
            want = []
            for i, t in pairs:
                ids = np.array(library.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
                want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), ids))
            got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, bytes(r.ids)) for r in after]
            assert sorted(got, key=str) == sorted(want, key=str)
        if name != "bpe_encoding":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = out


def repeated(row, rows):
    return sum(r.doc_id == row.doc_id for r in rows) > 1


def test_run(spark):
    rows = cp.run(spark, edge.SF).collect()
    documents = spark.read.parquet(f"{edge.SF}/documents.parquet")
    assert 0 < len(rows) < documents.count() and len({r.doc_id for r in rows}) == len(rows)
    assert decontam.contaminated(documents.join(spark.createDataFrame([(r.doc_id,) for r in rows], "doc_id long"), "doc_id"),
                                 spark.read.parquet(f"{edge.SF}/benchmark.parquet")).count() == 0
