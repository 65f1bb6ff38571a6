import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from ordermart.llm import langid
from tests.llm import edge


def test_viterbi_is_optimal():
    rng = np.random.default_rng(0)
    for _ in range(150):
        sizes, k = rng.integers(1, 6, size=3), 3
        scores = (rng.normal(size=(sizes.sum(), k)) * 3).astype(np.float32)
        scores[rng.random(scores.shape) < 0.1] = -np.inf
        scores[:, 0] = np.where(np.isinf(scores).all(axis=1), 0, scores[:, 0])
        doc = np.repeat(np.arange(3), sizes)
        label = langid.viterbi(scores, doc, 2.0)
        for d in range(3):
            rows = np.flatnonzero(doc == d)

            def value(path):
                return sum(float(scores[i, s]) for i, s in zip(rows, path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))

            best = max(map(value, itertools.product(range(k), repeat=len(rows))))
            assert abs(best - value(label[rows])) < 1e-4


def test_held_out_fold(spark):
    got = spark.createDataFrame([(i,) for i in [*range(-5, 300), None]], "doc_id long").select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0) for r in got)


def learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs, langid.train(docs.where(~langid.held_out(F.col("doc_id"))))


def test_held_out_accuracy_and_spans(spark):
    docs, model = learned(spark)
    assert model.languages == sorted(r.lang for r in docs.select("lang").where("lang is not null").distinct().collect())
    got = langid.predict(docs, model, keep={"held_out": langid.held_out(F.col("doc_id")), "true": F.col("lang")})
    right, total = got.where("held_out and true is not null").agg(
        F.sum((F.col("true") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / total >= 0.97
    assert got.where("not (score between 0 and 1)").count() == 0
    en, de = (docs.where(f"lang = '{x}' and n_chars > 300").orderBy("doc_id").first().text[:120] for x in ("en", "de"))
    mixed = spark.createDataFrame([(1, en + "\n" + de)], "doc_id long, text string")
    spans = langid.spans(mixed, model).first().spans
    assert [s.lang for s in spans] == ["en", "de"] and abs(spans[1].start - 121) < 25
    assert spans[0].start == 0 and all(a.end <= b.start for a, b in zip(spans, spans[1:]))


def test_edge_documents(spark):
    _, model = learned(spark)
    docs = edge.documents(spark)
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in langid.predict(docs, model).collect()), key=str)
    assert len(got) == docs.count()
    by_id = {i: (lang, score) for i, lang, score in got}
    for i in (1, 2, 3, 9):
        assert by_id[i] == ("und", 0.0)
    assert all(by_id[i][0] in model.languages and 0 < by_id[i][1] <= 1 for i in (4, 8, 10, 11))
    assert [r.spans for r in langid.spans(docs, model).where("doc_id in (1, 2, 3, 9)").collect()] == [[]] * 4
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(lang != "und" and s >= 0.3 for _, lang, s in got)
    assert langid.predict(edge.documents(spark, []), model).count() == 0


def test_slices_do_not_change_results(spark, monkeypatch):
    docs, model = learned(spark)
    texts = [r.text for r in docs.orderBy("doc_id").limit(80).collect()] + ["", "1 2"]
    whole = langid._predict(texts, model, 8.0)
    each = [langid._predict([t], model, 8.0) for t in texts]
    assert whole == ([x[0][0] for x in each], [x[1][0] for x in each])
    monkeypatch.setattr(langid, "SLICE_CHARS", 5000)
    slices = list(langid._slices(texts))
    assert len(slices) > 3 and sorted(i for s in slices for i in s) == list(range(len(texts)))
    assert langid._predict_all(texts, model, 8.0) == whole


def test_without_training_rows_and_with_other_scripts(spark):
    docs = spark.createDataFrame([(1, "abc abc", "xx"), (2, "где ты", "yy"), (3, None, "xx"), (4, "abc", None)],
                                 "doc_id long, text string, lang string")
    nothing = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}
    model = langid.train(docs)
    assert model.languages == ["xx", "yy"]
    ask = spark.createDataFrame([(1, "abd"), (2, "тот"), (3, "ελ"), (4, "abc abc abc тот тот abc")],
                                "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in langid.predict(ask, model).collect()}
    assert got[1] == "xx" and got[2] == "yy" and got[3] in ("xx", "yy") and got[4] == "xx"


def test_lower_case_keeps_offsets():
    assert langid.lowered(["İSTANBUL A", "ÄÖ"]) == ["İstanbul a", "äö"]
