import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ordermart.llm import catalog, pii
from tests.llm import edge

# The base patterns, as the contract states them.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = [(m.start(), m.end(), 0) for m in EMAIL.finditer(text)]
    out += [(m.start(), m.end(), 1) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1]))
        if 12 <= len(digits) <= 19 and luhn % 10 == 0:
            out.append((m.start(), m.end(), 2))
    out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_of_random_texts():
    rng = random.Random(3)
    parts = ["a", "@", ".", "-", "1", "23", "255", "4111111111111111", "+", "b.c", " ", "(", "9", "é", "\n", "00", "@x.y"]
    for _ in range(30_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert [s[:3] for s in pii.base_spans(text)] == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 200_000, "1." * 100_000, "@" * 200_000, "a@" * 100_000, "+1 " * 100_000):
        pii.base_spans(text)


def joined(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in spans)


@pytest.mark.parametrize("which", ["given", "edge", "empty"])
def test_query_columns(spark, which, monkeypatch):
    docs = {"given": lambda: spark.read.parquet(f"{edge.SF}/documents.parquet"),
            "edge": lambda: edge.documents(spark), "empty": lambda: edge.documents(spark, [])}[which]()
    monkeypatch.setattr(catalog, "table", lambda *_: docs)
    got = sorted((tuple(r) for r in catalog.op3_pii(spark, "").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256").collect()), key=str)
    want = []
    for r in docs.select("doc_id", "text").collect():
        spans = brute(r.text or "")
        want.append((r.doc_id, *[sum(k == s[2] for s in spans) for k in range(4)],
                     hashlib.sha256(joined(spans).encode()).hexdigest()))
    assert got == sorted(want, key=str)


def planted():
    """A nickname that gives one address away, a word often but not always
    beside another, copies of one line, and clean documents."""
    rows = [(i, f"Line {i} has plain words only and number {i}\nnothing else here {i * 7}") for i in range(200)]
    rows += [(300 + i, f"Ask Zorbulon{'' if i else ','} visit {i} times at zor@secret.example.org today") for i in range(5)]
    rows += [(400 + i, f"Case {i}: krenfolk and more, call 10.1.2.3 now {i}") for i in range(6)]
    rows += [(410, "the krenfolk came alone")]
    rows += [(500 + i, "copied line with glimmerword and cop@copies.example.com") for i in range(9)]
    rows += [(600, "Zorbulon writes alone"), (600, "Zorbulon writes alone"), (601, None), (None, "Zorbulon?")]
    return rows


def brute_terms(rows, support, disclose):
    import math
    lines = {line for _, t in rows if t is not None for line in t.split("\n")}
    entities, terms, both = {}, {}, {}
    for line in lines:
        spans = pii.base_spans(line)
        held = {f"{k}:{v}" for _, _, k, v in spans}
        words = {m[0].lower() for m in re.finditer(r"[^\W_]+", line)
                 if not any(a < m.end() and m.start() < b for a, b, _, _ in spans)}
        for c in held:
            entities[c] = entities.get(c, 0) + 1
            for t in words:
                both[c, t] = both.get((c, t), 0) + 1
        for t in words:
            terms[t] = terms.get(t, 0) + 1
    out = {}
    for (c, t), n in both.items():
        pmi = math.log2(n * len(lines) / (entities[c] * terms[t]))
        if n >= support and pmi >= disclose * math.log2(len(lines) / entities[c]) - 1e-9:
            out[t] = out.get(t, False) or n == terms[t]
    return out


def test_disclosing_terms_equal_a_count_by_hand(spark):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for support, disclose in ((3, 0.95), (3, 0.7), (2, 0.5)):
        terms, _ = pii.disclosing_terms(docs, "text", support, disclose)
        assert {r.term: r.whole for r in terms.collect()} == brute_terms(rows, support, disclose)
    assert "zorbulon" in brute_terms(rows, 3, 0.7) and "glimmerword" not in brute_terms(rows, 2, 0.5)


def test_sanitised_texts(spark):
    rows = planted()
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, spans string, value string")
    clean = pii.sanitise(docs, disclose=0.7)
    assert clean.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in clean.collect()), key=str)
    terms = brute_terms(rows, 3, 0.7)
    want = []
    for i, t in rows:
        if t is not None:
            spans = list(pii.base_spans(t))
            for m in re.finditer(r"[^\W_]+", t):
                if m[0].lower() in terms and not any(a < m.end() and m.start() < b for a, b, _, _ in pii.base_spans(t)):
                    spans.append((m.start(), m.end(), 4, "removed" if terms[m[0].lower()] else "generalised"))
            t = pii.redact(t, sorted(spans, key=lambda s: (s[0], s[2])))
        want.append((i, t))
    assert got == sorted(want, key=str)
    texts = dict(got)
    assert "[EMAIL]" in texts[300] and "Zorbulon" not in texts[301] and texts[3] == rows[3][1] and texts[601] is None


def test_sanitise_keeps_rows_and_columns_of_edge_documents(spark):
    docs = edge.documents(spark)
    clean = pii.sanitise(docs)
    assert clean.schema.names == docs.schema.names and clean.count() == docs.count()
    assert pii.sanitise(edge.documents(spark, [])).count() == 0
    text = clean.where("doc_id = 12").select("text").first().text
    assert text == "mail to [EMAIL] or [PHONE], ip [IP], card [CARD]"


def test_overlapping_spans_are_all_reported(spark):
    docs = spark.createDataFrame([(1, "+4111 1111 1111 1111 and 1.2.3.4@x.org")], "doc_id long, text string")
    row = pii.find(docs).select(pii.joined(F.col("spans")).alias("s")).first()
    assert row.s == joined(brute("+4111 1111 1111 1111 and 1.2.3.4@x.org"))


def test_entities_on_one_line_are_tested_over_documents(spark, monkeypatch):
    """A name beside its address on one line of many documents, and on the next
    line of a single one; the query checks both."""
    rows = [(i, f"plain words here {i}\nCall Wumblefrix at wum@one.example.com\nplain words end") for i in range(8)]
    rows += [(20, "Grindelmoor lives here\nwrite to gri@two.example.com\nplain words end")]
    rows += [(30 + i, "plain words here end to call at write lives\nnothing more") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(catalog, "table", lambda *_: docs)
    spans = {r.doc_id: r.spans for r in catalog.op3_pii(spark, "").collect()}
    at = rows[3][1].index("Wumblefrix")
    assert f"term:{at}:{at + 10}" in spans[3] and "term:0:11" in spans[20] and spans[30] == ""
    terms, _ = pii.disclosing_terms(docs, support=1, unit="document")
    assert {r.term: r.whole for r in terms.collect()}.items() >= {"wumblefrix": True, "grindelmoor": True}.items()
    clean = {r.doc_id: r.text for r in pii.sanitise(docs, support=1, unit="document").collect()}
    assert "Wumblefrix" not in clean[3] and "Grindelmoor" not in clean[20] and clean[30] == rows[9][1]
