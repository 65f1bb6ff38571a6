"""Information-theoretic sanitisation of personal data.

Base detectors find e-mail and IP addresses, card and phone numbers.  Their
values are the protected entities.  The corpus then tells which other terms
give an entity away.  The unit of observation is a distinct line (copies of a
line are one observation); with N distinct lines, n(c) of them holding entity
c, n(t) holding term t and n(c, t) holding both,

    information of c          I(c)    = log2(N / n(c))
    what t discloses about c  PMI(c,t) = log2(n(c, t) * N / (n(c) * n(t)))

A term discloses c if PMI(c, t) >= ``disclose`` * I(c) and both meet in at
least ``support`` distinct lines.  With ``unit`` "document" the observation is
a document instead (every row counts, copies too): n(c), n(t) and N count
documents, and c and t meet where t stands in the line of c or in one next to
it.  Such a term is generalised to its shape
("[NAME]", "[NUMBER]", "[WORD]") wherever it occurs; if it tells everything
(PMI = I: it is never seen without c) it is removed.  Its occurrences are the
added spans of kind ``term``; base spans stay.

Spark does the counting: entities and (entity, term) pairs come from the lines
that hold an entity; a pair that already fails against its line count in these
lines alone cannot pass against the whole corpus, so only the few remaining
terms are looked up in all texts.  That pass tests words against a bitmap of
fixed size (a superset), and a join makes it exact.

Defined results: a null or empty text has no spans; repeated rows repeat;
spans are in code points with the end exclusive; an empty table gives an empty
result; other columns are ignored (``sanitise`` keeps them).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ordermart.llm.common import lean, stored

# The patterns of the base detectors and the kinds in order.
EMAIL_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does; saying so keeps the search
# linear in long runs.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ["email", "ip", "card", "phone", "term"]

DIGIT = re.compile("[0-9]")
WORD = re.compile(r"[^\W_]+")
SUPPORT = 3
DISCLOSE = 0.95
BITMAP_BITS = 1 << 26       # 8 MB
SPAN = "struct<start: int, end: int, kind: int, value: string>"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("value", pa.string())])


# -- base detectors --------------------------------------------------------------

def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping e-mail addresses, in linear time: every
    address has one @ with the longest run of local characters before it."""
    free = 0     # nothing before this belongs to the next match
    at = text.find("@")
    while at >= 0:
        head = text[free:at]
        begin = free + len(head.rstrip(EMAIL_LOCAL))
        domain = EMAIL_DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind, canonical value) by start, then kind as listed."""
    found = []
    if "@" in text:
        found += [(a, b, 0, text[a:b].lower()) for a, b in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                found.append((m.start(), m.end(), 1, ".".join(parts)))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _digits(m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), m.end(), 2, digits))
        if "+" in text:
            for m in PHONE.finditer(text):
                digits = _digits(m[0])
                if 9 <= len(digits) <= 15:
                    found.append((m.start(), m.end(), 3, digits))
    return sorted(found, key=lambda s: (s[0], s[2]))


def terms_of(line: str, spans: list[tuple[int, int]]) -> dict[str, list[tuple[int, int]]]:
    """Occurrences of each term of a line, outside the base spans."""
    out: dict[str, list[tuple[int, int]]] = {}
    for m in WORD.finditer(line):
        if not any(a < m.end() and m.start() < b for a, b in spans):
            out.setdefault(m[0].lower(), []).append(m.span())
    return out


def line_key(line: str) -> bytes:
    return xxhash.xxh128_digest(line.encode())


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _lines(text: str) -> Iterator[tuple[int, str]]:
    at = 0
    for line in text.split("\n"):
        yield at, line
        at += len(line) + 1


# -- passes over the texts ---------------------------------------------------------

def detect(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, spans) of every row: the base spans."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_key(F.col(text_col)).alias("text_key"),
                       F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            spans = [[dict(zip(("start", "end", "kind", "value"), s)) for s in base_spans(t)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"),
                 pa.array(spans, pa.list_(_SPAN))], names=["id", "text_key", "spans"])

    return rows.mapInArrow(lean(run), f"id long, text_key binary, spans array<{SPAN}>")


def _entity_lines(docs: DataFrame, text_col: str, unit: str = "line") -> DataFrame:
    """(line, entities, terms) of every line that holds an entity.  With unit
    "document", a row per text and entity: the text's key, and the terms of the
    entity's lines and those next to them."""
    rows = docs.select(F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, entities, terms = [], [], []
            for text in batch.column("text").to_pylist():
                if not text or not DIGIT.search(text) and "@" not in text:
                    continue
                if unit == "document":
                    for entity, near in _contexts(text).items():
                        keys.append(line_key(text))
                        entities.append([entity])
                        terms.append(sorted(near))
                    continue
                for _, line in _lines(text):
                    spans = base_spans(line)
                    if spans:
                        keys.append(line_key(line))
                        entities.append(sorted({f"{KINDS[k]}:{v}" for _, _, k, v in spans}))
                        terms.append(sorted(terms_of(line, [s[:2] for s in spans])))
            words = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(entities, words), pa.array(terms, words)],
                names=["line", "entities", "terms"])

    return rows.mapInArrow(lean(run), "line binary, entities array<string>, terms array<string>")


def _contexts(text: str) -> dict[str, set[str]]:
    """Terms of each entity's lines and of the lines next to them."""
    lines = [line for _, line in _lines(text)]
    spans = [base_spans(line) for line in lines]
    out: dict[str, set[str]] = {}
    for i, some in enumerate(spans):
        if some:
            near = set().union(*(terms_of(lines[j], [s[:2] for s in spans[j]])
                                 for j in range(max(0, i - 1), min(len(lines), i + 2))))
            for _, _, k, v in some:
                out.setdefault(f"{KINDS[k]}:{v}", set()).update(near)
    return out


def _listed(bitmap: np.ndarray):
    """Whether a word's bit is set: true for all listed words, and few others."""
    bits, size, crc = memoryview(bitmap), 8 * len(bitmap), zlib.crc32

    def listed(word: str) -> bool:
        h = crc(word.encode()) % size
        return bits[h >> 3] >> (h & 7) & 1 == 1

    return listed


def _occurrences(docs: DataFrame, text_col: str, bitmap: np.ndarray) -> DataFrame:
    """(text_key, line, term, spans) wherever a line holds a word whose bit is
    set: spans are (start, end) in the text, outside base spans."""
    rows = docs.select(text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)
    pairs = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = _listed(sent.value)
        for batch in batches:
            out: list[tuple] = []
            for key, text in zip(batch.column("text_key").to_pylist(), batch.column("text").to_pylist()):
                if not text:
                    continue
                words = {w for w in {x.lower() for x in set(WORD.findall(text))} if listed(w)}
                if not words:
                    continue
                for at, line in _lines(text):
                    low = line.lower()
                    if not any(w in low for w in words):
                        continue
                    spans = [s[:2] for s in base_spans(line)]
                    for term, found in terms_of(line, spans).items():
                        if listed(term):
                            out.append((key, line_key(line), term,
                                        [{"start": at + a, "end": at + b} for a, b in found]))
            columns = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()),
                 pa.array(columns[2], pa.string()), pa.array(columns[3], pairs)],
                names=["text_key", "line", "term", "spans"])

    return rows.mapInArrow(
        lean(run), "text_key binary, line binary, term string, spans array<struct<start: int, end: int>>")


# -- statistics ------------------------------------------------------------------

def _bitmap(words: DataFrame) -> np.ndarray:
    """Bit crc32(word) mod BITMAP_BITS set for every word.  At most
    BITMAP_BITS / 64 numbers are read, however many words there are."""
    h = F.crc32(F.col("term").cast("binary")) % BITMAP_BITS
    cells = (words.select((h / 64).cast("long").alias("cell"), (h % 64).cast("int").alias("bit"))
             .groupBy("cell").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toArrow())
    out = np.zeros(BITMAP_BITS // 64, dtype="<i8")
    out[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return out.view(np.uint8)


def _discloses(n_ct: Column, n_c: Column, n_t: Column, n: float, share: float) -> Column:
    return F.log2(n_ct * F.lit(n) / (n_c * n_t)) >= share * F.log2(F.lit(n) / n_c) - 1e-9


def distinct_lines(docs: DataFrame, text_col: str) -> int:
    lines = docs.select(F.explode(F.split(text_col, "\n", -1)).alias("line"))
    return lines.select(F.xxhash64("line").alias("h")).distinct().count()


def disclosing_terms(docs: DataFrame, text_col: str = "text", support: int = SUPPORT,
                     disclose: float = DISCLOSE, unit: str = "line") -> tuple[DataFrame, DataFrame] | None:
    """(terms, occurrences): terms (term, whole) that disclose an entity -
    ``whole`` if one completely - and where they occur (text_key, term,
    spans).  None if no line holds an entity often enough."""
    if unit not in ("line", "document"):
        raise ValueError(f"unit {unit!r} is neither line nor document")
    # w: the observations a row stands for - one a line, or all rows of a text.
    whole_docs = unit == "document"
    weight = F.count("*") if whole_docs else F.lit(1).cast("long")
    found = _entity_lines(docs, text_col, unit)
    lines = stored(found.groupBy("line", "entities").agg(F.first("terms").alias("terms"), weight.alias("w")),
                   "entity-lines")
    named = lines.select("line", F.explode("entities").alias("entity"), "terms", "w")
    often = stored(named.groupBy("entity").agg(F.sum("w").alias("n_c")).where(F.col("n_c") >= support),
                   "entities")
    if often.isEmpty():
        return None
    together = (named.select("entity", "w", F.explode("terms").alias("term"))
                .groupBy("entity", "term").agg(F.sum("w").alias("n_ct")).where(F.col("n_ct") >= support)
                .join(often, "entity"))
    here = (lines.select("line", "w", F.explode("terms").alias("term")).distinct()
            .groupBy("term").agg(F.sum("w").alias("n_here")))
    n = float(docs.where(F.length(text_col) > 0).count() if whole_docs else distinct_lines(docs, text_col))
    pairs = stored(together.join(here, "term")
                   .where(_discloses(F.col("n_ct"), F.col("n_c"), F.col("n_here"), n, disclose))
                   .select("entity", "term", "n_c", "n_ct"), "pairs")
    if pairs.isEmpty():
        return None
    listed = stored(pairs.select("term").distinct(), "listed-terms")
    seen = stored(_occurrences(docs, text_col, _bitmap(listed)).join(listed, "term", "left_semi")
                  .groupBy("text_key", "line", "term", "spans").agg(weight.alias("w")), "occurrences")
    counts = (seen.select("term", "text_key" if whole_docs else "line", "w").distinct()
              .groupBy("term").agg(F.sum("w").alias("n_t")))
    terms = (pairs.join(counts, "term")
             .where(_discloses(F.col("n_ct"), F.col("n_c"), F.col("n_t"), n, disclose))
             .groupBy("term").agg(F.bool_or(F.col("n_ct") == F.col("n_t")).alias("whole")))
    return stored(terms, "terms"), seen


# -- results -----------------------------------------------------------------------

def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT,
         disclose: float = DISCLOSE, unit: str = "line") -> DataFrame:
    """(id_col, text_key, spans) of every row: all spans by start, then kind
    as listed.  The value of a term span is ``removed`` or ``generalised``."""
    base = stored(detect(docs, id_col, text_col), "base-spans")
    found = disclosing_terms(docs, text_col, support, disclose, unit)
    if found is None:
        return base.withColumnRenamed("id", id_col)
    added = _term_spans(*found)
    by_start = F.array_sort(F.concat("spans", F.coalesce("added", F.array())), _by_start)
    return (base.join(added, "text_key", "left")
            .select(F.col("id").alias(id_col), "text_key", by_start.alias("spans")))


def _term_spans(terms: DataFrame, seen: DataFrame) -> DataFrame:
    """(text_key, added): the spans of disclosing terms of each text."""
    value = F.when(F.col("whole"), "removed").otherwise("generalised")
    span = F.struct(F.col("s.start").alias("start"), F.col("s.end").alias("end"),
                    F.lit(KINDS.index("term")).alias("kind"), F.col("value").alias("value"))
    return (seen.join(terms, "term").select("text_key", value.alias("value"), F.explode("spans").alias("s"))
            .groupBy("text_key").agg(F.collect_set(span).alias("added")))


def _by_start(a: Column, b: Column) -> Column:
    key = lambda s: (s["start"], s["kind"], s["end"])
    order = F.lit(0)
    for x, y in reversed(list(zip(key(a), key(b)))):
        order = F.when(x < y, -1).when(x > y, 1).otherwise(order)
    return order


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["start"], s["end"])), ",")


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))


def base_of(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] < KINDS.index("term"))


def redact(text: str, spans: list[tuple[int, int, int, str]]) -> str:
    """The text with base spans replaced by their kind and terms removed or
    generalised.  Where spans overlap, the first one counts for all."""
    out, at = [], 0
    for start, end, kind, value in spans:
        if start >= at:
            out.append(text[at:start])
            if KINDS[kind] != "term":
                out.append(f"[{KINDS[kind].upper()}]")
            elif value != "removed":
                out.append(_shape(text[start:end]))
        at = max(at, end)
    out.append(text[at:])
    return "".join(out)


def _shape(term: str) -> str:
    return "[NUMBER]" if term.isdigit() else "[NAME]" if term[0].isupper() else "[WORD]"


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT,
             disclose: float = DISCLOSE, unit: str = "line") -> DataFrame:
    """``docs`` (all rows and columns) with the text redacted.  A null text
    stays null.

    Base spans are found again where the text is read.  Only texts that hold a
    word of the disclosing terms' bitmap are joined with the terms' spans; all
    others cross no shuffle.
    """
    found = disclosing_terms(docs, text_col, support, disclose, unit)
    if found is None:
        return docs.mapInArrow(_redactor(docs, text_col, None, False), docs.schema)
    terms, seen = found
    bitmap = _bitmap(terms)
    plain = docs.mapInArrow(_redactor(docs, text_col, bitmap, False), docs.schema)
    held = docs.mapInArrow(_redactor(docs, text_col, bitmap, True), docs.schema)
    spans = stored(_term_spans(terms, seen).withColumnRenamed("text_key", "__key"), "term-spans")
    joined_up = (held.withColumn("__key", text_key(F.col(text_col))).join(spans, "__key", "left")
                 .select(*docs.columns, "added"))
    kept = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_clean(t, [(x["start"], x["end"], x["kind"], x["value"]) for x in some or []])
                     for t, some in zip(batch.column(text_col).to_pylist(), batch.column("added").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in kept], names=kept)

    return plain.unionByName(joined_up.mapInArrow(lean(run), docs.schema))


def _clean(text: str | None, added: list[tuple[int, int, int, str]]) -> str | None:
    if not text:
        return text
    spans = base_spans(text)
    return redact(text, sorted([*spans, *added], key=lambda s: (s[0], s[2], s[1]))) if spans or added else text


def _redactor(docs: DataFrame, text_col: str, bitmap: np.ndarray | None, held: bool):
    """Without ``held``: the rows without a listed word, base spans redacted.
    With it: the other rows as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)
    kept = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = None if sent.value is None else _listed(sent.value)
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            if listed is not None:
                wanted = [bool(t) and any(listed(w.lower()) for w in set(WORD.findall(t))) == held
                          or not t and not held for t in texts]
                batch = batch.filter(pa.array(wanted, pa.bool_()))
                texts = batch.column(text_col).to_pylist()
            if not held:
                texts = [_clean(t, []) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in kept], names=kept)

    return lean(run)
