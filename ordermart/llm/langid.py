"""Language identification of mixed-language text.

A word is a run of letters.  The script of its letters narrows the candidate
languages to those seen with that script in training; each candidate scores
the word by the log probabilities of its character bigrams and trigrams
(boundaries included); Viterbi then finds the best labelling of the whole word
sequence, where a change of language costs a fixed penalty.  Runs of one label
are the spans; the document's language is the one that holds most letters.

Training counts hashed n-grams per language in every partition and sums them
in Spark; the model has a fixed size per language (two tables of 2^16 counts),
so it is sent to the tasks whole.  Texts of any length are handled whole: all
scores of a slice of documents are computed at once with numpy, and Viterbi
steps through the words of all documents of the slice side by side.

Defined results: a null text or one without a letter is ``und`` with score 0; a
word whose script was never seen in training keeps all languages as
candidates; ties go to the language that sorts first; an empty training set
makes every text ``und``.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ordermart.llm.common import lean

UNKNOWN = "und"
BUCKETS = 1 << 16          # of each n-gram table
MAX_LANGUAGES = 400        # bound of the model's size
SLICE_CHARS = 1_000_000    # characters worked on at once (one text at least)
SWITCH_PENALTY = 8.0       # nats
MIN_SHARE = 0.001          # of a language's letters, for a script to count as its own

# First and last code point of each script's main blocks.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
}
N_SCRIPTS = len(SCRIPTS) + 1   # 0: any other


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: whether it is a letter; the number of its script."""
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    script = np.zeros(0x110000, dtype=np.uint8)
    for k, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            script[first:last + 1] = k
    return letter, script


@dataclass
class Words:
    """The words of several texts, as arrays."""
    code: np.ndarray       # code points of the texts, a blank after each
    letter_at: np.ndarray  # positions of letters
    first: np.ndarray      # per word: its first row in letter_at
    start: np.ndarray      # per word: position in code
    size: np.ndarray       # per word: letters
    doc: np.ndarray        # per word: number of its text
    text_at: np.ndarray    # per text: position of its first code point
    script: np.ndarray     # per word


def split_words(texts: list[str]) -> Words:
    letter, script = _letters()
    joined = " ".join(texts) + " "
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    text_at = np.cumsum(sizes) - sizes
    is_letter = letter[code]
    letter_at = np.flatnonzero(is_letter)
    new = np.ones(len(letter_at), dtype=bool)
    new[1:] = np.diff(letter_at) > 1
    first = np.flatnonzero(new)
    start = letter_at[first]
    size = np.diff(np.append(first, len(letter_at)))
    doc = np.searchsorted(text_at, start, side="right") - 1
    return Words(code, letter_at, first, start, size, doc, text_at, script[code[start]])


def lowered(texts: list[str]) -> list[str]:
    """Lower case without a change of length, so that offsets stay true."""
    out = []
    for t in texts:
        low = t.lower()
        out.append(low if len(low) == len(t) else "".join(c.lower() if len(c.lower()) == 1 else c for c in t))
    return out


def ngram_buckets(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Per letter: bucket of the trigram around it and of the bigram that ends
    with it; what is not a letter counts as the boundary 0."""
    letter, _ = _letters()
    at = w.letter_at
    here = w.code[at]
    last = len(w.code) - 1
    before = np.where(at > 0, w.code[np.maximum(at - 1, 0)], 0)
    after = w.code[np.minimum(at + 1, last)]
    before = np.where(letter[before], before, 0).astype(np.uint32)
    after = np.where(letter[after], after, 0).astype(np.uint32)
    two = before * np.uint32(0x9E3779B1) ^ here * np.uint32(0x85EBCA6B)
    three = two * np.uint32(0xC2B2AE35) ^ after * np.uint32(0x27D4EB2F)
    mix = lambda x: ((x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(16)).astype(np.int64)
    return mix(three), mix(two) + BUCKETS


def _slices(texts: list[str]) -> Iterator[list[int]]:
    """Numbers of the texts to work on at once: texts of like length together,
    since Viterbi takes as many steps as the longest one has words."""
    some: list[int] = []
    chars = 0
    for i in sorted(range(len(texts)), key=lambda i: len(texts[i])):
        if some and chars + len(texts[i]) > SLICE_CHARS:
            yield some
            some, chars = [], 0
        some.append(i)
        chars += len(texts[i])
    if some:
        yield some


# -- training ------------------------------------------------------------------

@dataclass
class Model:
    languages: list[str]
    log_prob: np.ndarray     # [2 * BUCKETS, languages] float32
    scripts: np.ndarray      # [N_SCRIPTS, languages] bool: candidates


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from all rows with a text and a language.  Counts are summed in
    Spark; at most MAX_LANGUAGES * (2 * BUCKETS + N_SCRIPTS) sums are read."""
    rows = (docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .where("lang is not null and text is not null"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 2 * BUCKETS + N_SCRIPTS
        sums: dict[str, np.ndarray] = {}

        def partial() -> Iterator[pa.RecordBatch]:
            for lang, counts in sums.items():
                slot = np.flatnonzero(counts)
                yield pa.record_batch({"lang": pa.array([lang] * len(slot), pa.string()),
                                       "slot": pa.array(slot.astype(np.int32)), "n": pa.array(counts[slot])})
            sums.clear()

        for batch in batches:
            langs, all_texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for numbers in _slices(all_texts):
                by_lang: dict[str, list[str]] = {}
                for i in numbers:
                    by_lang.setdefault(langs[i], []).append(all_texts[i])
                for lang, some in by_lang.items():
                    w = split_words(lowered(some))
                    three, two = ngram_buckets(w)
                    counts = sums.setdefault(lang, np.zeros(width, dtype=np.int64))
                    counts += np.bincount(three, minlength=width)
                    counts += np.bincount(two, minlength=width)
                    counts[2 * BUCKETS:] += np.bincount(w.script, weights=w.size, minlength=N_SCRIPTS).astype(np.int64)
                if len(sums) > 64:
                    yield from partial()
        yield from partial()

    counts = (rows.mapInArrow(lean(run), "lang string, slot int, n long")
              .groupBy("lang", "slot").agg(F.sum("n").alias("n")))
    learned = counts.toArrow()
    languages = sorted(set(learned.column("lang").to_pylist()))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} language values; at most {MAX_LANGUAGES} can be learned")
    table = np.zeros((2 * BUCKETS + N_SCRIPTS, len(languages)))
    number = {lang: k for k, lang in enumerate(languages)}
    column = np.array([number[x] for x in learned.column("lang").to_pylist()], dtype=np.int64)
    table[learned.column("slot").to_numpy(), column] = learned.column("n").to_numpy()
    return _model(languages, table)


def _model(languages: list[str], table: np.ndarray) -> Model:
    three, two, scripts = table[:BUCKETS], table[BUCKETS:2 * BUCKETS], table[2 * BUCKETS:]
    log = [np.log((c + 0.1) / (c.sum(axis=0) + 0.1 * BUCKETS)) for c in (three, two)]
    share = scripts / np.maximum(1, scripts.sum(axis=0))
    known = share >= MIN_SHARE
    known[~known.any(axis=1)] = True
    return Model(languages, np.concatenate(log).astype(np.float32), known)


# -- prediction ----------------------------------------------------------------

def word_scores(w: Words, model: Model) -> np.ndarray:
    """[word, language] log probability, -inf for languages whose script it
    is not."""
    three, two = ngram_buckets(w)
    if not len(w.first):
        return np.zeros((0, len(model.languages)), dtype=np.float32)
    each = model.log_prob[three] + model.log_prob[two]
    scores = np.add.reduceat(each, w.first, axis=0)
    return np.where(model.scripts[w.script], scores, np.float32(-np.inf))


def viterbi(scores: np.ndarray, doc: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word: the sum of scores less ``penalty`` for every
    change of label within a text.  ``doc`` (ascending) tells texts apart."""
    n, k = scores.shape
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    begin = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    length = np.diff(np.append(begin, n))
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    # Texts still running at step t are the first active[t] of that order.
    active = np.searchsorted(-length, -np.arange(length[0]), side="left")
    jump = np.zeros((n, k), dtype=bool)     # the label came from another one
    source = np.zeros(n, dtype=np.int16)    # ... namely from this
    last = np.zeros(len(begin), dtype=np.int64)
    best = scores[begin].astype(np.float64)
    for t in range(1, int(length[0])):
        m = active[t]
        if m < len(best):
            last[m:len(best)] = best[m:].argmax(axis=1)
            best = best[:m]
        rows = begin[:m] + t
        top = best.argmax(axis=1)
        switched = best[np.arange(m), top][:, None] - penalty
        jumps = switched > best
        jump[rows] = jumps
        source[rows] = top
        best = np.where(jumps, switched, best) + scores[rows]
    last[:len(best)] = best.argmax(axis=1)
    label = np.zeros(n, dtype=np.int64)
    state = np.zeros(0, dtype=np.int64)
    for t in range(int(length[0]) - 1, -1, -1):
        m = active[t]
        if m > len(state):
            state = np.concatenate([state, last[len(state):m]])
        rows = begin[:m] + t
        label[rows] = state
        if t:
            state = np.where(jump[rows, state], source[rows], state)
    return label


def _label(texts: list[str], model: Model, penalty: float) -> tuple[Words, np.ndarray]:
    w = split_words(lowered(texts))
    return w, viterbi(word_scores(w, model), w.doc, penalty)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            penalty: float = SWITCH_PENALTY, keep: dict[str, Column] | None = None) -> DataFrame:
    """(id_col, lang_pred, score, *keep) for every row: the language that
    holds most letters and its share of them.  ``keep`` names further columns
    to carry through; they are not seen by the model."""
    keep = keep or {}
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"),
                       *(c.alias(n) for n, c in keep.items()))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    carried = list(keep)
    names = [id_col, *carried, "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = [t or "" for t in batch.column("__text").to_pylist()]
            langs, shares = _predict_all(texts, model, penalty)
            kept = [batch.column(n) for n in carried]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), *kept, pa.array(langs, pa.string()), pa.array(shares, pa.float64())],
                names=names)

    types = dict(rows.dtypes)
    schema = ", ".join([f"`{id_col}` long", *(f"`{n}` {types[n]}" for n in keep), "lang_pred string", "score double"])
    return rows.mapInArrow(lean(run), schema)


def _predict_all(texts: list[str], model: Model, penalty: float) -> tuple[list[str], list[float]]:
    langs, shares = [UNKNOWN] * len(texts), [0.0] * len(texts)
    for numbers in _slices(texts):
        for i, lang, share in zip(numbers, *_predict([texts[i] for i in numbers], model, penalty)):
            langs[i], shares[i] = lang, share
    return langs, shares


def _predict(texts: list[str], model: Model, penalty: float) -> tuple[list[str], list[float]]:
    k = len(model.languages)
    if not k:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    w, label = _label(texts, model, penalty)
    letters = np.bincount(w.doc * k + label, weights=w.size, minlength=len(texts) * k).reshape(-1, k)
    total = letters.sum(axis=1)
    top = letters.argmax(axis=1)
    share = letters[np.arange(len(texts)), top] / np.maximum(1, total)
    lang = [model.languages[i] if n else UNKNOWN for i, n in zip(top, total)]
    return lang, share.tolist()


def accepted(docs: DataFrame, model: Model, text_col: str = "text", min_score: float = 0.3,
             penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``docs`` (all columns) without the rows of no known language: those
    that are ``und`` and those whose main language holds less than
    ``min_score`` of the letters."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            langs, shares = _predict_all(texts, model, penalty)
            good = [x != UNKNOWN and s >= min_score for x, s in zip(langs, shares)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)


def spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          penalty: float = SWITCH_PENALTY) -> DataFrame:
    """(id_col, spans) for every row: spans is the list of (start, end, lang)
    in code points, from the first letter of a run of words with one label to
    the end of its last word.  No letter: an empty list."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found: list[list[dict]] = [[] for _ in texts]
            for numbers in _slices(texts):
                some = [texts[i] for i in numbers]
                out: list[list[dict]] = [[] for _ in some]
                if model.languages:
                    w, label = _label(some, model, penalty)
                    new = np.ones(len(label), dtype=bool)
                    new[1:] = (label[1:] != label[:-1]) | (w.doc[1:] != w.doc[:-1])
                    heads = np.flatnonzero(new)
                    tails = np.append(heads[1:], len(label)) - 1
                    for h, t in zip(heads, tails):
                        base = w.text_at[w.doc[h]]
                        out[w.doc[h]].append({"start": int(w.start[h] - base),
                                              "end": int(w.start[t] + w.size[t] - base),
                                              "lang": model.languages[label[h]]})
                for i, one in zip(numbers, out):
                    found[i] = one
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, kind)], names=[id_col, "spans"])

    return rows.mapInArrow(lean(run), f"`{id_col}` long, spans array<struct<start: long, end: long, lang: string>>")


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a document is kept from training: crc32 of its id as text has
    remainder 0.  A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0
