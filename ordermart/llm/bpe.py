"""Byte-pair encoding by backtracking, and decoding by an offset table.

Encoding follows the public description of linear-time exact BPE: an
Aho-Corasick automaton finds every token that occurs in a piece of text; from
left to right the longest token is taken if it may stand next to the token
before it, that is if merging the two tokens' bytes by the merge ranks would
give exactly these two; else the next shorter prefix is tried, and when none is
left the step before is taken back and the position marked as a dead end.
Every position is left at most once, so the work is linear in the piece.
Whether two tokens may be neighbours is kept in a pair-compatibility table that
is filled as pairs are met.

Decoding gathers bytes from one buffer of all token bytes by an offset table.

The vocabulary is a tokenizers JSON file of the byte-level kind whose ids
follow the merge order; its path is a parameter.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from ordermart.llm.common import lean

# The split that the byte-level pre-tokenizer applies before the
# merges.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
KEPT_PIECES = 300_000     # bound of a worker's table of encoded pieces
KEPT_PAIRS = 300_000      # bound of a worker's pair-compatibility table
LONG_PIECE = 200          # longer pieces are encoded but not kept


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file:
    printable Latin-1 characters stand for themselves, the other bytes are
    numbered upwards from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """One vocabulary: encoder, pair table and decoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        alphabet = byte_alphabet()
        size = 1 + max([*vocab.values(), *(a["id"] for a in spec["added_tokens"])])
        self.bytes_of: list[bytes] = [b""] * size
        for text, i in vocab.items():
            self.bytes_of[i] = bytes(alphabet[c] for c in text)
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        for text, i in self.added.items():
            self.bytes_of[i] = text.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        #: The token two tokens merge into; the two a token was merged from.
        self.merged = {(vocab[a], vocab[b]): vocab[a + b] for a, b in pairs}
        self.halves = {t: pair for pair, t in self.merged.items()}
        ranks = [self.merged[vocab[a], vocab[b]] for a, b in pairs]
        if ranks != sorted(ranks):
            raise ValueError("token ids must follow the merge order")
        self.token = {b: i for i, b in enumerate(self.bytes_of) if i not in self.added.values()}
        self.byte_token = [self.token[bytes([b])] for b in range(256)]
        self.shorter = [self._longest_prefix(b) for b in self.bytes_of]
        self.automaton = ahocorasick.Automaton()
        for b, i in self.token.items():
            if b:
                self.automaton.add_word(b.decode("latin-1"), (len(b), i))
        self.automaton.make_automaton()
        self.pair_table: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.split = regex.compile(PIECES).findall
        self.special = (regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
                        if self.added else None)
        self.blob = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.offsets = np.zeros(size + 1, dtype=np.int64)
        np.cumsum([len(b) for b in self.bytes_of], out=self.offsets[1:])

    def _longest_prefix(self, b: bytes) -> int:
        """The longest token that is a proper prefix; -1 for none."""
        return next((self.token[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in self.token), -1)

    # -- pair compatibility ---------------------------------------------------

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges, run on both tokens' bytes together, leave
        exactly these two tokens."""
        known = self.pair_table.get((left, right))
        if known is None:
            if len(self.pair_table) >= KEPT_PAIRS:
                self.pair_table.clear()
            known = self.pair_table[left, right] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        """Undo the latest merge on either side of the seam, step by step; a
        merge across the seam that ranks before the merge just undone would
        have come first."""
        before = len(self.bytes_of)   # rank of the merge undone last
        a, b = left, right
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < before:
                return False
            # Both halves equal in rank: the left occurrence merges first, so
            # the right one is undone first.
            if a > b:
                if a not in self.halves:
                    return True
                before, a = a, self.halves[a][1]
            else:
                if b not in self.halves:
                    if a not in self.halves:
                        return True
                    before, a = a, self.halves[a][1]
                else:
                    before, b = b + 1, self.halves[b][0]

    # -- encoding -------------------------------------------------------------

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.token.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest = [self.byte_token[b] for b in piece]
        reach = [1] * n
        for end, (length, token) in self.automaton.iter(piece.decode("latin-1")):
            start = end - length + 1
            if length > reach[start]:
                reach[start], longest[start] = length, token
        sizes, shorter, compatible = self.bytes_of, self.shorter, self.compatible
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            end = at + len(sizes[token])
            if not dead[end] and (not out or compatible(out[-1], token)):
                out.append(token)
                at = end
                if at < n:
                    token = longest[at]
                continue
            token = shorter[token]
            while token < 0:                 # nothing fits here: step back
                dead[at] = 1
                last = out.pop()
                at -= len(sizes[last])
                token = shorter[last]
        return out

    def _piece_ids(self, piece: str) -> bytes:
        ids = np.array(self.encode_piece(piece.encode()), dtype="<u4").tobytes()
        if len(piece) <= LONG_PIECE:
            if len(self.pieces) >= KEPT_PIECES:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def _encode_plain(self, text: str) -> bytes:
        known = self.pieces.get
        out = []
        for piece in self.split(text):
            out.append(known(piece) or self._piece_ids(piece))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.  The strings of
        added tokens become their ids, as in the library's encode."""
        if self.special is None or not any(s in text for s in self.added):
            return self._encode_plain(text)
        parts = self.special.split(text)
        return b"".join(np.array([self.added[p]], dtype="<u4").tobytes() if i % 2 else self._encode_plain(p)
                        for i, p in enumerate(parts))

    def forget(self) -> None:
        """Empty the tables of pieces and pairs."""
        self.pieces.clear()
        self.pair_table.clear()

    # -- decoding -------------------------------------------------------------

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        ids = ids.astype(np.int64)
        sizes = self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(sizes)
        if not len(ids):
            return b""
        place = np.arange(ends[-1]) - np.repeat(ends - sizes - self.offsets[ids], sizes)
        return self.blob[place].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """The vocabulary, read once per Python worker."""
    return Bpe(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(id_col, ids, n_tokens) for every row of ``docs``: ids are packed as
    little-endian unsigned 32-bit integers.  A null or empty text has no ids;
    repeated rows repeat; other columns are ignored."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            ids = [bpe.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(ids, pa.binary()),
                 pa.array([len(x) // 4 for x in ids], pa.int64())], names=[id_col, "ids", "n_tokens"])

    return rows.mapInArrow(lean(run, lambda: load(path).forget()), f"`{id_col}` long, ids binary, n_tokens long")


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id",
                     ids_col: str = "ids") -> DataFrame:
    """(id_col, text) from packed ids; null ids give an empty text."""
    rows = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = [bpe.decode(np.frombuffer(x or b"", dtype="<u4")) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())],
                                             names=[id_col, "text"])

    return rows.mapInArrow(lean(run, lambda: load(path).forget()), f"`{id_col}` long, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
               keep_ids: bool = False) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) for every row: digests
    of the encoded ids and of the text decoded from them, in one pass; the
    packed ids, too, if asked for."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            all_ids = [bpe.encode(t or "") for t in batch.column("text").to_pylist()]
            decoded = [sha256(bpe.decode(np.frombuffer(x, dtype="<u4")).encode()).hexdigest() for x in all_ids]
            columns = {id_col: batch.column("id"),
                       "n_tokens": pa.array([len(x) // 4 for x in all_ids], pa.int64()),
                       "ids_sha256": pa.array([sha256(x).hexdigest() for x in all_ids], pa.string()),
                       "decoded_sha256": pa.array(decoded, pa.string())}
            if keep_ids:
                columns["ids"] = pa.array(all_ids, pa.binary())
            yield pa.record_batch(columns)

    kept = ", ids binary" if keep_ids else ""
    return rows.mapInArrow(lean(run, lambda: load(path).forget()), f"`{id_col}` long, n_tokens long, ids_sha256 string, decoded_sha256 string{kept}")
