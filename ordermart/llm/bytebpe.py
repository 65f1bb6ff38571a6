"""Byte-level BPE from a rank file: encoding by memoised adjacency, decoding.

The vocabulary is a rank file: base64 of a token's bytes and its rank, which is
also its id.  Such a file names no merge pairs: any two neighbours whose joined
bytes are a token may merge, the lowest rank first, the leftmost of equals
first.  A token's two halves are therefore found by merging its own bytes until
two parts are left.

A piece of text is mapped byte by byte to Latin-1, so that one Aho-Corasick
automaton over strings finds all tokens in it.  From left to right the longest
token is taken that may stand beside the one before it; if none may, the step
before is taken back and its position marked, so each position is given up at
most once and the work is linear.  Two tokens may stand side by side if no
merge across their seam comes before the merges that made them; each answer is
kept, in a bounded table per Python worker.

Defined results: a null or empty text has no ids; repeated rows and repeated
ids stay rows of their own; texts of any length are encoded whole; an empty
table gives an empty one; special tokens are ordinary text; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from ordermart.llm.common import lean

KEPT_PIECES = 300_000     # bounds of a worker's tables; a full table is emptied
KEPT_PAIRS = 300_000
LONG_PIECE = 60           # longer pieces are encoded but not kept


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _keep(table: dict[str, bytes], text: str, ids: bytes) -> None:
    if len(text) <= LONG_PIECE:
        if len(table) >= KEPT_PIECES:
            table.clear()
        table[text] = ids


class Decoder:
    """The bytes of every token; decoding needs nothing else."""

    def __init__(self, path: str):
        rank = read_ranks(path)
        by_id = {r: token for token, r in rank.items()}
        self.tokens = [by_id.get(i) for i in range(1 + max(by_id))]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class RankBpe:
    """One rank file and the pattern that splits a text before the merges."""

    def __init__(self, path: str, pattern: str):
        self.rank = read_ranks(path)
        self.bytes_of = [b""] * (1 + max(self.rank.values()))
        for token, r in self.rank.items():
            self.bytes_of[r] = token
        self.never = len(self.bytes_of)                # after every merge
        #: The two tokens that each token is merged from; tokens that merging
        #: their own bytes does not give stand only for whole pieces.
        self.halves: dict[int, tuple[int, int]] = {}
        reached: dict[bytes, int] = {}
        for token, r in self.rank.items():
            parts = self._merged(token)
            if len(parts) == 2:
                self.halves[r] = parts[0], parts[1]
                if max(parts) >= r:      # merges would not go by rank alone
                    raise ValueError(f"token {r} ranks before a part of it")
            if len(parts) <= 2:
                reached[token] = r
        if any(bytes([b]) not in reached for b in range(256)):
            raise ValueError("every byte must be a token")
        self.automaton = ahocorasick.Automaton()
        for token, r in reached.items():
            self.automaton.add_word(token.decode("latin-1"), r)
        self.automaton.make_automaton()
        self.next_shorter = [-1] * self.never
        for token, r in reached.items():
            prefixes = (token[:n] for n in range(len(token) - 1, 0, -1))
            self.next_shorter[r] = next((reached[p] for p in prefixes if p in reached), -1)
        self.size_of = [len(b) for b in self.bytes_of]
        self.split = regex.compile(pattern).findall
        self.pairs: dict[int, bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _merged(self, token: bytes) -> list[int]:
        """The parts of a token's bytes before the last merge, or those that
        no merge joins any more."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            ranks = [self.rank.get(a + b, self.never) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == self.never:
                break
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank.get(p, self.never) for p in parts]

    def adjacent(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both leaves exactly these two."""
        key = left * self.never + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._adjacent(left, right)
        return known

    def _adjacent(self, left: int, right: int) -> bool:
        # Back in time: of the two tokens at the seam the one merged later is
        # taken apart (of equal ones the right one, as the left merges first).
        # A merge across the seam that was possible then and ranks before the
        # merge just taken back would have come first.
        rank, bytes_of, halves = self.rank, self.bytes_of, self.halves
        limit = self.never
        while True:
            if rank.get(bytes_of[left] + bytes_of[right], self.never) < limit:
                return False
            a, b = halves.get(left), halves.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                limit, left = left, a[1]
            else:
                limit, right = right + 1, b[0]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        latin, n = piece.decode("latin-1"), len(piece)
        size_of, shorter, known, never = self.size_of, self.next_shorter, self.pairs.get, self.never
        given_up = bytearray(n + 1)
        ids: list[int] = []
        at, token = 0, self._longest(latin, 0)
        while True:
            end = at + size_of[token]
            if not given_up[end] and (
                    not ids or known(ids[-1] * never + token) or self.adjacent(ids[-1], token)):
                ids.append(token)
                if end == n:
                    return ids
                at, token = end, self._longest(latin, end)
                continue
            token = shorter[token]
            while token < 0:
                given_up[at] = 1
                token = ids.pop()
                at -= size_of[token]
                token = shorter[token]

    def _longest(self, latin: str, at: int) -> int:
        """The longest token that begins at a place: as every byte is a token,
        the automaton's first match from there on."""
        return next(self.automaton.iter_long(latin, at))[1]

    def packed(self, text: str) -> bytes:
        """Ids of a text as 32-bit integers.  The text is taken in chunks, each
        from a space to before the next; most have been met before.  No match of
        the pattern reaches from a character to a space behind it, so where
        a space follows other than white space the parts can be split alone."""
        known, out, chunks = self.chunks.get, [], text.split(" ")
        lead = ""
        held = None
        for chunk in chunks:
            chunk = lead + chunk if held is None else held + lead + chunk
            lead = " "
            found = known(chunk)
            if found is None:
                held = chunk
                if not chunk or chunk[-1].isspace():
                    continue                     # the white space may go on
                found = self._chunk(chunk)
            held = None
            out.append(found)
        if held is not None:
            out.append(self._chunk(held))
        return b"".join(out)

    def _chunk(self, chunk: str) -> bytes:
        ids = []
        for piece in self.split(chunk):
            found = self.pieces.get(piece)
            if found is None:
                found = np.array(self.encode_piece(piece.encode()), dtype="<i4").tobytes()
                _keep(self.pieces, piece, found)
            ids.append(found)
        packed = b"".join(ids)
        if chunk and not chunk[-1].isspace():
            _keep(self.chunks, chunk, packed)
        return packed

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), dtype="<i4").tolist()

    def forget(self) -> None:
        """Empty the tables of texts; what is known of tokens stays."""
        self.pieces.clear()
        self.chunks.clear()


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> RankBpe:
    """The vocabulary, read once per Python worker."""
    return RankBpe(path, pattern)


def _each(run: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable:
    return lambda batches: map(run, batches)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids) for every row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(path, pattern)
        ids = [bpe.packed(t or "") for t in part.column("text").to_pylist()]
        counts = np.array([len(i) // 4 for i in ids], dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
        return pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array(counts), pa.ListArray.from_arrays(pa.array(ends), values)],
            names=[id_col, "n_tokens", "ids"])

    return rows.mapInArrow(lean(_each(run), lambda: load(path, pattern).forget()),
                           f"`{id_col}` long, n_tokens long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_tokens, ids, decoded): the bytes the ids stand for.  Null ids
    decode to no bytes; an id outside the vocabulary is an error."""
    rows = encoded.select(F.col(id_col).alias("id"), "n_tokens", "ids")

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        decode = decoder(path).decode
        decoded = [decode(ids.values.to_numpy().tolist() if ids.is_valid else []) for ids in part.column("ids")]
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())],
                                          names=[id_col, "n_tokens", "ids", "decoded"])

    return rows.mapInArrow(lean(_each(run)),
                           f"`{id_col}` long, n_tokens long, ids array<int>, decoded binary")
