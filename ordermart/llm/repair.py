"""Conversation structure repair by one integer shortest path.

Each row of a conversation is kept (K), given the role user or assistant (R) or
deleted (D), and an empty user or assistant row may be inserted (I) anywhere, so
that the initials of the roles read ``(s?(ua)+)?``.  Blank and repeated rows must
go; a truncated row may stay at a price.

Costs and audit letters are one integer: the high digits hold the cost, then
come digits of fixed width, the n-th for the n-th letter (in ASCII order, from
1), zero where the audit has ended.  The weight of an edit is its cost and its
letter in its place, so the smallest integer is the cheapest repair and, among
equals, the one whose audit comes first in ASCII order.  An ordinary shortest
path over (row, state) decides everything; the state is what the last kept role
allows next.  Keeping one smallest path a node is exact: two paths to one node at
one cost never spell one the other's beginning (the rest would be insertions,
which cost), so they differ in a place that both have.  Two insertions in a row
are never cheapest: what follows them can follow, cheaper, without them, or
without the system row before them.

Integers are as wide as the audit, so long conversations go in blocks of rows:
a block gives, for each state at its start, the smallest integer for each state
at its end, and blocks are joined by the same minimum.

Spark sorts the rows of a conversation into one partition.  The first pass
shuffles no texts, only a digest and flags, and streams over them (16 bytes a
distinct row and a byte a row are held, for one conversation); the second
streams over the audit, then the texts, and writes repaired turns in order.

Defined results: a null role or text is one space, a null conversation id is one
conversation; rows go by turn (none first), equal turns by role, then by the
SHA-256 of role and text; repeated rows are duplicates; an empty role fits
nowhere; texts of any length are only digested and passed on; an empty table
gives empty tables; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ordermart.llm.common import lean

# Costs of the edits.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLOCK = 2048              # rows decided at a time

#: What a row is to the repair: whether it must go, its price if it stays, and
#: the initial of its role.
MUST_GO, CUT_OFF = 8, 4
INITIALS = ["s", "u", "a"]

LETTERS = "DIKR"          # in ASCII order; digits 1 to 4
BITS = 3                  # of a digit
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: State after a kept row, by its initial: where it may come from.
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}   # the role a new name or row gets


# -- one conversation ---------------------------------------------------------------

def _block(rows: bytes, start: int, last: bool) -> dict[int, tuple[int, int]]:
    """For each state at the end of a block the smallest integer that leads
    there from ``start``, and the number of its letters.  Insertions stand
    before a row; after the last row, too, in the last block."""
    width = 2 * len(rows) + 1
    cost_bit = BITS * width

    def edit(cost: int, letter: str, place: int) -> int:
        return (cost << cost_bit) + ((LETTERS.index(letter) + 1) << (BITS * (width - 1 - place)))

    def inserted(nodes: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
        out = dict(nodes)
        for state, (weight, place) in nodes.items():
            step = weight + edit(INSERT, "I", place), place + 1
            out[NEXT[state]] = min(out.get(NEXT[state], step), step)
        return out

    nodes = {start: (0, 0)}
    for row in rows:
        after: dict[int, tuple[int, int]] = {}
        kept = AFTER.get((INITIALS + [""])[row & 3], {})
        price = TRUNCATED if row & CUT_OFF else 0
        for state, (weight, place) in inserted(nodes).items():
            steps = [(state, DELETE, "D")]
            if not row & MUST_GO:
                steps.append((NEXT[state], RENAME + price, "R"))
                if state in kept:
                    steps.append((kept[state], price, "K"))
            for to, cost, letter in steps:
                step = weight + edit(cost, letter, place), place + 1
                after[to] = min(after.get(to, step), step)
        nodes = after
    return inserted(nodes) if last else nodes


def plan(rows: bytes, block: int = BLOCK) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a conversation, a byte a row."""
    best, total = {START: (0, 0)}, 0           # weights as wide as all blocks so far
    cuts = range(0, max(len(rows), 1), block)
    for at in cuts:
        part, last = rows[at:at + block], at == cuts[-1]
        width = 2 * len(part) + 1
        joined: dict[int, tuple[int, int]] = {}
        for state, (weight, place) in best.items():
            head = weight << (BITS * width)
            for to, (more, letters) in _block(part, state, last).items():
                # The block's digits follow the letters there are already.
                cost = more >> (BITS * width)
                digits = (more & ((1 << BITS * width) - 1)) << (BITS * (total - place))
                step = head + (cost << BITS * (total + width)) + digits, place + letters
                joined[to] = min(joined.get(to, step), step)
        best, total = joined, total + width
    weight, letters = min(best[s] for s in ENDS if s in best)
    digits = oct(weight & ((1 << BITS * total) - 1))[2:].zfill(total)
    return weight >> (BITS * total), "".join(LETTERS[int(d) - 1] for d in digits[:letters])


def repaired(rows: Iterable[tuple[str, str]], audit: str) -> Iterator[tuple[str, str, str, bool]]:
    """(edit, role, text, stays) along an audit; deleted rows are told with
    their own role and text, a new role follows from what was kept before."""
    state, rows = START, iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "K":
            state = AFTER[role[:1]][state]
        elif letter != "D":
            state = NEXT[state]
            role = "user" if state == USER else "assistant"
        yield letter, role, text, letter != "D"


# -- tables -------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the rows with the faults that
    crc32(``conv_id:turn``) mod 20 deals out.  A conversation that loses a row
    keeps a row of nulls in its place, so that none is lost."""
    def spaced(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = (F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    gone = F.col("fault") == 0
    return (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 spaced("role").alias("role"), spaced("text").alias("text"), fault.alias("fault"))
            .withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", F.when(~gone, F.col("turn")).alias("turn"),
                    F.when(F.col("fault") == 4, "user").when(~gone, F.col("role")).alias("role"),
                    F.when(~gone, text).alias("text")))


def _digest() -> Column:
    """SHA-256 of role and text, which tells rows apart and orders equal turns."""
    return F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))


_WHITE = r"\x20\x09-\x0D"


def _facts(rows: DataFrame) -> DataFrame:
    """What the repair needs of each row, without its text; rows of nulls only
    name their conversation."""
    here = F.col("role").isNotNull() & F.col("text").isNotNull()
    initial = F.substring("role", 1, 1)
    blank = F.col("text").rlike(f"^[{_WHITE}]*\\z")
    cut_off = ~F.col("text").rlike(f"[.!?][{_WHITE}]*\\z")
    code = (F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
            + F.when(blank, MUST_GO).otherwise(0) + F.when(cut_off, CUT_OFF).otherwise(0))
    return rows.select("conv_id", "turn", "role", F.when(here, _digest()).alias("digest"),
                       F.when(here, code).cast("int").alias("code"), initial.alias("initial"))


REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string")
_LEGAL = {"su", "ua", "au"}


class _Conversation:
    """Counts of one conversation, row by row."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.first = self.last = self.initial = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.codes, self.seen = bytearray(), set()

    def add(self, turn: int | None, digest: bytes | None, code: int | None, initial: str | None) -> None:
        if digest is None:
            return
        if turn is not None:
            if turn != self.last:
                self.turns += 1
            self.first, self.last = turn if self.first is None else self.first, turn
        if self.initial is not None:
            self.illegal += self.initial + initial not in _LEGAL
        self.initial = initial
        digest, repeats = digest[:16], len(self.seen)
        self.seen.add(digest)
        if code & MUST_GO:
            self.blank += 1
        elif len(self.seen) == repeats:
            self.duplicate += 1
            code |= MUST_GO
        elif code & CUT_OFF:
            self.truncated += 1
        self.codes.append(code)

    def row(self) -> tuple:
        cost, audit = plan(bytes(self.codes))
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _batched(rows: Iterable[tuple], schema: pa.Schema, most_rows: int = 2000,
             most_chars: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded rows and characters."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= most_rows or chars >= most_chars:
            yield _batch(held, schema)
            held, chars = [], 0
    if held:
        yield _batch(held, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


_LONG, _STRING = pa.int64(), pa.string()
_REPORT_TYPES = pa.schema([("conv_id", _LONG), ("gaps", _LONG), ("blank", _LONG), ("duplicate", _LONG),
                           ("truncated", _LONG), ("illegal", _LONG), ("cost", _LONG), ("audit", _STRING)])


def report(rows: DataFrame) -> DataFrame:
    """One row a conversation: counts of its faults, cost and audit of its
    cheapest repair.  Rows whose role or text is null only name a conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversations() -> Iterator[tuple]:
            for conv_id, group in groupby(_rows(batches), key=lambda r: r[0]):
                conversation = _Conversation(conv_id)
                for _, turn, _, digest, code, initial in group:
                    conversation.add(turn, digest, code, initial)
                yield conversation.row()
        yield from _batched(conversations(), _REPORT_TYPES)

    facts = _facts(rows).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest")
    return facts.mapInArrow(lean(run), REPORT)


TURNS = "conv_id long, n long, edit string, role string, text string, stays boolean"
_TURN_TYPES = pa.schema([("conv_id", _LONG), ("n", _LONG), ("edit", _STRING), ("role", _STRING), ("text", _STRING),
                         ("stays", pa.bool_())])


def repaired_turns(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """(conv_id, n, edit, role, text, stays): every edit with its row.  Rows
    that stay are the repaired conversation.  A conversation's turns come from
    one partition, in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns() -> Iterator[tuple]:
            for conv_id, group in groupby(_rows(batches), key=lambda r: r[0]):
                audit = next(group)[-1]
                edits = repaired(((role, text) for _, _, role, text, _ in group), audit)
                for n, (edit, role, text, stays) in enumerate(edits):
                    yield conv_id, n, edit, role, text, stays
        yield from _batched(turns(), _TURN_TYPES)

    given = rows.where("role is not null and text is not null")
    both = (reports.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                           F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
                           F.lit(None).cast("binary").alias("digest"), "audit")
            .unionByName(given.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text",
                                      _digest().alias("digest"), F.lit(None).cast("string").alias("audit"))))
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    return ordered.select("conv_id", "turn", "role", "text", "audit").mapInArrow(lean(run), TURNS)


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the turns that stay, as ``repaired_turns``
    gives them: ``role:text``, joined by newlines, hashed turn by turn, so
    that a conversation of any length needs no more memory than a turn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashed() -> Iterator[tuple]:
            for conv_id, group in groupby(_rows(batches), key=lambda r: r[0]):
                whole, between = sha256(), b""
                for _, role, text in group:
                    whole.update(between + f"{role}:{text}".encode())
                    between = b"\n"
                yield conv_id, whole.hexdigest()
        yield from _batched(hashed(), pa.schema([("conv_id", _LONG), ("repaired_sha256", _STRING)]))

    return turns.where("stays").select("conv_id", "role", "text").mapInArrow(
        lean(run), "conv_id long, repaired_sha256 string")
