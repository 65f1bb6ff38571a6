import random
import re
import zlib
from hashlib import sha256

import pytest

from ordermart.llm import repair
from ordermart.llm.catalog import op11_repair
from tests.llm import edge

SCHEMA = "conv_id long, turn long, role string, text string, n long, kind string, audit string, edit string"


def cheapest(rows: list[tuple[str, bool, bool]]) -> tuple[int, str, str]:
    """Brute force: all edits of (initial, must go, truncated) rows that cost
    no more than deleting every row."""
    found = []

    def go(i, roles, audit, cost):
        if cost > 2 * len(rows) or not re.match(r"(s?(ua)*u?)?\Z", roles):
            return
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", roles):
            found.append((cost, audit, roles))
        for role in "ua":
            go(i, roles + role, audit + "I", cost + 5)
        if i < len(rows):
            initial, must_go, truncated = rows[i]
            go(i + 1, roles, audit + "D", cost + 2)
            if not must_go:
                price = 5 if truncated else 0
                for role in "ua":
                    go(i + 1, roles + role, audit + "R", cost + 1 + price)
                if initial in ("s", "u", "a"):
                    go(i + 1, roles + initial, audit + "K", cost + price)

    go(0, "", "", 0)
    return min(found)


def code(row):
    initial, must_go, truncated = row
    return {"s": 0, "u": 1, "a": 2}.get(initial, 3) + 8 * must_go + 4 * truncated


def random_rows(rng, n):
    return [(rng.choice("suuaat"), rng.random() < 0.15, rng.random() < 0.25) for _ in range(n)]


@pytest.mark.parametrize("block", [1, 2, 3, repair.BLOCK])
def test_plan_against_all_edits(block):
    rng = random.Random(block)
    for n in range(8):
        for _ in range(80):
            rows = random_rows(rng, n)
            assert repair.plan(bytes(map(code, rows)), block) == cheapest(rows)[:2]


def test_blocks_change_nothing_in_long_conversations():
    rng = random.Random(5)
    for rows in ([("u", False, False)] * 3001, random_rows(rng, 3000), [("s", False, False)] * 500):
        codes = bytes(map(code, rows))
        whole = repair.plan(codes, len(codes) + 1)
        assert all(repair.plan(codes, block) == whole for block in (2, 613, 2048))


def expected(rows):
    """The contract, row by row, in plain Python."""
    out = {}
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        mine = out.setdefault(conv, [])
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        mine += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return sorted((one(conv, mine) for conv, mine in out.items()), key=str)


def one(conv, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1],
                                       sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults = []
    for i, (_, role, text) in enumerate(rows):
        words = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not words else "duplicate" if (role, text) in [r[1:] for r in rows[:i]]
                      else "truncated" if words[-1] not in ".!?" else "")
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    codes = [(r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, faults)]
    cost, audit, roles = cheapest(codes)
    left, at, lines = iter(rows), iter(roles), []
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(left)[1:]
        if letter == "D":
            continue
        kind = next(at)
        lines.append((role if letter == "K" else {"u": "user", "a": "assistant"}[kind]) + ":" + text)
    return (conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            sha256("\n".join(lines).encode()).hexdigest())


def edge_rows():
    rng = random.Random(2)
    says = ["Yes.", "no", "", " \t\n", "Why?  ", "Fine!", None, "x" * 200_000, "tail.\x0b", "\x1c", "a\n.b"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None, "User"]), rng.choice(says))
            for c in range(60) for t in rng.sample(range(9), 5)]
    rows += [(None, t, "user", "no id.") for t in (0, 0, 1, None)]
    rows += [(100, None, "user", "Hi."), (100, 1, "assistant", "Ho."), (100, None, "user", "Hi.")]
    rows += [(101, 3, "user", "one."), (101, 3, "assistant", "two."), (101, 3, "assistant", "a."), (101, 9, "user", "c")]
    rows += [(200 + i, 0, "user", "Alone.") for i in range(60)]      # some lose their only row
    return rows


def write(spark, rows, folder):
    extra = [(*r, 1, "k", "a", "e") for r in rows]
    spark.createDataFrame(extra, SCHEMA).repartition(3).write.parquet(f"{folder}/conversations.parquet")
    return folder


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_over_edge_rows(spark, tmp_dir):
    rows = edge_rows()
    got = op11_repair(spark, write(spark, rows, f"{tmp_dir}/edge"))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                           "repaired_sha256"]
    assert result(got) == expected(rows)
    lost = {r[0] for r in expected(rows) if r[7] == "" and r[0] is not None and r[0] >= 200}
    assert lost and lost <= {r.conv_id for r in got.collect()}
    assert result(op11_repair(spark, write(spark, [], f"{tmp_dir}/none"))) == []


def test_query_over_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{edge.SF}/conversations.parquet").collect()]
    assert result(op11_repair(spark, edge.SF)) == expected(rows)


def test_repaired_turns_are_the_conversation(spark):
    rows = spark.createDataFrame(
        [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "user", "Anyone?"), (1, 3, "assistant", "Yes."),
         (1, 4, "assistant", "Yes."), (2, 0, "assistant", "Hi."), (3, None, None, None)],
        "conv_id long, turn long, role string, text string")
    report = repair.report(rows)
    assert {r.conv_id: (r.cost, r.audit) for r in report.collect()} == {1: (4, "KDKKD"), 2: (2, "D"), 3: (0, "")}
    turns = repair.repaired_turns(rows, report).where("stays").orderBy("conv_id", "n").collect()
    assert [(r.role, r.text) for r in turns] == [("system", "Be kind."), ("user", "Anyone?"), ("assistant", "Yes.")]


def test_one_conversation_with_most_rows(spark):
    """A third of all rows in one conversation passes through in blocks."""
    rows = [(7, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(6000)]
    rows += [(1000 + t, 0, "user", "Hi.") for t in range(12_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    big = repair.report(frame).where("conv_id = 7").collect()[0]
    assert (big.cost, big.audit) == (0, "K" * 6000)


def test_sql_says_the_same(spark, tmp_dir):
    import duckdb
    from ordermart.llm.catalog import SQL
    for folder in (edge.SF, write(spark, edge_rows(), f"{tmp_dir}/sql")):
        con = duckdb.connect()
        glob = "/*.parquet" if folder != edge.SF else ""
        con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet{glob}'")
        columns = "conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256"
        got = con.sql(f"SELECT {columns} FROM ({SQL['op11_repair']})").fetchall()
        assert sorted(got, key=str) == result(op11_repair(spark, folder))
