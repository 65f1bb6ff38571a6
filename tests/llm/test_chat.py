import hashlib
import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ordermart.llm import catalog, chat

ESC = chat.ESCAPE


def escape(text):
    """The rule by hand: one more escape after the first character of every
    control string, escaped or not."""
    out, i = [], 0
    while i < len(text):
        for c in chat.CONTROL:
            j = i + 1
            while j < len(text) and text[j] == ESC:
                j += 1
            if text[i] == c[0] and text.startswith(c[1:], j):
                out.append(text[i] + ESC + text[i + 1:j + len(c) - 1])
                i = j + len(c) - 1
                break
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


HARD = st.lists(st.sampled_from([*chat.CONTROL, ESC, "<", "[", "<|", "a", "\n", "s>", "<" + ESC + "s>", "é", "<<s>"]),
                max_size=12).map("".join)


def test_round_trip_of_hard_texts(spark):
    @settings(max_examples=1, deadline=None)
    @given(st.lists(st.tuples(HARD, HARD), min_size=400, max_size=500))
    def run(pairs):
        rows = [(1, i, role, text) for i, (role, text) in enumerate(pairs)]
        parts = chat.segments(spark.createDataFrame(rows, chat.TURNS), trained=pairs[0][0])
        segments = {r.turn: r.segment for r in parts.collect()}
        assert segments == {i: chat.START + escape(a) + chat.MIDDLE + escape(b) + chat.STOP
                            for i, (a, b) in enumerate(pairs)}
        for text in segments.values():
            inner = text[len(chat.START):-len(chat.STOP)]
            assert inner.count(chat.MIDDLE) == 1
            assert not any(c in part for part in inner.split(chat.MIDDLE) for c in chat.CONTROL)
        back = {r.turn: (r.role, r.text, r.loss_text) for r in chat.read_segments(parts).collect()}
        assert back == {i: (a, b, b if a == pairs[0][0] else None) for i, (a, b) in enumerate(pairs)}
    run()


def records():
    return [
        {"conv_id": 1, "messages": [{"role": "user", "content": "a <s>"}, {"role": "assistant", "content": None}]},
        {"conv_id": 2, "prompt": "p", "completion": "<|im_end|>"},
        {"conv_id": 3, "instruction": "i", "input": "", "output": "o"},
        {"conv_id": 4, "instruction": "i", "input": "x", "output": "o"},
        {"conv_id": 5, "conversations": [{"from": "human", "value": "x"}, {"from": "gpt", "value": "y"},
                                         {"from": "tool", "value": "z"}]},
        {"conv_id": 6, "conversation": {"messages": [{"role": "assistant", "content": "z"}]}},
        {"conv_id": 7, "turn": 3, "role": "user", "text": None},
        {"conv_id": 8, "question": "q", "answer": "a"},
        {"conv_id": 9, "messages": [{"role": "user", "text": "t"}]},
        {"conv_id": 10, "instruction": "only", "output": "o"},
        {"conv_id": 11, "prompt": "p", "response": "r"},
    ]


TURNS = {(1, 0, "user", "a <s>"), (1, 1, "assistant", ""), (2, 0, "user", "p"), (2, 1, "assistant", "<|im_end|>"),
         (3, 0, "user", "i"), (3, 1, "assistant", "o"), (4, 0, "user", "i\n\nx"), (4, 1, "assistant", "o"),
         (5, 0, "user", "x"), (5, 1, "assistant", "y"), (5, 2, "tool", "z"), (6, 0, "assistant", "z"),
         (7, 3, "user", ""), (8, 0, "user", "q"), (8, 1, "assistant", "a"), (9, 0, "user", "t"),
         (10, 0, "user", "only"), (10, 1, "assistant", "o"), (11, 0, "user", "p"), (11, 1, "assistant", "r")}


def test_json_records_of_mixed_layouts(spark):
    df = spark.createDataFrame([(json.dumps(r), "x") for r in records()] + [(None, "y")], "record string, layout string")
    assert {tuple(r) for r in chat.from_json_records(df).collect()} == TURNS
    assert chat.from_json_records(df.limit(0)).count() == 0
    for bad in ('{"a": 1}', "not json", '{"conv_id": 1, "messages": {"role": "user"}}'):
        with pytest.raises(ValueError, match="no mapping"):
            chat.from_json_records(spark.createDataFrame([(bad,)], "record string"))


def test_typed_tables_of_each_layout(spark):
    for r in records():
        df = spark.read.schema(chat._record_type(next(
            m for m in chat.REGISTRY if chat._layout_of(m) == layout(spark, r)))[7:-1].replace("`: ", "` ")
        ).json(spark.sparkContext.parallelize([json.dumps(r)]))
        df = df.withColumn("head", F.lit(1)).withColumn("segment", F.lit(2))
        assert {tuple(t) for t in chat.to_turns(df).collect()} == {t for t in TURNS if t[0] == r["conv_id"]}
    with pytest.raises(ValueError, match="no mapping"):
        chat.to_turns(spark.range(1))


def layout(spark, record):
    df = spark.createDataFrame([(json.dumps(record),)], "record string")
    return df.select(chat.json_layout(F.col("record"))).first()[0]


def test_fingerprints_are_distinct_and_ordered_by_path():
    assert len({m.fingerprint for m in chat.REGISTRY}) == len(chat.REGISTRY)
    assert chat.fingerprint(["b", "a"]) == chat.fingerprint(["a", "b"])


def rows_by_hand(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    for conv, turns in out.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        marks = len(chat.START + chat.MIDDLE + chat.STOP)
        yield (conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
               hashlib.sha256(loss.encode()).hexdigest(),
               sum(marks + len(escape(r)) + len(escape(t)) for _, r, t in turns))


@pytest.mark.parametrize("which", ["given", "edge", "empty"])
def test_query(spark, which, monkeypatch):
    if which == "given":
        df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    else:
        rows = [] if which == "empty" else [
            (1, 0, "user", None), (1, None, "assistant", "first"), (1, 2, None, "x"), (1, 2, "assistant", "b" * 9),
            (1, 2, "assistant", "b" * 9), (None, 0, "user", "no id"), (2, 0, "assistant", "é<s>" * 50_000),
            (3, 1, "user", ""), (-1, 7, "assistant", "<s>")]
        df = spark.createDataFrame([(*r, "x", "y") for r in rows],
                                   "conv_id long, turn long, role string, text string, segment string, head string")
    monkeypatch.setattr(catalog, "table", lambda *_: df)
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = sorted((tuple(r) for r in catalog.op5_chat(spark, "").select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars").collect()), key=str)
    assert got == sorted(rows_by_hand(rows), key=str)


def test_joined_conversation_and_mask(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b<s>"), (1, 2, "assistant", ""), (2, 0, "user", "c")]
    got = {r.conv_id: r for r in chat.formatted(chat.segments(spark.createDataFrame(rows, chat.TURNS))).collect()}
    assert [got[1].text[s.start:s.end] for s in got[1].loss] == ["b<" + ESC + "s>", ""] and got[2].loss == []


def test_no_python_in_the_plan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    plan = chat.read_segments(chat.segments(chat.to_turns(df)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
