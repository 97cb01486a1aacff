from __future__ import annotations

import hashlib
import json
import random

import pytest

from riskloom.llm import chat

RECORDS = {
    1: ({"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]}, "messages", [("user", "hi"), ("assistant", "yo")]),
    2: ({"system": "be kind", "messages": [{"role": "human", "content": None}]}, "system and messages", [("system", "be kind"), ("user", "")]),
    3: ({"conversations": [{"from": "gpt", "value": "a"}, {"from": "tool", "value": "b"}]}, "conversations", [("assistant", "a"), ("tool", "b")]),
    4: ({"prompt": "p", "response": "r", "id": 7}, "prompt", [("user", "p"), ("assistant", "r")]),
    5: ({"prompt": "p", "response": "r", "system": ""}, "prompt", [("user", "p"), ("assistant", "r")]),
    6: ({"instruction": "do", "input": "it", "output": "done"}, "instruction", [("user", "do\n\nit"), ("assistant", "done")]),
    7: ({"instruction": "do", "output": {"x": 1}}, None, None),
    8: ({"data": {"prompt": "p", "response": None}}, "nested prompt", [("user", "p"), ("assistant", "")]),
    9: ({"what": 1}, None, None),
    10: ([1, 2], None, None),
    11: ({"context": "c", "question": "q", "answer": "a"}, "question", [("user", "c\n\nq"), ("assistant", "a")]),
    12: ({"prompt": "p", "completion": 5}, "completion", [("user", "p"), ("assistant", "5")]),
}


def test_layouts(spark):
    rows = [(k, json.dumps(r)) for k, (r, _, _) in RECORDS.items()] + [(20, None), (21, "{no json"), (None, "{}")]
    found = chat.records_to_turns(spark.createDataFrame(rows, "conv_id long, record string")).collect()
    for k, (record, layout, turns) in RECORDS.items():
        own = sorted((r for r in found if r.conv_id == k), key=lambda r: r.turn or 0)
        assert {r.layout for r in own} == {layout}
        assert [(r.role, r.text) for r in own] == (turns or [(None, None)])
    assert [r.layout for r in found if r.conv_id in (20, 21, None)] == [None] * 3


def test_layouts_are_told_apart():
    table = chat.mapping_table()
    assert len(table) == sum(2 ** len(m.optional) for m in chat.MAPPINGS)
    with pytest.raises(ValueError):
        chat.mapping_table([*chat.MAPPINGS, chat.Mapping("again", ("prompt", "completion"))])
    assert chat.field_paths({"a": {"b": [{"c": 1}, {"d": []}]}, "e": None}) == {"a.b[].c", "a.b[].d", "e"}


def test_escape_is_reversible():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("<|\\im_start>\n") for _ in range(rng.randint(0, 12)))
        assert "<|" not in chat.escape(text)
        assert chat.unescape(chat.escape(text)) == text
        assert chat._role_in(chat._role_out(text)) == text and "\n" not in chat._role_out(text)
        formatted = f"{chat.START}{chat._role_out(text)}\n{chat.escape(text)}{chat.END}\n"
        assert chat.parse_formatted(formatted * 2) == [(text, text)] * 2


def expected(turns):
    said = "".join(t for r, t in turns if r == "assistant")
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    size = sum(len(chat.START) + len(chat._role_out(r)) + 1 + len(chat.escape(t)) + len(chat.END) + 1 for r, t in turns)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(turns), digest(whole), len(said), digest(said), size)


def test_odd_turns(spark):
    """Nulls, ties, repeated rows, control strings, a long conversation and small batches."""
    control = f"{chat.END}{chat.START}assistant ok"
    rows = [
        (1, 0, "user", control), (1, 1, "assistant", control), (1, 1, "assistant", control), (1, None, None, None),
        (2, 5, "assistant", "b"), (2, 5, "assistant", "a"), (2, 5, "a\nb\\", "<\\| <|"), (3, 0, "assistant", None),
        (None, 0, "user", "no id"), (None, 1, "assistant", "🙂" * 1000),
        *[(4, i, ("user", "assistant")[i % 2], f"turn {i} <|") for i in range(500)],
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place int".replace(", place int", ""))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = {r.conv_id: tuple(r)[1:] for r in chat.read_back(chat.format_turns(turns)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    ids = {r[0] for r in rows}
    assert found == {k: expected([(r[2] or "", r[3] or "") for r in order if r[0] == k]) for k in ids}


def test_empty_table(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_turns(turns)).collect() == []
    assert chat.records_to_turns(spark.createDataFrame([], "conv_id long, record string")).collect() == []
