import json

from hypothesis import given, settings
from hypothesis import strategies as st

from foldlake.llm import chat

TRICKY = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "a", "<", ">", "|", "[", "\n", "é", "<|im_", "end|>", "im_sep"]), max_size=12).map("".join)


@given(st.lists(st.tuples(TRICKY, TRICKY), max_size=4))
@settings(max_examples=200, deadline=None)
def test_escaping_is_reversible(turns):
    text, mask = chat.render(turns)
    assert chat.read_turns(text) == turns
    for _, body in turns:
        assert not any(c in chat.escape(body) for c in chat.CONTROLS)
    assert chat.unescape("".join(text[a:b] for a, b in zip(mask[::2], mask[1::2]))) == "".join(b for r, b in turns if r == "assistant")


def test_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": 3},
        {"prompt": "q", "completion": "a"},
        {"question": "q", "answer": "a"},
        {"instruction": "q", "input": "", "output": "a"},
        {"instruction": "q", "input": "more", "output": "a"},
        {"messages": []},
        {"other": 1},
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(8, None), (9, "no json"), (9, "[1]")]
    got = {}
    for r in chat.format_records(spark.createDataFrame(rows, "conv_id long, record string")).collect():
        got.setdefault(r.conv_id, []).append((r.layout, chat.read_turns(r.formatted)))
    plain = [("user", "q"), ("assistant", "a")]
    assert [got[i][0][1] for i in range(5)] == [plain] * 5
    assert got[5][0][1] == [("user", "q\n\nmore"), ("assistant", "a")]
    assert got[6] == [("messages", [])] and got[7] == [(None, [])] and got[8] == [(None, [])] and got[9] == [(None, [])] * 2


def test_other_fields_and_parts_of_content(spark):
    turn = [{"role": "user", "content": "q", "name": "n"}, {"role": "assistant", "content": [{"type": "text", "text": "a"}, {"type": "image", "url": "u"}]}]
    records = [
        {"messages": turn, "source": "web", "meta": {"lang": "en", "messages": 2}},
        {"prompt": "q", "completion": "a", "id": 4},
        {"id": "x", "question": "q", "answer": "a", "source": ["s"]},
        {"conversations": [{"from": "human", "value": "q", "weight": 0}, {"from": "gpt", "value": "a", "weight": 1}]},
        {"system": "be kind", "messages": turn},
        {"messages": [{"role": "user"}]},
        {"messages": ["loose", {"role": "user", "content": None}]},
        {"messages": "none"},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "conv_id long, record string")
    got = {r.conv_id: (r.layout, chat.read_turns(r.formatted)) for r in chat.format_records(df).collect()}
    plain = [("user", "q"), ("assistant", "a")]
    assert [got[i][1] for i in range(4)] == [plain] * 4
    assert got[4] == ("messages", [("system", "be kind"), *plain])
    assert got[5] == (None, []) and got[6] == ("messages", [("", "loose"), ("user", "")]) and got[7] == ("messages", [])


def test_conversations_come_in_several_layouts(spark):
    rows = [(i, t, ("human" if i == 5 else "user", "assistant")[t], f"text {i} {t}") for i in range(40) for t in (0, 1)]
    records = chat.records_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = chat.format_records(records).collect()
    assert {r.layout for r in out} == {"messages", "sharegpt"} and len({r.fingerprint for r in out}) == 3
    for r in out:
        assert chat.read_turns(r.formatted) == [(role, text) for i, _, role, text in rows if i == r.conv_id]


def test_rows(spark):
    schema = "conv_id long, turn long, role string, text string, record string"
    rows = [(1, 2, "assistant", "</s> b", "x"), (1, 1, "user", None, "x"), (None, 1, None, "z", "x"), (1, 2, "assistant", "</s> b", "x")]
    df = spark.createDataFrame(rows, schema)
    out = {r.conv_id: r for r in chat.digests(chat.format_records(chat.records_of(df))).collect()}
    assert out[1].n_turns == 3 and out[1].loss_chars == 12 and out[None].n_turns == 1
    assert chat.digests(chat.format_records(chat.records_of(df.limit(0)))).count() == 0
