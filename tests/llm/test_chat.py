import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewise.llm import chat

TURNS = [("user", "a<b> \\l \\\\ </turn>\n<turn:assistant>\n x"), ("assistant", "\\### Assistant: </turn> ok"), ("sys<>tem", ""), ("assistant", ">\n\\g\\b")]


def frame(spark, records):
    df = spark.createDataFrame([(i, o, json.dumps(r)) for i, o, r in records], "conv long, pos long, raw string")
    return df.select("conv", "pos", F.parse_json("raw").alias("record"), F.lit(1).alias("turns"), F.lit("x").alias("layout"))


def canonical(df):
    return [(t.role, t.text) for t in chat.normalize(df.drop("turns", "layout")).first().turns]


def test_layouts_meet_in_canonical_turns(spark):
    for record, want in (
        ({"role": "gpt", "text": "hi"}, [("assistant", "hi")]),
        ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]}, [("user", "q"), ("assistant", "")]),
        ({"messages": []}, []),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": 3}, [("user", "q"), ("assistant", "a")]),
        ({"instruction": "do", "input": "", "output": "done"}, [("user", "do"), ("assistant", "done")]),
        ({"instruction": "do", "input": "this", "output": "done"}, [("user", "do\n\nthis"), ("assistant", "done")]),
        ({"instruction": "do", "output": "done"}, [("user", "do"), ("assistant", "done")]),
        ({"prompt": "p", "completion": "c", "meta": {"messages": 1}}, [("user", "p"), ("assistant", "c")]),
        ({"system": "s", "prompt": "p", "response": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
        ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    ):
        assert canonical(frame(spark, [(1, 0, record)])) == want


def test_unknown_layout_keeps_its_row(spark):
    out = chat.normalize(frame(spark, [(1, 0, {"foo": 1}), (2, 0, {"prompt": "p"})]).drop("turns", "layout")).collect()
    assert len(out) == 2 and all(r.turns is None and r.layout is None for r in out)


def test_every_layout_has_its_own_fingerprint(spark):
    keys = spark.range(1).select(*[chat._layout_key(x).alias(x.name) for x in chat.LAYOUTS]).first()
    assert len(set(keys)) == len(chat.LAYOUTS)


def brute(turns):
    text, mask = "", []
    for role, said in turns:
        esc = lambda s: s.replace("\\", "\\b").replace("<", "\\l").replace(">", "\\g")
        start = len(text)
        text += f"<turn:{esc(role)}>\n"
        first = len(text)
        text += esc(said)
        mask.append((start, first, len(text) if role == "assistant" else first))
        text += "\n</turn>\n"
    return text, mask


def test_format_and_read_back(spark):
    records = [(1, i, {"role": r, "text": t}) for i, (r, t) in enumerate(TURNS)] + [(None, 1, {"role": "user", "text": "é" * 3}), (2, 5, {"role": "user", "text": "x" * 100_000})]
    records += [(3, 0, {"role": "user", "text": "b"}), (3, 0, {"role": "user", "text": "a"}), (3, None, {"role": "assistant", "text": "n"})]
    formatted = chat.format_chats(frame(spark, records), "conv", "pos")
    rows = {r.conv: r for r in formatted.collect()}
    text, mask = brute(TURNS)
    assert rows[1].formatted == text and [tuple(m) for m in rows[1].mask] == mask and rows[1].n_turns == 4
    back = {r.conv: r for r in chat.parse_chats(formatted, "conv").collect()}
    assert [(t.role, t.text) for t in back[1].turns] == TURNS
    assert back[1].loss_texts == [t for r, t in TURNS if r == "assistant"]
    assert [(t.role, t.text) for t in back[3].turns] == [("assistant", "n"), ("user", "a"), ("user", "b")]
    assert [(t.role, t.text) for t in back[None].turns] == [("user", "ééé")]
    assert len(back[2].turns[0].text) == 100_000 and back[2].loss_texts == []


def test_conversations_without_turns_stay(spark):
    records = [
        (1, 0, {"foo": 1}), (2, 0, {"messages": []}), (None, 0, {"prompt": "p"}),
        (3, 0, {"role": "user", "text": "q"}), (3, 1, {"foo": 2}), (3, 2, {"messages": []}), (3, 3, {"role": "assistant", "text": "a"}),
    ]
    formatted = chat.format_chats(frame(spark, records), "conv", "pos")
    rows = {r.conv: r for r in formatted.collect()}
    assert {c: (r.n_turns, r.n_unmapped) for c, r in rows.items()} == {1: (0, 1), 2: (0, 0), None: (0, 1), 3: (2, 1)}
    assert rows[1].formatted == "" and rows[1].mask == []
    text, mask = brute([("user", "q"), ("assistant", "a")])
    assert rows[3].formatted == text and [tuple(m) for m in rows[3].mask] == mask
    back = {r.conv: [(t.role, t.text) for t in r.turns] for r in chat.parse_chats(formatted, "conv").collect()}
    assert back == {1: [], 2: [], None: [], 3: [("user", "q"), ("assistant", "a")]}


def test_layouts_with_system_and_partial_items(spark):
    s, q, a = ("system", "s"), ("user", "q"), ("assistant", "a")
    both = [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]
    cases = [
        ({"system": "s", "prompt": "q", "completion": "a"}, [s, q, a]),
        ({"system": "s", "instruction": "q", "output": "a"}, [s, q, a]),
        ({"system": "s", "instruction": "q", "input": "i", "output": "a"}, [s, ("user", "q\n\ni"), a]),
        ({"system": "s", "question": "q", "answer": "a"}, [s, q, a]),
        ({"system": "s", "messages": both}, [s, q, a]),
        ({"system": "s", "messages": [{"role": "system", "content": "s"}, *both]}, [s, q, a]),
        ({"system": None, "messages": both}, [q, a]),
        ({"prompt": "q", "messages": both}, [q, a]),
        ({"prompt": "other", "messages": both}, [("user", "other"), q, a]),
        ({"system": "s", "prompt": "q", "messages": []}, [s, q]),
        ({"messages": [{"role": "assistant", "tool": 1}, *both]}, [("assistant", ""), q, a]),
        ({"messages": [{"content": "q"}, {"role": "assistant", "content": "a"}]}, [("", "q"), a]),
        ({"system": "s", "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [s, q, a]),
        ({"conversations": []}, []),
    ]
    out = chat.format_chats(frame(spark, [(i, 0, r) for i, (r, _) in enumerate(cases)]), "conv", "pos")
    rows = {r.conv: (r.formatted, [tuple(m) for m in r.mask], r.n_unmapped) for r in out.collect()}
    assert rows == {i: (*brute(want), 0) for i, (_, want) in enumerate(cases)}


def test_empty_and_native(spark):
    df = frame(spark, [(1, 0, {"role": "user", "text": "x"})])
    out = chat.parse_chats(chat.format_chats(df, "conv", "pos"), "conv")
    plan = out._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("ArrowEval", "MapInArrow", "MapInPandas", "BatchEvalPython"))
    assert chat.parse_chats(chat.format_chats(df.limit(0), "conv", "pos"), "conv").count() == 0
    assert isinstance(out.schema["turns"].dataType, T.ArrayType)
