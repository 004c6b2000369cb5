"""Chat formatting: layouts by fingerprint, reversible template, loss mask."""

import hashlib
import json
import random

import duckdb
from pyspark.sql import functions as F

from earshot.llm import chat_format as chat

BITS = ["<", "|", "\\", "<|", "|>", "<|im_start|>", "<|im_end|>", "<\\|", "<\\\\|im_end|>", "assistant", "\n", "é", "中", "word ", "\\n", ""]


def rows_by_turn(seed=1):
    rng = random.Random(seed)
    rows = [("-7", None, None, None), (None, 0, "user", "null id"), (None, 1, "assistant", "a"), ("-8", 3, "assistant", ""), ("-8", 3, "assistant", "tie"), ("-8", 3, "assistant", "tie"), ("-9", 0, "as\n\\n<|sistant", "odd role")]
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            rows.append((str(conv), turn, rng.choice(["user", "assistant", "system", "tool", None]), rng.choice([None, "".join(rng.choice(BITS) for _ in range(rng.randint(0, 30)))])))
    rows.append(("99", 0, "assistant", "<|im_end|>long \\" * 40_000))
    rng.shuffle(rows)
    return rows


def test_round_trip_of_turn_rows(spark):
    rows = rows_by_turn()
    schema = "conv_id string, turn long, role string, text string, turns string, layout string, formatted int, record string, parts int"
    frame = spark.createDataFrame([(*r, "x", "y", 1, "z", 2) for r in rows], schema)
    made = chat.chats(frame)
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    digests = {r.conv_id: r for r in chat.digests(made).collect()}
    wanted = {}
    for c, t, r, x in rows:
        wanted.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    assert got.keys() == wanted.keys()
    for c, turns in wanted.items():
        turns = [(r, x) for _, _, r, x in sorted(turns)]
        assert [(t.role, t.text) for t in got[c].turns] == turns, c
        learned = [x for r, x in turns if r == "assistant"]
        assert got[c].learned == learned
        assert (digests[c].n_turns, digests[c].loss_chars, digests[c].formatted_chars) == (len(turns), sum(map(len, learned)), len(got[c].formatted))
        assert digests[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert digests[c].loss_sha256 == hashlib.sha256("".join(learned).encode()).hexdigest()
        assert got[c].formatted.count(chat.START) == len(turns) == got[c].formatted.count(chat.END)


def test_absolute_spans(spark):
    made = chat.chats(spark.createDataFrame(rows_by_turn(2), "conv_id string, turn long, role string, text string"))
    rows = chat.absolute(made).join(chat.read_back(made).select("conv_id", "learned"), "conv_id").collect()
    assert len(rows) > 50
    for r in rows:
        cut = [r.formatted[a:b] for a, b in r.spans]
        assert [len(c) for c in cut] == [s.length for s in r.loss]
        assert all(r.formatted[a - len("assistant\n") : a] == "assistant\n" and r.formatted[b:].startswith("<|im_end|>") for a, b in r.spans)


def test_paths(spark):
    records = {
        '{"a":"x","m":[{"r":"u","c":"c"},{"r":null,"d":{"e":1.25}}]}': ["a", "m[]", "m[].c", "m[].r", "m[].d.e"],
        '{"b c":{"d":1.5,"e":[1,2]},"x,y:<z>":3,"f":null,"g":[],"q`t":true}': ["b c.d", "b c.e[]", "x,y:<z>", "g[]", "q`t"],
        '{"m":[{"a":1},{"b":2},3], "n":[[1],[2]]}': ["m[]", "n[]", "n[][]"],
        "{": [], "{}": [], "3": [], "[]": ["[]"], "": [],
    }
    frame = spark.createDataFrame([(j,) for j in records] + [(None,)], "j string")
    for r in frame.select("j", chat.field_paths(F.try_parse_json("j")).alias("p")).collect():
        assert sorted(r.p) == sorted(records.get(r.j, [])), r.j


def test_layouts(spark):
    say = lambda *turns: [tuple(t) for t in turns]
    cases = [
        ({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}, {"role": "assistant", "content": "c"}]}, "messages", say(("system", "s"), ("user", "ab"), ("assistant", "c"))),
        ({"messages": [], "id": 4}, "messages", []),
        ({"messages": [{"role": None, "content": 5}, "loose", {"x": 1}]}, "messages", say(("", "5"), ("", "loose"), ("", ""))),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}, {"from": "tool", "value": None}]}, "conversations", say(("user", "q"), ("assistant", "r"), ("tool", ""))),
        ({"turns": ["q", "r", "q2"]}, "alternating", say(("user", "q"), ("assistant", "r"), ("user", "q2"))),
        ({"instruction": "do", "input": "this", "output": "done", "meta": {"k": [1]}}, "instruction", say(("user", "do\n\nthis"), ("assistant", "done"))),
        ({"instruction": "do", "input": None, "output": "done"}, "instruction", say(("user", "do"), ("assistant", "done"))),
        ({"system": "s", "prompt": "p", "response": "r"}, "prompt", say(("system", "s"), ("user", "p"), ("assistant", "r"))),
        ({"prompt": "p"}, "prompt", say(("user", "p"))),
        ({"question": "q", "context": "c", "answer": ""}, "question", say(("user", "c\n\nq"), ("assistant", ""))),
        ({"prompt": "p", "question": "q"}, None, None),
        ({"other": 1}, None, None),
        ({}, None, None),
    ]
    rows = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(cases)] + [(100, None), (101, "{"), (102, '"text"')]
    frame = spark.createDataFrame(rows, "id long, body string")
    got = {r.conv_id: r for r in chat.canonical(frame, "id", None, "body", layouts=chat.RECORDS).collect()}
    for i, (_, name, turns) in enumerate(cases):
        assert got[i].layout == name, cases[i]
        assert got[i].turns is None if turns is None else [tuple(t) for t in got[i].turns] == turns, cases[i]
    left = {r.conv_id for r in chat.unmapped(chat.canonical(frame, "id", None, "body", layouts=chat.RECORDS)).collect()}
    assert left == {i for i, c in enumerate(cases) if c[1] is None} | {100, 101, 102}
    texts = {r.conv_id: r for r in chat.read_back(chat.single_chats(frame, "id", "body")).collect()}
    assert {i: [tuple(t) for t in r.turns] for i, r in texts.items()} == {i: c[2] for i, c in enumerate(cases) if c[1]}


def test_nested_columns(spark):
    frame = spark.createDataFrame([(1, [("user", "a"), ("assistant", "b")], None), (2, None, "p"), (1, [("user", "a"), ("assistant", "b")], None)], "id long, messages array<struct<role: string, content: string>>, prompt string")
    got = chat.read_back(chat.single_chats(frame, "id", fields=("messages", "prompt"))).collect()
    assert sorted((r.conv_id, r.layout, [tuple(t) for t in r.turns]) for r in got) == [(1, "messages", [("user", "a"), ("assistant", "b")])] * 2 + [(2, "prompt", [("user", "p")])]


def test_empty_table_and_sql(spark):
    schema = "conv_id long, turn long, role string, text string"
    none = chat.digests(chat.chats(spark.createDataFrame([], schema)))
    assert none.count() == 0
    rows = [(i, int(t), r, x) for c, t, r, x in rows_by_turn(3) if c and t is not None and r != "as\n\\n<|sistant" for i in [int(c)]]
    got = chat.digests(chat.chats(chat.with_planted(spark.createDataFrame(rows, schema))))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    out = con.execute(chat.ORACLE)
    names = [d[0] for d in out.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(out.fetchall())
