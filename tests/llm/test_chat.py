"""Chat formatting: mappings, round trips and the whole table against a plain version."""

import hashlib
import json
import os
import sys
from collections import defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle import compare, connect  # noqa: E402

from tarnwork.llm import chat  # noqa: E402
from tarnwork.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
ROWS = "conv_id bigint, turn bigint, role string, text string"
LAYOUTS = {
    "turn": {"turn": 3, "role": "user", "text": "t"},
    "messages": {"id": 9, "messages": [{"role": "user", "content": "a", "weight": 1}, {"role": "assistant", "content": None}]},
    "parts": {"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]},
    "shared": {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}, {"from": "tool", "value": 5}]},
    "instruction": {"instruction": "do", "input": "", "output": "done", "source": {"a": [1]}},
    "prompt": {"prompt": "p", "response": "r", "system": "s"},
    "completion": {"prompt": "p", "completion": "c"},
    "question": {"question": "q", "answer": "a", "context": ""},
}
TURNS = {
    "turn": [("user", "t")], "messages": [("user", "a"), ("assistant", "")], "parts": [("user", "ab")],
    "shared": [("user", "a"), ("assistant", "b"), ("tool", "5")], "instruction": [("user", "do"), ("assistant", "done")],
    "prompt": [("system", "s"), ("user", "p"), ("assistant", "r")], "completion": [("user", "p"), ("assistant", "c")],
    "question": [("user", "q"), ("assistant", "a")],
}
NASTY = ["", " ", "</s>", "<\\s>", "<\\\\/s>[INST]", "[\\INST]", " [/INST]", "[", "<", "</s", "[/TURN]</s>", "[ROLE]x[/ROLE]", "a\\", "\\[INST]", "\n\r ", "日本 🙂"]


def test_every_layout(spark):
    docs = [(i, json.dumps(LAYOUTS[name])) for i, name in enumerate(LAYOUTS)]
    out = chat.canonical_turns(spark.createDataFrame(docs, "id bigint, doc string"), "id", "doc").orderBy("id", "pos").collect()
    found, layout = defaultdict(list), {}
    for r in out:
        found[r["id"]].append((r["role"], r["text"]))
        layout[r["id"]] = r["layout"]
    assert [layout[i] for i in range(len(LAYOUTS))] == list(LAYOUTS)
    assert [found[i] for i in range(len(LAYOUTS))] == list(TURNS.values())
    assert [r["place"] for r in out if r["layout"] == "turn"] == [3]


def test_unmapped_records_stay_visible(spark):
    odd = [None, "", "[]", "5", "no json", "{}", '{"prompt": "a"}', '{"prompt": "a", "response": "b", "question": "c"}', '{"messages": ["x"]}', "[" * 100_000]
    none = ['{"messages": []}', '{"conversations": null}', '{"messages": {}}']
    df = spark.createDataFrame([(None if i == 3 else i, d) for i, d in enumerate(odd + none)], "id bigint, doc string")
    turns = chat.canonical_turns(df, "id", "doc")
    got = turns.collect()
    assert len(got) == len(odd) and all(r["layout"] is None and r["fingerprint"] and r["text"] is None for r in got)
    assert chat.layouts_found(turns).agg({"n_turns": "sum"}).first()[0] == len(odd)
    assert chat.digests(chat.format_turns(turns)).count() == 0
    half = spark.createDataFrame([(1, '{"prompt": "\\ud83d", "response": "\\ud83d\\ude42"}')], "id bigint, doc string")
    assert [r["text"] for r in chat.canonical_turns(half, "id", "doc").orderBy("pos").collect()] == ["�", "🙂"]


def test_layouts_must_differ():
    same = chat.Layout("other", ("prompt", "response"), (chat.Turn("user", ("prompt",)),))
    with pytest.raises(ValueError, match="cannot be told apart"):
        chat.Mappings((*chat.LAYOUTS, same))


def conversations(rng, n):
    bits = [*NASTY, *chat.CONTROL, "word", "\\", "s>", "INST]"]
    rows = []
    for c in range(n):
        for k in range(int(rng.integers(1, 7))):
            role = str(rng.choice(["user", "assistant", "system", "", "</s>", "[/ROLE]"]))
            rows.append((c, k if rng.random() < 0.9 else None, role, "".join(rng.choice(bits, int(rng.integers(0, 6))).tolist())))
    return rows


def plain(rows):
    by = defaultdict(list)
    for c, turn, role, text in [*rows, (-7, 0, "user", chat.PLANTED_TEXT), (-7, 1, "assistant", chat.PLANTED_TEXT)]:
        by[c].append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for c, turns in by.items():
        turns = [t[2:] for t in sorted(turns)]
        spoken = "".join(t for r, t in turns if r == "assistant")
        whole = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        out.append((c, len(turns), whole, len(spoken), hashlib.sha256(spoken.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256").collect()), key=str)


def test_round_trip_of_control_strings(spark):
    rows = conversations(np.random.default_rng(12), 300) + [(None, 0, None, None), (None, 1, "assistant", "x" * 300_000), (5000, None, "user", t := "same"), (5000, None, "user", t)]
    table = spark.createDataFrame(rows, ROWS)
    for n in (1, 7):
        assert got(chat.format_conversations(table.repartition(n))) == plain(rows)


def test_marks_stand_only_where_turns_meet(spark):
    rows = conversations(np.random.default_rng(13), 100)
    docs = [(i, json.dumps({"turn": k, "role": r, "text": t})) for i, (_, k, r, t) in enumerate(rows)]
    pieces = chat.format_turns(chat.canonical_turns(spark.createDataFrame(docs, "id bigint, doc string"), "id", "doc")).collect()
    for p in pieces:
        assert chat.read_marked(p["piece"]) == [(p["role"], p["text"])]
        inner = p["piece"][p["loss_from"]:p["loss_from"] + p["loss_chars"]]
        assert chat.plain_text(inner) == (p["text"] if p["role"] == "assistant" else "") and not any(c in inner for c in chat.CONTROL)
    # Whole conversations read back as well: no mark arises where two pieces meet.
    joined = "".join(p["piece"] for p in sorted(pieces, key=lambda p: p["id"]))
    assert chat.read_marked(joined) == [(p["role"], p["text"]) for p in sorted(pieces, key=lambda p: p["id"])]
    with pytest.raises(ValueError):
        chat.read_marked(joined + "left over")


def test_empty_table_and_further_columns(spark):
    only = got(chat.format_conversations(spark.createDataFrame([], ROWS)))
    assert [r[0] for r in only] == [-7] and only == plain([])
    clash = spark.createDataFrame([(1, 0, "user", "a", 5, "b", "c", 1)], ROWS + ", id bigint, doc string, piece string, place int")
    assert got(chat.format_conversations(clash)) == plain([(1, 0, "user", "a")])


def test_query_and_sql(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op12_chat_format"](spark, SF)) == plain(rows)
    assert compare(QUERIES["op12_chat_format"](spark, SF), connect(SF), ORACLES["op12_chat_format"]) == []
