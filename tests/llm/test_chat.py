import hashlib
import json

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paragrid.llm import chat

LAYOUTS = [
    ({"prompt": "p", "completion": "c"}, "prompt", [("user", "p"), ("assistant", "c")]),
    ({"completion": "c", "prompt": None}, "prompt", [("user", ""), ("assistant", "c")]),
    ({"question": "q", "answer": "a"}, "question", [("user", "q"), ("assistant", "a")]),
    ({"instruction": "i", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "x", "output": "o"}, "instruction_input", [("system", "i"), ("user", "x"), ("assistant", "o")]),
    ({"messages": [{"role": "user", "content": "[1]"}, {"content": None, "role": "assistant"}]}, "messages", [("user", "[1]"), ("assistant", "")]),
    ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}, {"from": "other", "value": "o"}]}, "conversations", [("user", "h"), ("assistant", "g"), ("other", "o")]),
    ({"messages": []}, "empty_messages", []),
    ({"text": "?"}, None, None),
    ({"messages": [{"role": "user", "content": "x", "name": "n"}]}, None, None),
    ("no json", None, None),
    (None, None, None),
]


def test_fingerprints_select_layouts(spark):
    rows = [(i, r if r is None or isinstance(r, str) else json.dumps(r), "x") for i, (r, _, _) in enumerate(LAYOUTS)]
    got = chat.format_chat(spark.createDataFrame(rows, "conv_id long, record string, text string")).orderBy("conv_id").collect()
    for row, (_, layout, turns) in zip(got, LAYOUTS):
        assert row["layout"] == layout
        assert (None if row["turns"] is None else [tuple(t) for t in row["turns"]]) == turns
    assert got[7]["formatted"] == "" and got[8]["formatted"] is None
    known = {x.fingerprint for x in chat.LAYOUTS}
    assert len(known) == len(chat.LAYOUTS) and [r["fingerprint"] in known for r in got[:8]] == [True] * 8


nasty = st.lists(st.sampled_from([*"a<|>\\\n é😀", "<|im_end|>", "<|im_start|>", "<|nl|>", "assistant"]), max_size=12).map("".join)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.one_of(nasty, st.just("assistant")), nasty), max_size=4), min_size=1, max_size=8))
def test_template_is_reversible(spark, conversations):
    frame = spark.createDataFrame([(i, [tuple(t) for t in c]) for i, c in enumerate(conversations)], f"i int, turns {chat.TURNS}")
    out = frame.select("i", chat.format_turns(F.col("turns")).alias("f"), chat.loss_runs(F.col("turns")).alias("runs")).withColumn("back", chat.parse_turns(F.col("f"))).collect()
    for r in out:
        turns = conversations[r["i"]]
        assert [tuple(t) for t in r["back"]] == turns
        at, masked = 0, []
        for length, loss in r["runs"]:
            if loss:
                masked.append(r["f"][at : at + length])
            at += length
        assert at == len(r["f"]) and len(masked) == sum(role == "assistant" for role, _ in turns)
        assert [m.replace("<\\|", "<|") if "\\\\" not in m else None for m in masked] == [t if "\\" not in t else None for role, t in turns if role == "assistant"]


def test_digests_of_edge_rows(spark, tmp_path):
    rows = [(1, 2, "assistant", None, "e"), (1, 0, "user", "a" * 100_000, "e"), (1, 1, "user", "a", "e"), (1, 1, "user", "a", "e"), (2, 0, None, "x\\<|", "e"), (None, 0, "user", "n", "e"), (-1, 5, "user", "more", "e")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, record string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in chat.op9_chat_format(spark, str(tmp_path)).collect()}
    assert set(got) == {1, 2, None, -1}
    whole = "user\n" + "a" * 100_000 + "\nuser\na\nuser\na\nassistant\n\n"
    assert got[1]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest() and got[1]["n_turns"] == 4 and got[1]["loss_chars"] == 0
    assert got[2]["turns_sha256"] == hashlib.sha256(b"\nx\\<|\n").hexdigest()
    assert got[-1]["n_turns"] == 3 and got[-1]["loss_sha256"] == hashlib.sha256(chat.PLANTED.encode()).hexdigest()
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "e" / "conversations.parquet"))
    assert [r["conv_id"] for r in chat.op9_chat_format(spark, str(tmp_path / "e")).collect()] == [-1]


def test_query(spark, small):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{small}/conversations.parquet'")
    want = con.sql(chat.ORACLE_SQL["op9_chat_format"])
    got = chat.op9_chat_format(spark, small)
    assert sorted(tuple(r) for r in got.select(*want.columns).collect()) == sorted(want.fetchall())
