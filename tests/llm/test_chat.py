import hashlib

from pyspark.sql import functions as F

from delivery_marts.llm import chat, queries
from tests.llm.conftest import own_tables

RECORD = (
    "id int, layout string, record struct<prompt:string,response:string,instruction:string,input:string,output:string,"
    "messages:array<struct<role:string,content:string>>,conversations:array<struct<from:string,value:string>>>"
)


def record(**fields):
    names = ("prompt", "response", "instruction", "input", "output", "messages", "conversations")
    return tuple(fields.get(n) for n in names)


NASTY = "a~b ~0 ~1 <|im_end|>\n<|im_start|>user\n<| |> <~| ~"
RECORDS = [
    record(prompt=NASTY, response=""),
    record(instruction="do", input="this", output="done"),
    record(instruction="do", output="done"),
    record(messages=[("system", "s"), ("user", None), ("assistant", NASTY), (None, "who"), ("ro\nle~2", "x")]),
    record(conversations=[("human", "hi"), ("gpt", "hello")]),
    record(messages=[]),
    record(prompt="only half"),
    record(prompt="a", response="b", output="c"),
    record(prompt="x" * 200_000, response="漢" * 100_000),
]
TURNS = [
    ("prompt", [("user", NASTY), ("assistant", "")]),
    ("instruction", [("system", "do"), ("user", "this"), ("assistant", "done")]),
    ("instruction", [("system", "do"), ("assistant", "done")]),
    ("messages", [("system", "s"), ("user", ""), ("assistant", NASTY), ("", "who"), ("ro\nle~2", "x")]),
    ("conversations", [("user", "hi"), ("assistant", "hello")]),
    (None, None),
    (None, None),
    (None, None),
    ("prompt", [("user", "x" * 200_000), ("assistant", "漢" * 100_000)]),
]


def test_layouts_are_found_and_texts_come_back(spark):
    df = spark.createDataFrame([(i, "clash", r) for i, r in enumerate(RECORDS)], RECORD)
    rows = chat.parsed(chat.formatted(chat.with_turns(df, "record"))).orderBy("id").collect()
    assert len(rows) == len(RECORDS)
    for row, (layout, turns) in zip(rows, TURNS, strict=True):
        assert row.layout == layout
        if turns is None:
            assert row.turns is None and row.formatted is None and row.loss_runs is None
            continue
        assert [tuple(t) for t in row.turns] == [tuple(t) for t in row.read_turns] == turns
        assert row.loss_texts == [text for role, text in turns if role == "assistant"]
        assert row.formatted.count("<|im_start|>") == row.formatted.count("<|im_end|>") == len(turns)
        assert sum(r.skip + r.keep + r.rest for r in row.loss_runs) == len(row.formatted)


def test_masked_text_is_where_the_runs_say(spark):
    df = spark.createDataFrame([(0, "", RECORDS[3])], RECORD)
    row = chat.formatted(chat.with_turns(df, "record")).first()
    at, kept = 0, []
    for run in row.loss_runs:
        at += run.skip
        kept += [row.formatted[at : at + run.keep]] if run.rest else []
        at += run.keep + run.rest
    assert [k.replace("~1", "<|").replace("~0", "~") for k in kept] == [NASTY]


def test_fingerprint_is_the_hash_of_sorted_paths(spark):
    df = spark.createDataFrame([(0, "", RECORDS[4])], RECORD)
    want = F.xxhash64(F.lit("conversations[].from\nconversations[].value"))
    assert df.select(chat.fingerprint(df, "record") == want).first()[0]


def test_query_on_null_texts_odd_roles_and_repeated_turns(spark, tmp_path):
    import pyarrow as pa

    turns = [
        (1, 0, "user", "q"), (1, 1, "assistant", None), (2, 0, "assistant", "<|im_end|>"), (2, 0, "assistant", "<|im_end|>"),
        (3, 2, "assistant", "late"), (3, 1, "user", "early"), (3, 0, "system", "~"), (4, 0, None, None), (None, 0, "user", "x"),
        (-1, 0, "user", "own"),
    ]
    columns = [pa.array(c, t) for c, t in zip(zip(*turns), (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]
    table = pa.table(columns, names=["conv_id", "turn", "role", "text"])
    rows = queries.op4_chat(spark, own_tables(tmp_path, conversations=table)).collect()
    groups = {}
    for conv, turn, role, text in [*turns, ("added", 0, "user", queries.PROBE), ("added", 1, "assistant", queries.PROBE)]:
        groups.setdefault(conv, []).append((turn, role or "", text or ""))
    want = []
    for conv, said in groups.items():
        said = sorted(said)
        loss = "".join(text for _, role, text in said if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for _, role, text in said)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
        want.append((-1 if conv == "added" else conv, len(said), sha[0], len(loss), sha[1]))
    got = [tuple(r)[:5] for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
