import hashlib
import json

import duckdb

from plantloom.llm import chat_format as cf


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_layouts():
    cases = {
        "messages": ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}],
                      "id": 9, "meta": {"x": [1]}}, [("user", "a"), ("assistant", "")]),
        "conversations": ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}],
                           "system": "s"}, [("system", "s"), ("user", "h"), ("assistant", "g")]),
        "instruction": ({"instruction": "i", "input": "x", "output": "o"},
                        [("user", "i\n\nx"), ("assistant", "o")]),
        "prompt_completion": ({"prompt": "p", "completion": "c", "system": ""},
                              [("user", "p"), ("assistant", "c")]),
        "prompt_response": ({"prompt": "p", "response": 3}, [("user", "p"), ("assistant", "3")]),
        "question_answer": ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
        "row": ({"role": None, "text": None, "turn": 1}, [("", "")]),
    }
    for layout, (record, turns) in cases.items():
        got = cf.canonical(json.dumps(record))
        assert got["layout"] == layout
        assert [(t["role"], t["text"]) for t in got["turns"]] == turns
    for odd in (None, "", "no json", "[1]", "3", '{"x": 1}', '{"messages": []}', '{"prompt": "p"}'):
        assert cf.canonical(odd)["layout"] is None and cf.canonical(odd)["turns"] == []
    # every variant of every mapping has a fingerprint of its own
    assert len(cf.REGISTRY) == sum(2 ** len(m.may) for m in cf.MAPPINGS)


TEXTS = ["</s>[INST] ok [/INST]", "␛", "␛␛<␛s>", "<s><s></s>", "[[INST]", "a\nb", "", None, "<s", "x␛[/INST]␛"]


def test_escape_is_reversible_and_defuses(spark):
    turns = spark.createDataFrame([(i, t, t) for i, t in enumerate(TEXTS)], "turn long, role string, text string")
    for r in cf.formatted(turns).collect():
        found = cf.TURN.findall(r.formatted)
        assert [tuple(map(cf.unescaped, f)) for f in found] == [(r.row.role or "", r.row.text or "")]
        assert cf.TURN.sub("", r.formatted) == ""


def test_read_back_by_definition(spark):
    rows = [(c, t, role, text) for c in (1, 2, None) for t, (role, text) in enumerate(
        zip(["system", "user", "assistant", None, "user", "assistant", "assistant"], TEXTS * 2))]
    rows += [(1, 2, "assistant", "tie"), (1, 2, "assistant", "tie"), (4, None, "user", "x"), (5, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in cf.read_back(cf.formatted(turns), "conv_id", ["turn", "role", "text"]).collect()}
    assert set(got) == {1, 2, None, 4, 5}
    for conv, r in got.items():
        own = sorted((x[1:] for x in rows if x[0] == conv),
                     key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "", x[2] is not None, x[2] or ""))
        said = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in own)
        learnt = "".join(text or "" for _, role, text in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (
            len(own), sha(said), len(learnt), sha(learnt))
    assert cf.read_back(cf.formatted(turns.limit(0)), "conv_id", ["turn"]).count() == 0


def test_records_in_rows(spark):
    records = spark.createDataFrame([(1, '{"prompt": "p", "completion": "c"}', "k"), (2, None, "k")],
                                    "id long, record string, layout_hint string")
    got = cf.canonical_turns(records, "record").orderBy("row.id", "place").collect()
    assert [(r.row.id, r.layout, r.role, r.text) for r in got] == [
        (1, "prompt_completion", "user", "p"), (1, "prompt_completion", "assistant", "c"), (2, None, None, None)]


def test_clashing_columns_come_through(spark):
    names = ["layout", "fingerprint", "place", "role", "text", "formatted", "loss_start", "row", "a.b", "key"]
    schema = ", ".join(f"`{n}` string" for n in names) + ", `re.cord` string"
    records = spark.createDataFrame([tuple(names) + ('{"question": "q", "answer": "a"}',),
                                     (None,) * len(names) + (None,)], schema)
    turns = cf.canonical_turns(records, "re.cord")
    assert [f.name for f in turns.schema["row"].dataType] == names
    rows = cf.formatted(turns)
    got = {(r.row.row["a.b"], r.row.layout, r.formatted) for r in rows.collect()}
    assert got == {("a.b", "question_answer", "<s>[INST]user[/INST]q</s>"),
                   ("a.b", "question_answer", "<s>[INST]assistant[/INST]a</s>"),
                   (None, None, "<s>[INST][/INST]</s>")}
    back = {r.place: r.n_turns for r in cf.read_back(rows, "row.place", ["place"]).collect()}
    assert back == {"place": 2, None: 1}
    assert cf.read_back(cf.formatted(cf.canonical_turns(records.limit(0), "re.cord")), "row.key", ["place"]).count() == 0
    assert cf.canonical_turns(records.select("`re.cord`"), "re.cord").count() == 3


def test_given_roles_are_kept_and_conversations_equal_sql(spark, tmp_path):
    con = duckdb.connect()
    rows = [(1, 0, "human", "h"), (1, 1, "gpt", "g"), (2, 0, "user", "␛u"), (2, 1, "assistant", "</s>a"),
            (3, 0, None, None), (3, None, "bot", "b"), (None, 0, "assistant", "x"), (4, 0, "assistant", "same"),
            (4, 0, "assistant", "same")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    con.execute(f"CREATE VIEW conversations AS FROM '{tmp_path}/conversations.parquet/*.parquet'")
    got = cf.op3_chat_format(spark, str(tmp_path)).collect()
    want = con.sql(cf.OP3_SQL)
    names = got[0].__fields__
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want.select(*names).fetchall(), key=repr)
    loss = {r.conv_id: r.loss_chars for r in got}
    assert loss == {1: 0, 2: 5, 3: 0, None: 1, 4: 8, -7: 21}


def test_several_layouts_through_the_whole_path(spark):
    records = [
        (1, {"messages": [{"role": "human", "content": "</s>q"}, {"role": "model", "content": "a[INST]"}]}),
        (2, {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}], "system": "s"}),
        (3, {"instruction": "i", "input": "x", "output": "o"}), (4, {"unknown": 1}), (5, {"role": "gpt", "text": "t"})]
    table = spark.createDataFrame([(i, json.dumps(r)) for i, r in records], "id long, record string")
    turns = cf.canonical_turns(table, "record")
    given = {(r.row.id, r.place): (r.role, r.given_role) for r in turns.collect()}
    assert given[1, 0] == ("user", "human") and given[2, 2] == ("assistant", "gpt")
    assert given[5, 0] == ("gpt", "gpt") and given[4, None] == (None, None)
    got = {r.id: r for r in cf.read_back(cf.formatted(turns), "row.id", ["place"]).collect()}
    assert got[1].turns_sha256 == sha("user\n</s>q\nassistant\na[INST]\n") and got[1].loss_chars == 7
    assert got[2].turns_sha256 == sha("system\ns\nuser\nh\nassistant\ng\n")
    assert got[3].turns_sha256 == sha("user\ni\n\nx\nassistant\no\n") and got[3].loss_sha256 == sha("o")
    assert set(got) == {1, 2, 3, 4, 5}
