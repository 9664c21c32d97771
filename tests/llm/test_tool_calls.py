import json
import random

import pytest

from holdfast.llm import tool_calls as C


def test_canonical_json():
    assert C.canonical({"b": [1.0, 2.5, True, None], "a": "é\n\""}) == '{"a":"é\\n\\"","b":[1,2.5,true,null]}'
    with pytest.raises(ValueError):
        C.canonical(float("nan"))
    text = C.canonical({"z": {"y": [], "x": {}}, "a": 10 ** 30})
    assert C.canonical(json.loads(text)) == text


def test_problems():
    schema = {"type": "object", "required": ["q"], "additionalProperties": False, "properties": {
        "q": {"type": "string", "maxLength": 3}, "n": {"type": "integer", "minimum": 1}, "k": {"enum": ["a"]},
        "l": {"type": "array", "items": {"type": "number"}}}}
    assert C.problems({"q": "abc", "n": 2, "k": "a", "l": [1, 2.5]}, schema) == []
    assert C.problems({"q": {"$ref": "c1"}}, schema) == []
    assert C.problems({"n": 0, "q": "abcd", "x": 1, "k": "b", "l": [True]}, schema) == [
        "$.k: not one of the values", "$.l[0]: not of type number", "$.n: out of range", "$.q: length",
        "$.x: unknown"]
    assert C.problems([], schema) == ["$: not of type object"] and C.problems({}, schema) == ["$.q: missing"]


@pytest.mark.parametrize("arguments", [None, "", "{", "[" * 5000 + "]" * 5000, '{"a":1,"a":2}', "NaN"])
def test_arguments_that_are_no_json(arguments):
    text, refs, found = C.checked_call("t", arguments, {"t": {}})
    assert text == "null" and refs == [] and found and found[0].startswith("$: no JSON")


def run(spark, messages, calls, results):
    rows = C.formatted(
        spark.createDataFrame(messages, "conv_id bigint, turn bigint, role string, text string, call_id string"),
        spark.createDataFrame(calls, "conv_id bigint, turn bigint, pos int, call_id string, name string, "
                                     "arguments string, first int, anchor int"),
        spark.createDataFrame(results, "conv_id bigint, turn bigint, call_id string, content string, own int"),
        {"t": {"type": "object"}}).collect()
    return sorted(rows, key=lambda r: (r.conv_id or 0, r.anchor or 0, r.step, r.kind, r.turn or 0, r.pos))


def call(conv, turn, call_id, *refs, pos=0):
    return conv, turn, pos, call_id, "t", json.dumps({"use": [{"$ref": r} for r in refs]}), 0, 0


def test_order_follows_the_links(spark):
    rows = run(spark, [(1, 0, "user", "hi", "x"), (1, 9, "user", None, "x")],
               [call(1, 1, "late", "a", "b"), call(1, 3, "a"), call(1, 3, "b", "a", pos=1), call(1, 5, "after", "late"),
                call(2, 1, "a")],
               [(1, 2, "a", "early answer", 0), (1, 8, "b", "B", 0), (1, 4, "late", "L", 0), (1, 4, "none", "?", 0)])
    order = [(r.kind, r.call_id) for r in rows if r.conv_id == 1]
    assert order == [(0, None), (1, "a"), (2, "a"), (1, "b"), (2, "b"), (1, "late"), (2, "late"), (2, "none"),
                     (1, "after"), (0, None)]
    status = {(r.kind, r.conv_id, r.call_id): r.status for r in rows}
    assert status[1, 1, "after"] == "unanswered" and status[2, 1, "none"] == "orphan"
    assert status[1, 2, "a"] == "unanswered" and status[1, 1, "late"] == "linked"


def test_cycles_duplicates_and_repeats(spark):
    rows = run(spark, [], [call(1, 1, "x", "y"), call(1, 2, "y", "x"), call(1, 3, "z", "y"), call(1, 4, "s", "s"),
                           call(1, 5, "d"), call(1, 6, "d"), call(1, 7, "u", "gone"), call(1, 8, None)],
               [(1, 9, "d", "1", 0), (1, 10, "d", "2", 0), (1, 3, "x", "in a cycle", 0), (1, 1, None, "", 0)])
    got = {(r.kind, r.turn): r.status for r in rows}
    assert [got[1, t] for t in range(1, 9)] == ["cycle"] * 4 + ["linked", "duplicate", "unanswered", "unanswered"]
    assert [got[2, t] for t in (9, 10, 3, 1)] == ["linked", "repeated", "linked", "orphan"]
    assert [r.problems for r in rows if r.turn == 7] == [["$: unknown reference gone"]]


def test_branches_between_circles(spark):
    # two circles that share no call with only one wait; "w" waits for a settled call and for a circle
    rows = run(spark, [], [call(1, 1, "a", "b", "c"), call(1, 2, "b", "a", "c"), call(1, 3, "c", "a", "b"),
                           call(1, 4, "ok"), call(1, 5, "w", "ok", "a"), call(1, 2, "d1", "ok"),
                           call(1, 1, "d2", "d1", "ok", "e"), call(1, 6, "e", "d1"), call(1, 1, "d3", "d2", "d1"),
                           call(1, None, "ok"), call(1, None, "alone")], [])
    got = {(r.call_id, r.turn): (r.status, r.anchor, r.step) for r in rows}
    assert {got[k][0] for k in (("a", 1), ("b", 2), ("c", 3), ("w", 5))} == {"cycle"}
    assert got["d1", 2] == ("unanswered", 4, 1) and got["e", 6] == ("unanswered", 6, 0)
    assert got["d2", 1] == ("unanswered", 6, 1) and got["d3", 1] == ("unanswered", 6, 2)
    assert got["ok", None][0] == "duplicate" and got["alone", None][0] == "unanswered"


def test_places_against_brute_force(spark):
    rng = random.Random(7)
    calls, owners = [], {}
    for conv in range(40):
        for i in range(rng.randint(1, 14)):
            owners[conv, f"c{i}"] = (rng.randint(0, 9), rng.sample([f"c{k}" for k in range(14)], rng.choice([0, 1, 1, 2])))
    calls = [call(conv, turn, c, *refs) for (conv, c), (turn, refs) in owners.items()]

    def place(node, seen=()):
        if node in seen:
            return None
        turn, refs = owners[node]
        below = [place((node[0], r), (*seen, node)) for r in refs if (node[0], r) in owners]
        return None if None in below else max([(turn, 0), *[(a, s + 1) for a, s in below]])

    rows = run(spark, [], calls, [])
    assert len(rows) == len(owners)
    for r in rows:
        want = place((r.conv_id, r.call_id))
        assert (r.status == "cycle") == (want is None)
        assert (r.anchor, r.step) == (want or (r.turn, 0))


def test_chain_of_ten_thousand_links(spark, monkeypatch):
    rounds, plain = [], C.stored
    monkeypatch.setattr(C, "stored", lambda df, label, *rest: rounds.append(label) or plain(df, label, *rest))
    owners = spark.range(10_000).selectExpr(
        "1L as conv_id", "concat('c', id) as call_id", "if(id = 5000, 3L, 1L) as turn",
        "if(id = 0, array(), array(concat('c', id - 1))) as refs")
    got = {r.call_id: (r.anchor, r.step) for r in C.settled(owners).collect()}
    assert len(got) == 10_000 and got["c4999"] == (1, 4999) and got["c9999"] == (3, 4999)
    assert len(rounds) < 20


def test_whole_texts_are_in_the_json(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    found = {}
    for r in C.op1_tool_call_linking(spark, sf).collect():
        body = json.loads(r.json)
        found[r.conv_id, r.turn] = body["arguments"]["query"] if r.kind == 1 else body["content"]
    assert found == {(t.conv_id, t.turn): t.text or "" for t in turns}


def test_long_chain_and_empty_tables(spark):
    calls = [call(1, 100 - i, f"c{i}", *([f"c{i - 1}"] if i else [])) for i in range(12)]
    rows = run(spark, [], calls, [])
    assert [r.call_id for r in rows] == [f"c{i}" for i in range(12)] and {r.anchor for r in rows} == {100}
    assert run(spark, [], [], []) == []


def test_every_row_is_canonical_json(spark, sf):
    rows = C.op1_tool_call_linking(spark, sf).collect()
    turns = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    assert len(rows) == len(turns)
    for r in rows:
        assert C.canonical(json.loads(r.json)) == r.json
