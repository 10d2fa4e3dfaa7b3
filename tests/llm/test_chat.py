import json

from pyspark.sql import functions as F

from docketmill.llm import chat as C

CALLS = "conv_id bigint, call_id string, turn bigint, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id bigint, call_id string, turn bigint, content string"
SCHEMAS = {
    "sum": {"a": C.Parameter("number"), "b": C.Parameter("number"), "note": C.Parameter("string", False)},
    "tags": {"list": C.Parameter("array"), "deep": C.Parameter("object", False), "on": C.Parameter("boolean", False),
             "n": C.Parameter("integer", False)},
}


def formatted(spark, calls, results=(), schemas=SCHEMAS):
    rows = C.formatted(
        spark.createDataFrame(list(calls), CALLS), spark.createDataFrame(list(results), RESULTS), schemas).collect()
    return {(r["conv_id"], r["call_id"]): r for r in rows}


def test_validation(spark):
    cases = {
        '{"a": 1, "b": 2.5}': "", '{"b":1}': "missing a", '{"a":"1","b":null}': "a is no number; b is no number",
        '{"a":1,"b":2,"z":3,"c":4}': "unknown c; unknown z", "[1]": "not an object", "{broken": "not an object",
        '{"a":1,"b":2,"note":5}': "note is no string", '{"a":1e400,"b":true}': None,
    }
    rows = formatted(spark, [(1, f"c{i}", i, "sum", a, None) for i, a in enumerate(cases)] + [
        (1, "null", 90, "sum", None, None), (1, "odd", 91, "nothing", "{}", None),
        (1, "types", 92, "tags", '{"list":[],"deep":{"x":1},"on":false,"n":7}', None),
        (1, "wrong", 93, "tags", '{"list":{},"deep":[],"on":0,"n":1.5}', None)])
    for i, (arguments, errors) in enumerate(cases.items()):
        if errors is not None:
            assert rows[1, f"c{i}"]["errors"] == errors, arguments
            assert rows[1, f"c{i}"]["valid"] == (errors == "")
    assert rows[1, "null"]["errors"] == "not an object" and rows[1, "odd"]["errors"] == "unknown tool"
    assert rows[1, "types"]["valid"]
    assert rows[1, "wrong"]["errors"] == "deep is no object; list is no array; n is no integer; on is no boolean"


def test_canonical_json(spark):
    text = '{ "b" : 1.50, "a": {"z": [1, {"y": "é\\n\\"", "x": null}], "k": true} }'
    rows = formatted(spark, [(1, "q\"1", 3, "sum", text, None)], [(1, "q\"1", 4, "line\nbreak")])
    message = rows[1, "q\"1"]["message"]
    parsed = json.loads(message)
    assert parsed["arguments"] == json.loads(text) and parsed["result"] == "line\nbreak" and parsed["turn"] == 3
    assert message == json.dumps(parsed, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_links_repeats_and_orphans(spark):
    calls = [(1, "a", 2, "sum", "{}", []), (1, "a", 1, "sum", '{"a":1,"b":2}', []), (1, "b", 3, "sum", "{}", []),
             (2, "a", 1, "sum", "{}", []), (None, "a", 1, "sum", "{}", []), (3, None, 1, "sum", "{}", [])]
    results = [(1, "a", 5, "late"), (1, "a", 4, "first"), (2, "zz", 2, "orphan"), (None, "a", 2, "lost")]
    rows = formatted(spark, calls, results)
    assert json.loads(rows[1, "a"]["message"])["result"] == "first" and rows[1, "a"]["valid"]
    assert [rows[k]["linked"] for k in ((1, "a"), (1, "b"), (2, "a"))] == [True, False, False]
    assert not rows[None, "a"]["linked"] and not rows[3, None]["linked"] and len(rows) == 5
    lost = C.orphans(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS))
    assert sorted(r["content"] for r in lost.collect()) == ["lost", "orphan"]


def places(spark, deps, turns):
    rows = formatted(spark, [(1, c, turns[c], "sum", "{}", deps.get(c, [])) for c in turns])
    return {c: rows[1, c]["place"] for c in turns}


def test_order_respects_dependencies(spark, monkeypatch):
    monkeypatch.setattr(C, "TURNS_OF_BLOCK", 4)
    turns = {f"c{i}": i for i in range(30)}
    assert places(spark, {f"c{i}": [f"c{i - 1}", "c0"] for i in range(1, 30)}, turns) == {
        c: t + 1 for c, t in turns.items()}
    backwards = {f"c{i}": [f"c{i + 1}"] for i in range(6)} | {"c20": ["c20", "unknown"], "c21": None}
    found = places(spark, backwards, turns)
    assert sorted(found.values()) == list(range(1, 31))
    assert all(found[f"c{i}"] > found[f"c{i + 1}"] for i in range(6))
    cycle = places(spark, {"c3": ["c4"], "c4": ["c5"], "c5": ["c3"], "c6": ["c5"]}, turns)
    assert {c for c, p in cycle.items() if p is None} == {"c3", "c4", "c5", "c6"}
    assert sorted(p for p in cycle.values() if p) == list(range(1, 27))


def expected_places(calls):
    """Places of (turn, turns it depends on): rounds of what depends on nothing unplaced, or the turns if all dependencies are earlier."""
    if all(p < t for t, parents in calls.items() for p in parents):
        return {t: i + 1 for i, t in enumerate(sorted(calls))}
    found, done = {}, set()
    while ready := [t for t, parents in calls.items() if t not in done and parents <= done]:
        for t in sorted(ready):
            found[t] = len(found) + 1
        done |= set(ready)
    return found


def test_conversations_against_a_loop(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = {(r["conv_id"], r["call_id"]): r for r in C.formatted(
        *C.conversation_calls(turns), C.CONVERSATION_TOOLS).collect()}
    said = {(r["conv_id"], r["turn"]): r for r in turns.collect()}
    asked = {}
    for (conv, turn), r in sorted(said.items()):
        if r["role"] in ("user", "system"):
            asked.setdefault(conv, {})[turn] = r["text"]
    assert len(rows) == sum(map(len, asked.values()))
    seen = set()
    for conv, texts in asked.items():
        parents = {t: {p for p in ({0: t + 2, 1: t - 2, 2: t - 2}.get(len(x) % 4), 0) if p in texts and p != t}
                   for t, x in texts.items()}
        places = expected_places(parents)
        for t, x in texts.items():
            row, r = rows[conv, f"{conv}-{t}"], said[conv, t]
            answer = said.get((conv, t + 1))
            result = answer["text"] if answer and answer["role"] == "assistant" else None
            arguments, errors = {"turn": t}, []
            if r["role"] == "system" and len(x) % 3 == 0:
                errors.append("missing rules")
            else:
                arguments["prompt" if r["role"] == "user" else "rules"] = x
                if len(x) % 5 == 0:
                    arguments["turn"] = str(t)
                    errors.append("turn is no integer")
                if len(x) % 7 == 0:
                    arguments["note"] = "as said"
                    errors.append("unknown note")
            assert row["place"] == places.get(t) and row["linked"] == (result is not None)
            assert row["errors"] == "; ".join(errors) and row["valid"] == (not errors)
            assert json.loads(row["message"]) == {
                "arguments": arguments, "errors": errors, "id": f"{conv}-{t}",
                "name": "reply" if r["role"] == "user" else "configure", "place": places.get(t), "result": result, "turn": t}
            seen |= {("place", row["place"] is None), ("ahead", any(p > t for p in parents[t])), *errors}
    assert {("place", True), ("place", False), ("ahead", True), "turn is no integer", "unknown note"} <= seen


def test_odd_rows(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", None, 1), (1, 0, "user", None, 2), (1, 1, "assistant", "", 1), (1, 1, "assistant", "x" * 100000, 1),
         (None, 0, "user", "hi", 1), (2, 0, None, "?", 1), (3, None, "user", "no turn", 1)],
        "conv_id bigint, turn bigint, role string, text string, place int")
    rows = {(r["conv_id"], r["call_id"]): r for r in C.formatted(
        *C.conversation_calls(turns), C.CONVERSATION_TOOLS).collect()}
    assert rows[1, "1-0"]["errors"] == "prompt is no string" and json.loads(rows[1, "1-0"]["message"])["result"] == ""
    assert len(rows) == 3
    assert C.formatted(*C.conversation_calls(turns.where("false")), C.CONVERSATION_TOOLS).collect() == []
