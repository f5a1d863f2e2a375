import json
import random

from strata.llm import toolcalls as C

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, parent_id string, level int, json string"
RESULTS = "conv_id long, call_id string, turn long, content string, status int"
SCHEMAS = [("f", "x", "integer", True), ("f", "y", "number", False), ("f", "s", "string", None), ("f", "o", "object", False),
           ("f", "a", "array", False), ("f", "b", "boolean", False), ("f", "x", "integer", True), (None, "z", "string", True),
           ("g", None, "string", True)]


def run(spark, calls, results, schemas=SCHEMAS):
    c = spark.createDataFrame([(*x, 5, "x") for x in calls], CALLS)
    r = spark.createDataFrame([(*x, 1) for x in results], RESULTS)
    s = spark.createDataFrame(schemas, "name string, param string, type string, required boolean")
    return C.link_calls(c, r, s)


def by_id(df):
    return {(r.conv_id, r.call_id): r for r in df.collect()}


def test_links_and_orders(spark):
    calls = [(1, "c", 9, "f", '{"x":1}', "b"), (1, "a", 7, "f", '{"x":1}', None), (1, "b", 8, "f", '{"x":1}', "a"),
             (1, "d", 1, "f", '{"x":1}', "gone"), (2, "a", 1, "f", '{"x":1}', "c"), (1, "p", 1, "f", '{"x":1}', "q"),
             (1, "q", 1, "f", '{"x":1}', "p"), (1, "r", 1, "f", '{"x":1}', "q"), (1, "self", 1, "f", '{"x":1}', "self"),
             (None, "a", 1, "f", '{"x":1}', None), (None, "b", 2, "f", '{"x":1}', "a"),
             (1, None, 3, "f", '{"x":1}', "a"), (1, "a", 8, "f", '{"x":2}', "b")]
    results = [(1, "a", 10, "ok"), (1, "a", 11, "later"), (1, "zz", 3, "lost"), (None, "b", 4, None), (1, None, 5, "no id")]
    out = run(spark, calls, results)
    rows = out.collect()
    got = {(r.conv_id, r.call_id, r.n_calls): (r.level, r.status, r.n_results) for r in rows}
    assert got == {(1, "a", 2): (0, "linked", 2), (1, "b", 1): (1, "no_result", 0), (1, "c", 1): (2, "no_result", 0),
                   (1, "d", 1): (0, "no_result", 0), (2, "a", 1): (0, "no_result", 0), (1, "p", 1): (None, "cycle", 0),
                   (1, "q", 1): (None, "cycle", 0), (1, "r", 1): (None, "cycle", 0), (1, "self", 1): (None, "cycle", 0),
                   (None, "a", 1): (0, "no_result", 0), (None, "b", 1): (1, "linked", 1), (1, None, 1): (0, "no_id", 0),
                   (1, "zz", 0): (None, "orphan_result", 1), (1, None, 0): (None, "orphan_result", 1)}
    assert len(rows) == len(got)
    assert json.loads(by_id(out)[1, "a"].json)["result"] == "ok"
    seen = set()
    for r in C.ordered(out.where("conv_id = 1 and level is not null and status <> 'no_id'"), 3).collect():
        assert r.level == 0 or (r.conv_id, r.parent_id) in seen
        seen.add((r.conv_id, r.call_id))


def test_long_shuffled_chain(spark):
    n = 700
    calls = [(1, f"c{i}", 0, "f", None, f"c{i - 1}") for i in range(n)]
    random.Random(1).shuffle(calls)
    assert {r.call_id: r.level for r in run(spark, calls, []).collect()} == {f"c{i}": i for i in range(n)}


def test_validation_and_canonical_json(spark):
    cases = {
        '{"x": 1, "s": "é\\u00e9\\n\\"", "o": {"z": null, "b": [1, {"y": 1.50}]}}': [],
        '{"y": 2, "x": 3, "b": true, "a": []}': [], '{"x": 1, "y": 2.5}': [],
        '{"x": 1.5}': ["type x"], '{"x": "1"}': ["type x"], '{"x": null}': ["type x"], '{}': ["missing x"],
        '{"x": 1, "k": 0, "b": 0}': ["type b", "unknown k"], '{"x": 1, "x": 2}': ["not an object"],
        '[1]': ["not an object"], 'nope': ["not an object"], '': ["not an object"], '"s"': ["not an object"],
        '{"x": 12345678901234567890123}': [], '{"x": 1, "s": "' + "long " * 100_000 + '"}': []}
    calls = [(1, f"c{i}", i, "f", a, None) for i, a in enumerate(cases)]
    calls += [(1, "null", 98, "f", None, None), (1, "g", 99, "g", "{}", None), (1, "n", 99, None, "{}", None)]
    got = by_id(run(spark, calls, []))
    for i, (a, wrong) in enumerate(cases.items()):
        r = got[1, f"c{i}"]
        assert (r.errors, r.valid) == (wrong, not wrong), a
        args = None if wrong == ["not an object"] else json.loads(a)
        assert r.json == json.dumps({"arguments": args, "conversation": 1, "id": f"c{i}", "level": 0, "name": "f",
                                     "result": None, "status": "no_result", "turn": i},
                                    sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert got[1, "null"].errors == ["not an object"]
    assert got[1, "g"].errors == got[1, "n"].errors == ["no schema"]


def test_empty(spark):
    assert run(spark, [], []).collect() == []
    assert [r.status for r in run(spark, [], [(1, "a", 1, "x")]).collect()] == ["orphan_result"]
    assert [r.errors for r in run(spark, [(1, "a", 1, "f", "{}", None)], [], []
                                  or [(None, None, None, None)]).collect()] == [["no schema"]]


def test_main_path_has_no_python(spark):
    from strata.llm import queries as Q
    plan = Q.op2_tool_call_linking(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_copies_are_rows_of_their_own(spark):
    calls = [(1, "a", 1, "f", '{"x":1}', None), (1, "a", 2, "f", '{"x":"no"}', None), (1, "a", 2, "f", '{"x":"no"}', None),
             (1, "b", 3, "f", '{"x":2}', "a"), (None, "a", 1, "f", '{"x":3}', None), (None, "a", 1, "f", '{"x":4}', None)]
    results = [(1, "a", 5, "ok"), (1, "a", 6, "more"), (1, "a", 6, "more"), (1, "zz", 7, "lost"), (1, "zz", 8, "too")]
    c, r = spark.createDataFrame([(*x, 5, "x") for x in calls], CALLS), spark.createDataFrame([(*x, 1) for x in results], RESULTS)
    s = spark.createDataFrame(SCHEMAS, "name string, param string, type string, required boolean")
    out = C.link_calls(c, r, s, copies=True).collect()
    got = sorted((r.status, r.conv_id or 0, r.call_id, r.turn or 0, r.level, r.valid, r.result_turn, r.n_calls, r.n_results,
                  json.loads(r.json)["result"], (json.loads(r.json)["arguments"] or {}).get("x")) for r in out)
    assert got == [
        ("duplicate_call", 0, "a", 1, 0, True, None, 2, 0, None, 4),
        *[("duplicate_call", 1, "a", 2, 0, False, None, 3, 3, None, "no")] * 2,
        *[("duplicate_result", 1, "a", 0, 0, None, 6, 3, 3, "more", None)] * 2,
        ("duplicate_result", 1, "zz", 0, None, None, 8, 0, 2, "too", None),
        ("linked", 1, "a", 1, 0, True, 5, 3, 3, "ok", 1), ("no_result", 0, "a", 1, 0, True, None, 2, 0, None, 3),
        ("no_result", 1, "b", 3, 1, True, None, 1, 0, None, 2),
        ("orphan_result", 1, "zz", 0, None, None, 7, 0, 2, "lost", None)]


def test_every_message_of_a_query_is_a_row(spark, tmp_path):
    from strata.llm import queries as Q
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "you"), (1, 1, "assistant", "one"), (1, 1, "assistant", "two"),
            (1, None, "user", "x"), (1, None, "user", "y"), (1, None, "assistant", "z"), (None, 0, "user", "u")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(r.status for r in Q.op2_tool_call_linking(spark, str(tmp_path)).collect())
    assert got == ["duplicate_call", "duplicate_result", "linked", "no_id", "no_id", "no_id", "orphan_result"]
