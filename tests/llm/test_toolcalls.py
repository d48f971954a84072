import json

import pytest
from llm_brute import SF1

from tabrisk.llm import toolcalls as T
from tabrisk.llm.queries import QUERIES

CALL = "conv_id long, turn long, seq int, call_id string, name string, arguments string, depends_on array<string>"
RESULT = "conv_id long, turn long, call_id string, content string"
KEYS = ["conv_id", "call_id", "turn", "seq"]


def levels(deps):
    """Longest chain of dependencies below each call by repeated passes; -1 for those that never settle."""
    done = {}
    for k in range(len(deps) + 1):
        now = [n for n, d in deps.items() if n not in done and all(x in done for x in d)]
        done |= dict.fromkeys(now, k)
    return {n: done.get(n, -1) for n in deps}


def brute(calls, results):
    """{(conv, id, turn, seq): (status, errors, level or None, result content)} of calls with identifiers."""
    heads = {}
    for c in sorted(calls, key=lambda c: (c[1], c[2])):
        if c[0] is not None and c[3] is not None:
            heads.setdefault((c[0], c[3]), c)
    deps = {k: {(k[0], d) for d in (c[6] or []) if (k[0], d) in heads and d != k[1]} for k, c in heads.items()}
    group = {k: k for k in deps}

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for k, ds in deps.items():
        for d in ds:
            group[top(k)] = top(d)
    mixed = {top(k) for k, ds in deps.items() for d in ds if heads[d][1:3] >= heads[k][1:3]}
    level = levels({k: v for k, v in deps.items() if top(k) in mixed})
    out = {}
    for c in calls:
        k = (c[0], c[3])
        head = heads.get(k) is c
        errors, args = T.check(c[4], c[5], T.TOOLS)
        errors = errors + ([f"depends_on: {'null' if d is None else d}" for d in set(c[6] or []) if (c[0], d) not in heads or d == c[3]] if head else []) + ["id: missing"] * (c[3] is None)
        mine = sorted((r for r in results if (r[0], r[2]) == k and None not in k), key=lambda r: (r[1], r[3])) if head else []
        after = [r for r in mine if r[1] >= c[1]]
        status = "duplicate" if not head and c[3] is not None else "cycle" if head and level.get(k, 0) < 0 else "invalid" if errors else "no_result" if not mine else "ok" if after else "early_result"
        out.setdefault((*k, c[1], c[2]), []).append((status, sorted(errors), level.get(k, 0) if head else 0, after[0][3] if after else None))
    return out, sorted(str((r[0], r[2], r[1])) for r in results if (r[0], r[2]) not in heads)


def compare(got, calls, results):
    want, orphans = brute(calls, results)
    have = {}
    for r in got:
        if r.status != "orphan_result":
            rec = json.loads(r.record)
            assert list(rec) == sorted(rec) and rec["id"] == r.call_id
            assert r.record == T.canonical(rec)
            have.setdefault((r.conv_id, r.call_id, r.turn, r.seq), []).append((r.status, r.errors, r.level, rec["result"]))
    assert {k: sorted(v, key=str) for k, v in have.items()} == {k: sorted(v, key=str) for k, v in want.items()}
    assert sorted(str((r.conv_id, r.call_id, r.result_turn)) for r in got if r.status == "orphan_result") == orphans
    place = {}
    rows = sorted((r for r in got if r.status != "orphan_result" and r.conv_id is not None), key=lambda r: [getattr(r, k) for k in T.ORDER])
    for i, r in enumerate(rows):
        if r.status != "duplicate" and r.call_id is not None:
            place[r.conv_id, r.call_id] = (i, r)
    for i, r in place.values():
        for d in json.loads(r.record)["depends_on"]:
            other = place.get((r.conv_id, d))
            if other and r.level >= 0 and d != r.call_id and other[1].level >= 0:
                assert other[0] < i


def test_query_equals_brute_force(spark):
    got = QUERIES["op8_tool_call_linking"](spark, SF1).collect()
    messages = T.derive_messages(spark.read.parquet(f"{SF1}/conversations.parquet"))
    calls, results = T.from_messages(messages)
    compare(got, [tuple(r) for r in calls.collect()], [tuple(r) for r in results.collect()])
    assert {r.status for r in got} >= {"ok", "invalid", "no_result", "cycle", "orphan_result"}


OK = '{"query":"q","limit":3}'
CALLS = [
    (1, 0, 0, "a", "search", OK, ["b"]), (1, 0, 1, "b", "search", OK, ["c"]), (1, 0, 2, "c", "search", OK, None), (1, 2, 0, "d", "search", OK, ["a", "c"]),
    (1, 3, 0, "e", "search", OK, ["f"]), (1, 3, 1, "f", "search", OK, ["e"]), (1, 3, 2, "g", "search", OK, ["f"]),
    (1, 4, 0, "a", "search", OK, None), (1, 5, 0, None, "search", OK, ["a"]), (1, 6, 0, "h", None, None, ["nope", "h", None]),
    (2, 0, 0, "a", "search", '{"limit":3.0,"query":"é\\u2028"}', []), (2, 0, 1, "x", "search", '{"query":"","limit":30,"z":1}', []), (None, 0, 0, "a", "search", OK, None), (2, 1, 0, "y", "translate", '{"text":"t","text":"u","to":"en"}', None),
    (3, 0, 0, "same", "search", OK, None), (3, 0, 0, "same", "search", OK, None), (4, 0, 0, "p", "measure", '{"words":["' + "w" * 100_000 + '"],"scale":1e-7}', None), (4, 0, 1, "q", "measure", '{"words":["w"],"scale":NaN}', ["p"]),
]
RESULTS = [(1, 0, "a", "late"), (1, 0, "a", "first"), (1, 1, "b", None), (1, 1, "d", "too early"), (1, 9, "d", "x"), (2, 9, "x", "r"), (2, 9, "lost", "r"), (None, 1, "a", "r"), (1, 1, None, "r"), (4, 0, "p", "é" * 50_000), (1, 1, "g", "only early")]


@pytest.mark.parametrize("in_task", [5_000, 0])
def test_edges(spark, in_task):
    calls = spark.createDataFrame(CALLS, CALL).selectExpr("*", "1 as no", "2 as root", "'x' as status", "3 as r_turn")
    results = spark.createDataFrame(RESULTS, RESULT).selectExpr("*", "1 as no", "'n' as name")
    compare(T.link(calls, results, T.TOOLS, in_task=in_task).collect(), CALLS, RESULTS)


def test_empty_tables(spark):
    none, nothing = spark.createDataFrame([], CALL), spark.createDataFrame([], RESULT)
    assert T.link(none, nothing, T.TOOLS).count() == 0
    assert [r.status for r in T.link(none, spark.createDataFrame(RESULTS[:1], RESULT), T.TOOLS).collect()] == ["orphan_result"]
    assert [r.status for r in T.link(spark.createDataFrame(CALLS[2:3], CALL), nothing, T.TOOLS).collect()] == ["no_result"]
    conv = "conv_id long, turn long, role string, text string"
    assert T.link_conversations(spark, spark.createDataFrame([], conv)).count() == 0
    odd = spark.createDataFrame([(1, 0, "assistant", None), (None, 1, "assistant", "a\nb"), (1, 2, None, "c"), (1, 0, "assistant", None)], conv)
    assert T.link_conversations(spark, odd).count() > 0


def test_canonical_json():
    for a, b in (('{"b":1.0,"a":[1e21,1e-7,0.000001,-0.0,1.50,"\\u00e9\\n"]}', '{"a":[1e+21,1e-7,0.000001,0,1.5,"é\\n"],"b":1}'), ('{"\\ud83d\\ude00":1,"\\ufb33":2}', '{"\U0001f600":1,"\ufb33":2}')):
        assert T.canonical(T._parse(a)) == b


def test_schemas_with_unchecked_keywords_are_refused(spark):
    calls, results = spark.createDataFrame([], CALL), spark.createDataFrame([], RESULT)
    string = {"type": "string"}
    for schema in ({"pattern": "^a"}, {"exclusiveMinimum": 1}, {"multipleOf": 2}, {"uniqueItems": True}, {"anyOf": [string]}, {"$ref": "#/x"}, {"additionalProperties": string}, {"type": "array", "items": [string]}, {"type": "text"}):
        for nested in (schema, {"type": "object", "properties": {"a": schema}}, {"type": "array", "items": schema}):
            with pytest.raises(ValueError, match="unsupported"):
                T.link(calls, results, {"t": nested})
    plain = {"type": ["object", "null"], "title": "t", "properties": {"pattern": {"type": "string", "description": "d"}, "anyOf": {"enum": [1, None]}}, "additionalProperties": False}
    assert T.unsupported(plain) == [] and all(T.unsupported(s) == [] for s in T.TOOLS.values())
    assert T.link(calls, results, {"t": plain}).count() == 0


def test_result_without_turn_and_content(spark):
    calls = spark.createDataFrame([(1, 1, 0, "a", "search", '{"query":"x","limit":1}', None), (1, 1, 1, "b", "search", '{"query":"x","limit":1}', None), (1, 5, 0, "c", "search", '{"query":"x","limit":1}', None)], "conv_id long, turn long, seq int, call_id string, name string, arguments string, depends_on array<string>")
    results = spark.createDataFrame([(1, None, "a", None), (1, 1, "b", None), (1, 4, "c", None)], "conv_id long, turn long, call_id string, content string")
    got = {r.call_id: (r.status, r.n_results, r.result_turn) for r in T.link(calls, results, T.TOOLS).collect()}
    assert got == {"a": ("ok", 1, None), "b": ("ok", 1, 1), "c": ("early_result", 1, None)}
