"""Tool-call linking for chat data.

Calls and results meet by (conversation, call identifier) in a hash join.
Calls may depend on other calls of their conversation; each set of calls that
depend on one another is put into a topological order. Arguments are validated
against the tool's JSON schema, and each call is written as canonical JSON
(keys sorted by UTF-16 code units, no white space, shortest numbers).

Order: sorting a conversation by ``ORDER`` is a topological order. Sets whose
calls only depend on earlier ones keep (turn, seq). In the others each call has
a level, one more than the highest of its dependencies; small sets get theirs
in one task, sets of more than ``IN_TASK`` calls by rounds of joins over the
whole cluster, with the same result.
"""

from __future__ import annotations

import json
import math
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, ensure_checkpoint_dir
from .components import components

ORDER = ["conv_id", "set_turn", "set_seq", "level", "turn", "seq"]
#: Calls of a set that one task puts in order.
IN_TASK = 5_000
CALLS = "array<struct<id:string,name:string,arguments:string,depends_on:array<string>>>"


def canonical(value) -> str:
    """Canonical JSON text of a parsed value."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("not a JSON number")
        return str(int(value)) if value == int(value) and abs(value) < 1e21 else _exponent(repr(value))
    return json.dumps(value, ensure_ascii=False)


def _exponent(text: str) -> str:
    """Python's exponent (1e-07) in the short form (1e-7); small ones down to 1e-6 in plain digits."""
    if "e" not in text:
        return text
    mantissa, exp = text.split("e")
    if -7 < int(exp) < 0:
        sign, digits = ("-", mantissa[1:]) if mantissa[0] == "-" else ("", mantissa)
        return f"{sign}0.{'0' * (-int(exp) - 1)}{digits.replace('.', '')}"
    return f"{mantissa}e{'+' if int(exp) > 0 else '-'}{abs(int(exp))}"


_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _has_type(v, kind: str) -> bool:
    if kind in ("number", "integer"):
        return isinstance(v, (int, float)) and not isinstance(v, bool) and (kind == "number" or v == int(v))
    return isinstance(v, _TYPES[kind])


def violations(v, schema: dict, at: str = "$") -> list[str]:
    """What in a value is against a JSON schema (type, enum, const, bounds, lengths, properties, required, items)."""
    out = []
    kinds = schema.get("type")
    if kinds is not None and not any(_has_type(v, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at}: type"]
    if "enum" in schema and canonical(v) not in map(canonical, schema["enum"]) or "const" in schema and canonical(v) != canonical(schema["const"]):
        out.append(f"{at}: value")
    if _has_type(v, "number") and (v < schema.get("minimum", v) or v > schema.get("maximum", v)):
        out.append(f"{at}: range")
    if isinstance(v, str) and not schema.get("minLength", 0) <= len(v) <= schema.get("maxLength", len(v)):
        out.append(f"{at}: length")
    if isinstance(v, list):
        if not schema.get("minItems", 0) <= len(v) <= schema.get("maxItems", len(v)):
            out.append(f"{at}: length")
        for i, x in enumerate(v):
            out += violations(x, schema.get("items", {}), f"{at}[{i}]")
    if isinstance(v, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in v]
        for k, x in v.items():
            if k in known:
                out += violations(x, known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{at}.{k}: unknown")
    return out


_RULES = {"type", "enum", "const", "minimum", "maximum", "minLength", "maxLength", "minItems", "maxItems", "items", "properties", "required", "additionalProperties"}
#: Keywords that describe and never reject a value.
_NOTES = {"title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly", "format", "$schema", "$comment"}


def unsupported(schema, at: str = "$") -> list[str]:
    """What in a schema ``violations`` does not check."""
    if not isinstance(schema, dict):
        return [f"{at}: not an object"]
    out = [f"{at}.{k}" for k in sorted(set(schema) - _RULES - _NOTES)]
    kinds = schema.get("type", [])
    out += [f"{at}.type: {k}" for k in ([kinds] if isinstance(kinds, str) else kinds) if k not in {*_TYPES, "number", "integer"}]
    if not isinstance(schema.get("additionalProperties", True), bool):
        out.append(f"{at}.additionalProperties: not true or false")
    for k, x in schema.get("properties", {}).items():
        out += unsupported(x, f"{at}.properties.{k}")
    return out + (unsupported(schema["items"], f"{at}.items") if "items" in schema else [])


def _parse(text: str):
    """Strict JSON: no NaN, no repeated keys."""

    def pairs(items):
        if len({k for k, _ in items}) < len(items):
            raise ValueError("repeated key")
        return dict(items)

    def refuse(x):
        raise ValueError(x)

    return json.loads(text, object_pairs_hook=pairs, parse_constant=refuse)


def check(name: str | None, arguments: str | None, schemas: dict[str, dict]) -> tuple[list[str], str | None]:
    """The errors of a call and its arguments in canonical form (null if they can't be parsed)."""
    try:
        v = _parse(arguments if arguments is not None else "")
        text = canonical(v)
        text.encode()
    except (ValueError, RecursionError):
        return ["arguments: not JSON"], None
    if name not in schemas:
        return ["name: unknown tool"], text
    return violations(v, schemas[name]), text


def from_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of chat messages (conv_id, turn, role, content, tool_calls, tool_call_id).

    ``tool_calls`` is a JSON list of {id, name, arguments, depends_on}, where
    arguments are a JSON text; lists that can't be parsed give no calls.
    """
    c = messages.where("tool_calls is not null").select("conv_id", "turn", F.posexplode(F.from_json("tool_calls", CALLS)).alias("seq", "c"))
    calls = c.select("conv_id", "turn", "seq", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"), F.col("c.depends_on").alias("depends_on"))
    return calls, messages.where("role = 'tool'").select("conv_id", "turn", F.col("tool_call_id").alias("call_id"), F.col("content"))


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (root, a, b) edges, b before a, to the level of each call; -1 for calls on a cycle or behind one."""

    def one(edges):
        need: dict[int, set[int]] = {}
        for a, b in edges:
            need.setdefault(a, set()).add(b)
            need.setdefault(b, set())
        users: dict[int, list[int]] = {}
        for a, bs in need.items():
            for b in bs:
                users.setdefault(b, []).append(a)
        left = {n: len(bs) for n, bs in need.items()}
        level, now, k = dict.fromkeys(need, -1), [n for n, x in left.items() if not x], 0
        while now:
            after = []
            for n in now:
                level[n] = k
                for u in users.get(n, ()):
                    left[u] -= 1
                    if not left[u]:
                        after.append(u)
            now, k = after, k + 1
        return pa.RecordBatch.from_arrays([pa.array(list(level), pa.int64()), pa.array(list(level.values()), pa.int64())], ["no", "level"])

    now, held = None, []
    for b in batches:
        for root, x, y in zip(*(b.column(k).to_pylist() for k in ("root", "a", "b"))):
            if root != now and held:
                yield one(held)
                held = []
            now = root
            held.append((x, y))
    if held:
        yield one(held)


def _levels_by_rounds(edges: DataFrame) -> DataFrame:
    """The same for large sets: a round for each level peels off the calls whose dependencies are all done.

    Levels are appended to a table in the shared checkpoint folder.
    """
    spark = edges.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"levels-{uuid.uuid4().hex}")
    nodes = cut_lineage(edges.select(F.col("a").alias("no")).unionByName(edges.select(F.col("b").alias("no"))).distinct())
    k = 0
    while True:
        ready = cut_lineage(nodes.join(edges.select(F.col("a").alias("no")).distinct(), "no", "left_anti"))
        last = ready.isEmpty()
        part = nodes if last else ready
        part.withColumn("level", F.lit(-1 if last else k).cast("long")).write.mode("append").parquet(path)
        if last:
            return spark.read.parquet(path)
        nodes = cut_lineage(nodes.join(ready, "no", "left_anti"))
        edges = cut_lineage(edges.join(ready.select(F.col("no").alias("b")), "b", "left_anti"))
        k += 1


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict], in_task: int = IN_TASK) -> DataFrame:
    """One row per call and per result without a call.

    calls: conv_id, turn, seq, call_id, name, arguments (JSON text), depends_on (identifiers).
    results: conv_id, turn, call_id, content. Columns returned: conv_id, call_id, turn, seq, set_turn,
    set_seq, level, name, errors, n_results, result_turn, status, record.

    status: ``ok``; ``invalid`` (errors are listed); ``no_result``; ``early_result`` (all results before
    the call; one without a turn counts as after it, whatever its content); ``duplicate`` (an identifier used before in its conversation; it links nothing); ``cycle``;
    ``orphan_result``. The first result not before the call is taken. A null conversation or identifier links nothing.
    Dependencies on unknown calls or on itself are errors.
    Rows that repeat a call count as its duplicates; repeated results are counted. Empty tables are fine.
    A schema with keywords that are not checked raises a ValueError.
    """
    if bad_schemas := [f"{name}: {x}" for name, schema in schemas.items() for x in unsupported(schema)]:
        raise ValueError("unsupported in a schema: " + ", ".join(bad_schemas))
    c = calls.select("conv_id", "turn", "seq", "call_id", "name", "arguments", F.coalesce("depends_on", F.array().cast("array<string>")).alias("depends_on"))
    c = cut_lineage(c).withColumn("no", F.monotonically_increasing_id())  # checkpoint files fix the partitions
    # the smallest number of an identifier is that of its first call
    first = c.where("call_id is not null and conv_id is not null").groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "seq", "no")).alias("f"))
    heads = cut_lineage(first.select("conv_id", "call_id", F.col("f.no").alias("no"), F.col("f.turn").alias("turn"), F.col("f.seq").alias("seq")))

    d = c.join(heads.select("no"), "no").select("conv_id", "no", "turn", "seq", "call_id", F.explode(F.array_distinct("depends_on")).alias("dep"))
    known = heads.select("conv_id", F.col("call_id").alias("dep"), F.col("no").alias("b"), F.col("turn").alias("b_turn"), F.col("seq").alias("b_seq"))
    d = cut_lineage(d.join(known, ["conv_id", "dep"], "left"))
    bad = d.where("b is null or b = no").groupBy("no").agg(F.array_sort(F.collect_set(F.concat(F.lit("depends_on: "), F.coalesce("dep", F.lit("null"))))).alias("bad"))
    edges = d.where("b <> no").select(F.col("no").alias("a"), "b", (F.struct("b_turn", "b_seq") >= F.struct("turn", "seq")).alias("back"))
    sets = cut_lineage(components(edges.select("a", "b")))
    e = edges.join(sets.select(F.col("node").alias("a"), "root"), "a")
    per_set = e.groupBy("root").agg(F.max("back").alias("mixed"), F.count(F.lit(1)).alias("n")).where("mixed")
    mixed = cut_lineage(e.join(per_set.select("root", "n"), "root").select("root", "a", "b", "n"))
    levels = mixed.where(F.col("n") <= in_task).repartition("root").sortWithinPartitions("root").select("root", "a", "b").mapInArrow(_levels, "no bigint, level bigint")
    if not mixed.where(F.col("n") > in_task).isEmpty():
        levels = levels.unionByName(_levels_by_rounds(cut_lineage(mixed.where(F.col("n") > in_task).select("a", "b").distinct())))

    starts = sets.join(heads.select(F.col("no").alias("node"), "turn", "seq"), "node").groupBy("root").agg(F.min(F.struct("turn", "seq")).alias("s"))
    place = sets.join(starts, "root").select(F.col("node").alias("no"), F.col("s.turn").alias("set_turn"), F.col("s.seq").alias("set_seq"))

    r = results.select("conv_id", F.col("turn").alias("r_turn"), "call_id", "content")
    met = heads.join(r, ["conv_id", "call_id"]).withColumn("late", F.coalesce(F.col("r_turn") < F.col("turn"), F.lit(False)))
    met = met.groupBy("no").agg(F.count(F.lit(1)).alias("n_results"), F.min(F.when(~F.col("late"), F.struct("r_turn", "content"))).alias("r"), F.bool_or(~F.col("late")).alias("answered"))
    lost = r.join(heads.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti")

    rows = c.join(heads.select("no", F.lit(True).alias("head")), "no", "left").join(bad, "no", "left").join(place, "no", "left").join(levels, "no", "left").join(met, "no", "left")
    rows = rows.select(
        "conv_id", "call_id", "turn", "seq", F.coalesce("set_turn", "turn").alias("set_turn"), F.coalesce("set_seq", "seq").alias("set_seq"), F.coalesce("level", F.lit(0)).cast("long").alias("level"),
        "name", "arguments", "depends_on", F.coalesce("bad", F.array().cast("array<string>")).alias("bad"), F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        F.col("r.r_turn").alias("result_turn"), F.col("r.content").alias("content"), F.coalesce("answered", F.lit(False)).alias("answered"), F.coalesce("head", F.lit(False)).alias("head"), F.col("call_id").isNull().alias("unnamed"),
    )
    kept = ["conv_id", "call_id", "turn", "seq", "set_turn", "set_seq", "level", "name"]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.to_pylist():
                errors, args = check(x["name"], x["arguments"], schemas)
                errors = sorted(errors + x["bad"] + ["id: missing"] * x["unnamed"])
                status = "duplicate" if not x["head"] and not x["unnamed"] else "cycle" if x["level"] < 0 else "invalid" if errors else "early_result" if x["n_results"] and not x["answered"] else "ok" if x["n_results"] else "no_result"
                body = {"id": x["call_id"], "name": x["name"], "arguments": None, "depends_on": sorted({i for i in x["depends_on"] if i is not None}), "result": x["content"]}
                text = canonical(body)
                if args is not None:
                    text = text.replace('{"arguments":null,', '{"arguments":' + args + ",", 1)
                out.append((errors, x["n_results"], x["result_turn"], status, text))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), pa.array(cols[0], pa.list_(pa.string())), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string())], [*kept, "errors", "n_results", "result_turn", "status", "record"])

    done = rows.withColumn("result_turn", F.col("result_turn").cast("long")).mapInArrow(finish, f"{types}, errors array<string>, n_results bigint, result_turn bigint, status string, record string")
    return done.unionByName(lost.select("conv_id", "call_id", F.col("r_turn").cast("long").alias("result_turn"), F.lit("orphan_result").alias("status"), F.lit(1).cast("long").alias("n_results")), allowMissingColumns=True)


#: Tools of the messages derived from ``conversations``.
TOOLS: dict[str, dict] = {
    "search": {"type": "object", "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 9}}, "required": ["query", "limit"], "additionalProperties": False},
    "translate": {"type": "object", "properties": {"text": {"type": "string"}, "to": {"enum": ["de", "en", "es", "fr"]}}, "required": ["text", "to"]},
    "measure": {"type": "object", "properties": {"words": {"type": "array", "items": {"type": "string", "maxLength": 24}, "minItems": 1}, "scale": {"type": "number", "maximum": 2}}, "required": ["words"]},
}


def derive_messages(conversations: DataFrame) -> DataFrame:
    """Chat messages with tool calls and results, made of every assistant's turn of ``conversations`` (the others hold no calls).

    Each line of an assistant's turn becomes a call; which tool, whether its
    arguments hold to the schema, which neighbour it depends on (so that some
    calls depend on later ones and some on each other) and whether a result
    follows is read off the line's CRC. Results come as tool turns of the same number.
    """
    line = conversations.where("role = 'assistant'").select("conv_id", "turn", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("seq", "line"))
    line = line.withColumn("crc", F.crc32(F.col("line").cast("binary"))).withColumn("call_id", F.concat_ws("-", F.lit("call"), "turn", "seq"))
    args = (
        F.when(F.col("crc") % 4 == 0, F.to_json(F.struct((F.col("crc") % 11).alias("limit"), F.col("line").alias("query"))))
        .when(F.col("crc") % 4 == 1, F.to_json(F.struct(F.element_at(F.array(*map(F.lit, ["en", "de", "fr", "es", "xx"])), (F.col("crc") % 5 + 1).cast("int")).alias("to"), F.col("line").alias("text"))))
        .when(F.col("crc") % 4 == 2, F.to_json(F.struct(F.split("line", " ").alias("words"), (F.col("crc") % 100 / 40.0).alias("scale"))))
        .otherwise(F.concat(F.lit('{"text":'), F.when(F.col("crc") % 3 == 0, F.lit("")).otherwise(F.lit("null}"))))
    )
    name = F.element_at(F.array(*map(F.lit, ["search", "translate", "measure", "other"])), (F.col("crc") % 4 + 1).cast("int"))
    around = lambda k: F.concat_ws("-", F.lit("call"), "turn", F.col("seq") + k)
    deps = F.filter(F.array(F.when((F.col("seq") > 0) & (F.col("crc") % 5 != 0), around(-1)), F.when(F.col("crc") % 7 == 0, around(1))), lambda x: x.isNotNull())
    calls = line.select("conv_id", "turn", F.struct("seq", F.struct(F.col("call_id").alias("id"), name.alias("name"), args.alias("arguments"), deps.alias("depends_on")).alias("c")).alias("x"))
    calls = calls.groupBy("conv_id", "turn").agg(F.to_json(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["c"])).alias("tool_calls"))
    calls = calls.select("conv_id", "turn", F.lit("assistant").alias("role"), F.lit(None).cast("string").alias("content"), "tool_calls", F.lit(None).cast("string").alias("tool_call_id"))
    back = F.to_json(F.struct(F.length("line").alias("n"), F.sha1(F.col("line").cast("binary")).alias("sha1")))
    tool = line.where(F.col("crc") % 9 != 0).select("conv_id", (F.col("turn") - F.when(F.col("crc") % 23 == 0, 1).otherwise(0)).alias("turn"), F.lit("tool").alias("role"), back.alias("content"), F.lit(None).cast("string").alias("tool_calls"), F.when(F.col("crc") % 29 == 0, F.concat("call_id", F.lit("x"))).otherwise(F.col("call_id")).alias("tool_call_id"))
    return calls.unionByName(tool)


def link_conversations(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    return link(*from_messages(cut_lineage(derive_messages(conversations))), TOOLS)
