"""Tool calls in chat rows: linked to their results, checked against schemas, ordered, written as canonical JSON."""

from __future__ import annotations

import json
import math
import re
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import cut

REFERENCE = r'"\$call:([^"\\]+)"'  # a string argument that stands for the result of another call
KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
ROW = ("conv_id {0}, call_id string, turn long, name string, status string, position long, level long, n_refs long, "
       "n_unresolved long, valid boolean, problems string, message string")


def calls_in_messages(messages: DataFrame) -> DataFrame:
    """conv_id, turn, call_id, name, arguments of calls that assistants write as JSON `{"tool_calls": [...]}`."""
    call = "struct<id: string, name: string, arguments: string>"
    found = F.from_json("text", f"tool_calls array<{call}>").getField("tool_calls")
    own = messages.filter((F.col("role") == "assistant") & F.startswith(F.ltrim("text"), F.lit("{")))
    return own.select("conv_id", F.col("turn").cast("long").alias("turn"), F.explode(found).alias("c")).select(
        "conv_id", "turn", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"),
        F.col("c.arguments").alias("arguments"))


def results_in_messages(messages: DataFrame) -> DataFrame:
    """conv_id, turn, call_id, content of results that tools write as JSON `{"tool_call_id": ..., "content": ...}`."""
    found = F.from_json("text", "tool_call_id string, content string")
    return messages.filter(F.col("role") == "tool").select(
        "conv_id", F.col("turn").cast("long").alias("turn"), found["tool_call_id"].alias("call_id"),
        found["content"].alias("content"))


def exchanges(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain chats as calls and results: each turn of a user or system asks, the turn after it answers.

    The arguments hold the text and, from the third turn on, a reference to the call two turns earlier.
    """
    turn = F.col("turn").cast("long")

    def name(at):
        return F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), at.cast("string"))

    asks = F.col("role").isin("user", "system")
    after = F.when(turn >= 2, F.concat(F.lit("$call:"), name(turn - 2)))
    calls = messages.filter(asks).select(
        "conv_id", turn.alias("turn"), name(turn).alias("call_id"),
        F.when(F.col("role") == "user", "reply").otherwise("configure").alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"), after.alias("after"))).alias("arguments"))
    results = messages.filter(~asks | F.col("role").isNull()).select(
        "conv_id", turn.alias("turn"), name(turn - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def schema_problems(value: Any, schema: dict, at: str = "$") -> list[str]:
    """What in a JSON value breaks a schema (type, enum, required, properties, items, bounds and pattern)."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{at}: not {'|'.join(kinds)}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not in enum")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in sorted(schema.get("required", [])) if k not in value]
        for k in sorted(value):
            if k in known:
                found += schema_problems(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{k}: unknown")
    elif isinstance(value, list):
        for i, item in enumerate(value if "items" in schema else []):
            found += schema_problems(item, schema["items"], f"{at}[{i}]")
    elif isinstance(value, str):
        if not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
            found.append(f"{at}: length")
        if "pattern" in schema and not re.search(schema["pattern"], value):
            found.append(f"{at}: pattern")
    elif _is(value, "number") and not schema.get("minimum", value) <= value <= schema.get("maximum", value):
        found.append(f"{at}: range")
    return found


def _is(value: Any, kind: str) -> bool:
    if kind in ("number", "integer"):
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        return number and (kind == "number" or isinstance(value, int) or value.is_integer())
    return isinstance(value, KINDS[kind])


def canonical(value: Any) -> str:
    """JSON with sorted keys, no spaces, and characters beyond ASCII as they are, but for halves of surrogate pairs."""
    return storable(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def storable(text: str) -> str:
    """The text with halves of surrogate pairs, which UTF-8 has no place for, as JSON escapes."""
    return re.sub("[\ud800-\udfff]", lambda half: f"\\u{ord(half.group()):04x}", text)


def parsed(text: str | None) -> Any:
    """The value of a JSON text, null for none; NaN, Infinity and numbers beyond doubles are no JSON (ValueError)."""
    def number(digits: str) -> float:
        value = float(digits)
        if math.isinf(value):
            raise ValueError(digits)
        return value

    def refused(word: str) -> None:
        raise ValueError(word)

    return json.loads(text or "null", parse_float=number, parse_constant=refused)


def reference_order(edges: DataFrame, calls: DataFrame) -> DataFrame:
    """call_id, position and level of the calls that refer to others; every reference comes before its call.

    `edges` has call_id, turn and ref, `calls` call_id and turn. position is the latest turn among the call and all it
    refers to, however indirectly; it is the call's own turn, and nothing is repeated, if references point back. Those
    that point to the same or a later turn take rounds: one for each step along such a chain. level orders calls of
    one position; it is null in a cycle of references, and behind one at the same position.
    """
    known = calls.select(F.col("call_id").alias("ref"), F.col("turn").alias("ref_position"))
    current = cut(edges.withColumnRenamed("turn", "position").join(known, "ref"), "references")
    while True:
        late = current.filter("ref_position > position").groupBy("call_id").agg(F.max("ref_position").alias("new"))
        late = cut(late, "late")
        if late.isEmpty():
            break
        moved = current.join(late, "call_id", "left").withColumn("position", F.coalesce("new", "position")).drop("new")
        moved = moved.join(late.withColumnRenamed("call_id", "ref"), "ref", "left")
        current = cut(moved.withColumn("ref_position", F.coalesce("new", "ref_position")).drop("new"), "references")

    placed = current.select("call_id", "position").distinct()
    level = F.lit(0).cast("long")
    waiting = cut(current.filter("ref_position = position").select("call_id", "ref"), "waiting")
    if waiting.isEmpty():
        return placed.withColumn("level", level)
    heads = waiting.select(F.col("ref").alias("call_id")).unionByName(placed.select("call_id")).distinct()
    done = cut(heads.join(waiting, "call_id", "left_anti").withColumn("level", level), "levels")
    while True:
        met = waiting.join(done.withColumnRenamed("call_id", "ref"), "ref", "left").groupBy("call_id").agg(
            F.count(F.lit(1)).alias("refs"), F.count("level").alias("met"), F.max("level").alias("level"))
        new = cut(met.filter("refs = met").select("call_id", (F.col("level") + 1).alias("level")), "levels")
        if new.isEmpty():
            return placed.join(done, "call_id", "left")
        waiting = cut(waiting.join(new, "call_id", "left_anti"), "waiting")
        done = cut(done.unionByName(new), "levels")


def link_conversations(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call, and per result that is not linked with one; identifiers hold within a conversation.

    As link_calls, but calls, results and references meet only where conv_id and call_id are the same (a null conv_id
    is one conversation), and nothing is left out: if an identifier repeats in a conversation, the first call and the
    first result (by turn, then by content) are linked, and references mean that call. Each further call or result
    has a row of its own with status `repeated`; all rows of that identifier have the problem `repeated`.
    """
    named = F.coalesce(F.col("call_id"), F.lit("")) != ""
    turn, row = F.coalesce("turn", F.lit(0)).cast("long").alias("turn"), F.monotonically_increasing_id().alias("row")
    calls = cut(calls.select("conv_id", "call_id", turn, "name", "arguments", row), "calls")
    results = cut(results.select("conv_id", "call_id", turn, "content", row), "results")
    ask, give = F.struct("turn", "arguments", "name", "conv_id"), F.struct("turn", "content", "conv_id")
    first = cut(calls.filter(named).groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "arguments", "name", "row")).alias("call"), F.count(F.lit(1)).alias("n")), "first")
    answers = cut(results.filter(named).groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "content", "row")).alias("result"), F.count(F.lit(1)).alias("n")), "answers")

    refs = F.array_distinct(F.regexp_extract_all(F.coalesce("arguments", F.lit("")), F.lit(REFERENCE), F.lit(1)))
    targets = first.select(F.col("conv_id").alias("conv"), F.col("call_id").alias("ref"), F.col("call.row").alias("to"))
    edges = calls.select("row", "turn", "conv_id", F.explode(refs).alias("id"))
    edges = cut(edges.join(targets, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("id") == F.col("ref")), "left")
                .select("row", "turn", "to"), "targets")
    order = reference_order(
        edges.filter("to IS NOT NULL").select(F.col("row").alias("call_id"), "turn", F.col("to").alias("ref")),
        calls.select(F.col("row").alias("call_id"), "turn"))
    order = order.select(F.col("call_id").alias("row"), "position", "level", F.lit(True).alias("ordered"))
    missing = edges.filter("to IS NULL").groupBy("row").agg(F.count(F.lit(1)).alias("n_unresolved"))
    placed = calls.select("row", "call_id", ask.alias("call"), F.size(refs).cast("long").alias("n_refs"))
    placed = cut(placed.join(order, "row", "left").join(missing, "row", "left"), "placed")

    heads = first.select(F.col("call.row").alias("row"), "conv_id", F.col("n").alias("n_calls"))
    found = answers.select(F.col("conv_id").alias("conv"), F.col("call_id").alias("id"), F.struct(
        "result.turn", "result.content", "conv_id").alias("result"), F.col("n").alias("n_results"))
    linked = placed.join(heads, "row").join(
        found, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("call_id") == F.col("id")), "full")
    linked = linked.withColumn("call_id", F.coalesce("call_id", "id")).drop("row", "conv_id", "conv", "id")
    more = F.when(named, 2).otherwise(1).cast("long")  # of the same identifier, the first included
    calls_left = placed.join(heads, "row", "left_anti").withColumn("n_calls", more).drop("row")
    results_left = results.join(answers.select("result.row"), "row", "left_anti").select(
        "call_id", give.alias("result"), more.alias("n_results"))
    rows = linked.withColumn("further", F.lit(False)).unionByName(calls_left.withColumn("further", named), True)
    return _written(rows.unionByName(results_left.withColumn("further", named), True), schemas)


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call identifier and per result without a call, with status, order, checks and canonical JSON.

    For identifiers that are unique in the whole table; link_conversations is for those that hold in a conversation.
    `calls` has conv_id, turn, call_id, name, arguments (JSON text), `results` conv_id, turn, call_id, content.
    status: linked, unanswered, early (the result stands before the call), orphan (result without call), unnamed (a
    call or result whose identifier is null or empty; each keeps a row). If an identifier repeats, the first by turn,
    then by content, counts; the others add the problem `repeated`. Sorting by conv_id, position, level is a
    topological order (see reference_order). n_refs and n_unresolved count distinct references and those without a
    call. A call is valid if its arguments are JSON, its name has a schema in `schemas` and nothing breaks it. A null
    turn counts as 0. Empty tables give no rows; other columns are ignored.
    """
    ask = F.struct("turn", "arguments", "name", "conv_id")
    give = F.struct("turn", "content", "conv_id")
    named = F.coalesce(F.col("call_id"), F.lit("")) != ""
    calls, results = (x.withColumn("turn", F.coalesce("turn", F.lit(0)).cast("long")) for x in (calls, results))
    first = cut(calls.filter(named).groupBy("call_id").agg(
        F.min(ask).alias("call"), F.count(F.lit(1)).alias("n_calls")), "calls")
    answers = results.filter(named).groupBy("call_id").agg(
        F.min(give).alias("result"), F.count(F.lit(1)).alias("n_results"))
    refs = F.array_distinct(F.regexp_extract_all(F.coalesce("call.arguments", F.lit("")), F.lit(REFERENCE), F.lit(1)))
    asked = first.select("call_id", F.col("call.turn").alias("turn"))
    edges = first.select("call_id", F.col("call.turn").alias("turn"), F.explode(refs).alias("ref"))
    order = reference_order(edges, asked)
    missing = edges.join(asked.select(F.col("call_id").alias("ref")), "ref", "left_anti").groupBy("call_id").agg(
        F.count(F.lit(1)).alias("n_unresolved"))
    rows = (
        first.withColumn("n_refs", F.size(refs).cast("long"))
        .join(order.withColumn("ordered", F.lit(True)), "call_id", "left").join(missing, "call_id", "left").join(answers, "call_id", "full"))
    blank_call = calls.filter(~named).select(
        "call_id", ask.alias("call"), F.lit(1).cast("long").alias("n_calls"))
    blank_result = results.filter(~named).select(
        "call_id", give.alias("result"), F.lit(1).cast("long").alias("n_results"))
    rows = rows.unionByName(blank_call, True).unionByName(blank_result, True)
    return _written(rows.withColumn("further", F.lit(False)), schemas)


def _written(rows: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """The rows of calls with their results as ROW: status, checks and canonical JSON."""
    named = F.coalesce(F.col("call_id"), F.lit("")) != ""
    no_call, no_result = F.col("call").isNull(), F.col("result").isNull()
    status = (
        F.when(~named, "unnamed").when(F.col("further"), "repeated").when(no_call, "orphan").when(no_result, "unanswered")
        .when(F.col("result.turn") < F.col("call.turn"), "early").otherwise("linked"))
    flat = rows.select(
        F.coalesce("call.conv_id", "result.conv_id").alias("conv_id"), "call_id",
        F.coalesce("call.turn", "result.turn").alias("turn"), F.col("call.name").alias("name"), status.alias("status"),
        F.coalesce("position", "call.turn", "result.turn").alias("position"),
        F.when(~no_call & F.col("ordered").isNull(), F.lit(0)).otherwise(F.col("level")).cast("long").alias("level"),
        F.coalesce("n_refs", F.lit(0)).cast("long").alias("n_refs"),
        F.coalesce("n_unresolved", F.lit(0)).cast("long").alias("n_unresolved"),
        F.col("call.arguments").alias("arguments"), F.col("result.content").alias("content"),
        no_call.alias("no_call"), no_result.alias("no_result"),
        (F.greatest(F.coalesce("n_calls", F.lit(1)), F.coalesce("n_results", F.lit(1))) > 1).alias("repeated"))

    def check(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                problems, value = [], None
                if not row["no_call"]:
                    try:
                        value = parsed(row["arguments"])
                        canonical([[value]])  # as deep as it will be written
                        problems = (schema_problems(value, schemas[row["name"]]) if row["name"] in schemas
                                    else ["$: no schema"])
                    except (ValueError, RecursionError):
                        value, problems = row["arguments"], ["$: no JSON"]
                valid = None if row["no_call"] else not problems
                message = {"id": row["call_id"], "status": row["status"]}
                if not row["no_call"]:
                    message |= {"name": row["name"], "arguments": value}
                if not row["no_result"]:
                    message["result"] = row["content"]
                kept = {k: row[k] for k in ("conv_id", "call_id", "turn", "name", "status", "position", "level", "n_refs",
                                            "n_unresolved")}
                problems = problems[:] + ["repeated"] * row["repeated"]
                out.append(kept | {"valid": valid, "problems": storable("; ".join(problems)), "message": canonical(message)})
            yield pa.RecordBatch.from_pylist(out, schema=target)

    kind = flat.schema["conv_id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark_schema = StructType.fromDDL(ROW.format(kind))
    target = to_arrow_schema(spark_schema)
    return flat.mapInArrow(check, spark_schema)
