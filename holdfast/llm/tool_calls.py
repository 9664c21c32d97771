"""Chat formatting: link tool calls with their results, order both, check arguments, write canonical JSON.

* Calls and results meet by (conversation, identifier) in a hash join. The first call with an identifier owns it.
* A call may use results of other calls of its conversation (``{"$ref": id}`` in its arguments). Order: a message
  stands at its turn; a call at its turn or behind the last result it uses; a result right behind its
  call. The order is a sort key (``anchor, step, kind, turn, pos``), so no conversation, however
  long, is gathered in a task. A wait for a call that itself waits for one other call skips to that one, with
  the links in between added up, so that a chain halves in each round.
* Arguments are parsed, checked against the schema of their tool and written with sorted keys and without blanks.

Defined results: a call is ``linked`` or ``unanswered``; ``duplicate`` if its identifier is taken; ``cycle`` if it waits
for itself or for such a call (it keeps its own turn). A result is ``linked``, ``repeated`` (not the first, or
without a turn) or ``orphan``. A NULL identifier or conversation links with nothing, and references from there are not
looked up. A call without a turn owns no identifier: it is a ``duplicate`` if another call does, else ``unanswered``.
References to unknown calls are a problem of the call, not of the order. NULL text is an empty one, a NULL position 0.
Repeated rows are repeated. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import json
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import map_arrow, stored, table

KINDS = {"string": str, "object": dict, "array": list, "boolean": bool, "null": type(None)}


def canonical(value) -> str:
    """JSON with sorted keys and no blanks; whole numbers without a fraction; no NaN or infinity."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{canonical(str(k))}:{canonical(v)}" for k, v in sorted(value.items())) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("number out of range")
        if value.is_integer() and abs(value) < 2 ** 53:
            value = int(value)
    return json.dumps(value, ensure_ascii=False)


def problems(value, schema: dict, at: str = "$") -> list[str]:
    """What is wrong with a value under a schema (type, enum, minimum, maximum, minLength, maxLength, required,
    properties, additionalProperties, items). A reference stands for any value."""
    if isinstance(value, dict) and set(value) == {"$ref"}:
        return []
    kind, found = schema.get("type"), []
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    fits = (kind is None or (kind == "number" and number)
            or (kind == "integer" and number and float(value).is_integer())
            or (kind in KINDS and isinstance(value, KINDS[kind])))
    if not fits:
        return [f"{at}: not of type {kind}"]
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not one of the values")
    if number and not schema.get("minimum", -math.inf) <= value <= schema.get("maximum", math.inf):
        found.append(f"{at}: out of range")
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get(
            "maxLength", math.inf):
        found.append(f"{at}: length")
    if isinstance(value, dict):
        own = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in own:
                found += problems(value[k], own[k], f"{at}.{k}")
            elif not schema.get("additionalProperties", True):
                found.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for k, v in enumerate(value):
            found += problems(v, schema["items"], f"{at}[{k}]")
    return found


def references(value) -> list[str]:
    """Identifiers that a value refers to."""
    if isinstance(value, dict):
        if set(value) == {"$ref"} and isinstance(value["$ref"], str):
            return [value["$ref"]]
        value = list(value.values())
    return [r for v in value for r in references(v)] if isinstance(value, list) else []


def checked_call(name: str | None, arguments: str | None, schemas: dict) -> tuple[str, list, list]:
    """Canonical arguments, references and problems of one call."""
    def pairs(items):
        if len({k for k, _ in items}) < len(items):
            raise ValueError("repeated key")
        return dict(items)

    try:
        value = json.loads(arguments or "", object_pairs_hook=pairs)
        text = canonical(value)
        refs = sorted(set(references(value)))
    except (ValueError, RecursionError) as error:
        return "null", [], [f"$: no JSON ({type(error).__name__})"]
    if name not in schemas:
        return text, refs, ["$: unknown tool"]
    return text, refs, problems(value, schemas[name])


def checked(calls: DataFrame, schemas: dict) -> DataFrame:
    """Calls with canonical arguments, references and problems."""
    def run(batches):
        for batch in batches:
            rows = [checked_call(n, a, schemas) for n, a in zip(
                batch.column("name").to_pylist(), batch.column("arguments").to_pylist())]
            texts = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("conv_id", "turn", "pos", "call_id", "name")],
                 pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], texts),
                 pa.array([r[2] for r in rows], texts)],
                names=["conv_id", "turn", "pos", "call_id", "name", "arguments", "refs", "problems"])

    plain = calls.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
                         F.coalesce(F.col("pos").cast("int"), F.lit(0)).alias("pos"), F.col("call_id").cast("string"),
                         F.col("name").cast("string"), F.col("arguments").cast("string"))
    return map_arrow(plain, run, "conv_id bigint, turn bigint, pos int, call_id string, name string, "
                                 "arguments string, refs array<string>, problems array<string>")


def settled(owners: DataFrame) -> DataFrame:
    """``conv_id, call_id, anchor, step`` of each owning call (``turn``, ``refs``) that waits for no cycle.

    A call's place is the greatest of (own turn, 0) and (anchor, step + links) of what it waits for. Each round
    replaces a wait for a call by that call's only wait, drops waits for settled calls, and keeps the greatest place met.
    A wait over as many links as a conversation has calls runs in a circle.
    """
    key = ["conv_id", "call_id"]
    waits = (owners.select("conv_id", "call_id", F.explode("refs").alias("ref"))
             .join(owners.select("conv_id", F.col("call_id").alias("ref")), ["conv_id", "ref"], "left_semi")
             .groupBy(*key).agg(F.collect_list(F.struct("ref", F.lit(1).cast("bigint").alias("links"))).alias("waits")))
    none = F.array().cast("array<struct<ref:string,links:bigint>>")
    state = stored(owners.join(waits, key, "left").select(
        *key, F.struct(F.col("turn").alias("anchor"), F.lit(0).cast("bigint").alias("step")).alias("place"),
        F.coalesce("waits", none).alias("waits"), F.lit(False).alias("circle"), F.lit(True).alias("moved")), "order")
    most = owners.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    waiting = (F.size("waits") > 0) & ~F.col("circle")
    while state.agg(F.max(waiting) & F.max("moved")).first()[0]:
        target = state.select("conv_id", F.col("call_id").alias("ref"), F.col("place").alias("t_place"),
                              F.col("waits").alias("t_waits"), F.col("circle").alias("t_circle"))
        links, onward = F.col("wait.links"), F.col("t_waits")
        only = F.size(F.array_distinct(F.transform(onward, lambda w: w["ref"]))) == 1
        skipped = F.struct(onward[0]["ref"].alias("ref"), (links + F.array_max(
            F.transform(onward, lambda w: w["links"]))).alias("links"))
        met = (state.filter(waiting).select(*key, "place", F.explode("waits").alias("wait"))
               .withColumn("ref", F.col("wait.ref")).join(target, ["conv_id", "ref"])
               .select(*key, "place", F.struct(F.col("t_place.anchor").alias("anchor"), (
                   F.col("t_place.step") + links).alias("step")).alias("behind"),
                   F.when(only, skipped).when(F.size(onward) > 0, F.col("wait")).alias("wait"),
                   (only | (F.size(onward) == 0) | F.col("t_circle")).alias("moved"), "t_circle"))
        next_state = met.groupBy(*key).agg(
            F.greatest(F.max("place"), F.max("behind")).alias("place"), F.collect_list("wait").alias("waits"),
            (F.max("t_circle") | F.coalesce(F.max(F.col("wait.links")) >= most, F.lit(False))).alias("circle"),
            F.max("moved").alias("moved"))
        state = stored(next_state.unionByName(state.filter(~waiting).withColumn("moved", F.lit(False))), "order")
    return state.filter((F.size("waits") == 0) & ~F.col("circle")).select(
        *key, "place.anchor", F.col("place.step").cast("int").alias("step"))


FORMATTED = ("conv_id bigint, anchor bigint, step int, kind int, turn bigint, pos int, call_id string, "
             "status string, problems array<string>, json string")


def formatted(messages: DataFrame, calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """One row per message (kind 0), call (1) and result (2), to be read in the order of ``anchor, step, kind,
    turn, pos``, with its canonical JSON.

    messages: conv_id, turn, role, text. calls: conv_id, turn, pos, call_id, name, arguments. results: conv_id, turn,
    call_id, content.
    """
    key = ["conv_id", "call_id"]
    known = stored(checked(calls, schemas), "calls")
    results = results.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
                             F.col("call_id").cast("string"), F.col("content").cast("string"))
    first = known.filter("conv_id is not null and call_id is not null and turn is not null").groupBy(*key).agg(
        F.min(F.struct("turn", "pos", "name", "refs")).alias("first"))
    owners = stored(first.select(*key, "first.turn", "first.pos", "first.refs"), "owners")
    order = stored(owners.select(*key, F.col("turn").alias("own"), F.col("pos").alias("own_pos"))
                   .join(settled(owners), key, "left"), "order")
    answers = results.filter("call_id is not null").groupBy(*key).agg(F.min("turn").alias("answered"))

    owned = (F.col("own") == F.col("turn")) & (F.col("own_pos") == F.col("pos"))
    status = (F.when(~F.coalesce(owned, F.lit(False)),
                     F.when(F.col("own").isNull(), "unanswered").otherwise("duplicate"))
              .when(F.col("anchor").isNull(), "cycle")
              .when(F.col("answered").isNull(), "unanswered").otherwise("linked"))
    place = [*key, "turn", "pos", "refs"]
    refs = known.select(*place, F.explode("refs").alias("ref")).join(
        owners.select("conv_id", F.col("call_id").alias("ref")), ["conv_id", "ref"], "left_anti")
    unknown = refs.groupBy(*place).agg(
        F.array_sort(F.collect_set(F.concat(F.lit("$: unknown reference "), "ref"))).alias("unknown"))
    call_rows = (known.join(order, key, "left").join(answers, key, "left")
                 .join(unknown, place, "left")
                 .select("conv_id",
                         F.when(owned, F.coalesce("anchor", "turn")).otherwise(F.col("turn")).alias("anchor"),
                         F.when(owned, F.coalesce("step", F.lit(0))).otherwise(0).alias("step"),
                         F.lit(1).alias("kind"), "turn", "pos", "call_id", status.alias("status"),
                         F.concat("problems", F.coalesce("unknown", F.array().cast("array<string>")))
                         .alias("problems"),
                         F.struct(F.col("name").alias("a"), F.col("arguments").alias("b")).alias("body")))
    none = F.array().cast("array<string>")
    result_rows = (results.join(order, key, "left").join(answers, key, "left")
                   .select("conv_id", F.coalesce("anchor", "own", "turn").alias("anchor"),
                           F.coalesce("step", F.lit(0)).alias("step"), F.lit(2).alias("kind"), "turn",
                           F.lit(0).alias("pos"), "call_id",
                           F.when(F.col("own").isNull(), "orphan")
                           .when(F.col("turn") == F.col("answered"), "linked").otherwise("repeated")
                           .alias("status"), none.alias("problems"),
                           F.struct(F.lit(None).cast("string").alias("a"), F.col("content").alias("b"))
                           .alias("body")))
    message_rows = messages.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint").alias("anchor"), F.lit(0).alias("step"),
        F.lit(0).alias("kind"), F.col("turn").cast("bigint"), F.lit(0).alias("pos"),
        F.lit(None).cast("string").alias("call_id"), F.lit("message").alias("status"), none.alias("problems"),
        F.struct(F.col("role").cast("string").alias("a"), F.col("text").cast("string").alias("b")).alias("body"))

    def write(batches):
        for batch in batches:
            kinds, ids, bodies = (batch.column(c).to_pylist() for c in ("kind", "call_id", "body"))
            made = []
            for kind, call_id, body in zip(kinds, ids, bodies):
                head, text = body["a"], body["b"]
                if kind == 1:  # the arguments are canonical already
                    made.append(f'{{"arguments":{text},"id":{canonical(call_id)},"name":{canonical(head)},'
                                '"role":"assistant"}')
                else:
                    made.append(canonical({"role": head, "content": text or ""} if kind == 0 else
                                          {"role": "tool", "content": text or "", "tool_call_id": call_id}))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in batch.schema.names if c != "body"], pa.array(made, pa.string())],
                names=[*[c for c in batch.schema.names if c != "body"], "json"])

    return map_arrow(message_rows.union(call_rows).union(result_rows), write, FORMATTED)


# ---------------------------------------------------------------- query

TOOLS = {
    "search": {"type": "object", "required": ["query"], "additionalProperties": False, "properties": {
        "query": {"type": "string", "minLength": 2},
        "limit": {"type": "integer", "minimum": 1, "maximum": 800}, "use": {"type": "object"}}},
    "count": {"type": "object", "required": ["limit"], "properties": {
        "limit": {"type": "integer", "minimum": 1}, "query": {"type": "string"}}},
}


def derived(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Messages, calls and results from plain conversations, which hold no calls of their own.

    An assistant's turn makes a call that carries its whole text (tool and references follow from the text's
    length); what follows a turn is the result for it; all other rows are messages, also those without role or turn.
    """
    text, turn = F.coalesce("text", F.lit("")), F.col("turn")
    size = F.length(text)
    assistant = F.col("role") == "assistant"
    ref = F.struct(F.concat(F.lit("c"), F.when(size % 5 == 0, turn + 2).when(size % 5 < 3, turn - 2))
                   .alias("$ref"))
    use = F.when(size % 5 < 3, ref)
    name = F.when(size % 7 == 0, "other").when(size % 2 == 0, "count").otherwise("search")
    is_call = F.coalesce(assistant & turn.isNotNull(), F.lit(False))
    is_result = F.coalesce(~assistant & (turn > 0), F.lit(False))
    calls = conversations.filter(is_call).select(
        "conv_id", "turn", F.lit(0).alias("pos"), F.concat(F.lit("c"), turn).alias("call_id"),
        name.alias("name"), F.to_json(F.struct(
            use.alias("use"), text.alias("query"), size.alias("limit"))).alias("arguments"))
    results = conversations.filter(is_result).select(
        "conv_id", "turn", F.concat(F.lit("c"), turn - 1).alias("call_id"), text.alias("content"))
    messages = conversations.filter(~is_call & ~is_result).select("conv_id", "turn", "role", "text")
    return messages, calls, results


def op1_tool_call_linking(spark, sf_dir) -> DataFrame:
    return formatted(*derived(table(spark, sf_dir, "conversations")), TOOLS).select(
        "conv_id", "anchor", "step", "kind", "turn", "call_id", "status",
        F.array_join("problems", ";").alias("problems"), "json")


SQL = r"""
with recursive rows as (select conv_id, turn, role, coalesce(text, '') as text, len(coalesce(text, '')) as size,
    coalesce(role = 'assistant' and turn is not null, false) as is_call,
    coalesce(role <> 'assistant' and turn > 0, false) as is_result from conversations),
calls as (select *, case when size % 7 = 0 then 'other' when size % 2 = 0 then 'count' else 'search' end as name,
    case when size % 5 = 0 then turn + 2 when size % 5 < 3 then turn - 2 end as ref from rows where is_call),
owners as (select conv_id, turn, min({'name': name, 'refs': case when ref is null then [] else ['c' || ref] end,
    'ref': ref}).ref as ref from calls where conv_id is not null group by conv_id, turn),
edges as (select o.conv_id, o.turn, d.turn as ref from owners o
    left join owners d on d.conv_id = o.conv_id and d.turn = o.ref),
reach as (select conv_id, turn as start, turn, ref from edges
    union select r.conv_id, r.start, e.turn, e.ref from reach r
    join edges e on e.conv_id = r.conv_id and e.turn = r.ref),
placed as (select conv_id, start, count(*) as depth, not bool_or(ref is null) as cycle, max(turn) as far
    from reach group by all),
answered as (select distinct conv_id, turn - 1 as call from rows where is_result),
spots as (select p.conv_id, p.start as turn, p.cycle, case when p.cycle then p.start else p.far end as anchor,
    case when p.cycle then 0 else p.depth - f.depth end as step
  from placed p join placed f on f.conv_id = p.conv_id and f.start = p.far),
call_rows as (select c.conv_id, coalesce(s.anchor, c.turn) as anchor, coalesce(s.step, 0) as step, 1 as kind, c.turn,
    'c' || c.turn as call_id, case when s.cycle then 'cycle' when a.call is null then 'unanswered' else 'linked' end
    as status,
    concat_ws(';', case when name = 'other' then '$: unknown tool'
        when size < 1 or (name = 'search' and size > 800) then '$.limit: out of range' end,
      case when name = 'search' and size < 2 then '$.query: length' end,
      case when c.ref is not null and c.conv_id is not null and o.turn is null
        then '$: unknown reference c' || c.ref end) as problems,
    '{"arguments":{"limit":' || size || ',"query":' || cast(to_json(text) as varchar)
      || case when c.ref is null then '' else ',"use":{"$ref":"c' || c.ref || '"}' end
      || '},"id":"c' || c.turn || '","name":"' || name || '","role":"assistant"}' as json
  from calls c left join spots s on s.conv_id = c.conv_id and s.turn = c.turn
  left join owners o on o.conv_id = c.conv_id and o.turn = c.ref
  left join answered a on a.conv_id = c.conv_id and a.call = c.turn),
result_rows as (select r.conv_id, coalesce(s.anchor, r.turn) as anchor, coalesce(s.step, 0) as step, 2 as kind,
    r.turn, 'c' || (r.turn - 1) as call_id, case when s.turn is null then 'orphan' else 'linked' end as status,
    '' as problems, '{"content":' || cast(to_json(text) as varchar) || ',"role":"tool","tool_call_id":"c'
      || (r.turn - 1) || '"}' as json
  from rows r left join spots s on s.conv_id = r.conv_id and s.turn = r.turn - 1 where r.is_result)
select conv_id, turn as anchor, 0 as step, 0 as kind, turn, null as call_id, 'message' as status, '' as problems,
  '{"content":' || cast(to_json(text) as varchar) || ',"role":' || coalesce(cast(to_json(role) as varchar), 'null')
    || '}' as json
from rows where not is_call and not is_result
union all select conv_id, anchor, cast(step as int), kind, turn, call_id, status, problems, json from call_rows
union all select conv_id, anchor, cast(step as int), kind, turn, call_id, status, problems, json from result_rows
"""
