"""Tool-call linking for chat formatting.

Calls and results meet by conversation and identifier in one hash join, which
names the calls without a result and the results without a call. Arguments are validated
against the tools' schemas. Calls of a turn are ordered topologically by the
calls of their conversation whose results they refer to: in rounds over all
conversations at once, every call whose references all have a level gets the
level above them; calls in a cycle, or referring to no call of their own or an
earlier turn, get none and are reported. Messages are serialised as canonical JSON (sorted keys, no
blanks). Nothing is grouped by conversation, so a long one is no heavier than
many short ones.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.common import slices, table, written

#: Tools by name: fields with their type, whether required, and the bounds of the value (length for strings).
SCHEMAS = {
    "search": {"query": ("string", True, 1, 120), "limit": ("integer", True, 1, 20), "after": ("reference", False, None, None)},
    "lookup": {"key": ("string", True, 1, 60), "after": ("reference", False, None, None)},
    "note": {"body": ("string", True, 1, 400), "urgent": ("boolean", False, None, None), "after": ("reference", False, None, None)},
}


def canonical(value) -> str:
    """JSON with sorted keys and without blanks; equal values give equal bytes."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def _refuse(constant: str):
    raise ValueError(f"{constant} is not JSON")


def violations(name: str | None, arguments, schemas: dict = SCHEMAS) -> list[str]:
    """What is wrong with parsed arguments, sorted; empty if they fit the tool's schema."""
    if name not in schemas:
        return ["unknown tool"]
    if not isinstance(arguments, dict):
        return ["arguments are not an object"]
    fields, wrong = schemas[name], [f"unknown field {k}" for k in arguments if k not in schemas[name]]
    for field, (kind, required, low, high) in fields.items():
        if field not in arguments:
            wrong += [f"missing field {field}"] if required else []
            continue
        value = arguments[field]
        fits = {"string": isinstance(value, str), "boolean": isinstance(value, bool),
                "integer": isinstance(value, int) and not isinstance(value, bool),
                "reference": isinstance(value, dict) and isinstance(value.get("$result"), str)}[kind]
        if not fits:
            wrong.append(f"{field} is not a {kind}")
        elif low is not None and not low <= (len(value) if kind == "string" else value) <= high:
            wrong.append(f"{field} is out of bounds")
    return sorted(wrong)


def references(value) -> list[str]:
    """Identifiers of the results that arguments refer to, at any depth."""
    found, stack = set(), [value]
    while stack:
        v = stack.pop()
        if isinstance(v, dict):
            if isinstance(v.get("$result"), str):
                found.add(v["$result"])
            stack.extend(v.values())
        elif isinstance(v, list):
            stack.extend(v)
    return sorted(found)


def scoped(identifier: str, conv: str = "conv_id") -> Column:
    """A conversation and an identifier as one text (a NULL conversation is one of its own)."""
    conv = F.col(conv).cast("string")
    return F.concat(F.coalesce(F.concat(F.length(conv).cast("string"), F.lit(":"), conv), F.lit("-:")), F.col(identifier))


def validated(calls: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """``calls`` with parsed arguments: errors, canonical arguments, and references. Arguments that are no JSON,
    hold half of a surrogate pair, or nest deeper than the parser reads have no canonical form (NULL)."""
    extra = "errors array<string>, canonical_arguments string, refers array<string>"

    def run(batches):
        for b in slices(batches):
            errors, texts, refers = [], [], []
            for name, raw in zip(b.column("name").to_pylist(), b.column("arguments").to_pylist()):
                try:
                    value = json.loads(raw or "null", parse_constant=_refuse)
                    text = canonical(value)
                    text.encode()                       # a lone surrogate is no text
                    found = text, violations(name, value, schemas), references(value)
                except (ValueError, RecursionError):
                    found = None, ["arguments are not JSON"], []
                for into, x in zip((texts, errors, refers), found):
                    into.append(x)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(errors, pa.list_(pa.string())), pa.array(texts, pa.string()),
                 pa.array(refers, pa.list_(pa.string()))], [*b.schema.names, "errors", "canonical_arguments", "refers"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in calls.schema)
    return calls.mapInArrow(run, f"{kinds}, {extra}")


def levels(calls: DataFrame) -> DataFrame:
    """(key, level) of calls (key, conv_id, turn, refers): 0 for calls that wait for none of their
    turn, else one above the highest call of the same turn that they refer to. Calls in a cycle or
    behind one, and calls that refer to a later turn or to nothing of their conversation, are left out."""
    edges = calls.select("key", "conv_id", "turn", F.explode("refers").alias("ref")).withColumn("needs", scoped("ref"))
    known = calls.select(F.col("key").alias("needs"), F.col("turn").alias("t2"))
    edges = written(edges.join(known, "needs", "left").select(
        "key", "needs", F.expr("coalesce(t2 < turn, false)").alias("done"), F.expr("coalesce(t2 = turn, false)").alias("same")).distinct(),
        "references")
    state = calls.select("key").join(
        edges.where("NOT done").groupBy("key").agg(F.count("*").alias("open")), "key", "left")
    done = written(state.where("open IS NULL").select("key", F.lit(0).alias("level")), "levels")
    waiting = edges.where("NOT done")
    depth = 0
    while True:
        ready = waiting.join(done.select(F.col("key").alias("needs"), "level"), "needs", "left")
        ready = (ready.groupBy("key").agg(F.count("*").alias("n"), F.count(F.when(F.col("same"), F.col("level"))).alias("met"),
                                          F.max("level").alias("level"))
                 .where("n = met").select("key", (F.col("level") + 1).alias("level"))
                 .join(done, "key", "left_anti"))
        ready = written(ready, "levels")
        if not ready.limit(1).count():
            return done
        done = done.union(ready)
        depth += 1
        if depth % 8 == 0:
            done = written(done, "levels")


def link(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """One row per call and per result without a call.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text); ``results``:
    conv_id, call_id, content. An identifier names a call within its conversation
    only; results without a conv_id column answer that identifier in every
    conversation. Columns returned: conv_id, turn, call_id, level, position
    (in its turn: by level, then identifier; NULL without a level), status
    (answered, unanswered, invalid, unordered or orphan), errors, message (the
    call and its result as canonical JSON). Repeated calls with one identifier in
    one conversation become the one with the least turn and arguments, repeated
    results the least content; rows without an identifier are dropped; a NULL
    conv_id is a conversation of its own; NULL contents count as empty results;
    other columns are ignored, empty tables give no rows.
    """
    calls = calls.where("call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "name", "arguments")).alias("c")).select("conv_id", "call_id", "c.*")
    calls = written(validated(calls.withColumn("key", scoped("call_id")), schemas), "calls")
    results = results.where("call_id IS NOT NULL")
    if "conv_id" in results.columns:
        results = results.select("conv_id", "call_id", "content")
    else:       # identifiers of all conversations that have them, or of none
        where = calls.select("conv_id", F.col("call_id").alias("of")).withColumn("has", F.lit(True))
        results = results.join(where, F.col("call_id") == F.col("of"), "left").select(
            F.when(F.col("has"), F.col("conv_id")).alias("conv_id"), "call_id", "content")
    results = results.groupBy(scoped("call_id").alias("key")).agg(
        F.first("conv_id").alias("r_conv"), F.first("call_id").alias("r_call"), F.coalesce(F.min("content"), F.lit("")).alias("content"))
    both = calls.join(results.withColumn("answer", F.lit(True)), "key", "full").join(levels(calls), "key", "left")
    both = both.withColumn("conv_id", F.when(F.col("call_id").isNull(), F.col("r_conv")).otherwise(F.col("conv_id"))).withColumn(
        "call_id", F.coalesce("call_id", "r_call"))
    status = F.expr("CASE WHEN errors IS NULL THEN 'orphan' WHEN size(errors) > 0 THEN 'invalid' WHEN level IS NULL THEN "
                    "'unordered' WHEN answer IS NULL THEN 'unanswered' ELSE 'answered' END")
    place = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("level", "call_id"))
    rows = both.withColumn("status", status)
    placed = rows.where("level IS NOT NULL").withColumn("position", place.cast("long"))
    rows = placed.unionByName(rows.where("level IS NULL").withColumn("position", F.lit(None).cast("long")))

    def run(batches):
        for b in slices(batches):
            lines = []
            for r in b.select(["call_id", "name", "canonical_arguments", "content", "status"]).to_pylist():
                message = {"call_id": r["call_id"], "status": r["status"]}
                if r["status"] != "orphan":
                    args = r["canonical_arguments"]
                    message["call"] = {"name": r["name"], "arguments": None if args is None else json.loads(args)}
                if r["content"] is not None:
                    message["result"] = {"role": "tool", "content": r["content"]}
                lines.append(canonical(message))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in kept), pa.array(lines, pa.string())], [*kept, "message"])

    kept = ["conv_id", "turn", "call_id", "level", "position", "status", "errors"]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept) + ", message string"
    return rows.select(*kept, "name", "canonical_arguments", "content").mapInArrow(run, schema)


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that a table of plain turns gives: every line of a turn that is
    not the assistant's is a call, every line of the turn after it the result of the call
    with its number. Identifiers hold turn and line, so they recur in other conversations.
    The line's length picks tool, arguments and what it refers to: from the second line of a
    turn on, odd lengths the line with half the number; multiples of 17 the next line
    (a cycle where that one refers back), multiples of 19 the turn after the next."""
    turns = conversations.select("conv_id", "turn", "role", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("k", "line"))
    ident = lambda turn, k: F.concat_ws("-", F.lit("call"), turn, k)      # noqa: E731
    size, turn, k = F.length("line"), F.col("turn"), F.col("k")
    needs = F.when((size % 17 == 0) & (size > 0), ident(turn, k + 1)).when((size % 19 == 0) & (size > 0), ident(turn + 2, k)).when(
        (size % 2 == 1) & (k > 0), ident(turn, F.floor(k / 2)))
    after = F.when(needs.isNotNull(), F.struct(needs.alias("$result")))
    arguments = F.when(size % 3 == 0, F.to_json(F.struct(F.col("line").alias("query"), (size % 23).alias("limit"), after.alias("after")))).when(
        size % 3 == 1, F.to_json(F.struct(after.alias("after"), F.col("line").alias("key")))).otherwise(
        F.to_json(F.struct(F.when(size % 5 == 0, size % 2 == 0).alias("urgent"), F.col("line").alias("body"), after.alias("after"))))
    name = F.when(size % 3 == 0, "search").when(size % 3 == 1, "lookup").otherwise("note")
    calls = turns.where("coalesce(role, '') <> 'assistant'").select(
        "conv_id", "turn", ident(turn, k).alias("call_id"), name.alias("name"), arguments.alias("arguments"))
    results = turns.where("role = 'assistant'").select("conv_id", ident(turn - 1, k).alias("call_id"), F.col("line").alias("content"))
    return calls, results


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(*calls_of(table(spark, sf_dir, "conversations")))
