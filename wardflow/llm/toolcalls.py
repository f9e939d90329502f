"""Tool-call linking for chat transcripts.

Messages are rows (``conv_id, turn, role, text``). The text of an assistant's
call is JSON with ``tool_calls`` (``id``, ``name``, ``arguments``), that of a tool's
result JSON with ``tool_call_id`` and ``content``; an argument ``{"$result": id}``
uses the result of another call. Calls and results are hash-joined by
conversation and identifier, put in topological order by rounds (a call's step
is one more than the latest of the calls whose results it uses), validated
against the tools' schemas, and written as canonical JSON: keys in order, no
blanks. DataFrame functions only.

The result is one row per message or call, with the columns that order them
(``step, turn, part``), so no conversation is gathered in one place. Chains of
calls that use one result are shortened by pointer doubling, the rest goes in
rounds of joins; only whether any call moved reaches the driver.

Defined results: messages that aren't calls or results (broken JSON included)
are plain text; a call without result is ``unanswered``, one whose results are
several is answered by the first after it; a result without call is ``orphan``;
of calls with one id in a conversation the first counts and the others are
``repeated``; calls that wait for each other, or for an unknown call, are
``blocked`` and come after all others; null texts are empty; null conversation
ids never link; repeated rows are kept; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.scratch import stored

CALLS = "struct<tool_calls:array<struct<id:string,name:string,arguments:variant>>>"
RESULT = "struct<tool_call_id:string,content:variant>"
#: Steps of blocked calls.
BLOCKED = 1 << 60

#: Kinds of schema_of_variant for each schema type.
KINDS = {"string": r"^STRING$", "integer": r"^BIGINT$", "number": r"^(BIGINT|DOUBLE|DECIMAL.*)$",
         "boolean": r"^BOOLEAN$", "object": r"^OBJECT", "array": r"^ARRAY"}


def with_argument_errors(calls: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """``calls`` (``name, arguments``) with ``errors``: short texts on what is wrong with the arguments, none if valid.

    ``schemas``: tool -> parameter -> (type, required). A ``$result`` reference
    stands for a value of any type.
    """
    kept, arguments = calls.columns, F.col("arguments")
    parameters = sorted({p for tool in schemas.values() for p in tool})
    # What each parameter holds, found once for all tools.
    calls = calls.withColumns({"_is": F.schema_of_variant(arguments),
                               "_keys": F.map_keys(F.from_json(F.to_json(arguments), "map<string,string>")),
                               **{f"_v{i}": F.try_variant_get(arguments, f"$.{p}", "variant") for i, p in enumerate(parameters)}})
    calls = calls.select(*kept, "_is", "_keys", *[F.schema_of_variant(f"_v{i}").alias(f"_t{i}") for i in range(len(parameters))],
                         *[F.try_variant_get(F.col(f"_v{i}"), "$['$result']", "string").isNotNull().alias(f"_r{i}")
                           for i in range(len(parameters))])
    name = F.col("name")
    out = F.when(name.isNull() | ~name.isin(*schemas), F.array(F.lit("unknown tool")))
    out = out.when(arguments.isNull() | ~F.col("_is").startswith("OBJECT"), F.array(F.lit("arguments are no object")))
    for tool, own in schemas.items():
        found = []
        for parameter, (type_, required) in own.items():
            i = parameters.index(parameter)
            of = F.col(f"_t{i}")
            error = F.when(of.isNull() | (of == "VOID"), F.lit(f"missing {parameter}") if required else F.lit(None).cast("string"))
            found.append(error.when(~F.col(f"_r{i}") & ~of.rlike(KINDS[type_]), F.lit(f"{parameter} is no {type_}")))
        extra = F.transform(F.array_sort(F.array_except("_keys", F.array(*map(F.lit, own)))),
                            lambda key: F.concat(F.lit("unknown "), key))
        out = out.when(name == tool, F.concat(F.array_compact(F.array(*found)), extra))
    return calls.select(*kept, out.alias("errors"))


def references(arguments: Column) -> Column:
    """Ids of the calls whose results the arguments use."""
    values = F.map_values(F.from_json(F.to_json(arguments), "map<string,string>"))
    ids = F.transform(values, lambda v: F.get_json_object(v, "$['$result']"))
    return F.coalesce(F.array_distinct(F.array_compact(ids)), F.array().cast("array<string>"))


def _chains(single: DataFrame, targets: DataFrame) -> DataFrame:
    """``no, anchor, dist`` of the calls that use one result: the first call up their chain that uses none or several,
    and how far off it is. By pointer doubling, so in as many rounds as the logarithm of the longest chain; a round in
    which no pointer arrives has only cycles left."""
    to = targets.select("conv_id", F.col("call_id").alias("used"), F.col("no").alias("to"), (F.col("n_uses") != 1).alias("ends"))
    pointers = stored(single.join(to, ["conv_id", "used"]).select("no", "to", F.lit(1).cast("long").alias("dist"), "ends"),
                      "calls-pointers")
    waiting = pointers.filter("not ends").count()
    while waiting:
        onward = pointers.select(F.col("no").alias("to"), F.col("to").alias("to2"), F.col("dist").alias("dist2"),
                                 F.col("ends").alias("ends2"))
        moved = pointers.filter("not ends").join(onward, "to").select(
            "no", F.col("to2").alias("to"), (F.col("dist") + F.col("dist2")).alias("dist"), F.col("ends2").alias("ends"))
        pointers = stored(pointers.filter("ends").union(moved), "calls-pointers")
        before, waiting = waiting, pointers.filter("not ends").count()
        if waiting == before:
            break
    return pointers.filter("ends").select("no", F.col("to").alias("anchor"), "dist")


def _steps(calls: DataFrame) -> DataFrame:
    """``no, step`` of the calls (``no, conv_id, call_id, uses``); those that can't be ordered are left out.

    Chains of calls that use one result are shortened first. Then calls that use
    several go on in rounds, each in the round in which it has seen all it asked
    for (``met``: how many it has seen, and the latest step), so rounds are as
    many as such calls build on one another.
    """
    calls = stored(calls.select("no", "conv_id", "call_id", "uses", F.size("uses").alias("n_uses")), "calls-all")
    targets = calls.select("no", "conv_id", "call_id", "n_uses")
    chains = stored(_chains(calls.filter("n_uses = 1").select("no", "conv_id", F.col("uses")[0].alias("used")), targets),
                    "calls-chains")
    latest = calls.filter("n_uses = 0").select("no", F.lit(0).cast("long").alias("step"))
    ordered = [latest]
    asks = calls.filter("n_uses > 1").select(F.col("no").alias("by"), "conv_id", F.col("n_uses").alias("asked"),
                                             F.explode("uses").alias("call_id")).join(targets, ["conv_id", "call_id"])
    asks = asks.join(chains, "no", "left").filter("n_uses <> 1 or anchor is not null")
    waits = stored(asks.select("by", "asked", F.coalesce("anchor", "no").alias("no"), F.coalesce("dist", F.lit(0)).alias("dist")),
                   "calls-waits")
    met = None
    while not waits.isEmpty() and not latest.isEmpty():
        seen = waits.join(latest, "no").select("by", "asked", F.lit(1).alias("n"), F.lit(1).alias("new"),
                                               (F.col("step") + F.col("dist")).alias("step"))
        if met is not None:
            seen = seen.unionByName(met.withColumn("new", F.lit(0)))
        met = stored(seen.groupBy("by", "asked").agg(F.sum("n").cast("int").alias("n"), F.sum("new").cast("int").alias("new"),
                                                     F.max("step").alias("step")), "calls-met")
        latest = met.filter("n = asked and new > 0").select(F.col("by").alias("no"), (F.col("step") + 1).alias("step"))
    if met is not None:
        ordered.append(met.filter("n = asked").select(F.col("by").alias("no"), (F.col("step") + 1).alias("step")))
    known = ordered[0] if len(ordered) == 1 else ordered[0].union(ordered[1])
    along = chains.join(known.select(F.col("no").alias("anchor"), "step"), "anchor").select(
        "no", (F.col("step") + F.col("dist")).alias("step"))
    return known.union(along)


def link_tool_calls(messages: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]], conv_id: str = "conv_id",
                    turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, step, turn, part, kind, call_id, status, errors, json``, one row per plain message, call or result."""
    rows = messages.select(F.monotonically_increasing_id().alias("row"), F.col(conv_id).alias("conv_id"),
                           F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"),
                           F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = stored(rows, "chat-rows")
    is_call = (F.col("role") == "assistant") & F.col("text").startswith("{")
    is_result = (F.col("role") == "tool") & F.col("text").startswith("{")
    parsed = rows.withColumns({"c": F.when(is_call, F.from_json("text", CALLS)["tool_calls"]),
                               "r": F.when(is_result, F.from_json("text", RESULT))})
    parsed = parsed.withColumn("kind", F.when(F.size("c") > 0, "call").when(
        F.col("r")["tool_call_id"].isNotNull(), "result").otherwise("text"))

    calls = parsed.filter("kind = 'call'").select("row", "conv_id", "turn", F.posexplode("c").alias("part", "c"))
    calls = calls.select("row", "conv_id", "turn", "part", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"),
                         F.col("c.arguments").alias("arguments"), references(F.col("c.arguments")).alias("uses"))
    calls = with_argument_errors(calls, schemas).withColumns({"arguments": F.to_json("arguments"),
                                                              "no": F.xxhash64("row", "part")})
    calls = stored(calls, "chat-calls")
    first = calls.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "row", "part")).alias("first"))
    own = (F.col("first.row") == F.col("row")) & (F.col("first.part") == F.col("part"))
    calls = calls.join(first, ["conv_id", "call_id"], "left").withColumn("counts", F.coalesce(own, F.lit(False)))
    calls = stored(calls.drop("first"), "chat-marked")

    results = parsed.filter("kind = 'result'").select(
        "row", "conv_id", "turn", F.col("r.tool_call_id").alias("call_id"), F.to_json("r.content").alias("content"))
    results = stored(results, "chat-results")
    linked = calls.filter("counts").select("conv_id", "call_id", F.col("turn").alias("asked"), "no", "name")
    linked = results.join(linked.hint("shuffle_hash"), ["conv_id", "call_id"], "left")
    linked = stored(linked.withColumn("fits", F.col("no").isNotNull() & (F.col("turn") >= F.col("asked"))), "chat-linked")
    answer = linked.filter("fits").groupBy("no").agg(F.min(F.struct("turn", "row")).alias("a")).select(
        "no", F.col("a.row").alias("answer"))

    steps = stored(_steps(calls.filter("counts and call_id is not null")), "chat-steps")
    counts = F.col("counts") & F.col("call_id").isNotNull()
    done = (calls.join(answer, "no", "left").join(steps, "no", "left")
            .withColumn("step", F.when(counts, F.coalesce("step", F.lit(BLOCKED))).otherwise(F.lit(BLOCKED))))
    call_rows = done.select(
        "conv_id", "step", "turn", F.col("part").cast("long").alias("part"), F.lit("call").alias("kind"), "call_id",
        F.when(~F.col("counts"), "repeated").when(F.col("step") == BLOCKED, "blocked")
        .when(F.col("answer").isNull(), "unanswered").otherwise("linked").alias("status"), "errors",
        _message(role=F.lit("assistant"), call_id=F.col("call_id"), name=F.col("name"), raw=("arguments", F.col("arguments"))))
    of = done.select("no", "step", "answer")
    result_rows = linked.join(of, "no", "left").select(
        "conv_id", F.coalesce("step", F.lit(BLOCKED)).alias("step"), "turn", F.lit(0).cast("long").alias("part"),
        F.lit("result").alias("kind"), "call_id",
        F.when(~F.col("fits"), "orphan").when(F.col("answer") == F.col("row"), "linked").otherwise("repeated").alias("status"),
        F.array().cast("array<string>").alias("errors"),
        _message(role=F.lit("tool"), call_id=F.col("call_id"), name=F.col("name"), raw=("content", F.col("content"))))
    plain = parsed.filter("kind = 'text'").select(
        "conv_id", F.lit(0).cast("long").alias("step"), "turn", F.lit(0).cast("long").alias("part"), "kind",
        F.lit(None).cast("string").alias("call_id"), F.lit("text").alias("status"),
        F.array().cast("array<string>").alias("errors"),
        F.concat(F.lit('{"content":'), _quoted(F.col("text")), F.lit(',"role":'), _quoted(F.col("role")), F.lit("}")).alias("json"))
    return call_rows.unionByName(result_rows).unionByName(plain)


def _quoted(value: Column) -> Column:
    """A JSON string, or null."""
    text = F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
    return F.when(value.isNull(), F.lit("null")).otherwise(text)


def _message(role: Column, call_id: Column, name: Column, raw: tuple[str, Column]) -> Column:
    """Canonical JSON of a call or result; ``raw`` is a field whose value is JSON already."""
    fields = {"call_id": _quoted(call_id), "name": _quoted(name), "role": _quoted(role),
              raw[0]: F.coalesce(raw[1], F.lit("null"))}
    parts = []
    for k, key in enumerate(sorted(fields)):
        parts += [F.lit(("{" if not k else ",") + f'"{key}":'), fields[key]]
    return F.concat(*parts, F.lit("}")).alias("json")
