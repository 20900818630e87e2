"""Tool-call linking for chat data (operator 3).

Calls and their results are hash-joined by conversation and identifier, calls are
put in topological order of what they depend on, arguments are validated against
the tool's schema, and each linked call is serialised as canonical JSON: keys
sorted, no blanks, one line.  Everything is DataFrame expressions.

Order is a level: 0 for a call that waits for none, else one more than the
highest level it waits for.  Where no call waits for more than one, levels come
from pointer doubling, in a logarithm of the longest chain's rounds; else from
rounds that resolve one level each.  Calls on a cycle, or behind one, have no level.

Defined results: a call without a result is ``unanswered``, a result without a
call is ``orphan`` (its call's columns are null), of several results for one call
the one of the least turn, then content, counts and ``n_results`` tells how many.
Repeated calls of one identifier count once (the one of the least turn).  Calls and results
with a null conversation or call identifier link with nothing and are left out of
the result.  Dependencies on missing calls are errors but not
waited for.  Null arguments are no JSON object.  Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import scratch
from tidemark.llm.tables import table


@dataclass(frozen=True)
class Property:
    """One property of a tool's arguments: a JSON type and its limits."""

    kind: str
    required: bool = False
    least: float | None = None
    most: float | None = None
    options: tuple = ()


@dataclass(frozen=True)
class Tool:
    properties: dict[str, Property] = field(default_factory=dict)
    others_allowed: bool = False


#: JSON types and how their values are called by ``schema_of_variant``.
KINDS = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN", "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*", "object": "OBJECT.*", "array": "ARRAY.*", "null": "VOID"}


def parsed(text: Column) -> Column:
    """The JSON value of a text as a variant; null if the text is anything but one value.

    The parser stops after a first value; a text that is also a sole array element
    and a sole object member has nothing behind it.
    """
    alone = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull() & F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
    return F.when(alone, F.try_parse_json(text))


def argument_errors(name: Column, text: Column, value: Column, tools: dict[str, Tool]) -> Column:
    """An array of messages, empty for valid arguments; ``value`` is the parsed text."""
    none = F.array().cast("array<string>")
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    out = F.array(F.concat(F.lit("unknown tool: "), F.coalesce(name, F.lit("null"))))
    for tool, spec in tools.items():
        checks = []
        for key, p in spec.properties.items():
            v = F.try_variant_get(value, "$['" + key.replace("'", "\\'") + "']", "variant")
            kind = F.schema_of_variant(v)
            fits = kind.rlike("^(" + KINDS[p.kind] + ")$")
            tests = [F.when(kind.isNull(), F.lit(f"{key}: missing") if p.required else F.lit(None).cast("string"))]
            wrong = F.when(kind.isNotNull() & ~fits, F.lit(f"{key}: not of type {p.kind}"))
            if p.kind in ("integer", "number"):
                size = F.try_variant_get(value, "$['" + key + "']", "double")
            elif p.kind == "string":
                size = F.char_length(F.try_variant_get(value, "$['" + key + "']", "string")).cast("double")
            else:
                size = F.lit(None).cast("double")
            tests.append(wrong)
            if p.least is not None:
                tests.append(F.when(fits & (size < p.least), F.lit(f"{key}: below {p.least:g}")))
            if p.most is not None:
                tests.append(F.when(fits & (size > p.most), F.lit(f"{key}: above {p.most:g}")))
            if p.options:
                tests.append(F.when(fits & ~F.coalesce(F.try_variant_get(value, "$['" + key + "']", "string").isin(*map(str, p.options)), F.lit(False)), F.lit(f"{key}: not an option")))
            checks += tests
        if not spec.others_allowed:
            others = F.array_sort(F.array_except(F.coalesce(F.json_object_keys(text), none), F.array(*map(F.lit, spec.properties)).cast("array<string>")))
            checks.append(F.when(F.size(others) > 0, F.concat(F.lit("unknown: "), F.array_join(others, ","))))
        found = F.array_compact(F.array(*checks)) if checks else none
        out = F.when(name == tool, F.when(is_object, found).otherwise(F.array(F.lit("arguments: not a JSON object")))).otherwise(out)
    return out


def levels(edges: DataFrame, calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, level`` of all ``calls``; ``edges`` has ``conv_id, call_id, on``, with both ends among the calls."""
    spark = calls.sparkSession
    key = ["conv_id", "call_id"]
    edges = scratch.materialise(edges.distinct())
    # No limit of one row: a maximum aggregates on the map side.
    most = edges.groupBy(*key).count().agg(F.max("count")).first()[0] or 0
    if most <= 1:
        state = calls.join(edges, key, "left").select("conv_id", "call_id", F.col("on").alias("ptr"), F.when(F.col("on").isNull(), 0).otherwise(1).cast("long").alias("level"))
        path = scratch.write(state)
        waiting, rounds, n = most, 0, None
        while waiting:
            state = spark.read.parquet(path)
            n = state.count() if n is None else n
            ahead = state.select("conv_id", F.col("call_id").alias("ptr"), F.col("ptr").alias("next"), F.col("level").alias("more"))
            moved = state.join(ahead, ["conv_id", "ptr"], "left").select("conv_id", "call_id", F.col("next").alias("ptr"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level"))
            new = scratch.write(moved)
            scratch.drop(spark, path)
            path, rounds = new, rounds + 1
            waiting = spark.read.parquet(path).where("ptr is not null").limit(1).count()
            if 2**rounds > 2 * n:  # longer than any chain: what still points is behind a cycle
                break
        return spark.read.parquet(path).select(*key, F.when(F.col("ptr").isNull(), F.col("level")).alias("level"))
    done = scratch.materialise(calls.join(edges.select(*key).distinct(), key, "left_anti").select(*key, F.lit(0).cast("long").alias("level")))
    fresh, level = done, 0
    waits = edges.groupBy(*key).agg(F.count("*").alias("waits"))
    met = None
    while not fresh.isEmpty():
        level += 1
        reached = edges.join(fresh.select("conv_id", F.col("call_id").alias("on")), ["conv_id", "on"]).groupBy(*key).agg(F.count("*").alias("met"))
        met = scratch.materialise((reached if met is None else met.union(reached)).groupBy(*key).agg(F.sum("met").alias("met")))
        ready = met.join(waits, key).where("met = waits").select(*key).join(done, key, "left_anti")
        fresh = scratch.materialise(ready.select(*key, F.lit(level).cast("long").alias("level")))
        done = scratch.materialise(done.union(fresh))
    return calls.select(*key).join(done, key, "left")


def link_calls(calls: DataFrame, results: DataFrame, tools: dict[str, Tool]) -> DataFrame:
    """Calls ``(conv_id, call_id, turn, name, arguments, depends_on)`` with results ``(conv_id, call_id, turn, content)``.

    Returns ``conv_id, call_id, turn, name, level, status, n_results, errors, json``.
    """
    key = ["conv_id", "call_id"]
    first = F.min(F.struct("turn", "name", "arguments", "depends_on")).alias("c")
    once = calls.where("conv_id is not null and call_id is not null").groupBy(*key).agg(first).select(*key, "c.turn", "c.name", "c.arguments", "c.depends_on")
    answers = results.where("conv_id is not null and call_id is not null").groupBy(*key).agg(F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results"))
    calls = scratch.materialise(once)
    wanted = calls.select(*key, F.explode(F.array_distinct("depends_on")).alias("on")).where("on is not null")
    ids = calls.select("conv_id", F.col("call_id").alias("on"))
    edges = wanted.join(ids, ["conv_id", "on"], "left_semi").select(*key, "on")
    missing = wanted.join(ids, ["conv_id", "on"], "left_anti").groupBy(*key).agg(F.array_sort(F.collect_set("on")).alias("missing"))
    placed = levels(edges, calls)
    value = parsed(F.col("arguments"))
    checked = calls.withColumn("value", value).withColumn("errors", argument_errors(F.col("name"), F.col("arguments"), F.col("value"), tools))
    linked = checked.join(placed, key).join(missing, key, "left").withColumn("called", F.lit(True)).join(answers, key, "full_outer")
    lost = F.transform(F.coalesce("missing", F.array().cast("array<string>")), lambda d: F.concat(F.lit("depends on missing call: "), d))
    errors = F.concat(F.coalesce("errors", F.array().cast("array<string>")), lost, F.when(F.col("called") & F.col("level").isNull(), F.array(F.lit("on a cycle"))).otherwise(F.array().cast("array<string>")))
    status = F.when(F.col("called").isNull(), "orphan").when(F.col("n_results").isNull(), "unanswered").otherwise("linked")
    # Members in the order of their names; a variant's keys are sorted by themselves.
    line = F.to_json(F.struct(F.col("value").alias("arguments"), F.col("call_id"), F.col("conv_id"), F.col("level"), F.col("name"), F.col("r.content").alias("result"), F.coalesce("turn", "r.turn").alias("turn")))
    return linked.select(*key, F.coalesce("turn", "r.turn").alias("turn"), "name", "level", status.alias("status"), F.coalesce("n_results", F.lit(0)).alias("n_results"), errors.alias("errors"), line.alias("json"))


#: What the sample conversations' turns are taken as.
CHAT_TOOLS = {"reply": Tool({"text": Property("string", required=True, least=1, most=300), "turn": Property("integer", required=True, least=0), "words": Property("integer", required=True, most=60)})}


def chat_calls(chats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as calls and results: a user's turn calls ``reply`` and waits for the user's turn before;
    an assistant's turn answers the turn before it."""

    def name(turn: Column) -> Column:
        return F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), turn.cast("string"))

    user = chats.where((F.col("role") == "user") & F.col("turn").isNotNull())
    arguments = F.to_json(F.struct(F.col("turn"), F.col("text"), F.size(F.split("text", " ")).alias("words")))
    waits = F.when(F.col("turn") >= 2, F.array(name(F.col("turn") - 2))).otherwise(F.array().cast("array<string>"))
    calls = user.select("conv_id", name(F.col("turn")).alias("call_id"), "turn", F.lit("reply").alias("name"), arguments.alias("arguments"), waits.alias("depends_on"))
    results = chats.where((F.col("role") == "assistant") & F.col("turn").isNotNull()).select("conv_id", name(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


def op3_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = link_calls(*chat_calls(table(spark, sf_dir, "conversations")), CHAT_TOOLS)
    return linked.withColumn("errors", F.array_join("errors", "; "))


ORACLE = """
WITH c AS (SELECT conv_id, 'call-' || conv_id || '-' || turn AS call_id, turn, text, len(string_split(text, ' ')) AS words FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, 'call-' || conv_id || '-' || (turn - 1) AS call_id, min(turn) AS rturn, any_value(text) AS content, count(*) AS n_results FROM conversations WHERE role = 'assistant' GROUP BY ALL),
m AS (SELECT c.*, p.call_id IS NULL AND c.turn >= 2 AS lost,
    row_number() OVER (PARTITION BY c.conv_id, c.turn % 2 ORDER BY c.turn) AS rn FROM c LEFT JOIN c p ON p.conv_id = c.conv_id AND p.turn = c.turn - 2),
s AS (SELECT *, turn // 2 - max(CASE WHEN lost OR turn < 2 THEN turn // 2 END) OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS level FROM m),
j AS (SELECT coalesce(s.conv_id, a.conv_id) AS conv_id, coalesce(s.call_id, a.call_id) AS call_id, coalesce(turn, rturn) AS turn, text, words, lost, level, content, n_results, s.call_id IS NOT NULL AS called FROM s FULL JOIN a ON s.conv_id = a.conv_id AND s.call_id = a.call_id)
SELECT conv_id, call_id, turn, CASE WHEN called THEN 'reply' END AS name, level,
    CASE WHEN NOT called THEN 'orphan' WHEN n_results IS NULL THEN 'unanswered' ELSE 'linked' END AS status, coalesce(n_results, 0) AS n_results,
    concat_ws('; ', CASE WHEN length(text) > 300 THEN 'text: above 300' END, CASE WHEN length(text) < 1 THEN 'text: below 1' END, CASE WHEN words > 60 THEN 'words: above 60' END,
        CASE WHEN lost THEN 'depends on missing call: call-' || conv_id || '-' || (turn - 2) END) AS errors,
    '{' || concat_ws(',', CASE WHEN called THEN '"arguments":{"text":' || to_json(text) || ',"turn":' || turn || ',"words":' || words || '}' END, '"call_id":"' || call_id || '"', '"conv_id":' || conv_id,
        '"level":' || level, CASE WHEN called THEN '"name":"reply"' END, '"result":' || to_json(content), '"turn":' || turn) || '}' AS json
FROM j
"""
