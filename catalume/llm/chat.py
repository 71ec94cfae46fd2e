"""Chat turns to canonical JSON messages with linked tool calls, by built-in functions alone.

An assistant's turn may be a JSON object with `tool_calls`, a list of calls {id, name, arguments} or {id, function: {name, arguments}}, a turn of the role `tool` one with `tool_call_id`; any other
text is content as it stands: so is an object that repeats a key, or holds a number that no double can. All members that such objects and calls have stay as they are, whatever they are called; only arguments are
written anew, as a string of canonical JSON (as they stand, if they are none), the role is that of the turn, and members that the shape calls for and that are missing are null.

Results are joined with calls by conversation and identifier. A result depends on its call, and nothing else in this format names another message, so that is the whole graph, and it is one step deep:
every message gets a place (order_turn, order_step) that is a topological order: sorted by it, a result never comes before its call. Arguments are validated against schemas of tools.
Conversations are never gathered in one task: order is a key, not a position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalume.llm.common import bound

#: Tool -> argument -> (type, required). Types are Spark's: string, double, bigint, boolean.
Schemas = dict[str, dict[str, tuple[str, bool]]]
#: The tools of production. A double takes any number, a bigint whole numbers alone; text of digits is no number.
SCHEMAS: Schemas = {
    "search": {"query": ("string", True), "limit": ("bigint", False)},
    "convert": {"value": ("double", True), "unit": ("string", True), "exact": ("boolean", False)},
}


def finite(json: Column) -> Column:
    """Whether all numbers of a JSON text are such that a double can hold them. What stands in strings does not count."""
    far = r"[eE]\+?\d{3}|\d{309}"
    bare = F.regexp_replace(json, r'"(?:[^"\\]|\\.)*+"', '""')
    huge = F.exists(F.regexp_extract_all(bare, F.lit(r"\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"), F.lit(0)), lambda x: x.try_cast("double") == float("inf"))
    return F.when(json.rlike(far), ~F.coalesce(huge, F.lit(False))).otherwise(True)  # hardly any text needs the closer look


def parsed_json(json: Column) -> Column:
    """A JSON text as VARIANT; null if it is none, repeats a key or holds a number that is not finite."""
    return F.when(finite(json), F.try_parse_json(json))


def canonical(json: Column) -> Column:
    """JSON without blanks, keys sorted; null as in parsed_json."""
    return F.to_json(parsed_json(json))


def quoted(text: Column) -> Column:
    """A string as JSON; null is null."""
    return bound(F.to_json(F.array(text)), lambda j: F.substr(j, F.lit(2), F.char_length(j) - 2))


def members(value: Column) -> Column:
    """Members of an object (VARIANT) as an array of their names and JSON texts; null for anything else."""
    found = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    return F.transform(found, lambda e: F.struct(e["key"].alias("key"), F.coalesce(F.to_json(e["value"]), F.lit("null")).alias("json")))


def object_json(found: Column, **ours: Column) -> Column:
    """An object's JSON from its members and ours (JSON texts), which take the place of those of their name. Keys are sorted."""
    rest = F.filter(found, lambda e: ~e["key"].isin(*ours))
    mine = F.array(*[F.struct(F.lit(k).alias("key"), F.coalesce(v, F.lit("null")).alias("json")) for k, v in ours.items()])
    all_of_them = F.array_sort(F.concat(F.coalesce(rest, F.array().cast("array<struct<key:string,json:string>>")), mine))
    return F.concat(F.lit("{"), F.array_join(F.transform(all_of_them, lambda e: F.concat(quoted(e["key"]), F.lit(":"), e["json"])), ","), F.lit("}"))


def member(found: Column, name: str) -> Column:
    """JSON text of a member; null if it is not there."""
    return F.get(F.filter(found, lambda e: e["key"] == name), F.lit(0))["json"]


def text_of(value: Column) -> Column:
    """A VARIANT's string, or the JSON of what is none; null for null."""
    kind = F.schema_of_variant(value)
    return F.when(kind == "STRING", F.try_variant_get(value, "$", "string")).when(kind != "VOID", F.to_json(value))


def calls_of(values: Column) -> Column:
    """id, name, arguments (canonical, or as they stand), is_call and json of each call (VARIANT); of what is no object, json alone. What several of them need is put beside the call first, so that it is computed once."""
    of = lambda v, path: text_of(F.try_variant_get(v, path, "variant"))

    def taken_apart(v: Column) -> Column:
        return F.struct(v.alias("v"), members(v).alias("own"), members(F.try_variant_get(v, "$.function", "variant")).alias("inner"))

    def with_arguments(c: Column) -> Column:
        nested, v = c["inner"].isNotNull(), c["v"]
        raw = F.when(nested, of(v, "$.function.arguments")).otherwise(of(v, "$.arguments"))
        name = F.when(nested, of(v, "$.function.name")).otherwise(of(v, "$.name"))
        return F.struct(v.alias("v"), c["own"].alias("own"), c["inner"].alias("inner"), of(v, "$.id").alias("id"), name.alias("name"), bound(raw, lambda x: F.coalesce(canonical(x), x)).alias("arguments"))

    def written(c: Column) -> Column:
        given = lambda found, x: F.coalesce(member(found, x), F.lit("null"))
        own, inner, arguments, there = c["own"], c["inner"], quoted(c["arguments"]), c["own"].isNotNull()
        deep = object_json(own, id=given(own, "id"), function=object_json(inner, name=given(inner, "name"), arguments=arguments))
        flat = object_json(own, id=given(own, "id"), name=given(own, "name"), arguments=arguments)
        return F.struct(F.when(there, c["id"]).alias("id"), F.when(there, c["name"]).alias("name"), F.when(there, c["arguments"]).alias("arguments"), there.alias("is_call"), F.when(inner.isNotNull(), deep).when(there, flat).otherwise(F.to_json(c["v"])).alias("json"))

    return F.transform(F.transform(F.transform(values, taken_apart), with_arguments), written)


def typed(arguments: Column, name: str, kind: str) -> Column:
    """Whether a member of a JSON object (VARIANT) is of a type: by the type that it is written in, not by what it could be cast to."""
    got = F.try_variant_get(arguments, f"$['{name}']", "variant")
    is_a = F.schema_of_variant(got)
    if kind in ("string", "boolean"):
        return is_a == kind.upper()
    number = is_a.isin("BIGINT", "DOUBLE", "FLOAT") | is_a.startswith("DECIMAL")
    value = F.try_variant_get(got, "$", kind)
    return number & value.isNotNull() & (F.try_variant_get(got, "$", "double") == value.cast("double"))


def valid(call: Column, schemas: Schemas) -> Column:
    """Whether a call's arguments are an object with all that its tool's schema requires, of the right types, and nothing else. A tool without a schema: false. So are arguments that repeat a key or hold a number that is not finite."""

    def fits(value: Column) -> Column:
        out, keys = F.lit(False), F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
        for tool, arguments in schemas.items():
            good = keys.isNotNull() & (F.size(F.array_except(keys, F.array(*map(F.lit, arguments)) if arguments else F.array().cast("array<string>"))) == 0)
            for name, (kind, required) in arguments.items():
                there, right = F.array_contains(keys, name), F.coalesce(typed(value, name, kind), F.lit(False))
                good = good & (there & right if required else ~there | right)
            out = F.when(call["name"] == tool, F.coalesce(good, F.lit(False))).otherwise(out)
        return out

    return F.coalesce(bound(parsed_json(call["arguments"]), fits), F.lit(False))


def with_tools(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of turns, with calls and results that the raw table lacks: every assistant turn becomes a message with its text as content, a member of its own, and one or two calls
    (valid, badly typed, incomplete, of an unknown tool; the second in the nested shape), and is joined by a result of its last call in a turn of its own, some before the call and some of no call.

    Turns count by fours, which leaves room for results: the result of a call in turn 4n is turn 4n + 2, or 4n - 1 if reversed.
    """
    conv, turn, text = F.col("conv_id"), F.col("turn"), F.col("text")
    kind, two = F.pmod(conv * 3 + turn, F.lit(6)), F.coalesce(F.pmod(turn, F.lit(4)) >= 2, F.lit(False))
    t, n = turn.cast("string"), (turn * 4)
    written = [
        ("search", F.concat(F.lit('{"query": "q'), t, F.lit('", "limit": '), t, F.lit("}"))),
        ("search", F.concat(F.lit('{"query":"q'), t, F.lit('","limit":"12"}'))),
        ("search", F.lit('{"limit":3}')),
        ("convert", F.concat(F.lit('{"value": '), t, F.lit(', "unit": "m", "exact": true}'))),
        ("convert", F.lit('{"value":1.5,"unit":5}')),
    ]
    name, arguments = F.lit("delete"), F.lit("{}")
    for k, (x, y) in enumerate(written):
        name, arguments = F.when(kind == k, x).otherwise(name), F.when(kind == k, y).otherwise(arguments)
    both, none = lambda x, y: F.struct(x.alias("name"), y.alias("arguments")), F.lit(None).cast("string")
    call = lambda mark, x, y, f: F.struct(F.lit("function").alias("type"), F.concat(F.lit("c"), t, F.lit(mark)).alias("id"), x.alias("name"), y.alias("arguments"), f.alias("function"))
    first = call("a", name, arguments, F.lit(None).cast("struct<name:string,arguments:string>"))
    second = call("b", none, none, both(F.lit("convert"), F.lit('{"unit":"km","value":2.5}')))
    calls = F.when(two, F.array(first, second)).otherwise(F.array(first))
    wanted = F.when(F.pmod(conv + turn, F.lit(7)) == 0, "gone").otherwise(F.concat(F.lit("c"), t, F.when(two, "b").otherwise("a")))
    place = F.when(F.pmod(conv + turn, F.lit(5)) == 0, n - 1).otherwise(n + 2)
    row = lambda at, role, x: F.struct(at.alias("turn"), role.alias("role"), x.alias("text"))
    asked = row(n, F.col("role"), F.to_json(F.struct(calls.alias("tool_calls"), F.lit("m-1").alias("model"), text.alias("content"))))
    answered = row(place, F.lit("tool"), F.to_json(F.struct(wanted.alias("tool_call_id"), (kind == 2).alias("is_error"), text.alias("content"))))
    rows = F.when(F.col("role") == "assistant", F.array(asked, answered)).otherwise(F.array(row(n, F.col("role"), text)))
    return turns.select("conv_id", F.explode(rows).alias("r")).select("conv_id", "r.*")


def parsed(turns: DataFrame) -> DataFrame:
    """turns with own (members of the turn's object), calls (those of calls_of, without nulls) and wanted (the identifier that a result answers); all three null where a turn is plain text, the last two where it is not of their kind."""
    object_of = F.when(F.col("role").isin("assistant", "tool") & F.ltrim("text").startswith("{"), parsed_json(F.col("text")))
    df = turns.withColumn("doc", object_of)
    calls = F.when(F.col("role") == "assistant", F.try_variant_get("doc", "$.tool_calls", "array<variant>"))
    listed = F.filter(calls, lambda c: F.coalesce(F.schema_of_variant(c) != "VOID", F.lit(False)))
    wanted = F.when(F.col("role") == "tool", text_of(F.try_variant_get("doc", "$.tool_call_id", "variant")))
    df = df.withColumns({"calls": calls_of(listed), "wanted": wanted})
    return df.withColumn("own", F.when(F.col("calls").isNotNull() | F.col("wanted").isNotNull(), members(F.col("doc")))).drop("doc")


def links(turns: DataFrame) -> DataFrame:
    """conv_id, call_id, name, arguments, call_turn, call_step: one row per call; of calls that repeat an identifier in a conversation, the first."""
    calls = parsed(turns).where("calls is not null").select("conv_id", "turn", F.posexplode("calls").alias("step", "c"))
    one = calls.where("c.id is not null").groupBy("conv_id", F.col("c.id").alias("call_id")).agg(F.min(F.struct("turn", "step", "c")).alias("x"))
    return one.select("conv_id", "call_id", F.col("x.c.name").alias("name"), F.col("x.c.arguments").alias("arguments"), F.col("x.turn").alias("call_turn"), F.col("x.step").alias("call_step"))


def answers(turns: DataFrame) -> DataFrame:
    """links with n_results: how many results each call has. 0: it was never answered; 2 and more: only one of them can count."""
    found = parsed(turns).where("wanted is not null").groupBy("conv_id", F.col("wanted").alias("call_id")).agg(F.count("*").alias("n_results"))
    return links(turns).join(found, ["conv_id", "call_id"], "left").withColumn("n_results", F.coalesce("n_results", F.lit(0)))


def formatted(turns: DataFrame, schemas: Schemas | None = None) -> DataFrame:
    """conv_id, turn, role, message, order_turn, order_step, n_calls, n_valid, linked, for each row of turns (conv_id, turn, role, text; other columns are ignored).

    linked: for tool results, whether their call is there; null for other messages. Null text is null content; null roles and turns stay null. Repeated rows stay, texts are
    whole however long, no rows give none. Messages with equal order keys are equal in rank: ties go by message.
    """
    df = parsed(turns.select("conv_id", "turn", "role", "text"))
    calls, own, role = F.col("calls"), F.col("own"), quoted(F.col("role"))
    content = F.coalesce(member(own, "content"), F.lit("null"))
    plain = F.to_json(F.struct(F.col("text").alias("content"), F.col("role")), {"ignoreNullFields": "false"})
    with_calls = object_json(own, content=content, role=role, tool_calls=F.concat(F.lit("["), F.array_join(F.transform(calls, lambda c: c["json"]), ","), F.lit("]")))
    known = links(turns).select(F.col("conv_id").alias("of"), "call_id", "call_turn", "call_step")
    results = df.where("wanted is not null").join(known, (F.col("conv_id") == F.col("of")) & (F.col("wanted") == F.col("call_id")), "left")
    out = df.where("wanted is null").unionByName(results, allowMissingColumns=True)  # only results are dealt out by conversation
    early = F.coalesce(F.col("turn") <= F.col("call_turn"), F.lit(False))
    real = F.filter(calls, lambda c: c["is_call"])
    return out.select(
        "conv_id",
        "turn",
        "role",
        F.when(calls.isNotNull(), with_calls).when(F.col("wanted").isNotNull(), object_json(own, content=content, role=role)).otherwise(plain).alias("message"),
        F.when(early, F.col("call_turn")).otherwise(F.col("turn")).alias("order_turn"),
        F.when(early, F.col("call_step") + 1).otherwise(0).alias("order_step"),
        F.coalesce(F.size(real), F.lit(0)).alias("n_calls"),
        F.coalesce(F.size(F.filter(real, lambda c: valid(c, schemas or {}))), F.lit(0)).alias("n_valid"),
        F.when(F.col("wanted").isNotNull(), F.col("call_id").isNotNull()).alias("linked"),
    )
