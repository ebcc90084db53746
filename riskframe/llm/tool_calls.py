"""Chat formatting: tool calls linked with their results.

Calls and results meet in a hash join by identifier. Events are put in a topological order per conversation:
calls by turn and position, a result after its call even where the table has it earlier. Arguments are
parsed as variants, checked against the tool's schema by compiled conditions, and each event is serialised as
canonical JSON: keys in byte order, no spaces, values as parsed.

Defined results: of calls that repeat an identifier in a conversation the first (by turn, position, hash of name and arguments,
row) counts and the others are ``duplicate``, wholly equal rows too; the same holds for results of one call. Rows without a conversation
are one conversation. Results without a call are ``orphan``, calls without a result ``pending``, also where the identifier is null. Arguments that are null, no object, or no JSON have the problem
``json``. Extra columns are ignored; empty tables give no events.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from riskframe.llm.common import ranked
from riskframe.sources.staging import stage

# fixed values: JSON schema types and the variant types that satisfy them
TYPES = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "DECIMAL"), "boolean": ("BOOLEAN",),
         "object": ("OBJECT",), "array": ("ARRAY",)}


def problems(name: Column, arguments: Column, parsed: Column, schemas: Mapping[str, Mapping[str, tuple[str, bool]]]) -> Column:
    """What is wrong with a call, as an array of texts; schemas: tool -> parameter -> (type, required)."""
    kind = lambda p: F.schema_of_variant(F.variant_get(parsed, f"$['{p}']", "variant"))
    given = F.json_object_keys(arguments)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    out = F.array(F.lit("tool"))
    for tool, params in schemas.items():
        tests = [F.array_sort(F.transform(F.array_except(given, F.array(*[F.lit(p) for p in params]).cast("array<string>")),
                                          lambda k: F.concat(F.lit("unknown:"), k)))]
        for p, (t, required) in sorted(params.items()):
            there = F.array_contains(given, p)
            right = F.lit(False)
            for v in TYPES[t]:
                right |= kind(p).startswith(v)
            bad = F.when(there & ~F.coalesce(right, F.lit(False)), F.lit(f"type:{p}"))
            tests.append(F.array_compact(F.array(bad.when(~there, F.lit(f"missing:{p}")) if required else bad)))
        out = F.when(name == tool, F.concat(*tests)).otherwise(out)
    return F.when(is_object, out).otherwise(F.array(F.lit("json")))


def link(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping[str, tuple[str, bool]]]) -> DataFrame:
    """conv_id, position, kind, call_id, status, problems, json.

    calls: conv_id, turn, pos, call_id, name, arguments (JSON text); results: conv_id, turn, pos, call_id, content.
    """
    number = F.monotonically_increasing_id().alias("row")
    calls = stage(calls.select("conv_id", "turn", "pos", "call_id", "name", "arguments", number), "calls")
    results = stage(results.select("conv_id", "turn", "pos", "call_id", "content", number), "results")
    # the first call of an identifier and the first result of a call, by row number; texts do not move
    order = lambda *text: F.struct("turn", "pos", F.xxhash64(*text).alias("text"), "row")
    first = calls.where("call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(F.min(order("name", "arguments")).alias("first"))
    answer = results.where("call_id IS NOT NULL").groupBy(F.col("conv_id").alias("_v"), F.col("call_id").alias("_c")).agg(F.min(order("content")).alias("answer"))
    by_id = F.col("conv_id").eqNullSafe(F.col("_v")) & (F.col("call_id") == F.col("_c"))
    keyed = first.join(answer.hint("shuffle_hash"), by_id, "left")
    known = keyed.select(F.col("conv_id").alias("_v"), F.col("call_id").alias("_c"), "first", "answer")

    parsed = F.try_parse_json("arguments")
    mine = calls.join(known.hint("shuffle_hash"), by_id, "left")
    is_first = F.coalesce(F.col("first.row") == F.col("row"), F.lit(False)) | F.col("call_id").isNull()
    events = mine.select(
        "conv_id", "turn", F.lit(0).alias("step"), F.col("pos"), F.lit("call").alias("kind"), "call_id",
        F.when(~is_first, "duplicate").when(F.col("answer").isNull(), "pending").otherwise("answered").alias("status"),
        problems(F.col("name"), F.col("arguments"), parsed, schemas).alias("problems"),
        _json(("arguments", F.coalesce(F.to_json(parsed), _text(F.col("arguments")))),
              ("id", _text(F.col("call_id"))), ("name", _text(F.col("name")))).alias("json"))
    theirs = results.join(known.hint("shuffle_hash"), by_id, "left")
    is_answer = F.coalesce(F.col("answer.row") == F.col("row"), F.lit(False))
    after = F.col("first").isNotNull() & (F.struct("first.turn", "first.pos") > F.struct("turn", "pos"))
    events = events.unionByName(theirs.select(
        "conv_id", F.when(after, F.col("first.turn")).otherwise(F.col("turn")).alias("turn"), F.lit(1).alias("step"),
        F.when(after, F.col("first.pos")).otherwise(F.col("pos")).alias("pos"), F.lit("result").alias("kind"), "call_id",
        F.when(F.col("first").isNull(), "orphan").when(is_answer, "linked").otherwise("duplicate").alias("status"),
        F.array().cast("array<string>").alias("problems"),
        _json(("content", _text(F.col("content"))), ("id", _text(F.col("call_id")))).alias("json")))
    events = events.withColumn("tie", F.xxhash64("json", "status"))
    return ranked(events, ["conv_id"], ["turn", "pos", "step", "call_id", "tie"], "position").select(
        "conv_id", "position", "kind", "call_id", "status", "problems", "json")


def _text(value: Column) -> Column:
    """A text as a JSON string, or null."""
    whole = F.to_json(F.struct(value.alias("v")))  # {"v":"..."}
    return F.when(value.isNull(), F.lit("null")).otherwise(F.substring(whole, F.lit(6), F.char_length(whole) - 6))


def _json(*fields: tuple[str, Column]) -> Column:
    """An object of the fields, whose values are JSON already; fields in byte order of their names."""
    parts = [F.lit("{")]
    for i, (k, v) in enumerate(sorted(fields, key=lambda f: f[0])):
        parts += [F.lit(("," if i else "") + f'"{k}":'), v]
    return F.concat(*parts, F.lit("}"))
