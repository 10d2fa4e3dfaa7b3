"""Chat formatting: tool calls linked to results, ordered, validated, as canonical JSON.

Calls and results are joined by conversation and identifier, with a shuffle on
both and no broadcast of either.  A call stands after the calls it depends on.
Where all of those come in earlier turns, as logs usually have it, the order of
turns is such an order and no search is needed; only the calls of the other
conversations go through rounds that place what depends on nothing unplaced.
Places are counted in blocks of turns, so that a very long conversation is not
ordered by one task.

Arguments are JSON objects.  They are checked against the schema of their tool
and written canonically: sorted keys, no white space, numbers in one spelling.

Everything is DataFrame functions.

Defined cases: rows without conversation or identifier are linked to nothing; of
calls that repeat an identifier the first by turn and text is the call, and of
results likewise, and the others are dropped as repeats; a call without a result
has `linked` false, a result without a call is in `orphans`; a dependency on
itself or on an unknown call counts as none; calls on a cycle have no place;
arguments that are NULL or no JSON object have the one error `not an object`;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketmill.llm.common import materialized, new_path, written

#: Turns that are counted together.
TURNS_OF_BLOCK = 256


@dataclass(frozen=True)
class Parameter:
    """Type (`string`, `integer`, `number`, `boolean`, `array` or `object`) of an argument."""

    type: str
    required: bool = True


Schemas = Mapping[str, Mapping[str, Parameter]]

# How the type of a JSON value is spelled by the parser.
TYPES = {
    "string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|DECIMAL.*)$",
    "boolean": "^BOOLEAN$", "array": "^ARRAY<.*>$", "object": "^OBJECT<.*>$"}


def argument_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with the arguments of a call, in the order of the parameters; no errors are no items."""
    parsed = F.try_parse_json(arguments)
    keys = F.json_object_keys(arguments)
    found = F.array(F.lit("unknown tool"))
    for tool, parameters in sorted(schemas.items()):
        checks = []
        for key, p in sorted(parameters.items()):
            value = F.schema_of_variant(F.try_variant_get(parsed, f"$.{key}", "variant"))
            missing = ~F.array_contains(keys, key)
            wrong = ~F.coalesce(F.regexp_like(value, F.lit(TYPES[p.type])), F.lit(False))
            absent = F.lit(f"missing {key}") if p.required else F.lit(None).cast("string")
            checks.append(F.when(missing, absent).when(wrong, F.lit(f"{key} is no {p.type}")))
        extra = F.transform(
            F.array_sort(F.array_except(keys, F.array(*[F.lit(k) for k in sorted(parameters)]))),
            lambda k: F.concat(F.lit("unknown "), k))
        found = F.when(name == tool, F.concat(F.array_compact(F.array(*checks)), extra)).otherwise(found)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT<"), F.lit(False))
    return F.when(is_object, found).otherwise(F.array(F.lit("not an object")))


def canonical(**fields: Column) -> Column:
    """The fields as a JSON object with sorted keys; NULL fields are written."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def _first(rows: DataFrame, *order: Column) -> DataFrame:
    """The first row of every (conv_id, call_id)."""
    place = F.row_number().over(Window.partitionBy("conv_id", "call_id").orderBy(*order))
    return rows.withColumn("repeat", place).where("repeat = 1").drop("repeat")


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Calls (conv_id, call_id, turn, name, arguments, depends_on) with `linked`, `result` and `result_turn`."""
    first = _first(calls, F.col("turn"), F.col("name"), F.col("arguments"))
    answers = _first(results, F.col("turn"), F.col("content")).select(
        "conv_id", "call_id", F.col("turn").alias("result_turn"), F.col("content").alias("result"))
    return first.hint("shuffle_hash").join(answers.hint("shuffle_hash"), ["conv_id", "call_id"], "left").withColumn(
        "linked", F.col("result_turn").isNotNull())


def orphans(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results that belong to no call."""
    return results.join(calls.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti")


def edges(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, turn, parent, parent_turn) of every dependency on another known call."""
    wanted = calls.select("conv_id", "call_id", "turn", F.explode("depends_on").alias("parent")).distinct()
    known = calls.select("conv_id", F.col("call_id").alias("parent"), F.col("turn").alias("parent_turn"))
    return wanted.where("parent <> call_id").join(known, ["conv_id", "parent"])


def _rounds(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): rounds until all that a call depends on is placed; cycles never are."""
    spark = calls.sparkSession
    paths = [new_path(spark, "levels") for _ in range(2)]
    keys = ["conv_id", "call_id"]
    placed = written(calls.join(needs, keys, "left_anti").select(*keys, F.lit(0).alias("level")), paths[0])
    before, level = -1, 0
    while (n := placed.count()) > before:
        before, level = n, level + 1
        done = placed.select("conv_id", F.col("call_id").alias("parent"))
        waiting = needs.join(done, ["conv_id", "parent"], "left_anti").select(*keys).distinct()
        left = calls.select(*keys).join(placed.select(*keys), keys, "left_anti")
        fresh = left.join(waiting, keys, "left_anti").withColumn("level", F.lit(level))
        paths.reverse()
        placed = written(placed.unionByName(fresh), paths[0], "overwrite")
    return placed


def order(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, place): place of every call in its conversation, from 1, after what it depends on."""
    needs = materialized(edges(calls), "dependencies")
    bad = needs.where(F.col("parent_turn") >= F.col("turn")).select("conv_id").distinct()
    plain = calls.join(bad, "conv_id", "left_anti").select("conv_id", "call_id", "turn", F.lit(0).alias("level"))
    if not bad.isEmpty():
        odd = calls.join(bad, "conv_id", "left_semi").select("conv_id", "call_id", "turn")
        levels = _rounds(odd, needs.join(bad, "conv_id", "left_semi").select("conv_id", "call_id", "parent"))
        plain = plain.unionByName(odd.join(levels, ["conv_id", "call_id"]).select(*plain.columns))
    block = F.floor(F.col("turn") / TURNS_OF_BLOCK)
    rows = plain.withColumn("block", block)
    by = Window.partitionBy("conv_id", "level", "block").orderBy("turn", "call_id")
    ranked = rows.withColumn("inside", F.row_number().over(by))
    sums = rows.groupBy("conv_id", "level", "block").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("conv_id").orderBy("level", "block")
    starts = sums.select("conv_id", "level", "block", (F.sum("n").over(upto) - F.col("n")).alias("before"))
    return ranked.join(starts, ["conv_id", "level", "block"]).select(
        "conv_id", "call_id", (F.col("before") + F.col("inside")).alias("place"))


def formatted(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row for each call: its place, whether it is linked and valid, and its canonical JSON."""
    errors = argument_errors(F.col("name"), F.col("arguments"), schemas)
    linked = materialized(link(calls, results).withColumn("errors", errors), "linked-calls")
    placed = linked.join(order(linked), ["conv_id", "call_id"], "left")
    arguments = F.coalesce(F.to_json(F.try_parse_json("arguments")), F.lit("null"))
    return placed.select(
        "conv_id", "call_id", "place", "linked", (F.size("errors") == 0).alias("valid"),
        F.array_join("errors", "; ").alias("errors"),
        F.concat(
            F.lit('{"arguments":'), F.when(F.col("errors") == F.array(F.lit("not an object")), "null").otherwise(
                arguments), F.lit(","),
            F.substring(canonical(
                errors=F.col("errors"), id=F.col("call_id"), name=F.col("name"), place=F.col("place"),
                result=F.col("result"), turn=F.col("turn")), F.lit(2), F.lit(1 << 30))).alias("message"))


#: Tools of `conversation_calls`.
CONVERSATION_TOOLS: Schemas = {
    "configure": {"rules": Parameter("string"), "turn": Parameter("integer")},
    "reply": {"prompt": Parameter("string"), "turn": Parameter("integer"), "style": Parameter("string", False)},
}


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A table (conv_id, turn, role, text) as calls and results.

    What a user says is a call of `reply`, what the system says of `configure`;
    what the assistant says in the next turn is the result.  The length of a text
    decides what else its call does, so that every branch occurs: every fifth length
    writes the turn as text and every seventh adds an argument that the tool does not
    know, every third of the system leaves out its rules; a call depends on the
    conversation's first, and by its length also on the call two turns before, on none,
    or, as a plan written ahead would, on the one two turns later.
    """
    def call_id(turn: Column) -> Column:
        return F.concat_ws("-", F.col("conv_id"), turn)

    turn, text = F.col("turn"), F.col("text")
    size = F.coalesce(F.char_length("text"), F.lit(1))

    def said(key: str) -> Column:
        """Canonical arguments by what the length of the text lets happen."""
        found = canonical(turn=turn, **{key: text})
        for odd_turn in (False, True):
            for note in (False, True):
                fields = {"turn": turn.cast("string") if odd_turn else turn, key: text}
                fields |= {"note": F.lit("as said")} if note else {}
                here = ((size % 5 == 0) == F.lit(odd_turn)) & ((size % 7 == 0) == F.lit(note))
                found = F.when(here, canonical(**fields)).otherwise(found)
        return found

    rules = F.when(size % 3 == 0, canonical(turn=turn)).otherwise(said("rules"))
    other = F.when(size % 4 == 0, call_id(turn + 2)).when((size % 4).isin(1, 2), call_id(turn - 2))
    calls = turns.where(F.col("role").isin("user", "system")).select(
        "conv_id", call_id(turn).alias("call_id"), "turn",
        F.when(F.col("role") == "user", "reply").otherwise("configure").alias("name"),
        F.when(F.col("role") == "user", said("prompt")).otherwise(rules).alias("arguments"),
        F.array_compact(F.array(other, call_id(F.lit(0)))).alias("depends_on"))
    results = turns.where(F.col("role") == "assistant").select(
        "conv_id", call_id(turn - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results
