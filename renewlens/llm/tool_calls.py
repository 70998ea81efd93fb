"""Tool calls of conversations: linked, ordered, checked, in canonical JSON.

Calls and results meet by conversation and call identifier (a hash join). A call
may name calls whose results it uses. Order: where every named call stands before
the one that uses it, the turns are an order already; only other conversations
are peeled level by level (calls whose named calls are all placed come next), and
calls that are left over in the end wait for each other in a circle. Sorting by
(conversation, ``stage``, ``turn``) is a topological order; no conversation is
gathered in one task for it.

Arguments are checked against the tool's schema and written with sorted keys, no
blanks, and one text for every number: ``1e2``, ``100`` and ``100.0`` are ``100``, and
all of them integers.

Status of a call: ``duplicate`` (its identifier was used on an earlier turn),
``unknown_tool``, ``invalid`` (no JSON object, or against the schema), ``circular``,
``unanswered``, else ``ok``; the first that applies. The earliest result is the call's,
then the least in text order; every other result is a row of its own, ``extra_result``
if its call is known, else ``orphan``. Turns that are neither call nor result are
carried through as ``other``. So no row is lost: calls, results that are no call's, and
others come out once each. Named calls that do not exist are ignored. Rows without
conversation or identifier are ``orphan`` results, or calls that are never answered.
Equal rows are duplicates of each other but for one; NULL texts are NULL in the JSON.

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens.session import staged


@dataclass(frozen=True)
class Argument:
    """Rule for one argument; ``kind``: string, integer, number, boolean."""

    kind: str
    required: bool = True
    least: float | None = None  # of numbers; of strings: characters
    choices: tuple[str, ...] = ()


Schema = Mapping[str, Argument]
_NUMBER = r"^(BIGINT|DOUBLE|DECIMAL\(.*\))$"
_KINDS = {"string": r"^STRING$", "integer": _NUMBER, "number": _NUMBER, "boolean": r"^BOOLEAN$"}
# Signs that JSON text never holds as such; they stand for a backslash and a quote.
_BACKSLASH, _QUOTE = "\x01", "\x02"


def _plain_number(token: Column) -> Column:
    """One text for a number, however written; whole ones below 1e38 in all digits."""
    value = token.try_cast("double")
    whole = F.abs(value) < 1e38
    digits = F.when(whole & (value == F.rint(value)), value.try_cast("decimal(38,0)"))
    fine = F.when(F.abs(value).between(1e-6, 1e15), token.try_cast("decimal(38,18)"))
    exact = fine.cast("double") == value
    fraction = F.rtrim(fine.cast("string"), F.lit("0"))
    number = token.rlike(r"^-?[0-9][0-9.]*([eE][+-]?[0-9]+)?$") & token.rlike("[.eE]")
    return F.when(
        number, F.coalesce(digits.cast("string"), F.when(exact, fraction), token)
    ).otherwise(token)


def _numbers_alike(json: Column) -> Column:
    """JSON text without blanks, its numbers rewritten, its strings as they are."""
    parts = F.split(
        F.replace(F.replace(json, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE)),
        '"',
    )
    # Every second part is the inside of a string.
    marks = r"(?<=[,:\[\]{}])|(?=[,:\[\]{}])"
    rewritten = F.transform(
        parts,
        lambda part, at: F.when(at % 2 == 1, part).otherwise(
            F.array_join(F.transform(F.split(part, marks), _plain_number), "")
        ),
    )
    joined = F.array_join(rewritten, '"')
    return F.replace(F.replace(joined, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))


def canonical(text: Column) -> Column:
    """JSON with sorted keys, no blanks and plain numbers; NULL if it is none."""
    return _numbers_alike(F.to_json(F.try_parse_json(text)))


def follows(text: Column, schema: Schema) -> Column:
    """Whether a JSON text is an object that keeps to the schema."""
    value = F.try_parse_json(text)
    kind = F.schema_of_variant(value)
    good = kind.startswith("OBJECT<")
    names = F.json_object_keys(text)
    good = good & (F.size(F.array_except(names, F.array(*map(F.lit, schema)))) == 0)
    for name, rule in schema.items():
        at = f"$['{name}']"
        field = F.try_variant_get(value, at, "variant")
        fits = F.schema_of_variant(field).rlike(_KINDS[rule.kind])
        if rule.kind == "string":
            content = F.try_variant_get(value, at, "string")
            if rule.least is not None:
                fits = fits & (F.length(content) >= int(rule.least))
            if rule.choices:
                fits = fits & content.isin(*rule.choices)
        elif rule.kind != "boolean":
            number = F.try_variant_get(value, at, "double")
            if rule.kind == "integer":
                fits = fits & (number == F.rint(number))
            if rule.least is not None:
                fits = fits & (number >= float(rule.least))
        absent = ~F.array_contains(names, name)
        good = good & (fits if rule.required else (absent | fits))
    return F.coalesce(good, F.lit(False))


def _levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, stage) by peeling; circles get stage -1."""
    placed: DataFrame | None = None
    left, stage = nodes, 1
    key = ["conv_id", "call_id"]
    while True:
        waiting = edges.select(*key).distinct()
        ready = staged(left.join(waiting, key, "anti"), "call-ready")
        if ready.isEmpty():
            last = left.select(*key, F.lit(-1).alias("stage"))
            return last if placed is None else placed.unionByName(last)
        now = ready.select(*key, F.lit(stage).alias("stage"))
        placed = staged(now if placed is None else placed.unionByName(now), "call-levels")
        left = staged(left.join(ready.select(*key), key, "anti"), "call-left")
        done = ready.select("conv_id", F.col("call_id").alias("used"))
        edges = staged(edges.join(done, ["conv_id", "used"], "anti"), "call-edges")
        stage += 1


def link(
    calls: DataFrame,
    results: DataFrame,
    schemas: Mapping[str, Schema],
    others: DataFrame | None = None,
) -> DataFrame:
    """One row per call, per result that is no call's, and per other turn.

    ``calls``: conv_id, turn, call_id, tool, arguments (JSON text), uses (array of
    call_id). ``results``: conv_id, turn, call_id, content. ``others``: conv_id, turn,
    role, content.
    Returns conv_id, turn, call_id, tool, status, stage, result_turn, json.
    """
    key = ["conv_id", "call_id"]
    calls = calls.select(*key, "turn", "tool", "arguments", "uses")
    mark = F.xxhash64("tool", "arguments", F.monotonically_increasing_id())
    calls = staged(calls.withColumn("mark", mark), "calls")
    # One call of each identifier is its first; counted before it is joined.
    first = calls.groupBy(*key).agg(F.min(F.struct("turn", "mark")).alias("first"))
    is_first = F.struct("turn", "mark").eqNullSafe(F.col("first"))
    results = results.select(*key, "turn", "content")
    results = staged(
        results.withColumn("mark", F.monotonically_increasing_id()), "call-results"
    )
    answers = (
        results.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
        .groupBy(*key)
        .agg(F.min(F.struct("turn", "content", "mark")).alias("answer"))
    )
    linked = calls.join(
        first.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), "first"),
        F.col("conv_id").eqNullSafe(F.col("c")) & F.col("call_id").eqNullSafe(F.col("i")),
    ).drop("c", "i")
    linked = linked.join(answers, key, "left").withColumn("is_first", is_first)

    known = calls.groupBy(*key).agg(F.min("turn").alias("turn"))
    edges = (
        calls.select(*key, "turn", F.explode("uses").alias("used"))
        .join(
            known.select("conv_id", F.col("call_id").alias("used"), F.col("turn").alias("used_turn")),
            ["conv_id", "used"],
        )
        .select("conv_id", "call_id", "used", "turn", "used_turn")
    )
    tangled = edges.where("used_turn >= turn").select("conv_id").distinct()
    tangled = staged(tangled, "call-tangled")
    if tangled.isEmpty():
        linked = linked.withColumn("stage", F.lit(0))
    else:
        nodes = known.select(*key).join(tangled, "conv_id", "semi")
        arcs = edges.select("conv_id", "call_id", "used").distinct()
        levels = _levels(nodes, staged(arcs.join(tangled, "conv_id", "semi"), "call-edges"))
        linked = linked.join(levels, key, "left").withColumn(
            "stage", F.coalesce("stage", F.lit(0))
        )

    keeps = F.lit(False)
    for tool, schema in schemas.items():
        keeps = F.when(F.col("tool") == tool, follows(F.col("arguments"), schema)).otherwise(keeps)
    status = (
        F.when(~F.col("is_first"), "duplicate")
        .when(~F.coalesce(F.col("tool").isin(*schemas), F.lit(False)), "unknown_tool")
        .when(~keeps, "invalid")
        .when(F.col("stage") < 0, "circular")
        .when(F.col("answer").isNull(), "unanswered")
        .otherwise("ok")
    )
    answered = linked.select(
        *key,
        "turn",
        "tool",
        status.alias("status"),
        "stage",
        F.when(F.col("is_first"), F.col("answer.turn")).alias("result_turn"),
        _json("arguments", "call_id", "tool", F.when(F.col("is_first"), F.col("answer.content"))),
    )
    # Results that answer a call stand in its row; marks are unique, so no key is hot.
    used = answers.join(known.select(*key), key, "semi").select(F.col("answer.mark").alias("mark"))
    named = known.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
    spare = results.join(used, "mark", "anti").join(
        named.select(*key, F.lit("extra_result").alias("status")), key, "left"
    )
    alone = spare.select(
        *key,
        "turn",
        F.lit(None).cast("string").alias("tool"),
        F.coalesce("status", F.lit("orphan")).alias("status"),
        F.lit(0).alias("stage"),
        F.col("turn").alias("result_turn"),
        _json(None, "call_id", None, F.col("content")),
    )
    found = answered.unionByName(alone)
    if others is None:
        return found
    said = F.concat(
        F.lit('{"content":'), _inner(F.col("content")), F.lit(',"role":'), _inner(F.col("role")), F.lit("}")
    )
    carried = others.select(
        "conv_id",
        F.lit(None).cast("string").alias("call_id"),
        "turn",
        F.lit(None).cast("string").alias("tool"),
        F.lit("other").alias("status"),
        F.lit(0).alias("stage"),
        F.lit(None).cast(others.schema["turn"].dataType).alias("result_turn"),
        said.alias("json"),
    )
    return found.unionByName(carried)


def _inner(value: Column) -> Column:
    """A text as JSON."""
    written = F.to_json(F.array(value))
    return F.substring(written, F.lit(2), F.length(written) - 2)


def _json(arguments: str | None, call_id: str, tool: str | None, result: Column) -> Column:
    """One call as canonical JSON: keys in order, NULLs written."""
    given = F.coalesce(canonical(F.col(arguments)), F.lit("null")) if arguments else F.lit("null")
    name = _inner(F.col(tool)) if tool else F.lit("null")
    return F.concat(
        F.lit('{"arguments":'),
        given,
        F.lit(',"id":'),
        _inner(F.col(call_id)),
        F.lit(',"name":'),
        name,
        F.lit(',"result":'),
        _inner(result),
        F.lit("}"),
    ).alias("json")
