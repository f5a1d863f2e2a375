"""Tool calls linked to their results, ordered, validated and written as canonical JSON.

DataFrame functions only. Calls and results meet in a hash join by
(conversation, identifier). A call may name one parent, the call whose result it goes on
from; the parents form a forest, and a call's level is its depth there. Levels come
from pointer doubling over (conversation, id) keys, so a chain of n calls takes
log2(n) joins on unique keys and a hot conversation is spread over all tasks.
(conversation, level, turn, id) is a topological order; ``ordered`` deals rows by it.

Arguments are parsed as variants: an object is checked against its tool's schema rows, and
serialised with sorted keys and no white space.

Defined results. Calls without an identifier are kept, at level 0, with status
``no_id``. Of calls that share an identifier the first by (turn, name, arguments, parent) is the call
and ``n_calls`` says how many there were; results likewise (turn, content; ``n_results``). With
``copies`` the others follow as rows of their own, ``duplicate_call`` and ``duplicate_result``, at the level and
with the counts of their identifier, their own arguments validated and serialised. A result
whose call is missing is kept with status ``orphan_result``. A parent that is missing makes a
root; calls on a cycle of parents, or behind one, have a null level and status
``cycle``. Null or invalid JSON, duplicate keys, values too large for a variant and
anything but an object fail validation and serialise as null. A tool without schema rows
fails validation; so do missing required, unknown and wrongly typed parameters.
Numbers beyond 38 digits are serialised as doubles. Arguments and contents of any length are taken whole, but for values
too large for a variant. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

KEYS = ["conv_id", "call_id"]
#: repeated identifiers are broadcast up to so many
BROADCAST_ROWS = 200_000


def _numbered(rows: DataFrame, uid: str) -> DataFrame:
    """Rows with an identifier, written with a number each, so that equal rows can be told apart."""
    rows = rows.where("call_id is not null").withColumn(uid, F.monotonically_increasing_id())
    return materialize(rows, "numbered")


def _first(rows: DataFrame, by: list[str], count: str) -> DataFrame:
    """The first row of each (conversation, id) and how many there were; ``by`` holds all other columns.
    Each task sends one row of an id on, however many it has."""
    found = rows.groupBy(*KEYS).agg(F.min(F.struct(*by)).alias("_s"), F.count("*").alias(count))
    return found.select(*KEYS, "_s.*", count)


def _copies(rows: DataFrame, linked: DataFrame, uid: str, count: str, status: str) -> DataFrame:
    """The numbered ``rows`` but the first of each (conversation, id), with what ``linked`` says of their id."""
    ids = materialize(linked.where(F.col(count) > 1).select(*KEYS, F.col(uid).alias("_first"), "level", "n_calls",
                                                            "n_results"), "repeated-ids")
    found = _linked(rows, F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, "inner")
    return found.where(F.col(uid) != F.col("_first")).drop("_first").withColumn("copy", F.lit(status))


def _linked(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join by conversation (null matches null) and identifier, keeping one pair of key columns."""
    r = right.withColumnsRenamed({"conv_id": "_conv", "call_id": "_call"})
    on = left["conv_id"].eqNullSafe(r["_conv"]) & (left["call_id"] == r["_call"])
    out = left.join(r, on, how)
    if how == "full":
        out = out.withColumns({"conv_id": F.coalesce("conv_id", "_conv"), "call_id": F.coalesce("call_id", "_call")})
    return out.drop("_conv", "_call")


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of calls with unique (conv_id, call_id) and a ``parent_id``; a null
    level marks a cycle. One written table per doubling."""
    nodes = materialize(calls.select("conv_id", "call_id", "parent_id"), "call-nodes")
    parents = nodes.select("conv_id", "call_id", F.lit(True).alias("known"))
    by_parent = nodes.select("conv_id", F.col("parent_id").alias("call_id"), F.col("call_id").alias("id"))
    found = _linked(by_parent, parents, "left")
    at = found.select("conv_id", F.col("id").alias("call_id"), F.when(F.col("known"), F.col("call_id")).alias("above"),
                      F.when(F.col("known"), 1).otherwise(0).cast("long").alias("level"))
    at = materialize(at, "call-levels")
    total, reach = nodes.count(), 1
    while not at.where("above is not null").isEmpty():
        if reach > total:       # longer than any chain: a cycle
            return at.select("conv_id", "call_id", F.when(F.col("above").isNull(), F.col("level")).alias("level"))
        up = at.select("conv_id", "call_id", F.col("above").alias("further"), F.col("level").alias("more"))
        moving = at.where("above is not null").select("conv_id", F.col("above").alias("call_id"),
                                                      F.col("call_id").alias("id"), "level")
        moved = _linked(moving, up, "inner").select(
            "conv_id", F.col("id").alias("call_id"), F.col("further").alias("above"),
            (F.col("level") + F.col("more")).alias("level"))
        at = materialize(at.where("above is null").unionByName(moved), "call-levels")
        reach *= 2
    return at.select("conv_id", "call_id", "level")


def json_kind(kind_of_variant: Column) -> Column:
    """JSON type of a variant from its schema text."""
    t = kind_of_variant
    return (F.when(t == "STRING", "string").when((t == "BIGINT") | t.rlike(r"^DECIMAL\(\d+,0\)$"), "integer")
            .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "number").when(t == "BOOLEAN", "boolean")
            .when(t.startswith("ARRAY"), "array").when(t.startswith("OBJECT"), "object").otherwise("null"))


def errors(kinds: Column, params: Column) -> Column:
    """What is wrong with a call: ``kinds`` maps given parameters to JSON types (null: not an object),
    ``params`` lists its tool's (param, type, required)."""
    given = F.map_keys(kinds)
    missing = F.transform(F.filter(params, lambda p: p["required"] & ~F.array_contains(given, p["param"])),
                          lambda p: F.concat(F.lit("missing "), p["param"]))

    def wrong(p):
        kind = F.element_at(kinds, p["param"])
        fits = (kind == p["type"]) | ((p["type"] == "number") & (kind == "integer"))
        return F.array_contains(given, p["param"]) & ~fits

    typed = F.transform(F.filter(params, wrong), lambda p: F.concat(F.lit("type "), p["param"]))
    names = F.transform(params, lambda p: p["param"])
    unknown = F.transform(F.array_except(given, names), lambda k: F.concat(F.lit("unknown "), k))
    return (F.when(params.isNull(), F.array(F.lit("no schema")))
            .when(kinds.isNull(), F.array(F.lit("not an object")))
            .otherwise(F.array_sort(F.concat(missing, typed, unknown))))


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame, copies: bool = False) -> DataFrame:
    """One row for each call identifier, call without one and orphan result; with ``copies`` one also for each
    further call and result of an identifier.

    ``calls``: conv_id, call_id (string), turn, name, arguments (JSON text), parent_id;
    ``results``: conv_id, call_id, turn, content; ``schemas``: name, param, type, required.

    Columns: conv_id, call_id, turn, parent_id, name, level, status (linked, no_result, orphan_result,
    no_id, cycle, duplicate_call, duplicate_result), valid, errors, result_turn, n_calls, n_results, json.
    """
    calls = calls.select("conv_id", F.col("call_id").cast("string").alias("call_id"), "turn",
                         F.col("name").cast("string").alias("name"), F.col("arguments").cast("string").alias("arguments"),
                         F.col("parent_id").cast("string").alias("parent_id"))
    every_call = _numbered(calls, "_call_uid")
    named = materialize(_first(every_call, ["turn", "name", "arguments", "parent_id", "_call_uid"], "n_calls"), "calls")
    answers = results.select("conv_id", F.col("call_id").cast("string").alias("call_id"),
                             F.col("turn").alias("result_turn"), F.col("content").cast("string").alias("content"))
    every_result = _numbered(answers, "_result_uid")
    known = materialize(_first(every_result, ["result_turn", "content", "_result_uid"], "n_results"), "results")
    nameless = calls.where("call_id is null").withColumn("n_calls", F.lit(1).cast("long"))
    lost = answers.where("call_id is null").withColumn("n_results", F.lit(1).cast("long"))
    depth = levels(named).withColumn("has_level", F.lit(True))
    linked = _linked(_linked(named, depth, "left"), known, "full")
    rows = linked.withColumn("copy", F.lit(None).cast("string"))
    if copies and not named.where("n_calls > 1").isEmpty():
        rows = rows.unionByName(_copies(every_call, linked, "_call_uid", "n_calls", "duplicate_call"),
                                allowMissingColumns=True)
    if copies and not known.where("n_results > 1").isEmpty():
        rows = rows.unionByName(_copies(every_result, linked, "_result_uid", "n_results", "duplicate_result"),
                                allowMissingColumns=True)
    rows = rows.unionByName(nameless.withColumn("level", F.lit(0).cast("long")), allowMissingColumns=True)
    rows = rows.unionByName(lost, allowMissingColumns=True)
    wanted = schemas.select(F.col("name").alias("tool"), "param", "type", "required").distinct() \
        .where("tool is not null and param is not null") \
        .groupBy("tool").agg(F.array_sort(F.collect_list(F.struct(
            "param", "type", F.coalesce("required", F.lit(False)).alias("required")))).alias("params"))
    rows = rows.join(wanted, rows["name"] == wanted["tool"], "left")
    rows = rows.withColumn("parsed", F.try_parse_json("arguments"))
    rows = rows.withColumn("parsed", F.when(F.schema_of_variant("parsed").startswith("OBJECT"), F.col("parsed")))
    kinds = F.transform_values(F.col("parsed").cast("map<string,variant>"),
                               lambda _, v: json_kind(F.schema_of_variant(v)))
    is_call = F.coalesce(F.col("copy") == "duplicate_call", F.col("n_calls").isNotNull())
    status = (F.when(F.col("copy").isNotNull(), F.col("copy")).when(~is_call, "orphan_result").when(F.col("call_id").isNull(), "no_id")
              .when(F.col("level").isNull(), "cycle").when(F.col("n_results").isNull(), "no_result")
              .otherwise("linked"))
    rows = rows.withColumn("errors", F.when(is_call, errors(kinds, F.col("params")))).withColumn("status", status)
    rows = rows.withColumn("valid", F.when(is_call, F.size("errors") == 0))
    canonical = F.to_json(F.struct(F.col("parsed").alias("arguments"), F.col("conv_id").alias("conversation"),
                                   F.col("call_id").alias("id"), "level", "name", F.col("content").alias("result"),
                                   "status", "turn"), {"ignoreNullFields": "false"})
    zero = F.lit(0).cast("long")
    return rows.select("conv_id", "call_id", "turn", "parent_id", "name", "level", "status", "valid", "errors",
                       "result_turn", F.coalesce("n_calls", zero).alias("n_calls"),
                       F.coalesce("n_results", zero).alias("n_results"), canonical.alias("json"))


def ordered(linked: DataFrame, partitions: int) -> DataFrame:
    """Rows in topological order, dealt by ranges of it: parents come before what follows from them, and a
    hot conversation takes several partitions."""
    keys = ["conv_id", "level", "turn", "call_id"]
    return linked.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
