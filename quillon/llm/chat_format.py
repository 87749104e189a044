"""Chat formatting with tool-call linking, in DataFrame operations only.

Messages are one table: (conv_id, turn, role, text, call_id, name, arguments, answers, after). A message with a
``call_id`` calls tool ``name`` with JSON ``arguments``; one with ``answers`` is the result of that call;
``after`` lists the calls whose results a call builds on. Identifiers hold within a conversation.

* Results meet calls by a hash join on (conv_id, identifier).
* Levels give the topological order: a call's level is above that of every call it comes after, a result shares the
  call's level, other messages keep the level of the last call before them. (level, turn) sorts a
  conversation so that every result follows its call and every call follows what it builds on. Where a conversation's calls
  only build on earlier ones, the order of turns is such an order and levels are its numbers, whatever the chain's length.
  Other conversations get theirs by repeated joins (a call is one level above the highest it comes after). A round settles all calls
  whose predecessors are settled and lets the others skip predecessors that have one predecessor themselves, so a plain chain of n calls takes about
  log n rounds; only calls that each build on several unsettled ones need a round a level. Calls on a cycle, or after one, get no level.
* Arguments are valid if they are a JSON object with all required keys, no unknown ones and the stated types.
* A message's canonical JSON has sorted keys, no white space and only the escapes that JSON asks for.

Statuses: ok, no_result (a call without one), no_call (a result without one), repeated_call (an identifier called
twice: the earliest turn counts), bad_arguments, unknown_tool, cycle; null for a plain message. Nulls in conv_id or turn are
values like any other; null text is an empty text. Messages of one turn are ordered by their content, so the order of the input doesn't matter;
of rows that are equal as a whole any may come first. Other columns of the table aren't read.

One row out for each row in. Messages are dealt by range of (conversation, turn, content), so a long conversation lies in many
partitions; what runs along a conversation is taken within a partition and carried over by one row a partition (``Lane``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm.scratch import Scratch

#: Types by what schema_of_variant calls them.
_TYPES = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN", "number": "(BIGINT|DOUBLE|FLOAT|DECIMAL.*)", "array": "ARRAY.*", "object": "OBJECT.*", "null": "VOID"}

Tools = dict[str, dict[str, tuple[str, bool]]]


def argument_faults(name: Column, arguments: Column, tools: Tools) -> Column:
    """Null where the arguments fit the tool's schema {argument: (type, required)}, else what is wrong."""
    v = F.try_parse_json(F.coalesce(arguments, F.lit("null")))
    keys = F.json_object_keys(arguments)
    out = F.lit("unknown_tool")
    for tool, schema in tools.items():
        good = keys.isNotNull() & (F.size(F.array_except(keys, F.array(*map(F.lit, schema)) if schema else F.array().cast("array<string>"))) == 0)
        for key, (kind, required) in schema.items():
            found = F.schema_of_variant(F.try_variant_get(v, f"$.{key}", "variant"))
            fits = F.coalesce(found.rlike(f"^{_TYPES[kind]}$"), F.lit(False))
            good &= fits if required else (fits | ~F.array_contains(keys, key))
        out = F.when(name == tool, F.when(F.coalesce(v.isNotNull() & good, F.lit(False)), F.lit(None).cast("string")).otherwise("bad_arguments")).otherwise(out)
    return out


def canonical(arguments: Column) -> Column:
    """Sorted keys at every depth and no white space; null where it isn't JSON."""
    return F.to_json(F.try_parse_json(arguments))


def in_lanes(rows: DataFrame, order: list, scratch: Scratch) -> DataFrame:
    """``rows``, written, with seq: numbers in the order asked for, whose bits from 33 up name a range partition."""
    keyed = rows.withColumns({f"_o{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order)})
    keys = [f"_o{i}" for i in range(len(order))]
    return scratch.keep(keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*keys).withColumn("seq", F.monotonically_increasing_id()), "rows")


class Lane:
    """What runs along conversations over rows with columns conv, seq, whose upper bits are the number of a range partition.

    A conversation's rows in one partition are one group; groups before a partition are one row each, so no task holds a long conversation.
    """

    def __init__(self, rows: DataFrame):
        self.rows = rows.withColumn("lane", F.shiftright("seq", 33))

    def carried(self, value: Column, name: str, fold: Callable = F.max, through: int = 0) -> DataFrame:
        """``rows`` with ``name``, the maximum or sum of ``value`` over the conversation's rows so far: the row itself included, or up to the one before it (``through`` = -1)."""
        rows = self.rows.withColumn("value", value)
        before = Window.partitionBy("conv").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
        groups = rows.groupBy("conv", "lane").agg(fold("value").alias("whole")).select("conv", "lane", fold("whole").over(before).alias("carry"))
        here = Window.partitionBy("conv", "lane").orderBy("seq").rowsBetween(Window.unboundedPreceding, through)
        both = F.greatest("carry", "own") if fold is F.max else F.coalesce("carry", F.lit(0)) + F.coalesce("own", F.lit(0))
        return rows.withColumn("own", fold("value").over(here)).join(groups, ["conv", "lane"]).withColumn(name, both).drop("value", "own", "carry", "lane")


def _levels(calls: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, id, level) of the calls that aren't on or after a cycle. Names of calls that don't exist don't hold a call up."""
    numbered = Lane(calls.select("conv", "id", "after", F.col("first_seq").alias("seq"))).carried(F.lit(1), "level", F.sum)
    calls = scratch.keep(numbered.select("conv", "id", "after", F.col("level").cast("int").alias("level")), "places")
    at = calls.select("conv", F.col("id").alias("before"), F.col("level").alias("before_level"))
    edges = calls.select("conv", "id", "level", F.explode("after").alias("before")).join(at, ["conv", "before"])
    forward = scratch.keep(edges.where("before_level >= level").select("conv").distinct(), "forward")
    if forward.isEmpty():
        return calls.select("conv", "id", "level")
    late = calls.join(forward, "conv", "left_semi")
    return calls.join(forward, "conv", "left_anti").select("conv", "id", "level").unionByName(_longest_chains(late.drop("level"), scratch))


def _longest_chains(calls: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges say that a call lies at least ``far`` levels above another."""
    edges = calls.select("conv", "id", F.explode("after").alias("before"))
    edges = scratch.keep(edges.join(calls.select(F.col("conv"), F.col("id").alias("before")), ["conv", "before"]).distinct().select("conv", "id", "before", F.lit(1).alias("far")), "edges")
    done = calls.join(edges, ["conv", "id"], "left_anti").select("conv", "id", F.lit(1).alias("level"))
    done = scratch.keep(done, "level")
    while not edges.isEmpty():
        left = edges.join(done.select("conv", F.col("id").alias("before"), "level"), ["conv", "before"], "left")
        ready = left.groupBy("conv", "id").agg(F.count_if(F.col("level").isNull()).alias("open"), F.max(F.col("level") + F.col("far")).alias("level")).where("open = 0").select("conv", "id", "level")
        ready = scratch.keep(ready, "ready")
        if ready.isEmpty():
            # Without a cycle some call has only settled predecessors.
            break
        rest = edges.join(ready, ["conv", "id"], "left_anti")
        # A predecessor that isn't settled and has one predecessor itself gives way to that.
        one = rest.groupBy("conv", F.col("id").alias("before")).agg(F.count("*").alias("n"), F.first("before").alias("up"), F.first("far").alias("more")).where("n = 1").drop("n")
        rest = rest.join(one, ["conv", "before"], "left").groupBy("conv", "id", F.coalesce("up", "before").alias("to")).agg(F.max(F.col("far") + F.coalesce("more", F.lit(0))).alias("far"))
        rest = scratch.keep(rest.select("conv", "id", F.col("to").alias("before"), "far"), "edges")
        both = scratch.keep(done.unionByName(ready), "level")
        for t in (edges, done, ready):
            scratch.drop(t)
        edges, done = rest, both
    return done


def format_chat(messages: DataFrame, tools: Tools) -> DataFrame:
    """conv_id, turn, role, call_id, answers, status, level and json, one row per message."""
    scratch = Scratch(messages.sparkSession, "chat")
    m = messages.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("\0")).alias("conv"), "conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), "call_id", "name", "arguments", "answers", F.coalesce("after", F.array().cast("array<string>")).alias("after"))
    m = in_lanes(m, ["conv", "turn", F.xxhash64("role", "text", "call_id", "name", "arguments", "answers", "after")], scratch)
    calls = m.where("call_id is not null")
    first = calls.groupBy("conv", F.col("call_id").alias("id")).agg(F.min(F.struct("seq", "after")).alias("f")).select("conv", "id", F.col("f.seq").alias("first_seq"), F.col("f.after").alias("after"))
    first = scratch.keep(first, "calls")
    levels = _levels(first, scratch)
    known = first.select("conv", "id", "first_seq").join(levels, ["conv", "id"], "left")
    results = m.where("answers is not null").select("conv", F.col("answers").alias("id")).distinct().withColumn("answered", F.lit(True))
    known = known.join(results, ["conv", "id"], "left").select("conv", F.col("id").alias("link"), "first_seq", "level", "answered")
    # A message without a link meets nothing; by its own number it isn't dealt to one task with all others of its conversation.
    m = m.withColumn("link", F.coalesce("call_id", "answers"))
    own = F.when(F.col("link").isNull(), F.concat(F.lit("\0"), F.col("seq").cast("string"))).otherwise(F.col("conv"))
    m = m.withColumn("at", own).join(known.select(F.col("conv").alias("at"), "link", "first_seq", "level", "answered"), ["at", "link"], "left").drop("at")
    is_call = F.col("call_id").isNotNull()
    status = (
        F.when(is_call & (F.col("seq") != F.col("first_seq")), "repeated_call")
        .when(is_call & F.col("level").isNull(), "cycle")
        .when(is_call, F.coalesce(argument_faults(F.col("name"), F.col("arguments"), tools), F.when(F.col("answered"), "ok").otherwise("no_result")))
        .when(F.col("answers").isNotNull(), F.when(F.col("first_seq").isNull(), "no_call").when(F.col("level").isNull(), "cycle").otherwise("ok"))
    )
    m = Lane(scratch.keep(m.withColumn("status", status), "linked")).carried(F.col("level"), "so_far")
    level = F.when(F.col("link").isNull(), F.coalesce("so_far", F.lit(0))).otherwise(F.col("level"))
    parts = F.array_compact(F.array(
        F.when(is_call, F.concat(F.lit('"arguments":'), F.coalesce(canonical(F.col("arguments")), F.lit("null")))),
        F.when(is_call, _field("call_id")),
        _field("text", "content"),
        F.when(is_call, _field("name")),
        F.when(F.col("answers").isNotNull(), _field("answers", "result_of")),
        _field("role"),
    ))
    return m.select("conv_id", "turn", "role", "call_id", "answers", "status", level.alias("level"), F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")).alias("json"))


def _field(column: str, key: str | None = None) -> Column:
    """'"key":"value"' with the value as a JSON string."""
    return F.expr(f"substr(to_json(struct(`{column}` as `{key or column}`)), 2, length(to_json(struct(`{column}` as `{key or column}`))) - 2)")
