"""Membership filters, lookups, windows between events and as-of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.operators.scan import last_so_far


def members(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is among ``keys``; the optimiser broadcasts keys only when their size allows."""
    return df.join(keys.select(on).distinct(), on, "left_semi")


def non_members(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return df.join(keys.select(on), on, "left_anti")


def with_event_within(df: DataFrame, events: DataFrame, on: str, at: str, event_at: str, before: str, partitions: int | None = None) -> DataFrame:
    """Rows with an event of the same key at most ``before`` (an interval) after them; null keys and times have none.

    The next event at or after a row is carried to it from behind over both sides in one order, so work grows with rows, however many events a key has.
    ``partitions``: see ``scan``, for keys that don't fit one task.
    """
    left = df.where(F.col(on).isNotNull() & F.col(at).isNotNull()).select(F.col(on).alias("k"), F.col(at).alias("t"), F.lit(0).alias("side"), F.struct(*df.columns).alias("left"))
    kind = left.schema["left"].dataType
    right = events.where(F.col(on).isNotNull() & F.col(event_at).isNotNull()).select(F.col(on).alias("k"), F.col(event_at).alias("t"), F.lit(1).alias("side"), F.lit(None).cast(kind).alias("left"))
    nearest = last_so_far(left.unionByName(right), ["k"], ["t", "side"], F.when(F.col("side") == 1, F.col("t")), "next", partitions, descending=True)
    return nearest.where((F.col("side") == 0) & (F.col("next") <= F.col("t") + F.expr(f"interval {before}"))).select("left.*")


def pairs_within(df: DataFrame, events: DataFrame, on: str, at: str, event_at: str, seconds: int, event: str = "event") -> DataFrame:
    """Each row with each event of the same key at most ``seconds`` after it, as a struct in ``event``: a hash join by key and bin of that width, where a row looks into its own bin and the next, so what
    is compared is within two bins' time. There are as many rows as pairs; ``with_event_within`` is the one that only asks whether there is any."""
    bins = F.floor(F.unix_micros(F.col(at).cast("timestamp")) / (seconds * 1_000_000))
    left = df.select(F.struct(*df.columns).alias("left"), F.explode(F.array(bins, bins + 1)).alias("bin"))
    right = events.select(F.struct(*events.columns).alias("right"), F.floor(F.unix_micros(F.col(event_at).cast("timestamp")) / (seconds * 1_000_000)).alias("event_bin"))
    t, u = F.col(f"left.`{at}`"), F.col(f"right.`{event_at}`")
    same = (F.col(f"left.`{on}`") == F.col(f"right.`{on}`")) & (F.col("bin") == F.col("event_bin")) & (u >= t) & (u <= t + F.expr(f"interval {seconds} seconds"))
    return left.join(right, same).select("left.*", F.col("right").alias(event))


def as_of(df: DataFrame, facts: DataFrame, on: str, at: str, fact_at: str, value: str, out: str, row_key: list[str], tie: str | None = None, partitions: int | None = None) -> DataFrame:
    """The latest fact not after each row, else the earliest there is, else null. Rows with a null key get the facts with a null key.

    Both sides go through one union in the order of key and time, over which the last fact so far is carried row by row; the earliest
    fact is a grouped minimum, combined before its exchange. So work grows with rows, not with pairs. A key's rows are
    sorted in one task, which spills; with ``partitions`` (see ``scan``) they lie in many.
    """
    left = df.select(F.col(on).alias("_on"), F.col(at).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(facts.schema[value].dataType).alias("_v"), F.lit(None).cast("string").alias("_tie"), F.struct(*df.columns).alias("_row"))
    t = F.lpad(F.col(tie).cast("string"), 20, "0") if tie else F.lit(None).cast("string")
    right = facts.select(F.col(on).alias("_on"), F.col(fact_at).alias("_at"), F.lit(0).alias("_side"), F.col(value).alias("_v"), t.alias("_tie"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"))
    both = last_so_far(left.unionByName(right), ["_on"], ["_at", "_side", "_tie"], F.when(F.col("_side") == 0, F.struct("_v")), "_last", partitions)
    earliest = right.groupBy(F.col("_on").alias("_key")).agg(F.min_by(F.struct("_v"), F.struct("_at", "_tie")).alias("_first"))
    rows = both.where("_side = 1").join(earliest, F.col("_on").eqNullSafe(F.col("_key")), "left")
    return rows.select("_row.*", F.coalesce("_last", "_first")["_v"].alias(out))


def joined_flags(flags: dict[str, Column], sep: str = ",") -> Column:
    """Names of the true flags as one text."""
    return F.array_join(F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in flags.items()))), sep)
