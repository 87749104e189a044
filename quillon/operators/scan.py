"""Running values over rows in order, for keys of any size.

A window function takes a key's rows in one task. With ``partitions`` the rows are dealt by ranges of (key, order) instead, so a key that holds a third of the table, or
the whole of it (no key at all), lies in many partitions. Each range is scanned on its own, from a checkpoint that fixes who has which rows; of each range and key one
value is left; these are scanned by key, which gives what comes into a range from those before it. Only a range's first key can have had rows
before, so what comes in is at most a row a range, and is broadcast. Rows equal in key and order stay in one range: name tie-breaking columns too.

Null keys are one key, nulls in an order column come first (last where it descends). Values are those of a window function with the same key and order, but for the
order in which floating sums are added. ``out`` replaces a column of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.session import with_checkpoints

#: Rows of a bin of ``last_rows``, at least.
BIN_ROWS = 20_000


def _order(names: list[str], descending: bool, at: str = "") -> list[Column]:
    return [F.desc(f"{at}`{c}`") if descending else F.asc(f"{at}`{c}`") for c in names]


def _windowed(df: DataFrame, keys: list[str], order: list[str], descending: bool, out: str, running) -> DataFrame:
    w = Window.partitionBy(*(F.col(f"`{k}`") for k in keys)).orderBy(*_order(order, descending)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, running(w))


def _scanned(df: DataFrame, keys: list[str], order: list[str], descending: bool, value: Column, out: str, partitions: int, running, of_piece, into) -> DataFrame:
    """``running(column, window)`` within a range, ``of_piece(column, i)`` of a range's rows of a key, ``into(before, here)`` puts them together."""
    with_checkpoints(df.sparkSession)
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), value.alias("v"))
    own = [f"row.`{k}`" for k in keys]
    by = [*map(F.asc, own), *_order(order, descending, "row.")]
    dealt = rows.repartitionByRange(partitions, *by).sortWithinPartitions(*by).withColumn("i", F.monotonically_increasing_id()).withColumn("p", F.shiftright("i", 33)).checkpoint()
    names = [f"k{j}" for j in range(len(keys))]
    keyed = dealt.withColumns({n: F.col(k) for n, k in zip(names, own, strict=True)})
    pieces = keyed.groupBy("p", *names).agg(of_piece(F.col("v"), F.col("i")).alias("total"))
    before = running(F.col("total"), Window.partitionBy(*names).orderBy("p").rowsBetween(Window.unboundedPreceding, -1))
    coming = pieces.withColumn("coming", before).where("coming is not null").select(F.col("p").alias("to"), *(F.col(n).alias(f"of_{n}") for n in names), "coming")
    here = keyed.withColumn("here", running(F.col("v"), Window.partitionBy("p", *names).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    same = F.col("p") == F.col("to")
    for n in names:
        same &= F.col(n).eqNullSafe(F.col(f"of_{n}"))
    cols = [F.col(f"row.`{c}`").alias(c) for c in df.columns if c != out]
    return here.join(F.broadcast(coming), same, "left").select(*cols, into(F.col("coming"), F.col("here")).alias(out))


def last_so_far(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, partitions: int | None = None, descending: bool = False) -> DataFrame:
    """The last ``value`` that isn't null among a key's rows up to each."""

    def running(c: Column, w) -> Column:
        return F.last(c, ignorenulls=True).over(w)

    if partitions is None:
        return _windowed(df, keys, order, descending, out, lambda w: running(value, w))
    return _scanned(df, keys, order, descending, value, out, partitions, running, lambda v, i: F.max_by(v, F.when(v.isNotNull(), i)), lambda before, here: F.coalesce(here, before))


def sum_so_far(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, partitions: int | None = None, descending: bool = False) -> DataFrame:
    """The sum of ``value`` over a key's rows up to each; null as long as all are."""

    def running(c: Column, w) -> Column:
        return F.sum(c).over(w)

    def into(before: Column, here: Column) -> Column:
        return F.coalesce(before + here, before, here)

    if partitions is None:
        return _windowed(df, keys, order, descending, out, lambda w: running(value, w))
    return _scanned(df, keys, order, descending, value, out, partitions, running, lambda v, i: F.sum(v), into)


def _binned(df: DataFrame, keys: list[str], order: list[Column], value: Column, bins: Column, out: str, frame) -> DataFrame:
    """A window function by key and bin; ``bins``: the row's own bin, and others that see it only as a row before theirs."""
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), value.alias("v"), F.posexplode(bins).alias("seen", "bin"))
    w = frame(Window.partitionBy(*(F.col(f"row.`{k}`") for k in keys), "bin").orderBy(*order))
    cols = [F.col(f"row.`{c}`").alias(c) for c in df.columns if c not in (out, "_place")]
    return rows.withColumn("x", F.sum("v").over(w)).where("seen = 0").select(*cols, F.col("x").alias(out))


def last_rows(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, rows: int, partitions: int) -> DataFrame:
    """The sum over the last ``rows`` rows of a key, each itself included: rows are numbered by a scan, and a window is taken over bins of numbers, each with the rows before it that its first ones need."""
    size = max(rows, BIN_ROWS)
    placed = sum_so_far(df, keys, order, F.lit(1).cast("long"), "_place", partitions)
    own = F.floor((F.col("_place") - 1) / size)
    bins = F.when((F.col("_place") - 1) % size > size - rows, F.array(own, own + 1)).otherwise(F.array(own))
    return _binned(placed, keys, [F.col("row._place")], value, bins, out, lambda w: w.rowsBetween(1 - rows, 0))


def last_span(df: DataFrame, keys: list[str], order: str, value: Column, out: str, span: int) -> DataFrame:
    """The sum over a key's rows at most ``span`` before each by a numeric column, as a window function over bins of that width, each with the one before it. Rows with a null there are one bin."""
    own = F.floor(F.col(f"`{order}`") / span)
    return _binned(df, keys, [F.col(f"row.`{order}`")], value, F.array(own, own + 1), out, lambda w: w.rangeBetween(-span, 0))
