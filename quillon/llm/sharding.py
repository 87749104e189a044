"""Sharding by a Feistel permutation of global row numbers, with cycle walking; DataFrame operations only.

Rows get numbers 0..n-1 in the order of (key, text CRC, size, hash of all columns): a range exchange of the whole rows, a sort
within partitions, and an offset for each partition. ``write_shards`` sends the rows on to their shards, in the order of their slots. A row number x is written as (x div b, x mod b) with
a*b >= n and a, b near the square root of n; six rounds add to one half, modulo its range, a keyed hash of the
other, which is a bijection of 0..a*b-1. Values of n and more are permuted again until they fall below n, which makes
it one of 0..n-1. Position p is shard p mod k, slot p div k, so shard counts are at most one apart and every
row's place is computable from its number, n, k and the seed.

Null keys come first; a null text has size 1 and the CRC of no bytes. Rows that are equal as a whole, however many, are dealt to several partitions by
where they were read; they may swap places, which no reader can tell (maps and variants can't be hashed: rows that differ only there may swap, too).
An empty table gives no rows. A walk of more than WALK steps, which has a chance of about n ** (1 - WALK / 2) in all, is an error, never a wrong place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm.scratch import Scratch

ROUNDS = 6
#: Steps of a walk; no walk is longer where a*b - n is less.
WALK = 64


def sides(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _permute(x: Column, n: int, seed: int) -> Column:
    a, b = sides(n)

    def keyed(half: Column, k: Column) -> Column:
        """60 bits of the MD5 of "key:half", a function that any engine has."""
        return F.conv(F.substring(F.md5(F.concat_ws(":", k.cast("string"), half.cast("string")).cast("binary")), 1, 15), 16, 10).cast("long")

    def step(acc: Column, k: Column) -> Column:
        left = F.pmod(acc["l"] + keyed(acc["r"], k), F.lit(a).cast("long"))
        right = F.pmod(acc["r"] + keyed(acc["l"], k), F.lit(b).cast("long"))
        even = k % 2 == 0
        return F.struct(F.when(even, left).otherwise(acc["l"]).alias("l"), F.when(even, acc["r"]).otherwise(right).alias("r"))

    # Bit 0 of a round's key says which half it changes.
    keys = F.array(*(F.lit(2 * (seed * ROUNDS + i) + i % 2).cast("long") for i in range(ROUNDS)))
    low = F.pmod(x, F.lit(b).cast("long"))
    start = F.struct(((x - low) / F.lit(b)).cast("long").alias("l"), low.alias("r"))
    return F.aggregate(keys, start, step, lambda s: s["l"] * F.lit(b).cast("long") + s["r"])


def permuted(x: Column, n: int, seed: int = 0) -> Column:
    """The place of row number ``x`` (long) among ``n``."""
    a, b = sides(n)
    once = _permute(x, n, seed)
    walk = min(a * b - n, WALK)
    if not walk:
        return once
    n_ = F.lit(n).cast("long")
    return F.aggregate(F.sequence(F.lit(1), F.lit(walk)), once, lambda acc, _: F.when(acc < n_, acc).otherwise(_permute(acc, n, seed)))


#: The columns that ``shard`` adds.
ADDED = ("size", "text_crc32", "row_number", "shard", "slot")


def shard(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16, seed: int = 0) -> DataFrame:
    """The rows of ``df`` with all columns and size, text_crc32, row_number, shard and slot."""
    clash = sorted({c.lower() for c in df.columns} & set(ADDED))
    if clash:
        raise ValueError(f"columns to be added are there already: {clash}")
    scratch = Scratch(df.sparkSession, "shard")
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashed = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    rows = df.select(F.struct(*df.columns).alias("row"), F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(*hashed).alias("tie"), F.monotonically_increasing_id().alias("read"))
    order = ["id", "crc", "size", "tie", "read"]
    rows = scratch.keep(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("id", "tie", "read").withColumn("at", F.monotonically_increasing_id()), "rows", "zstd")
    part = F.shiftright("at", 33)
    # One row a partition, so small whatever the input.
    sizes = rows.groupBy(part.alias("part")).count()
    offsets = sizes.withColumn("offset", F.sum("count").over(Window.orderBy("part")) - F.col("count")).select("part", "offset")
    n = rows.count()
    numbered = rows.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("row_number", F.col("offset") + F.col("at").bitwiseAND((1 << 33) - 1))
    placed = numbered.withColumn("p", permuted(F.col("row_number"), n, seed))
    # A walk that ran out of steps would give no place; none is passed on.
    p = F.when(F.col("p") < n, F.col("p")).otherwise(F.raise_error(F.lit("a cycle walk ended early; change the seed")).cast("long"))
    return placed.withColumn("p", p).select("row.*", "size", F.col("crc").alias("text_crc32"), "row_number", (F.col("p") % shards).cast("int").alias("shard"), F.expr(f"p div {shards}").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> DataFrame:
    """Writes the rows of ``shard`` as Parquet to a folder ``shard=N`` for each shard, in the order of their slots; returns what was written.

    A shard may have several files; their names follow the slots. ``path`` must not exist.
    """
    places = ["shard", "slot"]
    sharded.repartitionByRange(*places).sortWithinPartitions(*places).write.partitionBy("shard").parquet(path, compression="zstd")
    return sharded.sparkSession.read.schema(sharded.select(*(c for c in sharded.columns if c != "shard"), "shard").schema).parquet(path)
