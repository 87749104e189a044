"""Product codes of vectors: Lloyd rounds over distinct integer parts.

A component x becomes floor(scale * x). Vectors are cut into equal consecutive parts; at each part position equal parts are one row with the number of
vectors that have it (combined before the shuffle, so copies of a vector cost nothing), and the rounds run over these weighted distinct
rows only. A position's codebook starts as that part of the vectors with the smallest ids; a round gives each distinct part its nearest entry
(squared Euclidean distance, ties to the lower index) and replaces each entry by floor(weighted sum / weight). Codebooks have a fixed
number of entries, so they are the only thing that the driver and every task hold. At the end codes and errors of the distinct parts are joined back
to the vectors; a part that a fixed share of the vectors has is looked up by broadcast (there can be few of those), the others by a shuffle.

Null vectors and those with a null, NaN or infinite component are dropped. Vectors with another number of components than the kept one with the smallest
id, a number that isn't a multiple of ``parts`` (or 0), or an integer of ``LARGE`` or more in size keep their row with null codes and error, and don't count
anywhere. Rows with a null id come last among the ids; equal ids are ordered by their vectors. Repeated rows are coded each. With fewer vectors than entries
there are so many entries. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.scratch import Scratch
from quillon.llm.skew import lookup

#: Integers below this in size keep squared distances of 64 components within 64 bits.
LARGE = 1 << 27
#: Distances that a task holds at once.
CELLS = 1 << 20


@dataclass
class Compressed:
    """rows: the table's columns, ``codes`` (array<int>) and ``error`` (long), of whose names own columns are replaced; codebooks: (part, entry, component)."""

    rows: DataFrame
    codebooks: np.ndarray

    def codebooks_text(self) -> str:
        return ",".join(map(str, self.codebooks.ravel().tolist()))

    def codebooks_sha256(self) -> str:
        return hashlib.sha256(self.codebooks_text().encode()).hexdigest()


def _nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to each row's nearest entry."""
    at, far = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    step = max(1, CELLS // max(1, book.size))
    for lo in range(0, len(x), step):
        d = ((x[lo : lo + step, None, :] - book[None]) ** 2).sum(axis=2)
        at[lo : lo + step] = d.argmin(axis=1)
        far[lo : lo + step] = d.min(axis=1)
    return at, far


def _coded(batch: pa.RecordBatch, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Position, components, entry and squared distance of a batch of parts."""
    pos = batch.column("pos").to_numpy().astype(np.int64)
    x = batch.column("part").flatten().to_numpy().reshape(len(pos), books.shape[2])
    at, far = np.empty(len(pos), np.int64), np.empty(len(pos), np.int64)
    for p in np.unique(pos):
        own = np.flatnonzero(pos == p)
        at[own], far[own] = _nearest(x[own], books[p])
    return pos, x, at, far


def _round(parts: DataFrame, books: np.ndarray) -> np.ndarray:
    """New codebooks: sums and weights by entry, added up within each batch and then by Spark; entries without a part stay."""
    n, k, width = books.shape
    sums = [f"s{j}" for j in range(width)]

    def run(batches):
        for b in batches:
            pos, x, at, _ = _coded(b, books)
            w = b.column("weight").to_numpy()
            total = np.zeros((n * k, width + 1), np.int64)
            np.add.at(total, pos * k + at, np.c_[w, x * w[:, None]])
            used = np.flatnonzero(total[:, 0])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (used, *total[used].T)], names=["cell", "weight", *sums])

    schema = "cell long, weight long, " + ", ".join(f"{s} long" for s in sums)
    out = books.reshape(n * k, width).copy()
    for r in parts.mapInArrow(run, schema).groupBy("cell").agg(*(F.sum(c).alias(c) for c in ("weight", *sums))).collect():
        out[r["cell"]] = [r[s] // r["weight"] for s in sums]
    return out.reshape(books.shape)


def _finite(v: Column) -> Column:
    return v.isNotNull() & F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x))


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> Compressed:
    scratch = Scratch(df.sparkSession, "vectors")
    v = F.col(f"`{vector_col}`")
    cols = [c for c in df.columns if c not in ("codes", "error")]
    whole = F.transform(v, lambda x: F.when(F.abs(x.cast("double") * scale) < LARGE, F.floor(x.cast("double") * scale)))
    rows = df.where(_finite(v)).select(F.struct(*(F.col(f"`{c}`") for c in cols)).alias("row"), F.col(f"`{id_col}`").alias("id"), whole.alias("ints"), F.monotonically_increasing_id().alias("number"))
    rows = scratch.keep(rows, "rows")  # numbers are fixed from here on
    usable = rows.where((F.size("ints") > 0) & (F.size("ints") % parts == 0) & ~F.exists("ints", lambda x: x.isNull()))
    order = (F.asc_nulls_last("id"), F.col("ints"))
    first = usable.orderBy(*order).select(F.size("ints").alias("n")).first()
    dim = first["n"] if first else parts
    usable = usable.where(F.size("ints") == dim)
    seeds = [r["ints"] for r in usable.orderBy(*order).limit(entries).select("ints").collect()]
    width = dim // parts
    books = np.array(seeds, np.int64).reshape(len(seeds), parts, width).transpose(1, 0, 2)
    total = usable.count()
    if not total:
        return Compressed(rows.select("row.*", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("long").alias("error")), books)

    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice("ints", p * width + 1, width))
    each = usable.select("number", F.posexplode(cut).alias("pos", "part"))
    distinct = scratch.keep(each.groupBy("pos", "part").agg(F.count("*").alias("weight")), "distinct")
    for _ in range(rounds):
        books = _round(distinct, books)
    final = books

    def run(batches):
        for b in batches:
            _, _, at, far = _coded(b, final)
            yield pa.RecordBatch.from_arrays([b.column("pos"), b.column("part"), b.column("weight"), pa.array(at.astype(np.int32)), pa.array(far)], names=["at", "piece", "weight", "entry", "far"])

    part = distinct.schema["part"].dataType.simpleString()
    known = scratch.keep(distinct.mapInArrow(run, f"at int, piece {part}, weight long, entry int, far long"), "coded")
    found = lookup(each, known, {"pos": "at", "part": "piece"}, "weight", parts * total)
    codes = found.groupBy("number").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "entry"))), lambda x: x["entry"]).alias("codes"), F.sum("far").alias("error"))
    out = scratch.keep(rows.select("row", "number").join(codes, "number", "left").select("row", "codes", "error"), "out")
    return Compressed(out.select("row.*", "codes", "error"), books)


def group_errors(rows: DataFrame, group_col: str, out_col: str = "group_error") -> DataFrame:
    """``rows`` of ``compress`` with the sum of all errors of their group (nulls are one group) in ``out_col``, which replaces a column of that name; a group of any size isn't gathered in one task."""
    rows = rows.drop(out_col)
    each = rows.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"), F.col(f"`{group_col}`").alias("group"), "error")
    sums = each.groupBy(F.col("group").alias("of")).agg(F.sum("error").alias("total"), F.count("*").alias("uses"))
    return lookup(each, sums, {"group": "of"}, "uses", rows.count()).select("row.*", F.col("total").alias(out_col))
