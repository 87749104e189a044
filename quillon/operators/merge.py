"""Upsert, validation and snapshots in place of a mutable table."""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators.dedup import keep_last


class ConstraintError(ValueError):
    """Rows break a table's rules; nothing was published."""


class LostUpdateError(RuntimeError):
    """Another writer published first; nothing was published here. The merge can be done again."""


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: tuple[str, ...]
    schema: str
    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    preserve: tuple[str, ...] = ("id", "created_at")
    #: Expressions over key columns: a stored table is kept in parts by their values, and each of those in so many buckets by the whole key.
    parts: tuple[str, ...] = ()
    buckets: int = 1
    #: (columns, table, its columns): values that the other table must have. Rows with a null among them refer to nothing.
    references: tuple[tuple[tuple[str, ...], TableSpec, tuple[str, ...]], ...] = ()

    def part(self, df: DataFrame) -> Column:
        """The number of each row's part, a function of its key. Two values of ``parts`` may share a number; that only makes a part larger."""

        def plain(c: str) -> Column:  # -0.0 equals 0.0
            return F.col(c) + F.lit(0.0) if df.schema[c].dataType.typeName() in ("double", "float") else F.col(c)

        group = F.pmod(F.xxhash64(*(F.expr(x) for x in self.parts)), F.lit(1 << 40)) if self.parts else F.lit(0)
        return (group * self.buckets + (F.pmod(F.xxhash64(*map(plain, self.key)), F.lit(self.buckets)) if self.buckets > 1 else 0)).cast("long")


def upsert(target: DataFrame, source: DataFrame, key: list[str], preserve: tuple[str, ...] = ("id", "created_at"), order: list[str] | None = None, null_keys: str = "equal") -> DataFrame:
    """``target`` with ``source`` merged in by ``key``.

    Columns that the source lacks, and preserved ones, keep the target's values in matched rows. Of source rows with
    one key the last by ``order`` counts; without one the greatest by its other columns, in their order. ``null_keys``: "equal" merges null with null,
    "distinct" inserts such rows anew each time.
    """
    src = keep_last(source, key, order or [c for c in source.columns if c not in key] or key)
    src = src.select(*(c for c in target.columns if c in src.columns))
    s, t = src.alias("s"), target.alias("t")
    same = F.lit(True)
    for k in key:
        a, b = F.col(f"t.{k}"), F.col(f"s.{k}")
        same = same & (a.eqNullSafe(b) if null_keys == "equal" else a == b)
    both = t.withColumn("_t", F.lit(True)).join(s.withColumn("_s", F.lit(True)), same, "full_outer")

    def value(c: str) -> Column:
        if c not in src.columns:
            return F.col(f"t.{c}")
        if c in preserve:
            return F.when(F.col("_t"), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
        return F.when(F.col("_s"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))

    return both.select(*(value(c).cast(target.schema[c].dataType).alias(c) for c in target.columns))


def violations(df: DataFrame, spec: TableSpec, whole: DataFrame | None = None) -> dict[str, int]:
    """Counts of broken rules, in one pass and one grouped count for each unique key.

    ``whole``: the table that ``df`` is some parts of. A key lies in one part, so keys are counted in ``df`` alone; other unique columns are compared with
    those of the whole table.
    """
    checks = {f"{c} is null": F.count_if(F.col(c).isNull()) for c in dict.fromkeys(spec.not_null)}
    checks |= {f"{c} out of domain": F.count_if(~F.col(c).isin(*v)) for c, v in spec.domains.items()}
    out = df.agg(*(c.alias(n) for n, c in checks.items())).first().asDict() if checks else {}
    for cols in (spec.key, *spec.unique):
        rows = df if whole is None or cols == spec.key else whole.select(*cols).join(df.select(*cols).distinct(), list(cols), "left_semi")
        out[f"{', '.join(cols)} repeated"] = rows.where(" and ".join(f"`{c}` is not null" for c in cols)).groupBy(*cols).count().where("count > 1").count()
    return {k: v for k, v in out.items() if v}


def orphans(df: DataFrame, cols: tuple[str, ...], other: DataFrame, other_cols: tuple[str, ...]) -> DataFrame:
    """Rows of ``df`` whose values in ``cols``, none of them null, aren't in ``other``."""
    known = other.select(*(F.col(b).alias(a) for a, b in zip(cols, other_cols, strict=True)))
    return df.where(" and ".join(f"`{c}` is not null" for c in cols)).join(known, list(cols), "left_anti")


def validate(df: DataFrame, spec: TableSpec, whole: DataFrame | None = None) -> DataFrame:
    if bad := violations(df, spec, whole):
        raise ConstraintError(f"{spec.name}: {bad}")
    return df


class Snapshots:
    """Numbered pointer files in one folder, each naming a snapshot folder beside it; the highest number is the current one.

    A pointer is written under another name and then renamed to its number, which fails if the number is taken. So readers see a whole old or a whole new
    snapshot, a writer that stops halfway changes nothing, and of two writers that started from one number the second gets an error.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def number(self) -> int:
        """0 where there is none."""
        return max((int(m[1]) for x in self.names() if (m := re.fullmatch(r"v-(\d{12})\.json", x))), default=0)

    def manifest(self, number: int) -> dict:
        """What the pointer with this number says."""
        return json.loads("".join(r.value for r in self.spark.read.text(f"{self.folder}/v-{number:012d}.json").collect()))

    def current(self, number: int | None = None) -> str | None:
        """The folder of the snapshot with this number, or of the highest."""
        n = self.number() if number is None else number
        return f"{self.folder}/{self.manifest(n)['snapshot']}" if n else None

    def new(self) -> str:
        return f"{self.folder}/s-{uuid.uuid4().hex}"

    def delete(self, path: str) -> None:
        self._fs().delete(self.spark._jvm.org.apache.hadoop.fs.Path(path), True)

    def names(self, folder: str = "") -> list[str]:
        fs, path = self._fs(), self._path(folder)
        return [x.getPath().getName() for x in fs.listStatus(path)] if fs.exists(path) else []

    def expire(self, keep: int) -> list[str]:
        """Deletes all but the last ``keep`` pointers and the snapshot folders that none of those refers to, and returns the folders' names. Readers of older ones fail
        from then on, and so does a writer that hasn't published yet: its folder goes too, and its files are missed."""
        last = self.number()
        kept = [n for n in range(max(1, last - keep + 1), last + 1) if f"v-{n:012d}.json" in self.names()]
        used = {x for n in kept for m in (self.manifest(n),) for x in (m["snapshot"], *m.get("parts", {}).values())}
        gone = [x for x in self.names() if x.startswith("s-") and x not in used]
        for x in (*gone, *(x for x in self.names() if re.fullmatch(r"v-\d{12}\.json", x) and int(x[2:14]) not in kept)):
            self.delete(f"{self.folder}/{x}")
        return gone

    def publish(self, path: str, after: int, **more) -> None:
        """Makes ``path`` number ``after`` + 1; ``more`` goes into the pointer."""
        jvm, temporary = self.spark._jvm, self._path(f"next-{uuid.uuid4().hex}.json")
        out = self._fs().create(temporary, False)
        out.write(bytearray(json.dumps({"snapshot": path.rpartition("/")[2], **more}).encode()))
        out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs().getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(temporary, self._path(f"v-{after + 1:012d}.json"), options)
        except Py4JJavaError as e:
            self._fs().delete(temporary, False)
            if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
                raise LostUpdateError(f"{self.folder}: number {after + 1} is taken") from None
            raise


#: Columns that get the time of the merge where a row is new and the source doesn't have them.
STAMPS = ("created_at", "updated_at")


class SnapshotStore:
    """Tables as immutable Parquet snapshots under one root, each in the parts that its spec names.

    A pointer says for each part which snapshot folder holds it. A merge writes its source once, by part, reads and writes only the parts that the source has rows
    of, validates what was written and only then publishes a pointer to the new parts and the old others (see ``Snapshots``). So it costs what
    the touched parts hold, whatever the table holds. What the driver holds is a line for each part; choose ``parts`` and ``buckets`` so that there
    are thousands at most. A hot part is written by several tasks (rebalanced), in several files.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _snapshots(self, name: str) -> Snapshots:
        return Snapshots(self.spark, f"{self.root}/{name}")

    def exists(self, name: str) -> bool:
        return self._snapshots(name).number() > 0

    def init(self, spec: TableSpec) -> None:
        """An empty table, unless there is one."""
        if not self.exists(spec.name):
            self._publish(spec, self.spark.createDataFrame([], spec.schema), 0)

    def parts(self, spec: TableSpec, number: int | None = None) -> dict[int, str]:
        """The snapshot folder of each part."""
        snapshots = self._snapshots(spec.name)
        n = snapshots.number() if number is None else number
        return {int(k): v for k, v in snapshots.manifest(n)["parts"].items()} if n else {}

    def _read(self, spec: TableSpec, parts: dict[int, str]) -> DataFrame:
        paths = [f"{self.root}/{spec.name}/{folder}/_part={p}" for p, folder in sorted(parts.items())]
        return self.spark.read.schema(spec.schema).parquet(*paths) if paths else self.spark.createDataFrame([], spec.schema)

    def read(self, spec: TableSpec) -> DataFrame:
        return self._read(spec, self.parts(spec))

    def merge(self, spec: TableSpec, source: DataFrame, order: list[str] | None = None) -> bool:
        """False where the source is empty and nothing was done."""
        snapshots = self._snapshots(spec.name)
        number = snapshots.number()
        staged = f"{snapshots.folder}/d-{uuid.uuid4().hex}"
        kinds = self.spark.createDataFrame([], spec.schema).schema
        source = source.withColumns({k: F.col(k).cast(kinds[k].dataType) for k in spec.key})  # a part goes by the table's types
        try:
            source.withColumn("_part", spec.part(source)).write.partitionBy("_part").parquet(staged)
            touched = {int(x[6:]) for x in snapshots.names(staged.rpartition("/")[2]) if x.startswith("_part=")}
            if not touched:
                return False
            delta = self.spark.read.schema(source.schema).parquet(staged)
            target = self._read(spec, {p: f for p, f in self.parts(spec, number).items() if p in touched})
            stamps = [c for c in STAMPS if c in target.columns and c not in delta.columns]
            delta = delta.withColumns({c: F.current_timestamp().cast(target.schema[c].dataType) for c in stamps})
            self._publish(spec, upsert(target, delta, list(spec.key), (*spec.preserve, *stamps), order), number)
            return True
        finally:
            snapshots.delete(staged)

    def _publish(self, spec: TableSpec, df: DataFrame, after: int) -> None:
        """Makes ``df``, the rows of some parts, those parts' contents."""
        snapshots = self._snapshots(spec.name)
        path = snapshots.new()
        df.withColumn("_part", spec.part(df)).hint("rebalance", "_part").write.partitionBy("_part").parquet(path)
        folder = path.rpartition("/")[2]
        new = {int(x[6:]): folder for x in snapshots.names(folder) if x.startswith("_part=")}
        parts = self.parts(spec, after) | new
        try:
            written = validate(self._read(spec, new), spec, self._read(spec, parts) if spec.unique else None)
            for cols, other, other_cols in spec.references:
                if n := orphans(written, cols, self.read(other), other_cols).count():
                    raise ConstraintError(f"{spec.name}: {n} rows have no row in {other.name} by {', '.join(cols)}")
            snapshots.publish(path, after, parts={str(p): f for p, f in parts.items()})
        except (ConstraintError, LostUpdateError):
            snapshots.delete(path)
            raise

    def expire(self, spec: TableSpec, keep: int = 2) -> list[str]:
        """Deletes what only older states than the last ``keep`` need (see ``Snapshots.expire``)."""
        return self._snapshots(spec.name).expire(keep)
