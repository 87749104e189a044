"""A Spark data source of delimited members of ZIP files: one partition a member, chosen before anything but the archives' lists is read.

    register(spark)
    spark.read.format("zip_members").schema(...).option("members", "*_con_*.csv").load(folder)

The schema's columns year (from the file's name), member, place (number of the member among all of the archive) and pos (row in the member) are ordinals; all others are strings, null
where a member lacks them. Filters on year and member choose partitions: a year that isn't asked for isn't opened. A task seeks to its member and streams
rows in batches, so neither the archive nor the member is ever held, whatever its size. Unsafe names are skipped. Files are read through Arrow's file systems (local, HDFS, S3,
GCS); for other stores there is ``zipcsv.zip_csv``, which takes each file from Spark as a whole.

As a stream its offsets are the deliveries with size and time: a delivery that comes again changed is taken again, whole; one that went away is left alone.
"""

from __future__ import annotations

import csv
import fnmatch
import io
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition, StringContains, StringEndsWith, StringStartsWith

from quillon.functions.clean import NA_TOKENS
from quillon.sources.zipcsv import DELIMITER, ENCODING, wanted

ORDINALS = {"year": "int", "member": "string", "place": "int", "pos": "bigint"}
BATCH_ROWS = 10_000


@dataclass
class Member(InputPartition):
    path: str
    name: str
    place: int
    year: int | None


def _system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def deliveries(path: str) -> list[fs.FileInfo]:
    """ZIP files of a folder, of a folder and a pattern of names, or one file; by name."""
    system, at = _system(path)
    info = system.get_file_info(at)
    if info.type == fs.FileType.File:
        return [info]
    folder, pattern = (at, "*.zip") if info.type == fs.FileType.Directory else (at.rpartition("/")[0], at.rpartition("/")[2])
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted((f for f in found if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, pattern)), key=lambda f: f.path)


def year_of(path: str) -> int | None:
    """The last four digits of a file's name."""
    found = re.search(r"(\d{4})\D*$", path.rpartition("/")[2])
    return int(found[1]) if found else None


def _members(root: str, paths: list[str], options) -> list[Member]:
    system, _ = _system(root)
    out = []
    for path in paths:
        with system.open_input_file(path) as f, zipfile.ZipFile(f) as z:
            names = z.namelist()
        out += [Member(path, n, names.index(n), year_of(path)) for n in wanted(names, options.get("members", "*.csv"))]
    return out


def _rows(root: str, part: Member | None, fields: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of the member's rows in the schema's columns. Spark asks for None where there are no partitions."""
    if part is None:
        return
    system, _ = _system(root)
    own = [c for c in fields if c not in ORDINALS]
    types = [{"year": pa.int32(), "place": pa.int32(), "pos": pa.int64()}.get(c, pa.string()) for c in fields]

    def batch(pos: list[int], rows: list[list[str | None]]) -> pa.RecordBatch:
        given = {"year": [part.year] * len(pos), "member": [part.name] * len(pos), "place": [part.place] * len(pos), "pos": pos, **dict(zip(own, zip(*rows), strict=True))}
        return pa.RecordBatch.from_arrays([pa.array(given[c], t) for c, t in zip(fields, types, strict=True)], names=fields)

    with system.open_input_file(part.path) as f, zipfile.ZipFile(f) as z, z.open(part.name) as raw:
        lines = csv.reader(io.TextIOWrapper(raw, ENCODING, newline=""), delimiter=DELIMITER)
        at = {c: i for i, c in enumerate(next(lines, []))}
        places = [at.get(c, 1 << 30) for c in own]
        pos, rows = [], []
        for i, line in enumerate(lines):
            if line:
                pos.append(i)
                rows.append([line[p] if p < len(line) else None for p in places])
            if len(pos) == BATCH_ROWS:
                yield batch(pos, rows)
                pos, rows = [], []
        if pos:
            yield batch(pos, rows)


class ZipReader(DataSourceReader):
    def __init__(self, options, fields: list[str]):
        self.options, self.fields, self.filters = options, fields, []

    @staticmethod
    def _takes(f: Filter, values: dict) -> bool:
        x = values[f.attribute[0]]
        if isinstance(f, EqualTo):
            return x == f.value
        if isinstance(f, In):
            return x in f.value
        if x is None:
            return False
        return x.startswith(f.value) if isinstance(f, StringStartsWith) else x.endswith(f.value) if isinstance(f, StringEndsWith) else f.value in x

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, (EqualTo, In, StringStartsWith, StringEndsWith, StringContains)) and f.attribute in (("year",), ("member",)):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Member]:
        root = self.options["path"]
        of_year = [f for f in self.filters if f.attribute == ("year",)]
        paths = [d.path for d in deliveries(root) if all(self._takes(f, {"year": year_of(d.path)}) for f in of_year)]
        return [m for m in _members(root, paths, self.options) if all(self._takes(f, {"year": m.year, "member": m.name}) for f in self.filters)]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        return _rows(self.options["path"], partition, self.fields)


class ZipStream(DataSourceStreamReader):
    def __init__(self, options, fields: list[str]):
        self.options, self.fields = options, fields

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {d.path: [d.size, d.mtime_ns] for d in deliveries(self.options["path"])}

    def partitions(self, start: dict, end: dict) -> list[Member]:
        return _members(self.options["path"], [p for p in sorted(end) if start.get(p) != end[p]], self.options)

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        return _rows(self.options["path"], partition, self.fields)


class ZipMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return ", ".join(f"{c} {t}" for c, t in ORDINALS.items())

    def _fields(self, schema) -> list[str]:
        bad = [f.name for f in schema if f.dataType.simpleString() != ORDINALS.get(f.name, "string")]
        if bad:
            raise ValueError(f"columns of a member are strings: {bad}")
        return [f.name for f in schema]

    def reader(self, schema) -> ZipReader:
        return ZipReader(self.options, self._fields(schema))

    def streamReader(self, schema) -> ZipStream:
        return ZipStream(self.options, self._fields(schema))


def register(spark: SparkSession) -> None:
    """Makes the format known to the session and lets Python data sources take filters there."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ZipMembers)


def _schema(columns: list[str]) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in {**ORDINALS, **dict.fromkeys(columns, "string")}.items())


def _with_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """NA tokens of the members' own columns as null; ordinals as they are, so filters on them reach the source."""
    return df.select(*ORDINALS, *(F.when(~F.col(f"`{c}`").isin(*NA_TOKENS), F.col(f"`{c}`")).alias(c) for c in columns))


def zip_members(spark: SparkSession, path: str, columns: list[str], members: str = "*.csv") -> DataFrame:
    """year, member, place, pos and ``columns``."""
    register(spark)
    return _with_nulls(spark.read.format("zip_members").schema(_schema(columns)).option("members", members).load(path), columns)


def zip_stream(spark: SparkSession, path: str, columns: list[str], members: str = "*.csv") -> DataFrame:
    """The same of deliveries as they come, or come again."""
    register(spark)
    return _with_nulls(spark.readStream.format("zip_members").schema(_schema(columns)).option("members", members).load(path), columns)
