"""Delimited members of ZIP files as a data source: one partition a file, members chosen before anything is read.

Rows come with year (from the file's name), member, pos (row number in the member) and the wanted columns as strings, so order-dependent
steps have an ordinal. Unsafe member names are skipped. A ZIP is decoded by one task, so big deliveries should be repartitioned
after the scan.
"""

from __future__ import annotations

import csv
import fnmatch
import io
import re
import zipfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.clean import na_to_null

#: CSV dialect of the deliveries.
DELIMITER, ENCODING = ";", "latin-1"


def safe(name: str) -> bool:
    return ".." not in name and not name.startswith("/")


def wanted(names: list[str], pattern: str) -> list[str]:
    """CSV members that a pattern takes: "first" is the first alone, else a "|"-separated list of globs on lower case."""
    names = [n for n in names if safe(n) and n.lower().endswith(".csv")]
    if pattern == "first":
        return names[:1]
    return [n for n in names if any(fnmatch.fnmatch(n.lower(), p) for p in pattern.lower().split("|"))]


def read_zip(content: bytes, pattern: str, columns: list[str]) -> Iterator[tuple[str, int, list[str | None]]]:
    """(member, pos, values); columns that a member lacks are null."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for name in wanted(z.namelist(), pattern):
            with z.open(name) as raw:
                rows = csv.reader(io.TextIOWrapper(raw, ENCODING, newline=""), delimiter=DELIMITER)
                at = {c: i for i, c in enumerate(next(rows, []))}
                for pos, row in enumerate(rows):
                    if row:
                        yield name, pos, [row[at[c]] if c in at and at[c] < len(row) else None for c in columns]


def zip_csv(spark: SparkSession, paths: str | list[str], columns: list[str], members: str = "*.csv") -> DataFrame:
    """year, member, pos and ``columns``. Files are found and read by Spark, so any store that it knows will do; NA tokens are null."""
    files = spark.read.format("binaryFile").load(paths).select("path", "content")

    def run(batches):
        import pyarrow as pa

        names = ["year", "member", "pos", *columns]
        types = [pa.int32(), pa.string(), pa.int64(), *[pa.string()] * len(columns)]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content")):
                year = re.search(r"(\d{4})\D*$", path.rsplit("/", 1)[-1])
                rows = []
                for member, pos, values in read_zip(content.as_py(), members, columns):
                    rows.append((int(year[1]) if year else None, member, pos, *values))
                    if len(rows) >= 10_000:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    schema = "year int, member string, pos long, " + ", ".join(f"`{c}` string" for c in columns)
    return na_to_null(files.mapInArrow(run, schema))


#: Members of the reference form by table, and keys of the buyback delivery by part of the name.
FORM_MEMBERS = {"fre_capital_social": "capital_social", "fre_posicao_acionaria": "posicao_acionaria", "fre_remuneracao_orgao": "remuneracao_maxima_minima_media"}
BUYBACK_KEYS = ("quantidades", "intermediarios")


def form_members(table: str) -> str:
    """The reference form's member for a table: one of its name and year, and no longer name that begins alike."""
    return f"fre_cia_aberta_{FORM_MEMBERS[table]}_[0-9][0-9][0-9][0-9].csv"


def buyback_key(member: Column) -> Column:
    """quantidades or intermediarios where the name has it, else programas."""
    out = F.lit("programas")
    for k in reversed(BUYBACK_KEYS):
        out = F.when(member.contains(k), k).otherwise(out)
    return out


def statement_members(source: str, kinds: list[str]) -> str:
    """Consolidated statement members of a source (dfp or itr)."""
    return "|".join(f"{source.lower()}_cia_aberta_{k.lower()}_con_*.csv" for k in kinds)
