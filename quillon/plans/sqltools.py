"""Read-only SQL tools: query, list_tables, describe_table."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import SparkSession

from quillon.functions.loose import register
from quillon.plans.sqlguard import Guard, NotAllowed

__all__ = ["NotAllowed", "check", "describe_table", "list_tables", "query"]


def check(spark: SparkSession, sql: str, strict: bool = False, loose: bool = False) -> None:
    """One statement that only reads tables and views of the catalog by what ``sqlguard`` lists. ``strict`` takes SELECT as the first word only; else WITH and VALUES pass too. ``loose`` lets
    the functions of ``functions.loose`` be called."""
    if strict and not sql.strip().upper().startswith("SELECT"):
        raise NotAllowed("only SELECT is allowed")
    Guard(spark, {t.lower() for t in list_tables(spark)}, own=register(spark) if loose else frozenset()).check(sql)


def query(spark: SparkSession, sql: str, strict: bool = False, loose: bool = False) -> Iterator[dict]:
    """Rows as dicts, as many as there are: they come to the driver partition by partition while they're read. The statement is checked at once."""
    check(spark, sql, strict, loose)
    return (r.asDict() for r in spark.sql(sql).toLocalIterator())


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def describe_table(spark: SparkSession, table: str, key: tuple[str, ...] = ()) -> list[dict]:
    if not re.fullmatch(r"\w+", table):
        raise NotAllowed(f"not a table name: {table!r}")
    pk = {c: i for i, c in enumerate(key, 1)}
    return [{"cid": i, "name": f.name, "type": f.dataType.simpleString(), "notnull": int(not f.nullable), "dflt_value": None, "pk": pk.get(f.name, 0)} for i, f in enumerate(spark.table(table).schema)]
