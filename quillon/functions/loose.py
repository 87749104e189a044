"""The meanings that SQL text written for SQLite expects, as column functions and as SQL functions of the session.

Spark's own operators stay as they are: 5 / 2 is 2.5, a text that is no number is an error and LIKE tells case apart. Whoever brings such queries over names the other meaning
where it is wanted: ``loose_quotient(a, b)`` for whole numbers, ``loose_like(text, pattern)`` and so on; ``register`` makes them known to SQL. They are plain
expressions, so plans stay native. Rows where a group's greatest value stands (a bare column beside max) are ``with_extreme``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_INTEGER = r"^[ \t-\r]*([+-]?[0-9]+)"
_REAL = r"^[ \t-\r]*([+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?)"
#: An escape character that no pattern has.
_NEVER = "￿"


def quotient(a: Column, b: Column) -> Column:
    """Of whole numbers, cut off toward zero; null by zero."""
    a, b = a.cast("bigint"), b.cast("bigint")
    return F.when(b != 0, F.call_function("div", a, b))


def ratio(a: Column, b: Column) -> Column:
    """Of other numbers; null by zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def remainder(a: Column, b: Column) -> Column:
    """Of both cut off to whole numbers, with the sign of the first; null by zero."""
    return F.try_mod(a.cast("bigint"), b.cast("bigint"))


def like(c: Column, pattern: Column) -> Column:
    """% and _ as in LIKE; a-z equal A-Z, other letters don't equal their capitals; no character escapes."""
    return F.like(F.translate(c, _UPPER, _LOWER), F.translate(pattern, _UPPER, _LOWER), F.lit(_NEVER))


def to_integer(c: Column) -> Column:
    """The whole number that a text begins with, else 0; beyond 64 bits the nearest that there is."""
    found = F.regexp_extract(c, _INTEGER, 1)
    number = found.try_cast("decimal(38,0)")
    bound = F.when(found.startswith("-"), F.lit(-(2**63))).otherwise(F.lit(2**63 - 1))
    return F.when(c.isNotNull(), F.when(found == "", F.lit(0)).otherwise(F.coalesce(number.try_cast("bigint"), bound)))


def to_real(c: Column) -> Column:
    """The number that a text begins with, else 0."""
    return F.when(c.isNotNull(), F.coalesce(F.regexp_extract(c, _REAL, 1).try_cast("double"), F.lit(0.0)))


def with_extreme(df: DataFrame, keys: list[str], value: str, least: bool = False) -> DataFrame:
    """One row a group: that of its greatest (least) ``value``, all columns. Ties go to the greatest (least) row by its columns in order; groups without a value keep such a row, too."""
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    by = F.struct(F.col(f"`{value}`"), row)
    return df.groupBy(*(F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys))).agg((F.min_by if least else F.max_by)(row, F.struct(F.col(f"`{value}`").isNotNull() if not least else F.col(f"`{value}`").isNull(), by)).alias("_row")).select("_row.*")


#: SQL functions: name, parameters, result and expression.
_SQL = (
    ("loose_quotient", "a bigint, b bigint", "bigint", "case when b != 0 then a div b end"),
    ("loose_ratio", "a double, b double", "double", "try_divide(a, b)"),
    ("loose_remainder", "a double, b double", "bigint", "try_mod(cast(a as bigint), cast(b as bigint))"),
    ("loose_like", "c string, p string", "boolean", f"translate(c, '{_UPPER}', '{_LOWER}') like translate(p, '{_UPPER}', '{_LOWER}') escape '{_NEVER}'"),
    ("loose_integer", "c string", "bigint", f"case when c is not null then case when regexp_extract(c, r'{_INTEGER}', 1) = '' then 0 else coalesce(try_cast(try_cast(regexp_extract(c, r'{_INTEGER}', 1) as decimal(38, 0)) as bigint), if(startswith(regexp_extract(c, r'{_INTEGER}', 1), '-'), {-(2**63 - 1)} - 1, {2**63 - 1})) end end"),
    ("loose_real", "c string", "double", f"case when c is not null then coalesce(try_cast(regexp_extract(c, r'{_REAL}', 1) as double), 0.0) end"),
)
NAMES = frozenset(name for name, *_ in _SQL)


def register(spark: SparkSession) -> frozenset[str]:
    """Makes the SQL functions known to the session, under the names that are returned."""
    for name, given, result, expression in _SQL:
        spark.sql(f"create or replace temporary function {name}({given}) returns {result} return {expression}")
    return NAMES
