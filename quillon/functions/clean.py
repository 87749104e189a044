"""Cleaning of loosely typed text as native column expressions. Garbage gives null; only ``scaled`` raises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cell texts that count as missing.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: Monetary scale and order of the reported year.
SCALES = {"MIL": 1000, "UNIDADE": 1}
ORDERS = {"ÚLTIMO": "Último", "PENÚLTIMO": "Penúltimo"}

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def na_to_null(df: DataFrame) -> DataFrame:
    """All string columns with NA tokens as null."""
    return df.select(*(F.when(~F.col(f.name).isin(*NA_TOKENS), F.col(f.name)).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f.name) for f in df.schema))


def to_date(c: Column) -> Column:
    """yyyy-m-d, then d/m/yyyy; never month first."""
    t = F.trim(c)
    return F.coalesce(F.try_to_date(t, "yyyy-M-d"), F.try_to_date(t, "d/M/yyyy"))


def to_double(c: Column) -> Column:
    """Decimal comma or point; thousands separators aren't read."""
    t = F.replace(c, F.lit(","), F.lit("."))
    return F.when(t.rlike(_NUMBER), F.trim(t).try_cast("double"))


def to_long(c: Column) -> Column:
    """By way of a double, cut off toward zero."""
    return to_double(c).try_cast("bigint")


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def scaled(value: Column, scale: Column) -> Column:
    """``value`` times the scale; null stays null, and an unknown scale is an error when the row is computed."""
    out = F.raise_error(F.concat(F.lit("Escala desconhecida: "), F.coalesce(scale, F.lit("null")))).cast("double")
    for name, factor in SCALES.items():
        out = F.when(scale == name, value * factor).otherwise(out)
    return out


def year_order(c: Column) -> Column:
    """Title case of known orders; others pass unchanged and fail validation later."""
    up = F.upper(F.trim(c))
    out = up
    for name, title in ORDERS.items():
        out = F.when(up == name, F.lit(title)).otherwise(out)
    return out


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def version_or_one(c: Column) -> Column:
    return F.coalesce(to_long(c), F.lit(1)).cast("int")


def format_cnpj(c: Column) -> Column:
    """NN.NNN.NNN/NNNN-NN of up to 14 characters, padded with zeros; null where longer or all zero."""
    t = F.trim(c)
    padded = F.lpad(t, 14, "0")
    return F.when((F.length(t) <= 14) & (padded != "0" * 14), F.regexp_replace(padded, r"^(..)(...)(...)(....)(..)$", r"$1.$2.$3/$4-$5"))


def base64_json(c: Column) -> Column:
    return F.base64(F.encode(F.to_json(c), "UTF-8"))


def issuer_of(ticker: Column) -> Column:
    return F.upper(F.substring(ticker, 1, 4))


def document_text(c: Column) -> Column:
    return F.replace(c, F.lit("\0"), F.lit(""))


def label(c: Column, width: int = 60) -> Column:
    """A subject as one shows it in a list: cut at ``width`` characters, empty where there is none."""
    return F.left(F.coalesce(c, F.lit("")), F.lit(width))


def long_enough(c: Column) -> Column:
    return F.coalesce(F.length(c) > 100, F.lit(False))


def in_domain(url: Column, domain: str) -> Column:
    """The host is the domain or under it."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    return F.coalesce((host == domain) | host.endswith(f".{domain}"), F.lit(False))


def ratio(x: Column, y: Column, digits: int = 3) -> Column:
    return F.round(F.try_divide(x, y), digits)
