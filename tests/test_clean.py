"""Cleaning expressions, one row a case."""

import datetime

import pytest
from pyspark.sql import functions as F

from quillon.functions import clean, sectors


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("raw", "want"), [("2024-03-31", "2024-03-31"), ("31/03/2024", "2024-03-31"), ("2024-3-1", "2024-03-01"), ("1/3/2024", "2024-03-01"), ("", None), (None, None), ("nan", None), ("20240301", None), ("2024-02-30", None)])
def test_date(spark, raw, want):
    assert one(spark, raw, clean.to_date) == (want and datetime.date.fromisoformat(want))


@pytest.mark.parametrize(("raw", "want"), [("1234.56", 1234.56), ("1234,56", 1234.56), ("1.234,56", None), ("1,234", 1.234), (" 12 ", 12.0), ("1e3", 1000.0), ("5f", None), ("5d", None), ("-", None), ("--1", None), ("0x10", None), ("+7", 7.0), ("nan", None), ("", None), (None, None)])
def test_double(spark, raw, want):
    assert one(spark, raw, clean.to_double) == want


@pytest.mark.parametrize(("raw", "want"), [("42", 42), ("1,0", 1), ("1.9", 1), ("-1.9", -1), ("nan", None), ("", None)])
def test_long(spark, raw, want):
    assert one(spark, raw, clean.to_long) == want


@pytest.mark.parametrize(("value", "scale", "want"), [("5000", "MIL", 5000000.0), ("5000", "UNIDADE", 5000.0), ("1234.56", "MIL", 1234560.0), ("", "MIL", None), ("nan", "MIL", None)])
def test_scale(spark, value, scale, want):
    df = spark.createDataFrame([(value, scale)], "v string, s string")
    got = df.select(clean.scaled(clean.to_double(F.col("v")), F.col("s")).alias("y")).first()["y"]
    assert got == (want if want is None else pytest.approx(want))


def test_unknown_scale_is_an_error(spark):
    df = spark.createDataFrame([("5000", "MILHAR")], "v string, s string")
    with pytest.raises(Exception, match="Escala desconhecida"):
        df.select(clean.scaled(clean.to_double(F.col("v")), F.col("s"))).collect()


def test_nan_and_tokens(spark):
    assert one(spark, float("nan"), clean.nan_to_null, "double") is None
    assert one(spark, 0.0, clean.nan_to_null, "double") == 0.0
    df = spark.createDataFrame([("N/A", "007"), ("", "x")], "a string, b string")
    assert [tuple(r) for r in clean.na_to_null(df).collect()] == [(None, "007"), (None, "x")]


@pytest.mark.parametrize(("raw", "want"), [("123", "00.000.000/0001-23"), ("0", None), ("123456789012345", None), (None, None), (" 11222333000181 ", "11.222.333/0001-81")])
def test_cnpj(spark, raw, want):
    assert one(spark, raw, clean.format_cnpj) == want


def test_orders_sectors_domains(spark):
    assert one(spark, " último", clean.year_order) == "Último"
    assert one(spark, "x", clean.year_order) == "X"
    assert one(spark, "Têxtil e Vestuário ", sectors.sector) == "Varejo"
    assert one(spark, "Desconhecido", sectors.sector) == "Outros"
    assert one(spark, "https://www.rad.cvm.gov.br/a?b", lambda c: clean.in_domain(c, "cvm.gov.br")) is True
    assert one(spark, "https://evilcvm.gov.br/", lambda c: clean.in_domain(c, "cvm.gov.br")) is False
