"""Text, JSON and fetched sources, and CSV sinks."""

from __future__ import annotations

import csv
import io
import time
import urllib.error
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.clean import base64_json, na_to_null

#: Columns of the watchlist, in order.
WATCHLIST = ("ticker", "cnpj", "codigo_cvm", "nome_cvm", "setor", "status_cvm", "observacao")


def delimited(spark: SparkSession, path: str, sep: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """All columns as strings, NA tokens as null."""
    return na_to_null(spark.read.csv(path, sep=sep, header=True, encoding=encoding, quote='"', escape='"'))


def watchlist(spark: SparkSession, path: str) -> DataFrame:
    """Without rows whose id is still to be checked."""
    df = spark.read.csv(path, header=True, schema=", ".join(f"{c} string" for c in WATCHLIST), encoding="UTF-8")
    return df.where(F.coalesce(F.col("cnpj"), F.lit("")) != "VERIFICAR")


def catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True).na.fill("")


def registry(spark: SparkSession, path: str) -> DataFrame:
    return delimited(spark, path).where("SIT = 'ATIVO'")


def json_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The elements of the documents' ``results`` arrays, with their ordinal."""
    docs = spark.read.json(path, schema=f"results array<struct<{schema}>>", multiLine=True)
    return docs.select(F.posexplode("results").alias("ordinal", "r")).select("ordinal", "r.*")


def listing_url(spark: SparkSession, base: str, **payload) -> str:
    """An API address whose last part is the payload as base64 of JSON."""
    row = spark.range(1).select(base64_json(F.struct(*(F.lit(v).alias(k) for k, v in payload.items()))).alias("x"))
    return base + row.first()["x"].replace("\r\n", "")


#: The exchange's addresses, and payloads of its company list and indices.
COMPANIES_URL = "https://sistemaswebb3-listados.b3.com.br/listedCompaniesProxy/CompanyCall/GetInitialCompanies/"
INDEX_URL = "https://sistemaswebb3-listados.b3.com.br/indexProxy/indexCall/GetPortfolioDay/"
COMPANIES_PAYLOAD = {"language": "pt-br", "issuingCompany": ""}
INDEX_PAYLOADS = {
    "IBOV": {"language": "pt-br", "pageNumber": 1, "pageSize": 100, "index": "IBOV", "segment": "1"},
    "IBRX": {"language": "pt-br", "pageNumber": 1, "pageSize": 200, "index": "IBRX", "segment": "1"},
}


def _results(spark: SparkSession, body: bytes, schema: str) -> DataFrame:
    """As ``json_results``, of one answer held by the driver (a list of some hundred entries)."""
    docs = spark.createDataFrame([(body.decode("utf-8"),)], "body string").select(F.from_json("body", f"results array<struct<{schema}>>").alias("d"))
    return docs.select(F.posexplode("d.results").alias("ordinal", "r")).select("ordinal", "r.*")


def listed_companies(spark: SparkSession, get: Callable[..., bytes] | None = None) -> DataFrame:
    """The exchange's company list, with ordinal, as ``plans.catalog.equities`` takes it. A failed call is an error."""
    names = ("status", "type", "marketIndicator", "typeBDR", "cnpj", "codeCVM", "issuingCompany", "tradingName", "companyName", "segment")
    return _results(spark, fetch(listing_url(spark, COMPANIES_URL, **COMPANIES_PAYLOAD), get=get), ", ".join(f"{n}: string" for n in names))


def index_members(spark: SparkSession, index: str, get: Callable[..., bytes] | None = None) -> DataFrame:
    """(ordinal, cod, asset) of an index; no rows where the call or its answer fails, as a catalog can do without."""
    schema = "cod: string, asset: string"
    try:
        return _results(spark, fetch(listing_url(spark, INDEX_URL, **INDEX_PAYLOADS[index]), timeout=30, get=get), schema)
    except (OSError, ValueError):
        return _results(spark, b"{}", schema)


def fetch(url: str, timeout: float = 60, tries: int = 3, get: Callable[..., bytes] | None = None, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """GET on the driver. Connection errors and timeouts are tried again after 1, 2, ... s; an HTTP status error is raised at once."""

    def plain(u: str, timeout: float) -> bytes:
        with urllib.request.urlopen(u, timeout=timeout) as r:
            return r.read()

    for i in range(tries):
        try:
            return (get or plain)(url, timeout=timeout)
        except urllib.error.HTTPError:
            raise
        except (urllib.error.URLError, ConnectionError, TimeoutError):
            if i == tries - 1:
                raise
            sleep(2**i)
    raise ValueError("tries must be positive")


def write_csv(df: DataFrame, path: str) -> None:
    """A small table as one file, whole."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def append_csv(df: DataFrame, path: str, commit: bool = False) -> DataFrame:
    """Appends to the file that ``watchlist`` reads, in its column order, only where ``commit`` says so; returns what is (or would be) written.

    ``path`` is one file with a header, as people edit it; new lines (a short list, held by the driver) are added at its end, after the old
    bytes. The whole file is written beside the old one and then takes its name. A missing file begins with the header.
    """
    out = df.select(*(F.col(c).cast("string").alias(c) for c in WATCHLIST))
    if commit:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        old = b""
        if fs.exists(p):
            old = bytes(spark.read.format("binaryFile").load(path).first()["content"])
        text = io.StringIO()
        lines = csv.writer(text, lineterminator="\n")
        if not old:
            lines.writerow(WATCHLIST)
        lines.writerows(["" if v is None else v for v in r] for r in out.collect())
        new = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.new")
        stream = fs.create(new, True)
        stream.write(bytearray(old + (b"" if not old or old.endswith(b"\n") else b"\n") + text.getvalue().encode()))
        stream.close()
        jvm = spark._jvm.org.apache.hadoop.fs
        options = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
        options[0] = jvm.Options.Rename.OVERWRITE
        jvm.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(new, p, options)
    return out


def preview(df: DataFrame, rows: int = 50, width: int = 44) -> str:
    """The first rows as a table of text, cells cut at ``width``: what a run without ``commit`` shows."""
    return df._show_string(rows, width)
