"""The data source of ZIP members: partitions, pruning, big files and streams of deliveries."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from quillon import schema
from quillon.operators import merge
from quillon.plans import ingest
from quillon.sources import zipcsv, zipsource
from quillon.streaming.ingest import stream_deliveries

HEAD = "CNPJ_CIA;DT_REFER;VERSAO;ORDEM_EXERC;DT_INI_EXERC;DT_FIM_EXERC;CD_CONTA;DS_CONTA;VL_CONTA;ESCALA_MOEDA"
COLUMNS = HEAD.split(";")
rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)


def line(account, value, cnpj="c", year=2023):
    return f'{cnpj};{year}-12-31;1;ÚLTIMO;;{year}-12-31;{account};"a;b";{value};UNIDADE'


def deliver(folder, year, members, source="dfp"):
    with zipfile.ZipFile(folder / f"{source}_cia_aberta_{year}.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for name, lines in members.items():
            z.writestr(name, "\n".join([HEAD, *lines]).encode("latin-1"))


@pytest.fixture
def folder(tmp_path):
    for year in (2021, 2022, 2023):
        deliver(tmp_path, year, {f"dfp_cia_aberta_{k}_{c}_{year}.csv": [line("3.01", year, year=year), "", line("3.02", "NA", year=year)] for k in ("DRE", "BPA") for c in ("con", "ind")} | {"../evil_con_.csv": [line("1", 1)], "notes.txt": ["x"]})
    (tmp_path / "readme.txt").write_text("no delivery")
    return tmp_path


def test_rows_equal_the_whole_file_reader(spark, folder):
    pattern = zipcsv.statement_members("dfp", ["DRE", "BPA"])
    got, want = zipsource.zip_members(spark, str(folder), [*COLUMNS, "absent"], pattern), zipcsv.zip_csv(spark, f"{folder}/*.zip", [*COLUMNS, "absent"], pattern)
    assert rows(got.drop("place")) == rows(want) and got.count() == 12
    assert got.rdd.getNumPartitions() == 6  # one a member
    assert {(r["member"], r["place"]) for r in got.where("year = 2021").collect()} == {("dfp_cia_aberta_DRE_con_2021.csv", 0), ("dfp_cia_aberta_BPA_con_2021.csv", 2)}
    assert zipsource.zip_members(spark, f"{folder}/*_2022.zip", COLUMNS, "first").count() == 2
    assert zipsource.zip_members(spark, f"{folder}/nothing", COLUMNS).count() == 0


def test_filters_choose_partitions(spark, folder, capsys):
    df = zipsource.zip_members(spark, str(folder), COLUMNS)
    some = df.where("year = 2022 and member like '%DRE%' and CD_CONTA = '3.01'")
    assert some.rdd.getNumPartitions() == 2 and some.count() == 2
    some.explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo" in plan and "2022" in plan and "StringContains" in plan
    assert df.where(F.col("year").isin(2021, 2023)).rdd.getNumPartitions() == 8
    # An archive of another year isn't even opened.
    with open(folder / "dfp_cia_aberta_2020.zip", "w") as f:
        f.write("no archive")
    again = lambda: zipsource.zip_members(spark, str(folder), COLUMNS)
    assert again().where("year = 2022").count() == 8
    with pytest.raises(Exception, match="zip"):
        again().count()


def test_a_file_over_two_gigabytes(spark, tmp_path):
    """An archive behind 2.5 GB of other bytes (a hole in the file): more than a cell of a table can hold."""
    path = tmp_path / "dfp_cia_aberta_2023.zip"
    with open(path, "wb") as f:
        f.truncate(2_500_000_000)
    with zipfile.ZipFile(path, "a", zipfile.ZIP_DEFLATED) as z:
        z.writestr("dfp_cia_aberta_DRE_con_2023.csv", "\n".join([HEAD, *(line("3.01", i) for i in range(25_000))]).encode("latin-1"))
    assert os.path.getsize(path) > 2**31
    got = zipsource.zip_members(spark, str(tmp_path), COLUMNS)
    assert got.agg(F.count("*"), F.sum(F.col("VL_CONTA").cast("long")), F.max("pos")).first() == (25_000, sum(range(25_000)), 24_999)


def test_last_member_is_the_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "vlmo_2023.zip", "w") as z:
        for name, key in (("z.csv", "p1"), ("a.csv", "p2")):
            z.writestr(name, f"Protocolo_Entrega;CNPJ_Companhia\n{key};c")
    raw = zipsource.zip_members(spark, str(tmp_path), ["Protocolo_Entrega", "CNPJ_Companhia"])
    assert rows(ingest.last_member(raw).select("Protocolo_Entrega")) == [("p2",)]


def test_only_strings_and_ordinals(spark, folder):
    zipsource.register(spark)
    with pytest.raises(Exception, match="strings"):
        spark.read.format("zip_members").schema("year int, VL_CONTA double").load(str(folder)).count()


def test_a_delivery_that_comes_again_is_merged_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    watch = spark.createDataFrame([("c",)], "cnpj string")
    store = merge.SnapshotStore(spark, str(tmp_path / "store"))
    seen = []

    def take(df):
        seen.append(sorted({r["year"] for r in df.select("year").collect()}))
        store.merge(schema.STATEMENTS, ingest.statements(df, watch, "DFP").drop(*ingest.ORDER))

    def run():
        stream_deliveries(spark, str(folder), COLUMNS, zipcsv.statement_members("dfp", ["DRE"]), take, str(tmp_path / "ck")).awaitTermination()
        return {(r["cd_conta"], r["data_referencia"].year): r["vl_conta"] for r in store.read(schema.STATEMENTS).collect()}

    name = "dfp_cia_aberta_DRE_con_{}.csv".format
    for year in (2022, 2023):
        deliver(folder, year, {name(year): [line("3.01", 10, year=year), line("3.02", 5, year=year)]})
    assert run() == {("3.01", 2022): 10, ("3.02", 2022): 5, ("3.01", 2023): 10, ("3.02", 2023): 5}
    assert run() and len(seen) == 1  # nothing new
    before = store.parts(schema.STATEMENTS)
    deliver(folder, 2023, {name(2023): [line("3.01", 11), line("3.02", 5), line("3.05", 1)]})
    want = {("3.01", 2022): 10, ("3.02", 2022): 5, ("3.01", 2023): 11, ("3.02", 2023): 5, ("3.05", 2023): 1}
    assert run() == want and seen[1:] == [[2023]]
    assert run() == want and len(seen) == 2
    after = store.parts(schema.STATEMENTS)
    assert len(after) == 2 and sum(after[p] != before[p] for p in after) == 1
