"""Deliveries to typed tables, source files, catalog filters and event streams."""

import base64
import datetime
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from quillon import schema
from quillon.functions import clean
from quillon.operators import dedup, merge
from quillon.plans import catalog, ingest, statements
from quillon.session import root_path
from quillon.sources import files, zipcsv
from quillon.streaming import ingest as streaming


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def watch(spark):
    return spark.createDataFrame([("c",)], "cnpj string")


def delivery(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, lines in members.items():
            z.writestr(name, "\n".join(lines).encode("latin-1"))


def test_documents(spark, watch, tmp_path):
    """Only the first CSV member is read; keys must be there; the year comes from the delivery date; the last row of a key stays."""
    head = "Protocolo_Entrega;CNPJ_Companhia;Data_Entrega;Categoria;Versao;Assunto"
    body = ["p1;c;2023-05-04;Assembleia;;Ação", "p1;c;2024-01-02;Assembleia;2;NA", ";c;2024-01-02;x;1;x", "p3;c;04/05/2023;x;1;y", "p4;other;2024-01-02;x;1;x"]
    delivery(tmp_path / "ipe_cia_aberta_2023.zip", {"readme.txt": ["x"], "a.csv": [head, *body], "b.csv": [head, "p9;c;2024-01-02;x;1;x"]})
    raw = zipcsv.zip_csv(spark, str(tmp_path), head.split(";"), "first")
    got = ingest.documents(raw, watch)
    assert rows(got.select("protocolo_entrega", "versao", "ano", "assunto")) == [("p1", 2, 2024, None), ("p3", 1, 2023, "y")]
    store = merge.SnapshotStore(spark, str(tmp_path / "store"))
    assert ingest.load_each(store, schema.DOCUMENTS, [("2023", lambda: got)]) == {"2023": "merged"}
    first = store.read(schema.DOCUMENTS).first()
    assert first["created_at"] is not None and first["texto_extraido"] is None and first["nome_companhia"] is None
    with pytest.raises(KeyError):
        ingest.documents(raw.drop("Protocolo_Entrega"), watch)
    with pytest.raises(KeyError):
        ingest.load_each(store, schema.DOCUMENTS, [("bad", lambda: ingest.documents(raw.drop("Protocolo_Entrega"), watch))], contain=False)


def test_positions_movements_and_programmes(spark, watch, tmp_path):
    pos = ["Protocolo_Entrega;CNPJ_Companhia;Data_Referencia;Versao", "p1;c;2023-01-31;1"]
    names = [f.name for f in spark.createDataFrame([], schema.MOVEMENTS.schema).schema if f.name != "created_at"]
    values = {"cnpj_companhia": "c", "data_referencia": "2023-01-31", "data_movimentacao": "2023-01-05", "versao": "1", "quantidade": "10", "preco_unitario": "1.5", "volume": "15"}
    row = lambda **more: ";".join({**values, **more}.get(n, "t") for n in names)
    delivery(tmp_path / "vlmo_cia_aberta_2023.zip", {"vlmo_1.csv": ["x;y", "1;2"], "vlmo_2.csv": pos, "vlmo_con_1.csv": [";".join(names), row(volume="15"), row(volume="99"), row(quantidade="11"), row(cnpj_companhia="other")]})
    raw = zipcsv.zip_csv(spark, str(tmp_path), sorted({*pos[0].split(";"), *names} - {"cnpj_companhia", "data_referencia", "versao"}), "vlmo_*.csv")
    assert rows(ingest.positions(raw, watch).select("protocolo_entrega", "versao", "data_referencia")) == [("p1", 1, datetime.date(2023, 1, 31))]
    raw = zipcsv.zip_csv(spark, str(tmp_path), names, "*_con_*.csv").withColumnRenamed("cnpj_companhia", "CNPJ_Companhia")
    assert rows(ingest.movements(raw, watch).select("quantidade", "preco_unitario", "volume")) == [(10, 1.5, 15.0), (11, 1.5, 15.0)]
    raw = spark.createDataFrame([(2023, "recompra_programas.csv", 0, "1", "c", "2024-02-01"), (2023, "recompra_programas.csv", 1, "1", "c", "2025-02-01"), (2023, "recompra_quantidades.csv", 0, "2", "c", None)], "year int, member string, pos int, Id_Programa string, CNPJ_Companhia string, Data_Final_Prazo string")
    programmes = ingest.programmes(raw, watch)
    assert rows(programmes.select("id_programa", "data_final_prazo")) == [("1", datetime.date(2025, 2, 1))]
    assert statements.active_programmes(programmes, F.lit("2025-02-01").cast("date")).count() == 1 and statements.active_programmes(programmes, F.lit("2025-02-02").cast("date")).count() == 0


def test_source_files(spark, tmp_path):
    (tmp_path / "watch.csv").write_text("ticker,cnpj,codigo_cvm,nome_cvm,setor,status_cvm,observacao\nA,1,,Ação,s,ATIVO,\nB,VERIFICAR,,x,s,ATIVO,\n", "utf-8")
    assert rows(files.watchlist(spark, str(tmp_path / "watch.csv")).select("ticker", "nome_cvm")) == [("A", "Ação")]
    (tmp_path / "reg.csv").write_bytes('CD_CVM;DENOM_SOCIAL;SIT\n009;"AÇÃO; ""SA""";ATIVO\n8;X;CANCELADA\n7;nan;ATIVO\n'.encode("latin-1"))
    assert rows(files.registry(spark, str(tmp_path / "reg.csv")).select("CD_CVM", "DENOM_SOCIAL")) == [("009", 'AÇÃO; "SA"'), ("7", None)]
    (tmp_path / "cat.csv").write_text("ticker,indices\nA,\n")
    assert rows(files.catalog_csv(spark, str(tmp_path / "cat.csv"))) == [("A", "")]
    (tmp_path / "r.json").write_text('{"results": [{"a": "1"}, {"a": null}]}')
    assert rows(files.json_results(spark, str(tmp_path / "r.json"), "a: string")) == [(0, "1"), (1, None)]
    files.write_csv(spark.range(3), str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 3
    assert json.loads(base64.b64decode(spark.range(1).select(clean.base64_json(F.struct(F.lit("é").alias("k")))).first()[0])) == {"k": "é"}
    assert list(ingest.years(2020, 2023)) == [2020, 2021, 2022, 2023] and list(ingest.years(None, 2023, "weekly")) == [2022, 2023] and list(ingest.years(None, 2023, "current")) == [2023]
    assert spark.createDataFrame([("x" * 70,), (None,)], "t string").select(clean.label(F.col("t")).alias("t")).agg(F.max(F.length("t")), F.min("t")).first() == (60, "")


def test_root_paths():
    assert root_path("data", "/home/x/") == "/home/x/data" and root_path("/abs", "/home") == "/abs" and root_path("hdfs://h/p", "/x") == "hdfs://h/p"
    for bad in ("", "sqlite:///x.db", "http://h/x", "s3a://", "1x://y"):
        with pytest.raises(ValueError):
            root_path(bad, "/x")


def test_candidate_scopes(spark, watch):
    df = spark.createDataFrame([("A3", "IBOV,IBRX", "index", "Bancos", "1"), ("B3", "IBRX", "index", "Energia", "2"), ("C3", "", "assumed", "Bancos", "3"), ("D3", "IBOV,IBRX", "index", None, "c")], "ticker string, indices string, confidence string, setor_cvm string, cnpj string")
    got = lambda **k: [r[0] for r in rows(catalog.candidates(df, watch, **k).select("ticker"))]
    assert got(everything=True) == ["A3", "B3", "C3"] and got() == ["A3", "B3"] and got(ibov=True) == ["A3"] and got(ibrx=True) == ["A3", "B3"] and got(ibov=True, ibrx=True) == ["A3", "B3"]
    assert got(ticker="c3", ibov=True) == ["C3"] and got(everything=True, sector_like="banc") == ["A3", "C3"] and got(everything=True, skip_assumed=True) == ["A3", "B3"]
    docs = spark.createDataFrame([(str(i), "c", "Assembleia" if i % 2 else "x", datetime.date(2020, 1, 1 + i // 2)) for i in range(8)], "protocolo_entrega string, cnpj_companhia string, categoria string, data_entrega date")
    assert [r[0] for r in catalog.latest_meetings(docs, "c", 2).select("protocolo_entrega").collect()] == ["7", "5"]


def test_statement_dates_holders_and_margins(spark):
    d = lambda m: datetime.date(2023, m, 28)
    facts = spark.createDataFrame([("c", "ITR", "DRE", d(9), 1, "Último", d(m), d(9), conta, "", x) for m, conta, x in ((7, "3.01", 10.0), (1, "3.05", 4.0))], schema.STATEMENTS.schema)
    r = statements.with_margin(statements.income_statement(facts)).first()
    assert (r["dt_ini_exerc"], r["dt_fim_exerc"], r["margem_ebit"]) == (d(1), d(9), 0.4)
    held = spark.createDataFrame([("c", d(1), 1, "a", 90.0), ("c", d(2), 1, "a", 10.0), ("c", d(2), 2, "a", 20.0), ("c", d(2), 2, "b", 30.0), ("c", d(2), 2, "e", None)], "cnpj_companhia string, data_referencia date, versao int, id_acionista string, percentual_total_acoes_circulacao double")
    assert rows(statements.top_holders(held, 2).select("posicao", "id_acionista")) == [(1, "b"), (2, "a")]
    assert rows(dedup.ranked(held, ["cnpj_companhia"], [F.col("data_referencia")], "dense_rank", 1).select("id_acionista")) == [("a",)]
    none = spark.createDataFrame([("c", "DFP", d(1), None, None, None), ("c", "DFP", d(2), 5.0, None, None)], "cnpj_companhia string, fonte string, data_referencia date, divida_curto_prazo double, divida_longo_prazo double, caixa double")
    assert rows(statements.with_net_debt(none).select("divida_liquida")) == [(5.0,), (None,)]


def test_event_streams(spark, tmp_path):
    """Repeats within the watermark go; windows and sessions close when the watermark has passed them, and late rows don't count."""
    t = lambda minutes: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minutes)
    batches = [[(1, "a", t(0)), (1, "a", t(0)), (2, "a", t(50)), (3, "b", t(70))], [(2, "a", t(50)), (4, "a", t(300))], [(5, "a", t(5)), (6, "b", t(600))], [(7, "b", t(900))]]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, "id int, user string, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "in" / f"b{i}"))

    def run(make, name):
        src = spark.readStream.schema("id int, user string, ts timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        make(src).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination()
        return rows(spark.table(name))

    assert [r[0] for r in run(lambda e: streaming.deduplicated(e, ["id"]), "once")] == [1, 2, 3, 4, 6, 7]
    hours = run(lambda e: streaming.window_counts(e, ["user"]), "hours")
    assert (t(60), "b", 1) in hours and (t(300), "a", 1) in hours and all(r[0] != t(900) for r in hours)
    assert sum(r[2] for r in hours if r[0] == t(0)) in (3, 4)
    sliding = run(lambda e: streaming.window_counts(e, ["user"], slide="30 minutes"), "sliding")
    assert (t(270), "a", 1) in sliding and (t(300), "a", 1) in sliding
    sessions = run(lambda e: streaming.session_counts(e, ["user"]), "sessions")
    assert ("b", t(70), 1) in sessions and any(r[0] == "a" and r[1] == t(0) for r in sessions)


def test_a_statement_without_its_order_fails_its_part_only(spark, watch, tmp_path):
    """The order of the reported year is part of the key: rows without one change nothing, and other parts go on."""
    head = "CNPJ_CIA;DT_REFER;VERSAO;ORDEM_EXERC;DT_FIM_EXERC;CD_CONTA;DS_CONTA;VL_CONTA;ESCALA_MOEDA"
    good, bad = "c;2023-12-31;1;ÚLTIMO;2023-12-31;3.01;x;5;UNIDADE", "c;2023-12-31;1;;2023-12-31;3.02;x;6;UNIDADE"
    for name, lines in (("good", [good]), ("bad", [good, bad])):
        (tmp_path / name).mkdir()
        delivery(tmp_path / name / "dfp_cia_aberta_2023.zip", {"dfp_cia_aberta_DRE_con_2023.csv": [head, *lines]})
    store = merge.SnapshotStore(spark, str(tmp_path / "store"))
    parts = [(n, lambda n=n: ingest.statements(zipcsv.zip_csv(spark, str(tmp_path / n), head.split(";")), watch, "DFP")) for n in ("bad", "good")]
    out = ingest.load_each(store, schema.STATEMENTS, parts)
    assert out["bad"].startswith("failed") and "ordem_exercicio is null" in out["bad"] and out["good"] == "merged"
    assert rows(store.read(schema.STATEMENTS).select("cd_conta", "vl_conta")) == [("3.01", 5.0)]
