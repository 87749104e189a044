"""Dedup, merge, snapshots, statements, catalog, full text, SQL tools, sources and streaming on small frames."""

import datetime
import sqlite3
import time
import urllib.error
import zipfile

import pytest
from pyspark.sql import functions as F

from quillon import schema
from quillon.operators import dedup, fts, joins, merge
from quillon.plans import catalog, ingest, sqlguard, sqltools, statements
from quillon.sources import files, pdf, zipcsv
from quillon.streaming.ingest import stream_upsert

SPEC = merge.TableSpec("companies", ("cnpj",), "cnpj string, ticker string, created_at string", ("cnpj", "ticker"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_keep_first_and_last_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "b", 2), ("k", "c", 3)], "k string, v string, pos int")
    assert rows(dedup.keep_first(df, ["k"], ["pos"]).select("v")) == [("a",), ("c",)]
    assert rows(dedup.keep_last(df, ["k"], ["pos"]).select("v")) == [("b",), ("c",)]


def test_snapshot_merge(spark, tmp_path):
    store = merge.SnapshotStore(spark, str(tmp_path))
    make = lambda *r: spark.createDataFrame(list(r), SPEC.schema)
    store.init(SPEC)
    assert store.read(SPEC).count() == 0
    assert not store.merge(SPEC, make())
    store.merge(SPEC, make(("1", "OLD", "2020-01-01")))
    store.merge(SPEC, make(("1", "NEW", "2099-01-01"), ("2", "X", None)))
    assert rows(store.read(SPEC)) == [("1", "NEW", "2020-01-01"), ("2", "X", None)]
    with pytest.raises(merge.ConstraintError):
        store.merge(SPEC, make(("3", None, None)))
    assert store.read(SPEC).count() == 2
    store.merge(SPEC, spark.createDataFrame([("1", "FIRST", 1), ("1", "LAST", 2)], "cnpj string, ticker string, pos int"), ["pos"])
    assert rows(store.read(SPEC).where("cnpj = '1'").select("ticker", "created_at")) == [("LAST", "2020-01-01")]


def test_upsert_keeps_missing_columns_and_null_keys(spark):
    t = spark.createDataFrame([("a", "text", "old"), (None, "t2", "old")], "k string, texto string, v string")
    s = spark.createDataFrame([("a", "new"), (None, "new")], "k string, v string")
    assert rows(merge.upsert(t, s, ["k"])) == [("a", "text", "new"), (None, "t2", "new")]
    assert merge.upsert(t, s, ["k"], null_keys="distinct").count() == 3


def test_income_statement_takes_latest_version_by_account(spark):
    d = datetime.date(2023, 12, 31)
    f = lambda fonte, v, ordem, conta, x: ("c", fonte, "DRE", d, v, ordem, None, d, conta, "", float(x))
    facts = spark.createDataFrame([f("DFP", 1, "Último", "3.01", 100), f("DFP", 2, "Último", "3.01", 110), f("DFP", 1, "Último", "3.05", 20), f("DFP", 3, "Penúltimo", "3.01", 999), f("ITR", 1, "Último", "3.01", 50)], schema.STATEMENTS.schema)
    got = {r["fonte"]: r for r in statements.income_statement(facts).collect()}
    assert (got["DFP"]["receita_liquida"], got["DFP"]["ebit"], got["DFP"]["lucro_liquido"]) == (110.0, 20.0, None)
    assert (got["ITR"]["receita_liquida"], got["ITR"]["ebit"]) == (50.0, None)


def test_balance_and_net_debt(spark):
    d = datetime.date(2023, 12, 31)
    f = lambda tipo, conta, x: ("c", "DFP", tipo, d, 1, "Último", None, d, conta, "", float(x))
    facts = spark.createDataFrame([f("BPA", "1", 100), f("BPA", "1.01.01", 10), f("BPP", "2.01.04", 30), f("BPP", "2.02.01", 40)], schema.STATEMENTS.schema)
    r = statements.with_net_debt(statements.balance_sheet(facts)).first()
    assert (r["ativo_total"], r["divida_liquida"], r["variacao"]) == (100.0, 60.0, None)


def test_per_share_series(spark):
    got = statements.per_share(spark.createDataFrame([(2016, 946892882, 219388000.0, 118432000.0, 0.0), (2025, 1136271458, 1223349000.0, 298736000.0, 692929000.0)], "ano int, shares long, net_income double, jcp double, dividends double"))
    assert rows(got.select("ano", "eps", "dps_jcp", "dps_div", "payout")) == [(2016, 0.232, 0.125, 0.0, 54.0), (2025, 1.077, 0.263, 0.61, 81.1)]
    g = statements.cagr(got.withColumn("k", F.lit(1)), ["k"], "ano", "eps").first()
    assert round(g["cagr"], 3) == 0.186


def test_as_of_falls_back_to_the_earliest(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 1), (3, "b", 1)], "id int, k string, t int")
    facts = spark.createDataFrame([("a", 2, 20), ("a", 4, 40), ("a", 9, None)], "k string, t int, v int")
    assert rows(joins.as_of(left, facts, "k", "t", "t", "v", "v", ["id"]).select("id", "v")) == [(1, 40), (2, 20), (3, None)]


def test_catalog(spark):
    listed = spark.createDataFrame([(0, "A", "1", "7", None, "123", "9", "XXXX", "NOME", "Nome SA", "s"), (1, "A", "1", "7", "", "456", "8", "YYYY", "Y", "Y SA", "s"), (2, "A", "1", "7", "X", "789", "7", "Z", "Z", "Z", "s")], "ordinal int, status string, type string, marketIndicator string, typeBDR string, cnpj string, codeCVM string, issuingCompany string, tradingName string, companyName string, segment string")
    registry = spark.createDataFrame([("9", "NOME SA", "Bancos", "A", "ATIVO")], "CD_CVM string, DENOM_SOCIAL string, SETOR_ATIV string, CATEG_REG string, SIT string")
    index = lambda *c: spark.createDataFrame([(x, "N", i) for i, x in enumerate(c)], "cod string, asset string, ordinal int")
    df = catalog.build_catalog(listed, registry, index("XXXX4"), index("XXXX3", "XXXX4"))
    assert rows(df.select("ticker", "confidence", "indices", "cnpj")) == [("XXXX4", "index", "IBOV,IBRX", "00.000.000/0001-23"), ("YYYY3", "assumed", "", "00.000.000/0004-56")]
    watch = spark.createDataFrame([("00.000.000/0001-23",)], "cnpj string")
    new = catalog.watchlist_rows(catalog.candidates(df, watch, everything=True))
    assert rows(new.select("ticker", "setor", "observacao", "nome_cvm")) == [("YYYY3", "Outros", "auto:assumed", "Y SA")]
    assert catalog.search(df, "xx.x4", ["ticker", "nome_cvm"]).count() == 1


def test_tickers_of_an_index_with_repeats(spark):
    """A code's rows of both indices go with each other: the operator counts them, and the catalog never makes them."""
    index = lambda *r: spark.createDataFrame(list(r), "cod string, asset string, ordinal int")
    ibov = index(("XXXX3", "N", 1), ("XXXX3", "M", 5), ("XXXX3", None, 6), ("ZZZZ3", "Q", 2), (None, "P", 3))
    ibrx = index(("XXXX3", "A", 2), ("XXXX3", "B", 4), ("XXXX3", "B", 7), ("YYYY4", "C", 3), ("YYYY4", "C", 8))
    tickers = catalog.index_tickers(ibov, ibrx)
    plain = {}
    a, b = ibrx.collect(), ibov.collect()
    pairs = [(x, y) for x in a for y in b if x["cod"] == y["cod"]]
    for x, y in [*pairs, *((x, None) for x in a if x["cod"] not in {y["cod"] for y in b}), *((None, y) for y in b if y["cod"] not in {x["cod"] for x in a})]:
        key = (x or y)["cod"], y["asset"] if y and y["asset"] else x["asset"], y is not None, x is not None
        last, times = plain.get(key, (0, 0))
        plain[key] = max(last, x["ordinal"] if x else y["ordinal"] + 1_000_000), times + 1
    assert rows(tickers.select("cod", "asset", "ibov", "ibrx", "ordinal", "times")) == sorted(((*k, *v) for k, v in plain.items()), key=str)
    many = index(*(("XXXX3", f"N{i}", i) for i in range(300)))
    n = catalog.index_tickers(many, many)
    assert n.count() == 300 and n.agg(F.sum("times")).first()[0] == 90_000
    companies = spark.createDataFrame([("XXXX", "none"), ("WWWW", "none")], "issuingCompany string, tradingName string")
    got = {r["ticker"]: (r["count"], r["i"]) for r in catalog.with_ticker(companies, n).groupBy("ticker").agg(F.count("*").alias("count"), F.max("indices").alias("i")).collect()}
    assert got == {"XXXX3": (90_000, "IBOV,IBRX"), "WWWW3": (1, "")}


def test_full_text_ranks_equal_sqlite(spark):
    texts = ["Aquisição de CONTROLE da companhia", "Aviso aos acionistas", "controle e aquisicao de controle", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    index = fts.build_index(df, "id", ["t"])
    con = sqlite3.connect(":memory:")
    con.execute("create virtual table f using fts5(t)")
    con.executemany("insert into f(rowid, t) values (?, ?)", list(enumerate(texts)))
    want = {r[0]: round(r[1], 6) for r in con.execute("select rowid, rank from f where f match 'aquisicao AND controle'")}
    assert {r["doc"]: round(r["rank"], 6) for r in index.bm25(["aquisicao", "controle"]).collect()} == want
    assert rows(index.phrase(["de", "controle"])) == [(0,), (2,)]
    assert rows(index.without(index.term("contr", prefix=True), ["companhia"])) == [(2,)]
    assert rows(index.near("aquisicao", "companhia", 3)) == [(0,)]


def test_sql_tools(spark):
    spark.range(3).createOrReplaceTempView("t3")
    assert list(sqltools.query(spark, "select count(*) n from t3")) == [{"n": 3}]
    assert list(sqltools.query(spark, "with x as (select 1 a) select * from x, t3 where id = (select max(id) from t3)")) == [{"a": 1, "id": 2}]
    assert len(list(sqltools.query(spark, "select id from range(12000)"))) == 12_000
    calls = "reflect('java.lang.System', 'getProperty', 'user.home')"
    files_ = ("select * from text.`/etc/hostname`", "select (select max(value) from text.`/etc/hostname`)", "with a as (select * from parquet.`/tmp/x`) select * from a", "select id from t3 where id in (select length(value) from text.`/etc/hostname`)", "select * from nowhere")
    reflections = (f"select {calls}", f"select id from t3 where {calls} is null", f"select (select {calls})", f"with a as (select try_{calls} x) select * from a", f"select id from t3 order by java_method{calls[7:]}")
    for bad in ("drop table t3", "create table z as select 1", "set x = 1", "insert into t3 values (1)", *files_, *reflections):
        with pytest.raises(sqltools.NotAllowed):
            sqltools.query(spark, bad)
    with pytest.raises(sqltools.NotAllowed):
        sqltools.query(spark, "with x as (select 1 a) select * from x", strict=True)
    assert "t3" in sqltools.list_tables(spark)
    assert sqltools.describe_table(spark, "t3")[0]["name"] == "id"


@pytest.fixture(scope="module")
def shelf(spark):
    spark.range(4).selectExpr("id", "cast(id as string) s", "id * 1.5 v", "array(id) a", "date'2024-01-01' d").createOrReplaceTempView("shelf")
    yield "shelf"
    spark.catalog.dropTempView("shelf")


ALLOWED = """select id, v + 1, -v, v / 2, v % 2, id div 2 from shelf where id > 1 and v <= 9 or not s = 'x'
select * from shelf where id in (1, 2) and exists (select 1 from shelf u where u.id = shelf.id)
select id % 2 k, count(*), sum(v) filter (where id > 0), min_by(s, v) from shelf group by all having count(*) > 0 order by k desc nulls last limit 3 offset 0
with a as (select id from shelf), b as (select * from a) select * from a join b using (id)
select id from shelf union all select id from shelf intersect select 3 except select 2
select row_number() over (partition by id % 2 order by v rows between unbounded preceding and current row) from shelf
select case when id = 1 then 'a' end, cast(s as int), s like 'a%', s ilike 'a%', s rlike 'b', id between 1 and 3, coalesce(s, 'x'), lpad(s, 3, '0'), floor(v), try_divide(id, 0) from shelf
select percentile_cont(0.5) within group (order by v), listagg(s, ',') from shelf
select x.y from shelf lateral view explode(a) x as y
select * from shelf, lateral (select shelf.id + 1)
select transform(a, x -> x + 1), struct(id, s).id, map('a', 1)['a'] from shelf
select * from (select id, s, v from shelf) pivot (sum(v) for s in ('0', '1'))
select d + interval 1 day, extract(month from d), date_trunc('month', d), try_to_date('x') from shelf
select id, count(*) from shelf group by 1 order by 2 limit all
select id is distinct from 1, (id > 1) is true, d - date'2023-01-01', d - interval '1' month from shelf
values (1, 2)
/* a comment */ select * from shelf tablesample (2 rows) join range(3) using (id)""".split("\n")
REFUSED = """select * from identifier('text.`/etc/hostname`')
select * from identifier('shelf')
select identifier('reflect')('java.lang.System', 'getProperty', 'user.home')
select identifier('id') from shelf
begin drop view shelf; end
begin select 1; end
show tables
explain select 1
set x = 1
cache table shelf
refresh table shelf
describe shelf
use default
create table z as select 1
insert into shelf values (1)
delete from shelf
call x()
execute immediate 'drop view shelf'
select * from json.`/tmp/x`
select * from (select * from csv.`/tmp/x`) q
select (select count(*) from `parquet`.`/tmp/x`)
with shelf2 as (select 1) select * from text.`/etc/hostname`
select * from (with inner_name as (select 1) select * from inner_name) join inner_name
select * from shelf with ('a' = 'b')
select * from shelf version as of 1
select * from python_function('x')
select input_file_name() from shelf
select /*+ broadcast(shelf) */ * from shelf
from shelf |> where id > 1
with recursive r(n) as (select 1 union all select n + 1 from r where n < 3) select * from r
select id from shelf where java_method('java.lang.System', 'exit', '1') is null
select current_user()
select hidden from secret_table""".split("\n")


@pytest.mark.parametrize("sql", ALLOWED)
def test_guard_lets_reading_statements_run(spark, shelf, sql):
    list(sqltools.query(spark, sql))


@pytest.mark.parametrize("sql", REFUSED)
def test_guard_refuses(spark, shelf, sql):
    with pytest.raises(sqltools.NotAllowed):
        sqltools.query(spark, sql)
    assert spark.catalog.tableExists(shelf)


def test_guard_refuses_what_is_not_listed(spark, shelf, monkeypatch):
    """Whatever the class: without its entry in a list a statement that passes is refused, in the parsed and in the analysed plan."""
    sql = "select upper(s), count(*) from shelf where id > 1 group by s order by s limit 2"
    sqltools.check(spark, sql)
    for name, entry in (("PARSED", "Sort"), ("PARSED", "Aggregate"), ("ANALYSED", "GlobalLimit"), ("ANALYSED", "View"), ("SYNTAX", "GreaterThan"), ("SYNTAX", "AggregateExpression"), ("SYNTAX", "UnresolvedFunction")):
        with monkeypatch.context() as m:
            m.setattr(sqlguard, name, getattr(sqlguard, name) - {entry})
            with pytest.raises(sqltools.NotAllowed):
                sqltools.check(spark, sql)
    with pytest.raises(sqltools.NotAllowed):
        sqlguard.Guard(spark, {shelf}, sqlguard.FUNCTIONS - {"upper"}).check(sql)


def test_guard_sees_through_a_shadowed_function(spark):
    other = spark.newSession()
    other.range(2).selectExpr("cast(id as string) s").createOrReplaceTempView("shadow")
    sqltools.check(other, "select upper(s) from shadow")
    other.udf.register("upper", lambda x: "not the built-in one")
    with pytest.raises(sqltools.NotAllowed):
        sqltools.query(other, "select upper(s) from shadow")


def test_zip_statements_to_facts(spark, tmp_path):
    head = "CNPJ_CIA;DT_REFER;VERSAO;ORDEM_EXERC;DT_INI_EXERC;DT_FIM_EXERC;CD_CONTA;DS_CONTA;VL_CONTA;ESCALA_MOEDA"
    body = ["1;2023-12-31;1;ÚLTIMO;2023-01-01;2023-12-31;3.01;Receita;5000;MIL", "1;2023-12-31;1;ÚLTIMO;2023-01-01;2023-12-31;3.01;Receita;5000;MIL", "1;2023-12-31;1;ÚLTIMO;2023-10-01;2023-12-31;3.01;Receita;70;UNIDADE", "9;2023-12-31;1;ÚLTIMO;;2023-12-31;3.01;x;1;MIL"]
    with zipfile.ZipFile(tmp_path / "itr_cia_aberta_2023.zip", "w") as z:
        z.writestr("itr_cia_aberta_DRE_con_2023.csv", "\n".join([head, *body]).encode("latin-1"))
        z.writestr("itr_cia_aberta_DRE_ind_2023.csv", head)
        z.writestr("../evil_con_.csv", head)
    raw = zipcsv.zip_csv(spark, str(tmp_path), head.split(";"), zipcsv.statement_members("itr", ["DRE"]))
    watch = spark.createDataFrame([("1",)], "cnpj string")
    assert raw.count() == 4
    got = ingest.statements(raw, watch, "ITR").collect()
    assert [(r["fonte"], r["tipo_doc"], r["ordem_exercicio"], r["vl_conta"], r["dt_ini_exerc"]) for r in got] == [("ITR", "DRE", "Último", 70.0, datetime.date(2023, 10, 1))]
    assert ingest.statements(raw, watch, "ITR", with_period=True).count() == 2
    store = merge.SnapshotStore(spark, str(tmp_path / "store"))
    bad = raw.withColumn("ESCALA_MOEDA", F.lit("MILHAR"))
    out = ingest.load_each(store, schema.STATEMENTS, [("bad", lambda: ingest.statements(bad, watch, "ITR")), ("good", lambda: ingest.statements(raw, watch, "ITR"))])
    assert out["bad"].startswith("failed") and out["good"] == "merged"
    assert store.read(schema.STATEMENTS).count() == 1


def test_fetch_retries_connections_only():
    calls, naps = [], []

    def get(results):
        def f(url, timeout):
            calls.append(url)
            r = results.pop(0)
            if isinstance(r, Exception):
                raise r
            return r

        return f

    assert files.fetch("u", get=get([ConnectionError(), b"x"]), sleep=naps.append) == b"x" and naps == [1]
    with pytest.raises(ConnectionError):
        files.fetch("u", get=get([ConnectionError()] * 3), sleep=naps.append)
    assert naps == [1, 1, 2]
    calls.clear()
    with pytest.raises(urllib.error.HTTPError):
        files.fetch("u", get=get([urllib.error.HTTPError("u", 404, "", None, None)]), sleep=naps.append)
    assert len(calls) == 1


def test_pdf_guards(spark):
    url = "https://rad.cvm.gov.br/x"
    df = spark.createDataFrame([(1, url, b"%PDF" + b"a" * 200), (2, "https://example.com/x", b"%PDF" + b"a" * 200), (3, url, b"nope"), (4, url, None)], "id int, url string, content binary")
    got = pdf.extract_texts(df, lambda b: b.decode())
    assert rows(got.select("id", "extracao_falhou")) == [(1, 0), (2, 1), (3, 1), (4, 1)]


def test_texts_are_written_back(spark):
    """A row without a link stays pending; a failure keeps an earlier text; other rows aren't touched."""
    url = "https://rad.cvm.gov.br/x"
    docs = spark.createDataFrame([(k, u, None, f, None, "kept") for k, u, f in (("1", url, 0), ("2", url, None), ("3", None, None), ("4", "", 0), ("5", url, 1))] + [("6", url, "old", 0, None, "kept")], "protocolo_entrega string, url string, texto_extraido string, extracao_falhou int, extraido_em timestamp, assunto string")
    fetched = {"1": b"%PDF" + b"a" * 200, "2": b"gone", "6": None}
    content = docs.where("protocolo_entrega != '5'").drop("texto_extraido", "extracao_falhou").join(spark.createDataFrame(list(fetched.items()), "protocolo_entrega string, content binary"), "protocolo_entrega", "left")
    extracted = pdf.extract_texts(content, lambda b: b.decode())
    assert {r["status"]: r["count"] for r in pdf.outcome_counts(extracted).collect()} == {"ok": 1, "fail": 2, "skip": 2}
    got = {r["protocolo_entrega"]: r for r in pdf.save_texts(docs, extracted).collect()}
    assert {k: (r["extracao_falhou"], (r["texto_extraido"] or "")[:4], r["extraido_em"] is not None) for k, r in got.items()} == {"1": (0, "%PDF", True), "2": (1, "", False), "3": (None, "", False), "4": (0, "", False), "5": (1, "", False), "6": (1, "old", False)}
    assert {r["assunto"] for r in got.values()} == {"kept"}
    left = pdf.pending(pdf.save_texts(docs, extracted).selectExpr("*", "'c' cnpj_companhia", "'k' categoria", "date'2020-01-01' data_entrega"), ["c"], ["k"])
    assert rows(left.select("protocolo_entrega")) == [("3",), ("4",)]


def test_download_checks_host_and_size():
    class Answer:
        def __init__(self, url, body, length=None):
            self.url, self.body, self.headers = url, body, {"Content-Length": length} if length else {}

        def geturl(self):
            return self.url

        def read(self, n):
            return self.body[:n]

        __enter__ = lambda self: self
        __exit__ = lambda self, *a: None

    good = "https://www.cvm.gov.br/doc"
    assert pdf.download("u", open_url=lambda u, timeout: Answer(good, b"%PDF-x")) == b"%PDF-x"
    for bad in (Answer("https://cvm.gov.br.example.com/", b"%PDF"), Answer("https://xcvm.gov.br/", b"%PDF"), Answer(good, b"%PDF", str(pdf.MAX_BYTES + 1)), Answer(good, b"<html>")):
        with pytest.raises(pdf.NoText):
            pdf.download("u", open_url=lambda u, timeout: bad)


def test_watchlist_file_grows(spark, tmp_path):
    path = str(tmp_path / "watchlist.csv")
    add = lambda t, note="": spark.createDataFrame([(t, f"cnpj {t}", "1", "Nome, SA", "Bancos", "ATIVO", note)], ", ".join(f"{c} string" for c in files.WATCHLIST))
    assert files.append_csv(add("A"), path).count() == 1 and not (tmp_path / "watchlist.csv").exists()
    files.append_csv(add("A"), path, commit=True)
    files.append_csv(add("B", "auto"), path, commit=True)
    assert rows(files.watchlist(spark, path).select("ticker", "nome_cvm", "observacao")) == [("A", "Nome, SA", None), ("B", "Nome, SA", "auto")]
    assert "Nome, SA" in files.preview(files.watchlist(spark, path))


def test_exchange_lists(spark):
    import base64
    import json

    asked = []

    def get(url, timeout):
        asked.append(json.loads(base64.b64decode(url.rsplit("/", 1)[1])))
        if "IBRX" in str(asked[-1]):
            return b'{"results": [{"cod": "XXXX3", "asset": "N"}, {"cod": "XXXX4", "asset": "N"}]}'
        if "index" in asked[-1]:
            raise urllib.error.HTTPError(url, 404, "", None, None)
        return b'{"results": [{"status": "A", "type": "1", "marketIndicator": "7", "typeBDR": null, "cnpj": "123", "codeCVM": "9", "issuingCompany": "XXXX", "tradingName": "N", "companyName": "Nome", "segment": "s"}]}'

    listed = files.listed_companies(spark, get)
    assert rows(catalog.equities(listed).select("ordinal", "cnpj_fmt")) == [(0, "00.000.000/0001-23")]
    assert files.index_members(spark, "IBOV", get).count() == 0 and rows(files.index_members(spark, "IBRX", get).select("ordinal", "cod")) == [(0, "XXXX3"), (1, "XXXX4")]
    assert asked[0] == files.COMPANIES_PAYLOAD and asked[1] == files.INDEX_PAYLOADS["IBOV"] and asked[-1]["pageSize"] == 200


def test_delivery_members(spark):
    raw = spark.createDataFrame([(2023, m, p) for m, p in (("fre_cia_aberta_capital_social_2023.csv", 0), ("fre_cia_aberta_capital_social_aumento_2023.csv", 0), ("cia_aberta_recompra_quantidades.csv", 0), ("cia_aberta_recompra_programas.csv", 0), ("recompra_intermediarios.csv", 0), ("a_con_1.csv", 0), ("a_con_2.csv", 1))], "year int, member string, pos int")
    assert {k: v.count() for k, v in ingest.buyback_parts(raw).items()}["intermediarios"] == 1
    assert zipcsv.wanted([r["member"] for r in raw.collect()], zipcsv.form_members("fre_capital_social")) == ["fre_cia_aberta_capital_social_2023.csv"]
    assert rows(ingest.last_member(raw.where("member like '%_con_%'")).select("member")) == [("a_con_2.csv",)]
    cols = {f.name: F.lit("1") for f in spark.createDataFrame([], schema.CAPITAL.schema).schema}
    some = raw.withColumns({**cols, "cnpj_companhia": F.lit("c"), "data_referencia": F.lit("2023-01-01")}).withColumnRenamed("cnpj_companhia", "CNPJ_Companhia")
    assert ingest.reference_form(some, spark.createDataFrame([("c",)], "cnpj string"), schema.CAPITAL).count() == 1


def test_snapshots_survive_crashes_and_notice_lost_updates(spark, tmp_path, monkeypatch):
    store = merge.SnapshotStore(spark, str(tmp_path))
    make = lambda *r: spark.createDataFrame(list(r), "cnpj string, ticker string")
    spec = merge.TableSpec("companies", ("cnpj",), "cnpj string, ticker string, created_at timestamp", ("cnpj", "ticker"))
    store.merge(spec, make(("1", "A")))
    born = store.read(spec).first()["created_at"]
    assert born is not None
    store.merge(spec, make(("1", "B"), ("2", "C")))
    got = {r["cnpj"]: r for r in store.read(spec).collect()}
    assert got["1"]["created_at"] == born and got["1"]["ticker"] == "B" and got["2"]["created_at"] > born
    # A stop before the pointer is there: readers see the old table, and the next merge starts from it.
    with monkeypatch.context() as m:
        m.setattr(merge.Snapshots, "publish", lambda *a, **b: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            store.merge(spec, make(("3", "D")))
    assert store.read(spec).count() == 2
    # Another writer publishes between this one's read and its own pointer.
    other, write = merge.SnapshotStore(spark, str(tmp_path)), merge.SnapshotStore._publish
    with monkeypatch.context() as m:
        m.setattr(merge.SnapshotStore, "_publish", lambda *a: (m.undo(), other.merge(spec, make(("4", "E"))), write(*a)))
        with pytest.raises(merge.LostUpdateError):
            store.merge(spec, make(("3", "D")))
    assert rows(store.read(spec).select("cnpj")) == [("1",), ("2",), ("4",)]
    assert merge.Snapshots(spark, f"{tmp_path}/companies").number() == 3


def test_as_of_is_linear_in_a_key(spark):
    left = spark.range(100_000).select("id", F.lit("k").alias("k"), (F.col("id") * 3 + 1).alias("t"))
    facts = spark.range(100_000).select(F.lit("k").alias("k"), (F.col("id") * 3 + 30).alias("t"), F.col("id").alias("v"))
    begun = time.perf_counter()
    got = joins.as_of(left, facts, "k", "t", "t", "v", "v", ["id"]).agg(F.sum("v"), F.count("v")).first()
    assert time.perf_counter() - begun < 30 and tuple(got) == (sum(max(0, i - 10) for i in range(100_000)), 100_000)


def test_stored_index(spark, tmp_path):
    """Stale until it's built again; equal to the built one; folds as SQLite does."""
    docs = spark.createDataFrame([(1, "Aquisição de controle", "a"), (2, "a\u0301rvore de controle", "de"), (3, "nada", "b")], "id int, t string, s string")
    store = fts.FtsStore(spark, str(tmp_path / "index"))
    with pytest.raises(FileNotFoundError):
        store.open()
    store.rebuild(docs.where("id < 3"), "id", ["t", "s"])
    index = store.open()
    assert rows(index.all_of(["de", "controle"])) == [(1,), (2,)] and index.term("nada").count() == 0
    assert rows(index.term("de", "s")) == [(2,)] and rows(index.term("arvore")) == [(2,)]
    assert "bucket" in index.words(["de"])._jdf.queryExecution().executedPlan().toString()
    store.rebuild(docs, "id", ["t", "s"])
    assert store.open().term("nada").count() == 1 and index.term("nada").count() == 0
    built = fts.build_index(docs, "id", ["t", "s"])
    assert rows(store.open().bm25(["de", "controle"])) == rows(built.bm25(["de", "controle"]))
    assert [r["id"] for r in store.open().top(["de"], docs, "id").collect()] == [2, 1]
    con = sqlite3.connect(":memory:")
    con.execute("create virtual table f using fts5(t)")
    con.execute("create virtual table v using fts5vocab(f, 'row')")
    letters = [c for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]) if c.isalpha() and c not in "İẞ"]
    con.executemany("insert into f values (?)", [(f"x{c}",) for c in letters])
    got = {t for r in spark.createDataFrame([(f"x{c}",) for c in letters], "t string").select(fts.tokens(F.col("t")).alias("w")).collect() for t in r["w"]}
    want = {r[0] for r in con.execute("select term from v")}
    assert len(got ^ want) <= 8, sorted(got ^ want)


def test_stream_upsert_is_idempotent(spark, tmp_path):
    src = spark.createDataFrame([("1", "A", "x"), ("2", "B", "y")], SPEC.schema)
    src.write.parquet(str(tmp_path / "in"))
    store = merge.SnapshotStore(spark, str(tmp_path / "store"))
    for _ in range(2):
        stream_upsert(spark, str(tmp_path / "in"), SPEC.schema, store, SPEC, str(tmp_path / "ck")).awaitTermination()
    assert rows(store.read(SPEC)) == [("1", "A", "x"), ("2", "B", "y")]


# --- stored tables in parts -------------------------------------------------------------------------------------------
YEARLY = merge.TableSpec("yearly", ("k", "at"), "k string, at date, v double, created_at timestamp, updated_at timestamp", ("k",), parts=("year(at)",), buckets=2)


def yearly(spark, *r):
    return spark.createDataFrame([(k, datetime.date(y, 5, 1) if y else None, float(v)) for k, y, v in r], "k string, at date, v double")


def test_merge_reads_and_writes_only_the_parts_it_touches(spark, tmp_path):
    store = merge.SnapshotStore(spark, str(tmp_path))
    store.merge(YEARLY, yearly(spark, *((f"k{i}", y, i) for y in (2020, 2021, 2022) for i in range(20)), ("n", None, 0)))
    before = store.parts(YEARLY)
    assert len(before) == 3 * 2 + 1
    own = YEARLY.part(yearly(spark, ("x", 2021, 0)))
    of_2021 = {r[0] for r in yearly(spark, *((f"k{i}", 2021, i) for i in range(20))).select(own).distinct().collect()}
    read = []
    plain = merge.SnapshotStore._read
    with pytest.MonkeyPatch.context() as m:
        m.setattr(merge.SnapshotStore, "_read", lambda self, spec, parts: (read.append(dict(parts)), plain(self, spec, parts))[1])
        store.merge(YEARLY, yearly(spark, *((f"k{i}", 2021, 100 + i) for i in range(10)), ("new", 2021, 7)))
    after = store.parts(YEARLY)
    changed = {p for p in after if after[p] != before.get(p)}
    assert changed == of_2021 and len({after[p] for p in changed}) == 1
    assert all(set(x) <= of_2021 for x in read)
    got = {(r["k"], r["at"] and r["at"].year): r["v"] for r in store.read(YEARLY).collect()}
    assert len(got) == 62 and got["k3", 2021] == 103 and got["k13", 2021] == 13 and got["k3", 2020] == 3 and got["new", 2021] == 7 and got["n", None] == 0
    # The same again changes nothing but the parts' folders; a null in the key is one key.
    store.merge(YEARLY, yearly(spark, ("n", None, 5)))
    assert rows(store.read(YEARLY).where("k = 'n'").select("v")) == [(5.0,)] and store.read(YEARLY).count() == 62


def test_expire_keeps_what_is_referred_to(spark, tmp_path):
    store = merge.SnapshotStore(spark, str(tmp_path))
    for v in range(4):
        store.merge(YEARLY, yearly(spark, ("a", 2020, v), *([("b", 2021, v)] if v == 0 else [])))
    want = rows(store.read(YEARLY).select("k", "v"))
    assert want == [("a", 3.0), ("b", 0.0)]
    assert len(store.expire(YEARLY, keep=1)) == 2  # the first holds 2021 still
    assert rows(store.read(YEARLY).select("k", "v")) == want
    store.merge(YEARLY, yearly(spark, ("b", 2021, 9)))
    assert rows(store.read(YEARLY).select("k", "v")) == [("a", 3.0), ("b", 9.0)]
    assert sorted(p.name for p in (tmp_path / "yearly").glob("v-*.json")) == ["v-000000000004.json", "v-000000000005.json"]


def test_parts_go_by_the_tables_types_and_values(spark, tmp_path):
    spec = merge.TableSpec("typed", ("n", "x"), "n long, x double, v string", buckets=8)
    store = merge.SnapshotStore(spark, str(tmp_path))
    store.merge(spec, spark.createDataFrame([("7", 0.0, "old")], "n string, x double, v string"))
    store.merge(spec, spark.createDataFrame([(7, -0.0, "new")], "n int, x double, v string"))
    assert rows(store.read(spec).select("n", "v")) == [(7, "new")]


def test_stamps_are_set_at_insert(spark, tmp_path):
    store = merge.SnapshotStore(spark, str(tmp_path))
    store.merge(YEARLY, yearly(spark, ("a", 2020, 1)))
    first = store.read(YEARLY).first()
    store.merge(YEARLY, yearly(spark, ("a", 2020, 2), ("b", 2020, 1)))
    got = {r["k"]: r for r in store.read(YEARLY).collect()}
    assert first["updated_at"] == first["created_at"] == got["a"]["updated_at"] == got["a"]["created_at"] and got["b"]["updated_at"] > first["updated_at"]
    # A source that has the column sets it.
    store.merge(YEARLY, yearly(spark, ("a", 2020, 3)).withColumn("updated_at", F.lit("2030-01-01").cast("timestamp")))
    assert {r["k"]: r for r in store.read(YEARLY).collect()}["a"]["updated_at"].year == 2030


def test_unique_columns_are_compared_with_untouched_parts(spark, tmp_path):
    spec = merge.TableSpec("tickers", ("k",), "k string, ticker string", unique=(("ticker",),), buckets=16)
    store = merge.SnapshotStore(spark, str(tmp_path))
    make = lambda *r: spark.createDataFrame(list(r), "k string, ticker string")
    store.merge(spec, make(*((f"k{i}", f"T{i}") for i in range(10)), ("n", None), ("m", None)))
    with pytest.raises(merge.ConstraintError, match="ticker repeated"):
        store.merge(spec, make(("other", "T3")))
    assert store.read(spec).count() == 12


def test_orphans_fail_the_publish_and_both_buyback_tables_load(spark, tmp_path):
    names = {"programas": ["ID_Programa;CNPJ_Companhia;Situacao", "1;c;Ativo", "2;c;Encerrado", "9;other;Ativo"], "quantidades": ["ID_Programa;CNPJ_Companhia;Data_Referencia;Tipo_Ativo;Quantidade;Preco_Medio;Volume", "1;c;2023-01-31;ON;10;1,5;15", "1;c;2023-01-31;ON;12;1,5;18", "2;c;28/02/2023;PN;7;NA;"], "intermediarios": ["ID_Programa;CNPJ_Companhia;Intermediario", "1;c;Corretora", "2;c;Corretora", "9;other;Outra"]}
    with zipfile.ZipFile(tmp_path / "cia_aberta_recompra_acoes.zip", "w") as z:
        for k, lines in names.items():
            z.writestr(f"cia_aberta_recompra_acoes_{k}.csv", "\n".join(lines).encode("latin-1"))
    columns = sorted({c for v in names.values() for c in v[0].split(";")})
    raw = zipcsv.zip_csv(spark, str(tmp_path), columns)
    watch = spark.createDataFrame([("c",)], "cnpj string")
    store = merge.SnapshotStore(spark, str(tmp_path / "store"))
    details = [(s.name, lambda s=s: ingest.buyback_details(raw, watch, s)) for s in (schema.AMOUNTS, schema.BROKERS)]
    with pytest.raises(merge.ConstraintError, match="no row in recompra_programas"):
        store.merge(schema.AMOUNTS, details[0][1]().drop(*ingest.ORDER))
    assert not store.exists("recompra_quantidades")
    for spec, make in ((schema.PROGRAMMES, lambda: ingest.programmes(raw, watch)), (schema.AMOUNTS, details[0][1]), (schema.BROKERS, details[1][1])):
        assert ingest.load_each(store, spec, [("all", make)], contain=False) == {"all": "merged"}
    assert rows(store.read(schema.AMOUNTS).select("id_programa", "quantidade", "preco_medio", "volume")) == [("1", 12, 1.5, 18.0), ("2", 7, None, None)]
    assert rows(store.read(schema.BROKERS).select("id_programa", "intermediario")) == [("1", "Corretora"), ("2", "Corretora")]
    more = spark.createDataFrame([("3", "c", "X")], "id_programa string, cnpj_companhia string, intermediario string")
    out = ingest.load_each(store, schema.BROKERS, [("orphan", lambda: more.withColumns({c: F.lit(0) for c in ingest.ORDER}))])
    assert out["orphan"].startswith("failed") and store.read(schema.BROKERS).count() == 2
