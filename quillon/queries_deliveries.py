"""Registered queries of the deliveries' way: raw rows to typed tables, the catalog, stored tables, query strings, and what needs more than one task a key.

Raw deliveries are made from rows of the star schema as they would come: texts with NA tokens, decimal commas, repeated keys. Expressions that both engines read
the same are written once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quillon import schema
from quillon.functions import clean, loose
from quillon.operators import dedup, fts, joins, sketches
from quillon.operators.merge import SnapshotStore
from quillon.plans import catalog, ingest, sqltools, statements
from quillon.registry import query, table
from quillon.session import with_checkpoints
from quillon.sources import pdf


def _made(spark, sf_dir, source: str, columns: dict[str, str]):
    return table(spark, sf_dir, source).selectExpr(*(f"{e} as {n}" for n, e in columns.items()))


def _sql(source: str, columns: dict[str, str]) -> str:
    return f"select {', '.join(f'{e} as {n}' for n, e in columns.items())} from {source}"


def _strings(df, columns: list[str]):
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# --- raw rows to tables ---------------------------------------------------------------------------------------------
_POS = "((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 1000 + l_suppkey % 1000"
_RAW = {"year": "year(l_shipdate)", "kind": "case l_linestatus when 'O' then 'DRE' else 'BPA' end", "pos": _POS, "CNPJ_CIA": "l_suppkey", "VERSAO": "l_linenumber", "previous": "l_returnflag = 'A'", "CD_CONTA": "concat('3.0', l_orderkey % 9 + 1)", "VL_CONTA": "l_extendedprice", "mil": "l_linenumber % 2 = 0"}


def _raw_statements(spark, sf_dir):
    raw = _made(spark, sf_dir, "lineitem", _RAW)
    year = F.col("year").cast("string")
    return raw.select(
        F.col("year").cast("int").alias("year"), F.concat(F.lit("dfp_cia_aberta_"), "kind", F.lit("_con_"), year, F.lit(".csv")).alias("member"), "pos", F.col("CNPJ_CIA").cast("string").alias("CNPJ_CIA"), F.concat(year, F.lit("-12-31")).alias("DT_REFER"),
        F.when(F.col("VERSAO") > 1, F.col("VERSAO").cast("string")).alias("VERSAO"), F.when(F.col("previous"), "PENÚLTIMO").otherwise(" último ").alias("ORDEM_EXERC"), F.concat(year, F.lit("-01-01")).alias("DT_INI_EXERC"), F.concat(F.lit("31/12/"), year).alias("DT_FIM_EXERC"),
        "CD_CONTA", F.lit("x").alias("DS_CONTA"), F.replace(F.col("VL_CONTA").cast("string"), F.lit("."), F.lit(",")).alias("VL_CONTA"), F.when(F.col("mil"), "MIL").otherwise("UNIDADE").alias("ESCALA_MOEDA"),
    )


def _watch(spark, sf_dir):
    return table(spark, sf_dir, "supplier").where("s_nationkey < 15").select(F.col("s_suppkey").cast("string").alias("cnpj"))


_STATEMENTS = f"""raw as ({_sql('lineitem', _RAW)}), own as (select * from raw where CNPJ_CIA in (select s_suppkey from supplier where s_nationkey < 15)),
once as (select * from own qualify row_number() over (partition by CNPJ_CIA, kind, year, VERSAO, previous, CD_CONTA, VL_CONTA order by pos) = 1),
st as (select CNPJ_CIA::varchar cnpj_companhia, 'DFP' fonte, kind tipo_doc, year ano, VERSAO::int versao, case when previous then 'Penúltimo' else 'Último' end ordem_exercicio, CD_CONTA cd_conta, round(case when mil then VL_CONTA * 1000 else VL_CONTA end, 2) vl_conta
  from once qualify row_number() over (partition by CNPJ_CIA, kind, year, VERSAO, previous, CD_CONTA order by pos desc) = 1)"""
_OUT = ("cnpj_companhia", "fonte", "tipo_doc", "versao", "ordem_exercicio", "cd_conta")


@query(f"with {_STATEMENTS} select cnpj_companhia, fonte, tipo_doc, versao, ordem_exercicio, cd_conta, vl_conta, ano || '-12-31' data_referencia, ano || '-12-31' dt_fim_exerc from st")
def statements_typed(spark, sf_dir):
    out = ingest.statements(_raw_statements(spark, sf_dir), _watch(spark, sf_dir), "DFP")
    return out.select(*_OUT, F.round("vl_conta", 2).alias("vl_conta"), F.col("data_referencia").cast("string").alias("data_referencia"), F.col("dt_fim_exerc").cast("string").alias("dt_fim_exerc"))


@query(f"with {_STATEMENTS} select cnpj_companhia, fonte, tipo_doc, versao, ordem_exercicio, cd_conta, case when ano = 1997 then vl_conta + 1 else vl_conta end vl_conta, ano from st where ano <= 1997 or versao = 7")
def stored_merge(spark, sf_dir):
    """Two deliveries into a stored table in parts: all rows but some later versions of late years, then 1997 again with other values."""
    with_checkpoints(spark)
    store = SnapshotStore(spark, f"{spark.sparkContext.getCheckpointDir()}/store-{uuid.uuid4().hex}")
    rows = ingest.statements(_raw_statements(spark, sf_dir), _watch(spark, sf_dir), "DFP").drop(*ingest.ORDER)
    year = F.year("data_referencia")
    store.merge(schema.STATEMENTS, rows.where((year <= 1997) | (F.col("versao") == 7)))
    store.merge(schema.STATEMENTS, rows.where(year == 1997).withColumn("vl_conta", F.col("vl_conta") + 1))
    return store.read(schema.STATEMENTS).select(*_OUT, F.round("vl_conta", 2).alias("vl_conta"), year.cast("long").alias("ano"))


_DOCS = {"year": "2020 + doc_id % 3", "pos": "doc_id", "key": "case when doc_id % 11 = 0 then '' when doc_id % 13 != 0 then concat('p', doc_id % 700) end", "source": "source", "lang": "lang", "version": "doc_id % 4", "days": "n_chars % 900"}


@query(f"""with raw as ({_sql('documents', _DOCS)}) select key protocolo_entrega, case when version < 2 then 1 else version end::int versao, year(date '2020-01-01' + days::int)::int ano, (date '2020-01-01' + days::int)::date::varchar data_entrega, lang categoria
from raw where key != '' and source != 'src0' qualify row_number() over (partition by key order by year desc, pos desc) = 1""")
def documents_typed(spark, sf_dir):
    raw = _made(spark, sf_dir, "documents", _DOCS)
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.col("days").cast("int"))
    version = F.when(F.col("version") == 1, "x").when(F.col("version") > 1, F.col("version").cast("string"))
    raw = raw.select(F.col("year").cast("int").alias("year"), F.lit("a.csv").alias("member"), "pos", F.col("key").alias("Protocolo_Entrega"), F.col("source").alias("CNPJ_Companhia"), F.date_format(day, "d/M/yyyy").alias("Data_Entrega"), F.col("lang").alias("Categoria"), version.alias("Versao"))
    watch = table(spark, sf_dir, "documents").where("source != 'src0'").select(F.col("source").alias("cnpj"))
    return ingest.documents(raw, watch).select("protocolo_entrega", "versao", "ano", F.col("data_entrega").cast("string").alias("data_entrega"), "categoria")


_MOVES = {"pos": "event_id", "company": "concat('u', user_id % 50)", "role": "event_type", "amount": "event_id % 4", "ts": "ts", "volume": "value"}


@query(f"with raw as ({_sql('events', _MOVES)}) select company cnpj_companhia, role tipo_cargo, amount quantidade, ts::date::varchar data_movimentacao, volume from raw where company != 'u7' qualify row_number() over (partition by company, role, amount, ts::date order by pos) = 1")
def movements_typed(spark, sf_dir):
    """Of repeated raw keys the first row counts, before the companies are chosen."""
    raw = _made(spark, sf_dir, "events", _MOVES)
    names = ["Tipo_Movimentacao", "Tipo_Operacao", "Tipo_Ativo"]
    raw = raw.select(F.lit(2024).alias("year"), F.lit("vlmo_cia_aberta_con_2024.csv").alias("member"), "pos", F.col("company").alias("CNPJ_Companhia"), F.lit("2024-01-31").alias("Data_Referencia"), F.lit("1").alias("Versao"), F.col("role").alias("Tipo_Cargo"), *(F.lit("x").alias(c) for c in names), F.date_format("ts", "yyyy-MM-dd").alias("Data_Movimentacao"), F.col("amount").cast("string").alias("Quantidade"), F.lit("1,5").alias("Preco_Unitario"), F.replace(F.col("volume").cast("string"), F.lit("."), F.lit(",")).alias("Volume"))
    watch = table(spark, sf_dir, "events").selectExpr("concat('u', user_id % 50) as cnpj").where("cnpj != 'u7'")
    return ingest.movements(raw, watch).select("cnpj_companhia", "tipo_cargo", "quantidade", F.col("data_movimentacao").cast("string").alias("data_movimentacao"), "volume")


_HOLDERS = {"year": "year(o_orderdate)", "pos": "o_orderkey", "company": "o_custkey % 40", "holder": "o_orderkey % 60", "version": "o_orderkey % 3 + 1", "share": "o_totalprice"}


@query(f"""with raw as ({_sql('orders', _HOLDERS)}), own as (select * from raw qualify row_number() over (partition by company, year, version, holder order by pos desc) = 1),
last as (select * from own qualify rank() over (partition by company order by year desc, version desc) = 1)
select company::varchar cnpj_companhia, holder::varchar id_acionista, share percentual, row_number() over (partition by company order by share desc, holder::varchar)::int posicao from last qualify posicao <= 3""")
def holders_of_latest_form(spark, sf_dir):
    """Rows of the reference form's own member by key, then the largest holders in each company's latest version."""
    raw = _made(spark, sf_dir, "orders", _HOLDERS)
    year = F.col("year").cast("string")
    raw = raw.select(F.col("year").cast("int").alias("year"), F.concat(F.lit("fre_cia_aberta_posicao_acionaria_"), year, F.lit(".csv")).alias("member"), "pos", F.col("company").cast("string").alias("CNPJ_Companhia"), F.concat(year, F.lit("-12-31")).alias("Data_Referencia"), F.col("version").cast("string").alias("Versao"), F.col("holder").cast("string").alias("ID_Acionista"), F.replace(F.col("share").cast("string"), F.lit("."), F.lit(",")).alias("Percentual_Total_Acoes_Circulacao"))
    raw = raw.unionByName(raw.withColumn("member", F.lit("fre_cia_aberta_posicao_acionaria_classe_acao_2023.csv")).withColumn("Percentual_Total_Acoes_Circulacao", F.lit("9e9")))
    watch = table(spark, sf_dir, "orders").selectExpr("cast(o_custkey % 40 as string) as cnpj")
    out = statements.top_holders(ingest.reference_form(raw, watch, schema.HOLDERS))
    return out.select("cnpj_companhia", "id_acionista", F.col("percentual_total_acoes_circulacao").alias("percentual"), "posicao")


_AMOUNTS = {"pos": "o_orderkey", "programme": "o_custkey % 300", "month": "month(o_orderdate)", "kind": "case when o_orderkey % 2 = 0 then 'ON' else 'PN' end", "amount": "o_orderkey % 1000", "total": "o_totalprice"}


@query(f"with raw as ({_sql('orders', _AMOUNTS)}) select programme::varchar id_programa, tipo tipo_ativo, amount quantidade, total volume, month mes from (select *, kind tipo from raw) qualify row_number() over (partition by programme, month, kind order by pos desc) = 1")
def buyback_amounts(spark, sf_dir):
    raw = _made(spark, sf_dir, "orders", _AMOUNTS)
    raw = raw.select(F.lit(2024).alias("year"), F.lit("cia_aberta_recompra_quantidades.csv").alias("member"), "pos", F.col("programme").cast("string").alias("ID_Programa"), F.lit("c").alias("CNPJ_Companhia"), F.concat(F.lit("28/"), F.col("month").cast("string"), F.lit("/2024")).alias("Data_Referencia"), F.col("kind").alias("Tipo_Ativo"), F.col("amount").cast("string").alias("Quantidade"), F.col("total").cast("string").alias("Volume"))
    out = ingest.buyback_details(raw, spark.createDataFrame([("c",)], "cnpj string"), schema.AMOUNTS)
    return out.select("id_programa", "tipo_ativo", "quantidade", "volume", F.month("data_referencia").cast("long").alias("mes"))


# --- statements -----------------------------------------------------------------------------------------------------
_ACCOUNTS = {
    "cnpj_companhia": "l_suppkey", "fonte": "case when l_discount > 0.05 then 'DFP' else 'ITR' end", "tipo_doc": "case l_partkey % 3 when 0 then 'DRE' when 1 then 'BPA' else 'BPP' end", "data_referencia": "make_date(cast(year(l_shipdate) as int), 12, 31)", "versao": "l_linenumber",
    "ordem_exercicio": "case when l_returnflag = 'A' then 'Penúltimo' else 'Último' end", "dt_ini_exerc": "make_date(cast(year(l_shipdate) as int), l_linenumber, 1)", "dt_fim_exerc": "make_date(cast(year(l_shipdate) as int), 12, 31)",
    "cd_conta": "case l_partkey % 3 when 0 then case l_orderkey % 7 when 0 then '3.01' when 1 then '3.02' when 2 then '3.03' when 3 then '3.05' when 4 then '3.06' when 5 then '3.08' else '3.11' end when 1 then case l_orderkey % 4 when 0 then '1' when 1 then '1.01' when 2 then '1.01.01' else '1.02' end else case l_orderkey % 3 when 0 then '2.01.04' when 1 then '2.02.01' else '2.03' end end",
    "vl_conta": "l_extendedprice",
}
_LATEST = f"f as ({_sql('lineitem', _ACCOUNTS)}), l as (select * from f where ordem_exercicio = 'Último' qualify rank() over (partition by cnpj_companhia, fonte, tipo_doc, data_referencia, cd_conta order by versao desc) = 1)"
_INCOME = ", ".join(f"max(case when cd_conta = '{c}' then vl_conta end) {n}" for n, c in statements.INCOME.items())
_BALANCE = ", ".join(f"max(case when tipo_doc = '{t}' and cd_conta = '{c}' then vl_conta end) {n}" for n, (t, c) in statements.BALANCE.items())


@query(f"with {_LATEST} select cnpj_companhia, fonte, data_referencia::varchar data_referencia, min(dt_ini_exerc)::varchar dt_ini_exerc, min(dt_fim_exerc)::varchar dt_fim_exerc, {_INCOME} from l where tipo_doc = 'DRE' group by 1, 2, l.data_referencia")
def income_statement_view(spark, sf_dir):
    return _strings(statements.income_statement(_made(spark, sf_dir, "lineitem", _ACCOUNTS)), ["data_referencia", "dt_ini_exerc", "dt_fim_exerc"])


@query(f"with {_LATEST}, b as (select cnpj_companhia, fonte, data_referencia, min(dt_fim_exerc) dt_fim_exerc, {_BALANCE} from l where tipo_doc in ('BPA', 'BPP') group by 1, 2, 3), n as (select *, case when coalesce(divida_curto_prazo, divida_longo_prazo, caixa) is not null then coalesce(divida_curto_prazo, 0) + coalesce(divida_longo_prazo, 0) - coalesce(caixa, 0) end d from b)\nselect cnpj_companhia, fonte, data_referencia::varchar data_referencia, dt_fim_exerc::varchar dt_fim_exerc, {', '.join(statements.BALANCE)}, round(d, 2) divida_liquida, round(d - lag(d) over (partition by cnpj_companhia, fonte order by n.data_referencia), 2) variacao from n")
def balance_sheet_view(spark, sf_dir):
    out = statements.with_net_debt(statements.balance_sheet(_made(spark, sf_dir, "lineitem", _ACCOUNTS)))
    return _strings(out, ["data_referencia", "dt_fim_exerc"]).withColumns({c: F.round(c, 2) for c in ("divida_liquida", "variacao")})


# --- catalog --------------------------------------------------------------------------------------------------------
_LISTED = {
    "status": "case when c_custkey % 10 = 0 then 'I' else 'A' end", "type": "case when c_custkey % 7 = 0 then '2' else '1' end", "marketIndicator": "cast(c_custkey % 25 as varchar(9))", "typeBDR": "case c_custkey % 4 when 0 then null when 1 then 'DRN' else '' end",
    "cnpj": "case when c_custkey % 17 != 0 then cast((c_custkey % 900) * 7919 as varchar(20)) end", "codeCVM": "cast(c_custkey % 130 as varchar(9))", "issuingCompany": "concat('c', lpad(cast(c_custkey % 700 as varchar(9)), 3, '0'), ' ')", "tradingName": "concat('Supplier#000000', lpad(cast(c_custkey % 160 as varchar(9)), 3, '0'))", "companyName": "c_name", "segment": "c_mktsegment", "ordinal": "c_custkey",
}
_REGISTRY = {"CD_CVM": "cast(s_suppkey as varchar(9))", "DENOM_SOCIAL": "case when s_suppkey % 6 = 0 then '' else s_name end", "SETOR_ATIV": "case s_suppkey % 3 when 0 then 'Bancos' when 1 then 'Energia Elétrica' else 'other' end", "SIT": "case when s_suppkey % 5 = 0 then 'CANCELADA' else 'ATIVO' end", "CATEG_REG": "'A'"}
_INDEX = {"cod": "concat('C', lpad(cast(s_suppkey % 700 as varchar(9)), 3, '0'), cast(3 + s_suppkey % 2 as varchar(9)))", "asset": "s_name", "ordinal": "s_suppkey"}
_IDS = "lpad(cnpj, 14, '0')"
_EQUITIES = rf"""listed as ({_sql('customer', _LISTED)}), eq as (select *, regexp_replace({_IDS}, '^(..)(...)(...)(....)(..)$', '\1.\2.\3/\4-\5') cnpj_fmt from listed where status = 'A' and type = '1' and marketIndicator in ('7', '8', '14', '16', '17', '18') and not coalesce(length(typeBDR) > 0, false) and cnpj is not null and {_IDS} != '00000000000000')"""
_TICKERS = f"""ibov as (select * from ({_sql('supplier', _INDEX)}) where ordinal % 3 = 0), ibrx as (select * from ({_sql('supplier', _INDEX)}) where ordinal % 2 = 0),
tick as (select coalesce(a.cod, b.cod) cod, coalesce(b.asset, a.asset) asset, coalesce(a.ordinal, b.ordinal + 1000000) o, b.cod is not null ibov, a.cod is not null ibrx from ibrx a full join ibov b on a.cod = b.cod),
by_issuer as (select upper(left(cod, 4)) k, arg_max(cod, o) t from tick group by 1), by_name as (select upper(trim(asset)) k, arg_max(cod, o) t from tick group by 1),
res as (select eq.*, coalesce(i.t, n.t, upper(trim(issuingCompany)) || '3') ticker, case when coalesce(i.t, n.t) is not null then 'index' else 'assumed' end confidence from eq left join by_issuer i on i.k = upper(trim(issuingCompany)) left join by_name n on n.k = upper(trim(tradingName))),
named as (select res.*, concat_ws(',', case when f.ibov then 'IBOV' end, case when f.ibrx then 'IBRX' end) indices from res left join tick f on f.cod = res.ticker)"""
_CATALOG = f"""{_EQUITIES}, {_TICKERS}, reg as (select * from ({_sql('supplier', _REGISTRY)}) where SIT = 'ATIVO'),
cat as (select ticker, confidence, indices, cnpj_fmt cnpj, codeCVM codigo_cvm, companyName nome_b3, DENOM_SOCIAL nome_cvm, SETOR_ATIV setor_cvm, segment from named left join reg on codeCVM = CD_CVM qualify row_number() over (partition by cnpj_fmt order by ordinal, ticker) = 1)"""


def _index(spark, sf_dir, step: int):
    return _made(spark, sf_dir, "supplier", _INDEX).where(f"ordinal % {step} = 0")


def _catalog(spark, sf_dir):
    return catalog.build_catalog(_made(spark, sf_dir, "customer", _LISTED), _made(spark, sf_dir, "supplier", _REGISTRY), _index(spark, sf_dir, 3), _index(spark, sf_dir, 2))


@query(f"with {_EQUITIES} select companyName, cnpj_fmt from eq")
def listed_equities(spark, sf_dir):
    return catalog.equities(_made(spark, sf_dir, "customer", _LISTED)).select("companyName", "cnpj_fmt")


@query(f"with {_EQUITIES}, {_TICKERS} select companyName, ticker, confidence, indices from named")
def tickers_resolved(spark, sf_dir):
    tickers = catalog.index_tickers(_index(spark, sf_dir, 3), _index(spark, sf_dir, 2))
    return catalog.with_ticker(catalog.equities(_made(spark, sf_dir, "customer", _LISTED)), tickers).select("companyName", "ticker", "confidence", "indices")


@query(f"with {_CATALOG} select * from cat order by ticker")
def company_catalog(spark, sf_dir):
    return _catalog(spark, sf_dir)


@query(f"with {_CATALOG} select ticker, cnpj from cat where contains(indices, 'IBOV') and (regexp_matches(upper(setor_cvm), 'BANC|EL.TR') or regexp_matches(upper(indices), 'BANC|EL.TR')) and confidence != 'assumed' and cnpj not in (select cnpj from cat where ticker like '%7%')")
def catalog_candidates(spark, sf_dir):
    """Members of one index in some sectors that aren't on the watchlist, without guessed tickers."""
    c = _catalog(spark, sf_dir)
    return catalog.candidates(c, c.where("ticker like '%7%'"), sector_like="banc|el.tr", skip_assumed=True, ibov=True).select("ticker", "cnpj")


@query(f"with {_CATALOG} select ticker, cnpj, codigo_cvm, coalesce(nullif(nome_cvm, ''), nome_b3) nome_cvm, case setor_cvm when 'Bancos' then 'Financeiro' when 'Energia Elétrica' then 'Energia' else 'Outros' end setor, 'ATIVO' status_cvm, case when confidence = 'assumed' then 'auto:assumed' else 'auto' end observacao from cat")
def watchlist_from_catalog(spark, sf_dir):
    c = _catalog(spark, sf_dir)
    return catalog.watchlist_rows(catalog.candidates(c, c.limit(0), everything=True))


# --- cells ----------------------------------------------------------------------------------------------------------
@query("select doc_id, left(coalesce(text, ''), 60) label, coalesce(length(text) > 100, false) good, length(replace(coalesce(text, ''), 'ou', chr(0) || 'ou')) - length(coalesce(text, '')) zeros from documents")
def texts_checked(spark, sf_dir):
    """Subjects as they're shown, texts long enough to count, and zero characters removed."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", F.replace(F.coalesce("text", F.lit("")), F.lit("ou"), F.lit("\0ou")).alias("raw"))
    return d.select("doc_id", clean.label(F.col("text")).alias("label"), clean.long_enough(F.col("text")).alias("good"), (F.length("raw") - F.length(clean.document_text(F.col("raw")))).cast("long").alias("zeros"))


@query("select event_id, case when event_id % 5 != 0 then value end as x, base64(encode('{\"language\":\"pt-br\",\"pageNumber\":' || event_id || '}')) payload from events")
def payloads_and_nans(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("x", F.when(F.col("event_id") % 5 == 0, float("nan")).otherwise(F.col("value")))
    return e.select("event_id", clean.nan_to_null(F.col("x")).alias("x"), clean.base64_json(F.struct(F.lit("pt-br").alias("language"), F.col("event_id").alias("pageNumber"))).alias("payload"))


@query("with h as (select page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)) h from pages) select page_id, coalesce(h = 'example.com' or ends_with(h, '.example.com'), false) own from h")
def links_in_domain(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", clean.in_domain(F.col("url"), "example.com").alias("own"))


@query("select case when doc_id % 4 = 0 then 'skip' when length(text) > 300 then 'ok' else 'fail' end status, count(*) as count from documents group by 1")
def extraction_outcomes(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("extracao_falhou", F.when(F.col("doc_id") % 4 != 0, F.when(F.length("text") > 300, 0).otherwise(1)))
    return pdf.outcome_counts(d)


# --- full text ------------------------------------------------------------------------------------------------------
_POST = r"tok as (select doc_id doc, regexp_extract_all(strip_accents(lower(coalesce(text, ''))), '[\p{L}\p{N}\p{Co}]+') w from documents), post as (select doc, unnest(w) term, unnest(range(len(w))) pos from tok)"


@query(f"""with {_POST}, phrase as (select a.doc from post a join post b on a.doc = b.doc and b.pos = a.pos + 1 where a.term = 'of' and b.term = 'the'), near as (select a.doc from post a join post b on a.doc = b.doc and abs(a.pos - b.pos) <= 4 where a.term = 'de' and starts_with(b.term, 'la'))
select distinct doc from (select * from phrase union all select * from near) where doc not in (select doc from post where term = 'une')""")
def fts_query_string(spark, sf_dir):
    index = fts.build_index(table(spark, sf_dir, "documents"), "doc_id", ["text"])
    return index.match('("of the" OR NEAR(de la*, 3)) NOT text : une')


@query(f"""with {_POST}, st as (select count(*) nd, avg(len(w)) al from tok), f as (select doc, 1 p, count(*) f from post where term = 'der' group by 1 union all select a.doc, 2, count(*) from post a join post b on a.doc = b.doc and b.pos = a.pos + 1 where a.term = 'of' and b.term = 'the' group by 1), n as (select p, count(*) n from f group by 1)
select doc, round(-sum(greatest(ln((nd - n + 0.5) / (n + 0.5)), 1e-6) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(w) / al))), 6) rank from f join n using (p) join tok using (doc), st group by 1""")
def fts_query_string_ranked(spark, sf_dir):
    index = fts.build_index(table(spark, sf_dir, "documents"), "doc_id", ["text"])
    return index.match_ranked('der OR of + the').select("doc", F.round("rank", 6).alias("rank"))


@query("select doc_id from documents where contains(strip_accents(lower(text)), 'echelle')")
def folded_containment(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(fts.contains_folded(F.col("text"), "ÉCHELLE")).select("doc_id")


# --- keys that don't fit one task -----------------------------------------------------------------------------------
@query("select event_id, sum((value * 100)::bigint) over (order by ts, event_id)::bigint total, sum((value * 100)::bigint) over (order by ts, event_id rows 6 preceding)::bigint last_seven from events")
def running_total_of_all(spark, sf_dir):
    """No key at all: ranges of time are scanned apart, and what comes into each is carried over."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", F.round(F.col("value") * 100).cast("long").alias("cents"))
    both = dedup.rolling(e, [], ["ts", "event_id"], F.col("cents"), "total", partitions=8)
    return dedup.rolling(both, [], ["ts", "event_id"], F.col("cents"), "last_seven", rows=7, partitions=8).select("event_id", "total", "last_seven")


@query("with s as (select event_type k, event_id, ts, value from events where event_id % 3 = 0) select e.event_id, coalesce((select arg_max(s.value, (s.ts, s.event_id)) from s where s.k = e.event_type and s.ts <= e.ts), (select arg_min(s.value, (s.ts, s.event_id)) from s where s.k = e.event_type)) known from events e where event_id % 3 != 0")
def asof_over_ranges(spark, sf_dir):
    """Five keys hold all rows."""
    e = table(spark, sf_dir, "events")
    left, facts = e.where("event_id % 3 != 0").select("event_id", "event_type", "ts"), e.where("event_id % 3 = 0").select("event_type", "ts", "value", "event_id")
    return joins.as_of(left, facts, "event_type", "ts", "ts", "value", "known", ["event_id"], tie="event_id", partitions=8).select("event_id", "known")


@query("select a.event_id, b.event_id after_id from events a join events b on b.user_id = a.user_id and b.ts >= a.ts and b.ts <= a.ts + interval 6 hour where a.event_type = 'purchase' and b.event_type = 'error'")
def pairs_in_time(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    out = joins.pairs_within(e.where("event_type = 'purchase'"), e.where("event_type = 'error'"), "user_id", "ts", "ts", 6 * 3600)
    return out.select("event_id", F.col("event.event_id").alias("after_id"))


@query("select l_returnflag, count(*) n, true d_good, true q_good from lineitem group by 1")
def sketches_put_together(spark, sf_dir):
    """Sketches by flag and year, put together by flag, beside exact values: distinct parts within three standard errors, medians within the rank error."""
    li = table(spark, sf_dir, "lineitem")
    stored = sketches.summarise(li, {"l_returnflag": F.col("l_returnflag"), "ano": F.year("l_shipdate")}, ["l_partkey"], ["l_extendedprice"])
    made = sketches.combined(stored, ["l_returnflag"]).select("l_returnflag", "n", sketches.distinct_count("l_partkey").alias("d"), sketches.quantile("l_extendedprice", 0.5).alias("q"))
    exact = li.join(made.select(F.col("l_returnflag").alias("f"), "q"), F.col("l_returnflag") == F.col("f")).groupBy("f").agg(F.count_distinct("l_partkey").alias("parts"), F.avg((F.col("l_extendedprice") <= F.col("q")).cast("int")).alias("rank"))
    both = made.join(exact, F.col("l_returnflag") == F.col("f"))
    return both.select("l_returnflag", "n", (F.abs(F.col("d") - F.col("parts")) <= 3 * sketches.HLL_ERROR * F.col("parts")).alias("d_good"), (F.abs(F.col("rank") - 0.5) <= sketches.KLL_ERROR + 0.001).alias("q_good"))


# --- loose SQL ------------------------------------------------------------------------------------------------------
@query("select c_custkey, c_custkey // 7 q, case when c_custkey % 3 != 0 then c_custkey // (c_custkey % 3) end z, c_custkey % 5 m, c_name ilike 'CUSTOMER%7' l, (regexp_extract(c_name, '[0-9]+$'))::bigint i, 0::bigint n, c_custkey + 0.5 r from customer")
def loose_sql(spark, sf_dir):
    table(spark, sf_dir, "customer").createOrReplaceTempView("q_loose")
    text = "select c_custkey, loose_quotient(c_custkey, 7) q, loose_quotient(c_custkey, c_custkey % 3) z, loose_remainder(c_custkey, 5) m, loose_like(c_name, 'CUSTOMER%7') l, loose_integer(concat(' ', substr(c_name, 10), 'x')) i, loose_integer(c_name) n, loose_real(concat(c_custkey, '.5e0kg')) r from q_loose"
    sqltools.check(spark, text, loose=True)
    return spark.sql(text)


@query("select c_nationkey, c_custkey, c_acctbal from customer qualify row_number() over (partition by c_nationkey order by c_acctbal desc, c_custkey desc) = 1")
def bare_columns_beside_max(spark, sf_dir):
    return loose.with_extreme(table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_acctbal"), ["c_nationkey"], "c_acctbal")
