"""Registered queries: each operator on the star-schema, event and document tables, and its DuckDB counterpart.

Statements are lineitem rows (company: supplier, account: return flag, source: line status, version: line number), companies
are suppliers and customers, filings are documents, insider movements are events, buybacks are orders.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.functions import clean, sectors
from quillon.operators import dedup, fts, joins, merge
from quillon.plans import catalog, sqltools, statements
from quillon.registry import QUERIES, SQL, Query, query, table
from quillon.sources import pdf

def _facts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("cnpj"), F.year("l_shipdate").alias("ano"), F.col("l_returnflag").alias("cd_conta"), F.col("l_linestatus").alias("fonte"), F.col("l_linenumber").alias("versao"), F.col("l_extendedprice").alias("vl"))


_FACTS = "facts as (select l_suppkey cnpj, year(l_shipdate)::int ano, l_returnflag cd_conta, l_linestatus fonte, l_linenumber versao, l_extendedprice vl from lineitem)"
_LATEST = "latest as (select f.* from facts f join (select cnpj, ano, cd_conta, fonte, max(versao) versao from facts group by all) m using (cnpj, ano, cd_conta, fonte, versao))"
_KEYS = ["cnpj", "ano", "fonte"]


# --- membership, joins --------------------------------------------------------------------------------------------
@query("select o_orderkey, o_custkey, o_totalprice from orders where exists (select 1 from customer where c_custkey = o_custkey and c_mktsegment = 'BUILDING')")
def watchlist_semi_join(spark, sf_dir):
    watch = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return joins.members(table(spark, sf_dir, "orders"), watch, "o_custkey").select("o_orderkey", "o_custkey", "o_totalprice")


@query("select c_custkey, c_name from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')")
def catalog_anti_join(spark, sf_dir):
    placed = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.non_members(table(spark, sf_dir, "customer"), placed, "c_custkey").select("c_custkey", "c_name")


@query("select c_custkey, coalesce(n_name, 'none') nation, coalesce(nullif(r_name, ''), n_name) region from customer left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey")
def left_join_coalesce(spark, sf_dir):
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    df = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
    return df.select("c_custkey", F.coalesce("n_name", F.lit("none")).alias("nation"), F.coalesce(clean.empty_to_null(F.col("r_name")), F.col("n_name")).alias("region"))


@query("select c_custkey, concat_ws(',', case when c_mktsegment = 'BUILDING' then 'B' end, case when c_acctbal > 5000 then 'RICH' end, case when c_nationkey < 5 then 'LOW' end) indices from customer")
def index_flags_join(spark, sf_dir):
    flags = {"B": F.col("c_mktsegment") == "BUILDING", "RICH": F.col("c_acctbal") > 5000, "LOW": F.col("c_nationkey") < 5}
    return table(spark, sf_dir, "customer").select("c_custkey", joins.joined_flags(flags).alias("indices"))


@query("""select event_id, user_id from events p where event_type = 'purchase' and exists (select 1 from events e where e.event_type = 'error' and e.user_id = p.user_id and e.ts >= p.ts and e.ts <= p.ts + interval 7 day)""")
def insider_window(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return joins.with_event_within(e.where("event_type = 'purchase'"), e.where("event_type = 'error'"), "user_id", "ts", "ts", "7 days").select("event_id", "user_id")


@query("""with b as (select event_id, user_id, ts from events where event_type = 'purchase'), f as (select event_id fid, user_id, ts ft, value from events where event_type = 'signup'),
p as (select b.event_id, arg_max(f.value, (f.ft, f.fid)) v from b join f on f.user_id = b.user_id and f.ft <= b.ts group by 1), n as (select b.event_id, arg_min(f.value, (f.ft, f.fid)) v from b join f on f.user_id = b.user_id group by 1)
select b.event_id, b.user_id, coalesce(p.v, n.v) shares from b left join p using (event_id) left join n using (event_id)""")
def asof_shares_fallback(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    out = joins.as_of(left, e.where("event_type = 'signup'"), "user_id", "ts", "ts", "value", "shares", ["event_id"], tie="event_id")
    return out.select("event_id", "user_id", "shares")


# --- latest version, pivots, ratios ---------------------------------------------------------------------------------
_LATEST_SQL = f"with {_FACTS}, {_LATEST} select cnpj, ano, cd_conta, fonte, versao, vl from latest"


@query(_LATEST_SQL)
def latest_version_self_join(spark, sf_dir):
    return dedup.latest_version_by_join(_facts(spark, sf_dir), [*_KEYS, "cd_conta"], "versao").select("cnpj", "ano", "cd_conta", "fonte", "versao", "vl")


@query(_LATEST_SQL)
def latest_version_window(spark, sf_dir):
    return dedup.latest_version(_facts(spark, sf_dir), [*_KEYS, "cd_conta"], "versao").select("cnpj", "ano", "cd_conta", "fonte", "versao", "vl")


@query(f"with {_FACTS}, {_LATEST} select cnpj, ano, fonte, max(vl) filter (cd_conta = 'A') receita, max(vl) filter (cd_conta = 'N') ebit, max(vl) filter (cd_conta = 'R') lucro from latest group by all")
def income_statement_pivot(spark, sf_dir):
    f = dedup.latest_version(_facts(spark, sf_dir), [*_KEYS, "cd_conta"], "versao")
    return statements.pivot(f, _KEYS, {"receita": F.col("cd_conta") == "A", "ebit": F.col("cd_conta") == "N", "lucro": F.col("cd_conta") == "R"}, "vl")


def _balance(spark, sf_dir):
    f = dedup.latest_version(_facts(spark, sf_dir), [*_KEYS, "cd_conta"], "versao")
    at = lambda s, c: (F.col("fonte") == s) & (F.col("cd_conta") == c)
    return statements.pivot(f, ["cnpj", "ano"], {"caixa": at("F", "A"), "curto": at("F", "R"), "longo": at("O", "N")}, "vl")


_BALANCE = f"{_FACTS}, {_LATEST}, bal as (select cnpj, ano, max(vl) filter (fonte = 'F' and cd_conta = 'A') caixa, max(vl) filter (fonte = 'F' and cd_conta = 'R') curto, max(vl) filter (fonte = 'O' and cd_conta = 'N') longo from latest group by all)"


@query(f"with {_BALANCE} select * from bal")
def balance_pivot_2d(spark, sf_dir):
    return _balance(spark, sf_dir)


@query(f"with {_BALANCE}, d as (select cnpj, ano, case when coalesce(curto, longo, caixa) is not null then coalesce(curto, 0) + coalesce(longo, 0) - coalesce(caixa, 0) end divida from bal) select cnpj, ano, round(divida, 2) divida, round(divida - lag(divida) over (partition by cnpj order by ano), 2) variacao from d")
def net_debt(spark, sf_dir):
    b = _balance(spark, sf_dir).select(F.col("cnpj").alias("cnpj_companhia"), F.lit("DFP").alias("fonte"), F.col("ano").alias("data_referencia"), "caixa", F.col("curto").alias("divida_curto_prazo"), F.col("longo").alias("divida_longo_prazo"))
    return statements.with_net_debt(b).select(F.col("cnpj_companhia").alias("cnpj"), F.col("data_referencia").alias("ano"), F.round("divida_liquida", 2).alias("divida"), F.round("variacao", 2).alias("variacao"))


def _by_year(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("ano"), "o_totalprice", "o_orderstatus")
    return o.groupBy("k", "ano").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"), F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice").cast("decimal(18,2)"))).cast("double").alias("done"))


_BY_YEAR = "y as (select o_custkey k, year(o_orderdate)::int ano, sum(o_totalprice::decimal(18,2))::double total, (sum(o_totalprice::decimal(18,2)) filter (o_orderstatus = 'F'))::double done from orders group by all)"


@query(f"with {_BY_YEAR} select k, ano, round(done / nullif(total, 0), 6) margem from y")
def margin_by_year(spark, sf_dir):
    return statements.with_margin(_by_year(spark, sf_dir), "done", "total", "margem").select("k", "ano", F.round("margem", 6).alias("margem"))


@query(f"with {_BY_YEAR} select k, ano, round(total / nullif(lag(total) over (partition by k order by ano), 0) - 1, 6) yoy from y")
def yoy_growth(spark, sf_dir):
    return statements.growth(_by_year(spark, sf_dir), ["k"], "ano", "total").select("k", "ano", F.round("yoy", 6).alias("yoy"))


@query(f"with {_BY_YEAR}, g as (select k, arg_min(total, ano) a, arg_max(total, ano) b, max(ano) - min(ano) n from y group by 1) select k, n::int as years, case when n > 0 then round(pow(b / nullif(a, 0), 1.0 / n) - 1, 6) end cagr from g")
def cagr(spark, sf_dir):
    return statements.cagr(_by_year(spark, sf_dir), ["k"], "ano", "total").select("k", "years", F.round("cagr", 6).alias("cagr"))


@query(f"""with {_BY_YEAR}, s as (select c_custkey k, c_acctbal shares from customer where c_acctbal > 0) select k, ano, round(total / shares, 3) eps, round(done / shares, 3) dps_jcp, round((coalesce(done, 0) + 0) * 100 / nullif(total, 0), 1) payout, round((coalesce(done, 0)) * 100 / nullif(total, 0), 1) > 70 high from y join s using (k)""")
def per_share_payout(spark, sf_dir):
    shares = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("shares"))
    y = _by_year(spark, sf_dir).join(shares, "k").select("k", "ano", "shares", F.col("total").alias("net_income"), F.coalesce("done", F.lit(0.0)).alias("jcp"), F.lit(0.0).alias("dividends"), "done")
    return statements.per_share(y).select("k", "ano", "eps", F.when(F.col("done").isNotNull(), F.col("dps_jcp")).alias("dps_jcp"), "payout", (F.col("payout") > 70).alias("high"))


# --- dedup, upsert --------------------------------------------------------------------------------------------------
@query("select event_id, user_id, event_type, value from events qualify row_number() over (partition by user_id, event_type order by event_id) = 1")
def dedup_keep_first(spark, sf_dir):
    return dedup.keep_first(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"), ["user_id", "event_type"], ["event_id"])


@query("select event_id, user_id, event_type, value from events qualify row_number() over (partition by user_id, event_type order by event_id desc) = 1")
def dedup_keep_last(spark, sf_dir):
    return dedup.keep_last(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"), ["user_id", "event_type"], ["event_id"])


def _slices(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    types = lambda *x: dedup.keep_last(e.where(F.col("event_type").isin(*x)), ["user_id"], ["event_id"])
    return types("view", "click"), types("purchase", "error")


_SLICES = "t as (select user_id, event_type, event_id, value from events where event_type in ('view', 'click') qualify row_number() over (partition by user_id order by event_id desc) = 1), s as (select user_id, event_type, event_id, value from events where event_type in ('purchase', 'error') qualify row_number() over (partition by user_id order by event_id desc) = 1)"


@query(f"with {_SLICES} select coalesce(s.user_id, t.user_id) user_id, coalesce(s.event_type, t.event_type) event_type, coalesce(s.event_id, t.event_id) event_id, coalesce(s.value, t.value) as value from t full join s on t.user_id is not distinct from s.user_id")
def upsert_merge(spark, sf_dir):
    t, s = _slices(spark, sf_dir)
    return merge.upsert(t, s, ["user_id"], preserve=())


@query(f"with {_SLICES} select coalesce(s.user_id, t.user_id) user_id, coalesce(s.event_type, t.event_type) event_type, case when t.user_id is not null then t.event_id else s.event_id end event_id, t.value as value from t full join s on t.user_id is not distinct from s.user_id")
def upsert_partial_columns(spark, sf_dir):
    t, s = _slices(spark, sf_dir)
    return merge.upsert(t, s.drop("value"), ["user_id"], preserve=("event_id",))


# --- cleaning -------------------------------------------------------------------------------------------------------
_RAW_NUMBER = "case when event_id % 7 = 0 then 'nan' when event_id % 7 = 1 then '' when event_id % 7 = 2 then '1.234,56' when event_id % 7 = 3 then (event_id % 1000)::varchar || ',5' when event_id % 7 = 4 then '-' || (event_id % 1000)::varchar || '.25' when event_id % 7 = 5 then ' 12 ' else '5f' end"
_SPARK_RAW_NUMBER = _RAW_NUMBER.replace("::varchar", "").replace("(event_id % 1000)", "cast(event_id % 1000 as string)")
_NUMBER_VALUE = "case when event_id % 7 = 3 then (event_id % 1000) + 0.5 when event_id % 7 = 4 then -((event_id % 1000) + 0.25) when event_id % 7 = 5 then 12.0 end::double"


@query(f"select event_id, {_NUMBER_VALUE} as num from events")
def clean_decimal(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr("event_id", f"{_SPARK_RAW_NUMBER} as raw").select("event_id", clean.to_double(F.col("raw")).alias("num"))


@query(f"select event_id, trunc({_NUMBER_VALUE})::bigint as num from events")
def clean_int(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr("event_id", f"{_SPARK_RAW_NUMBER} as raw").select("event_id", clean.to_long(F.col("raw")).alias("num"))


@query("select o_orderkey, case when o_orderkey % 4 < 3 then strftime(o_orderdate, '%Y-%m-%d') end as d from orders")
def clean_date(spark, sf_dir):
    raw = "case o_orderkey % 4 when 0 then date_format(o_orderdate, 'yyyy-MM-dd') when 1 then date_format(o_orderdate, 'd/M/yyyy') when 2 then concat(' ', date_format(o_orderdate, 'yyyy-M-d')) else date_format(o_orderdate, 'yyyyMMdd') end as raw"
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", raw).select("o_orderkey", clean.to_date(F.col("raw")).cast("string").alias("d"))


@query("select c_custkey, case when c_custkey % 3 = 2 then c_name end as s from customer")
def null_tokens(spark, sf_dir):
    return clean.na_to_null(table(spark, sf_dir, "customer").selectExpr("c_custkey", "case c_custkey % 3 when 0 then 'N/A' when 1 then '' else c_name end as s"))


@query("select l_orderkey, l_linenumber, round(case when l_linestatus = 'O' then l_quantity * 1000 else l_quantity end, 2) vl from lineitem")
def scale_normalize(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(clean.scaled(F.col("l_quantity"), F.when(F.col("l_linestatus") == "O", "MIL").otherwise("UNIDADE")), 2).alias("vl"))


@query("select l_orderkey, l_linenumber, case l_returnflag when 'A' then 'Último' when 'N' then 'Penúltimo' else l_returnflag end ordem from lineitem")
def domain_map(spark, sf_dir):
    raw = F.when(F.col("l_returnflag") == "A", " último ").when(F.col("l_returnflag") == "N", "PENÚLTIMO").otherwise(F.col("l_returnflag"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", clean.year_order(raw).alias("ordem"))


@query("select c_custkey, case c_mktsegment when 'BUILDING' then 'Imobiliario' when 'AUTOMOBILE' then 'Varejo' else 'Outros' end setor from customer")
def sector_map_default(spark, sf_dir):
    raw = F.when(F.col("c_mktsegment") == "BUILDING", " Construção Civil").when(F.col("c_mktsegment") == "AUTOMOBILE", "Têxtil e Vestuário").otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", sectors.sector(raw).alias("setor"))


@query(r"select c_custkey, case when c_custkey > 0 then regexp_replace(lpad((c_custkey * 7919)::varchar, 14, '0'), '^(..)(...)(...)(....)(..)$', '\1.\2.\3/\4-\5') end cnpj from customer")
def cnpj_format(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", clean.format_cnpj((F.col("c_custkey") * 7919).cast("string")).alias("cnpj"))


# --- filters, top n, sets -------------------------------------------------------------------------------------------
@query("select p_partkey from part where regexp_matches(upper(p_name), 'BR.SS|#1') or regexp_matches(upper(p_brand), 'BR.SS|#1') or regexp_matches(upper(p_type), 'BR.SS|#1')")
def regex_search_multi(spark, sf_dir):
    return catalog.search(table(spark, sf_dir, "part"), "br.ss|#1", ["p_name", "p_brand", "p_type"]).select("p_partkey")


@query("select event_id from events where event_type in ('purchase', 'signup') and value > 10 and not coalesce(length(json_extract_string(props, '$.missing')) > 0, false)")
def composite_filter(spark, sf_dir):
    return table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "signup") & (F.col("value") > 10) & ~F.coalesce(F.length(F.get_json_object("props", "$.missing")) > 0, F.lit(False))).select("event_id")


def _filings(spark, sf_dir):
    """Documents as filings: company is the source, category the language, delivery date by length, a text where doc_id isn't divisible by 3, a failure where it's divisible by 5."""
    d = table(spark, sf_dir, "documents")
    key = F.lpad(F.col("doc_id").cast("string"), 12, "0")
    return d.select(
        key.alias("protocolo_entrega"), F.col("source").alias("cnpj_companhia"), F.col("lang").alias("categoria"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("n_chars") % 900).cast("int")).alias("data_entrega"), F.substring("text", 1, 40).alias("assunto"),
        F.when(F.col("doc_id") % 3 != 0, F.col("text")).alias("texto_extraido"), F.when(F.col("doc_id") % 5 == 0, 1).otherwise(0).alias("extracao_falhou"),
    )


_FILINGS = "filings as (select lpad(doc_id::varchar, 12, '0') protocolo_entrega, source cnpj_companhia, lang categoria, (date '2020-01-01' + (n_chars % 900)::int)::date data_entrega, case when doc_id % 3 != 0 then text end texto_extraido, (doc_id % 5 = 0)::int extracao_falhou from documents)"


@query(f"with {_FILINGS} select protocolo_entrega, data_entrega::varchar data_entrega from filings where texto_extraido is null and extracao_falhou = 0 and categoria = 'en' and cnpj_companhia in ('src0', 'src1') order by filings.data_entrega desc nulls last, protocolo_entrega limit 200")
def pending_topn(spark, sf_dir):
    return pdf.pending(_filings(spark, sf_dir), ["src0", "src1"], ["en"]).select("protocolo_entrega", F.col("data_entrega").cast("string").alias("data_entrega"))


@query(f"with {_FILINGS} select protocolo_entrega from filings where texto_extraido is null and extracao_falhou = 1 and categoria in ('en', 'fr') and cnpj_companhia in (select distinct source from documents where lang = 'de')")
def pending_retries(spark, sf_dir):
    companies = table(spark, sf_dir, "documents").where("lang = 'de'").select(F.col("source").alias("cnpj"))
    return pdf.pending(_filings(spark, sf_dir), companies, ["en", "fr"], None, retry_failed=True).select("protocolo_entrega")


@query(f"with {_FILINGS} select protocolo_entrega, data_entrega::varchar data_entrega from filings where cnpj_companhia = 'src0' and categoria = 'fr' order by filings.data_entrega desc nulls last, protocolo_entrega limit 10")
def latest_meetings(spark, sf_dir):
    return catalog.latest_meetings(_filings(spark, sf_dir), "src0", 10, "fr").select("protocolo_entrega", F.col("data_entrega").cast("string").alias("data_entrega"))


@query(f"""with {_FILINGS}, r as (select protocolo_entrega k, max(case when length(text) > 300 then left(text, 200) end) t, min(case when length(text) > 300 then 0 else 1 end) f from filings join documents on doc_id = protocolo_entrega::bigint where texto_extraido is null and doc_id % 2 = 0 group by 1)
select protocolo_entrega, coalesce(r.t, texto_extraido) texto_extraido, coalesce(r.f, extracao_falhou)::int extracao_falhou from filings left join r on k = protocolo_entrega""")
def texts_written_back(spark, sf_dir):
    docs = _filings(spark, sf_dir)
    d = table(spark, sf_dir, "documents").where("doc_id % 3 = 0 and doc_id % 2 = 0")
    good = F.length("text") > 300
    found = d.select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("protocolo_entrega"), F.when(good, F.substring("text", 1, 200)).alias("texto_extraido"), F.when(good, 0).otherwise(1).alias("extracao_falhou"))
    return pdf.save_texts(docs, found).select("protocolo_entrega", "texto_extraido", "extracao_falhou")


@query("select o_orderkey, o_custkey from orders where o_orderstatus = 'O' and o_orderdate::date >= date '1996-01-01'")
def active_programmes(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").withColumn("data_final_prazo", F.to_date("o_orderdate"))
    return statements.active_programmes(o, F.lit("1996-01-01").cast("date")).select("o_orderkey", "o_custkey")


@query("select c_nationkey, c_custkey, c_acctbal, row_number() over (partition by c_nationkey order by c_acctbal desc, c_custkey) as rank from customer qualify rank <= 3")
def top_holders(spark, sf_dir):
    return dedup.top_n_per_group(table(spark, sf_dir, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 3).select("c_nationkey", "c_custkey", "c_acctbal", F.col("rank").cast("long").alias("rank"))


@query("select event_id, user_id, round(sum(value) over (partition by user_id order by ts, event_id rows between 4 preceding and current row), 4) volume from events")
def running_volume(spark, sf_dir):
    out = dedup.rolling(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("value"), "volume", rows=5)
    return out.select("event_id", "user_id", F.round("volume", 4).alias("volume"))


@query("select event_id, round(sum(value) over (partition by user_id order by epoch(ts) range between 86400 preceding and current row), 4) volume from events")
def day_volume(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("s", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    return dedup.rolling(e, ["user_id"], ["s"], F.col("value"), "volume", span=86400).select("event_id", F.round("volume", 4).alias("volume"))


@query("select c_custkey, dense_rank() over (partition by c_nationkey order by c_mktsegment) as segment, ntile(4) over (partition by c_nationkey order by c_acctbal, c_custkey) as quarter from customer")
def ranks_in_groups(spark, sf_dir):
    c = dedup.ranked(table(spark, sf_dir, "customer"), ["c_nationkey"], [F.col("c_mktsegment")], "dense_rank", out="segment")
    c = dedup.ranked(c, ["c_nationkey"], [F.col("c_acctbal"), F.col("c_custkey")], "ntile", 4, "quarter")
    return c.select("c_custkey", F.col("segment").cast("long").alias("segment"), F.col("quarter").cast("long").alias("quarter"))


@query("select event_type, count(*) n, count(*) filter (value > 50) high, count(*) filter (value is null) missing from events group by 1")
def conditional_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("high"), F.count_if(F.col("value").isNull()).alias("missing"))


@query("select l_suppkey, count(distinct l_partkey) parts, count(distinct l_orderkey) orders from lineitem group by 1")
def distinct_agg(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_orderkey").alias("orders"))


@query("select l_returnflag, sum(distinct l_quantity::bigint)::bigint total, round(avg(distinct l_quantity::bigint), 6) mean from lineitem group by 1")
def distinct_sums(spark, sf_dir):
    q = F.col("l_quantity").cast("bigint")
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.sum_distinct(q).alias("total"), F.round(F.expr("avg(distinct cast(l_quantity as bigint))"), 6).alias("mean"))


@query("select l_returnflag, true as near from lineitem group by 1")
def approximate_distinct(spark, sf_dir):
    """Whether the estimate is within a tenth of the exact count."""
    g = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_orderkey", 0.02).alias("about"), F.count_distinct("l_orderkey").alias("exact"))
    return g.select("l_returnflag", (F.abs(F.col("about") - F.col("exact")) <= 0.1 * F.col("exact")).alias("near"))


@query("select l_returnflag, l_linestatus, count(*) n, sum(l_quantity::bigint)::bigint q from lineitem group by rollup (l_returnflag, l_linestatus)")
def rollup_totals(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("q"))


@query("select l_returnflag, l_linestatus, count(*) n from lineitem group by cube (l_returnflag, l_linestatus)")
def cube_totals(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("select l_returnflag, l_linestatus, count(*) n from lineitem group by grouping sets ((l_returnflag), (l_linestatus), ())")
def grouping_sets(spark, sf_dir):
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("q_lineitem")
    return spark.sql("select l_returnflag, l_linestatus, count(*) n from q_lineitem group by grouping sets ((l_returnflag), (l_linestatus), ())")


@query("select c_nationkey k, 'customer' fonte from customer union all select s_nationkey, 'supplier' from supplier")
def union_sources(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), F.lit("customer").alias("fonte"))
    return c.unionByName(table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), F.lit("supplier").alias("fonte")))


@query("select c_nationkey k from customer intersect select s_nationkey from supplier")
def intersect_members(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, sf_dir, "supplier").select("s_nationkey"))


@query("select c_custkey k from customer except select o_custkey from orders where o_orderstatus = 'P'")
def except_watchlist(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select("o_custkey"))


@query("select (select count(*) from orders) orders, (select count(*) from events) events, (select count(*) from documents) documents")
def row_counts(spark, sf_dir):
    one = lambda t: table(spark, sf_dir, t).agg(F.count("*").alias(t))
    return one("orders").join(one("events"), F.lit(True)).join(one("documents"), F.lit(True))


@query("select source, lang, count(*) n, max(n_chars) longest from documents where n_chars >= 1000 group by 1, 2")
def facts_by_type(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("n_chars >= 1000").groupBy("source", "lang").agg(F.count("*").alias("n"), F.max("n_chars").alias("longest"))


# --- full text ------------------------------------------------------------------------------------------------------
_TOK = r"tok as (select doc_id doc, regexp_extract_all(strip_accents(lower(coalesce(text, ''))), '[\p{L}\p{N}\p{Co}]+') w from documents)"
_POST = f"{_TOK}, post as (select doc, unnest(w) term, unnest(range(len(w)))::int pos from tok)"


def _index(spark, sf_dir):
    return fts.build_index(table(spark, sf_dir, "documents"), "doc_id", ["text"])


@query(f"with {_POST} select term, count(*) n, count(distinct doc) docs from post group by 1")
def fts_tokens(spark, sf_dir):
    return _index(spark, sf_dir).postings.groupBy("term").agg(F.count("*").alias("n"), F.count_distinct("doc").alias("docs"))


@query(f"with {_POST} select doc from post where term in ('the', 'ou') group by 1 having count(distinct term) = 2")
def fts_match_and(spark, sf_dir):
    return _index(spark, sf_dir).all_of(["the", "ou"])


@query(f"with {_POST} select distinct doc from post where term in ('une', 'der')")
def fts_match_or(spark, sf_dir):
    return _index(spark, sf_dir).any_of(["une", "der"])


@query(f"with {_POST} select distinct doc from post where starts_with(term, 'ention')")
def fts_prefix(spark, sf_dir):
    return _index(spark, sf_dir).term("ention", prefix=True)


@query(f"with {_POST} select distinct doc from post where term = 'the' except select doc from post where term = 'of'")
def fts_not(spark, sf_dir):
    i = _index(spark, sf_dir)
    return i.without(i.term("the"), ["of"])


@query(f"with {_POST} select distinct a.doc from post a join post b on a.doc = b.doc and b.pos = a.pos + 1 where a.term = 'of' and b.term = 'the'")
def fts_phrase(spark, sf_dir):
    return _index(spark, sf_dir).phrase(["of", "the"])


@query(f"with {_POST} select distinct a.doc from post a join post b on a.doc = b.doc and a.pos != b.pos and abs(a.pos - b.pos) <= 4 where a.term = 'de' and b.term = 'la'")
def fts_near(spark, sf_dir):
    return _index(spark, sf_dir).near("de", "la", 3)


@query(f"""with {_POST}, st as (select count(*) nd, avg(len(w)) al from tok), tf as (select doc, term, count(*) f from post where term in ('the', 'ou') group by all), n as (select term, count(*) n from tf group by 1), hit as (select doc from tf group by 1 having count(*) = 2)
select doc, round(-sum(greatest(ln((nd - n + 0.5) / (n + 0.5)), 1e-6) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(w) / al))), 6) rank from tf join hit using (doc) join n using (term) join tok using (doc), st group by doc""")
def fts_bm25(spark, sf_dir):
    return _index(spark, sf_dir).bm25(["the", "ou"]).select("doc", F.round("rank", 6).alias("rank"))


_TOP = f"""{_POST}, st as (select count(*) nd, avg(len(w)) al from tok), tf as (select doc, term, count(*) f from post where term in ('the', 'of') group by all), n as (select term, count(*) n from tf group by 1), hit as (select doc from tf group by 1 having count(*) = 2),
ranks as (select doc, round(-sum(greatest(ln((nd - n + 0.5) / (n + 0.5)), 1e-6) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(w) / al))), 6) rank from tf join hit using (doc) join n using (term) join tok using (doc), st group by doc)"""


@query(f"with {_TOP} select doc_id, lang, source from ranks join documents on doc_id = doc order by rank, doc_id limit 20")
def fts_top_documents(spark, sf_dir):
    """The 20 best documents by rank (rounded, so that ties don't depend on the order of sums)."""
    i, docs = _index(spark, sf_dir), table(spark, sf_dir, "documents")
    best = i.bm25(["the", "of"]).select("doc", F.round("rank", 6).alias("rank")).orderBy("rank", "doc").limit(20)
    return docs.join(best, F.col("doc_id") == F.col("doc")).select("doc_id", "lang", "source")


@query(r"select doc_id doc from documents where list_contains(regexp_extract_all(lower(source), '[\p{L}\p{N}]+'), 'src1') and list_contains(regexp_extract_all(strip_accents(lower(coalesce(text, ''))), '[\p{L}\p{N}\p{Co}]+'), 'the')")
def fts_column_filter(spark, sf_dir):
    i = fts.build_index(table(spark, sf_dir, "documents"), "doc_id", ["text", "source"])
    return i.term("src1", "source").join(i.term("the", "text"), "doc", "left_semi")


# --- JSON, SQL, windows in time -------------------------------------------------------------------------------------
@query("select event_id, json_extract_string(props, '$.k') k, json_extract_string(props, '$.page') page from events")
def json_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.get_json_object("props", "$.page").alias("page"))


@query("select n_name, count(*) n from customer join nation on n_nationkey = c_nationkey group by 1")
def sql_passthrough(spark, sf_dir):
    for t in ("customer", "nation"):
        table(spark, sf_dir, t).createOrReplaceTempView(f"q_{t}")
    text = "select n_name, count(*) n from q_customer join q_nation on n_nationkey = c_nationkey group by 1"
    sqltools.check(spark, text)
    return spark.sql(text)


@query("select time_bucket(interval 1 hour, ts) start, event_type, count(*) n from events group by all")
def tumbling_window(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


@query("select start, count(*) n from (select unnest([time_bucket(interval 30 minute, ts), time_bucket(interval 30 minute, ts) - interval 30 minute]) start from events) group by 1")
def sliding_window(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour", "30 minutes").alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")


@query("""with g as (select *, case when ts < lag(ts) over w + interval 1 hour then 0 else 1 end new from events window w as (partition by user_id order by ts)), s as (select *, sum(new) over (partition by user_id order by ts rows unbounded preceding) k from g)
select user_id, min(ts) start, count(*) n from s group by user_id, k""")
def session_window(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id", F.session_window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


from quillon import queries_deliveries  # noqa: E402, F401  (registers its own)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
