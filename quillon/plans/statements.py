"""Statement facts (one row an account and version) to income statements, balance sheets and ratios.

Facts have cnpj_companhia, fonte, tipo_doc, data_referencia, versao, ordem_exercicio, dt_ini_exerc, dt_fim_exerc, cd_conta and vl_conta.
The latest version is picked for each account, so an account that only an older version has stays. A group is there if any account of its kind
is, whatever its measures. Version choice and pivot share the company's partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.clean import ratio
from quillon.operators.dedup import latest_version

#: Accounts by measure.
INCOME = {"receita_liquida": "3.01", "custo_bens_servicos": "3.02", "resultado_bruto": "3.03", "ebit": "3.05", "resultado_financeiro": "3.06", "ebt": "3.08", "lucro_liquido": "3.11"}
BALANCE = {"ativo_total": ("BPA", "1"), "ativo_circulante": ("BPA", "1.01"), "caixa": ("BPA", "1.01.01"), "divida_curto_prazo": ("BPP", "2.01.04"), "divida_longo_prazo": ("BPP", "2.02.01"), "patrimonio_liquido": ("BPP", "2.03")}
LAST_YEAR = "Último"


def pivot(df: DataFrame, keys: list[str], measures: dict[str, Column], value: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """One grouped aggregate: the greatest ``value`` where a measure's condition holds."""
    return df.groupBy(*keys).agg(*(c.alias(n) for n, c in (extra or {}).items()), *(F.max(F.when(c, F.col(value))).alias(n) for n, c in measures.items()))


def income_statement(facts: DataFrame) -> DataFrame:
    keys = ["cnpj_companhia", "fonte", "data_referencia"]
    f = latest_version(facts.where((F.col("tipo_doc") == "DRE") & (F.col("ordem_exercicio") == LAST_YEAR)), [*keys, "cd_conta"], "versao")
    return pivot(f, keys, {n: F.col("cd_conta") == c for n, c in INCOME.items()}, "vl_conta", {c: F.min(c) for c in ("dt_ini_exerc", "dt_fim_exerc")})


def balance_sheet(facts: DataFrame) -> DataFrame:
    keys = ["cnpj_companhia", "fonte", "data_referencia"]
    f = facts.where(F.col("tipo_doc").isin("BPA", "BPP") & (F.col("ordem_exercicio") == LAST_YEAR))
    f = latest_version(f, [*keys, "tipo_doc", "cd_conta"], "versao")
    return pivot(f, keys, {n: (F.col("tipo_doc") == t) & (F.col("cd_conta") == c) for n, (t, c) in BALANCE.items()}, "vl_conta", {"dt_fim_exerc": F.min("dt_fim_exerc")})


def with_net_debt(balance: DataFrame) -> DataFrame:
    """Short- and long-term debt less cash, and its change to the date before. A part that isn't stated counts as 0; without any part there is no net debt."""
    w = Window.partitionBy("cnpj_companhia", "fonte").orderBy("data_referencia")
    short, long, cash = (F.col(c) for c in ("divida_curto_prazo", "divida_longo_prazo", "caixa"))
    stated = F.coalesce(short, long, cash).isNotNull()
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    out = balance.withColumn("divida_liquida", F.when(stated, zero(short) + zero(long) - zero(cash)))
    return out.withColumn("variacao", F.col("divida_liquida") - F.lag("divida_liquida").over(w))


def with_margin(income: DataFrame, profit: str = "ebit", revenue: str = "receita_liquida", out: str = "margem_ebit") -> DataFrame:
    return income.withColumn(out, F.try_divide(profit, revenue))


def per_share(df: DataFrame) -> DataFrame:
    """Of net_income, jcp, dividends and shares: eps, dps_jcp, dps_div (three digits) and payout (per cent, one digit)."""
    n = F.col("shares")
    return df.withColumns({"eps": ratio(F.col("net_income"), n), "dps_jcp": ratio(F.col("jcp"), n), "dps_div": ratio(F.col("dividends"), n), "payout": ratio((F.col("jcp") + F.col("dividends")) * 100, F.col("net_income"), 1)})


def growth(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """``yoy``: the change to the row before, as a share of it."""
    last = F.lag(value).over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("yoy", F.try_divide(F.col(value), last) - 1)


def cagr(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Yearly growth from each group's first to its last year; null for a single year or a first value of 0."""
    g = df.groupBy(*keys).agg(F.min_by(value, order).alias("first_value"), F.max_by(value, order).alias("last_value"), (F.max(order) - F.min(order)).alias("years"))
    return g.withColumn("cagr", F.when(F.col("years") > 0, F.pow(F.try_divide("last_value", "first_value"), F.try_divide(F.lit(1.0), "years")) - 1))


def top_holders(positions: DataFrame, n: int = 3) -> DataFrame:
    """Largest shareholders of each company in its latest filing (date, then version)."""
    keys = ["cnpj_companhia"]
    latest = positions.withColumn("_r", F.rank().over(Window.partitionBy(*keys).orderBy(F.desc("data_referencia"), F.desc("versao")))).where("_r = 1").drop("_r")
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("percentual_total_acoes_circulacao"), "id_acionista")
    return latest.withColumn("posicao", F.row_number().over(w)).where(F.col("posicao") <= n)


def active_programmes(programmes: DataFrame, today: Column | None = None) -> DataFrame:
    return programmes.where(F.col("data_final_prazo") >= (F.current_date() if today is None else today))
