"""Raw deliveries to table rows: members of the watchlist, typed columns, one row a key.

A mapping names, for each target column, its source column and cleaner; source columns are target names but for case unless
stated. Raw frames have the ordinals year, member and pos.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon import schema
from quillon.functions import clean
from quillon.operators.dedup import keep_first, keep_last
from quillon.operators.merge import SnapshotStore, TableSpec
from quillon.sources.zipcsv import BUYBACK_KEYS, FORM_MEMBERS, buyback_key

ORDER = ["year", "member", "pos"]
_BY_TYPE: dict[str, Callable[[Column], Column]] = {"date": clean.to_date, "bigint": clean.to_long, "int": lambda c: clean.to_long(c).cast("int"), "double": clean.to_double, "string": lambda c: c}
_OWN = {"created_at", "updated_at", "ano", "texto_extraido", "extracao_falhou", "extraido_em"}


def typed(df: DataFrame, spec: TableSpec, renamed: dict[str, str] | None = None, computed: dict[str, Column] | None = None) -> DataFrame:
    """The spec's columns from raw strings; a raw column that is missing gives null, except the key's."""
    raw = {c.lower(): c for c in df.columns}
    out = []
    for f in df.sparkSession.createDataFrame([], spec.schema).schema:
        if f.name in _OWN:
            continue
        if computed and f.name in computed:
            out.append(computed[f.name].alias(f.name))
            continue
        source = raw.get((renamed or {}).get(f.name, f.name).lower())
        if source is None and f.name in spec.key:
            raise KeyError(f"{spec.name}: no column for {f.name}")
        out.append((_BY_TYPE[f.dataType.simpleString()](F.col(source)) if source else F.lit(None).cast(f.dataType)).alias(f.name))
    return df.select(*ORDER, *out)


def of_watchlist(df: DataFrame, watchlist: DataFrame, column: str = "CNPJ_Companhia") -> DataFrame:
    return df.join(watchlist.select(F.col("cnpj").alias(column)).distinct(), column, "left_semi")


def documents(raw: DataFrame, watchlist: DataFrame) -> DataFrame:
    df = typed(of_watchlist(raw, watchlist), schema.DOCUMENTS, computed={"versao": clean.version_or_one(F.col("Versao"))})
    df = df.where("protocolo_entrega is not null and protocolo_entrega != ''").withColumn("ano", F.year("data_entrega"))
    return keep_last(df, ["protocolo_entrega"], ORDER)


def last_member(raw: DataFrame) -> DataFrame:
    """Rows of each year's last member in its archive; by name where rows don't say their member's ``place`` (one row a year on the right side)."""
    by = "place" if "place" in raw.columns else "member"
    last = raw.groupBy(F.col("year").alias("_y")).agg(F.max(by).alias("_m"))
    return raw.join(last, raw["year"].eqNullSafe(last["_y"]) & (raw[by] == last["_m"]), "left_semi")


def positions(raw: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Of a delivery with several members of positions the last one counts, whole."""
    df = typed(of_watchlist(last_member(raw.where(~F.col("member").contains("_con_"))), watchlist), schema.POSITIONS)
    return keep_last(df, list(schema.POSITIONS.key), ORDER)


def movements(raw: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Of several members the last one counts, whole; repeated raw keys keep their first row, before the watchlist is looked at."""
    df = last_member(raw.where(F.col("member").contains("_con_")))
    df = keep_first(df, [c for c in df.columns if c.lower() in schema.MOVEMENTS.key], ORDER)
    return keep_last(typed(of_watchlist(df, watchlist), schema.MOVEMENTS), list(schema.MOVEMENTS.key), ORDER)


def programmes(raw: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Members with other keys (amounts, brokers) are no programmes; see ``buyback_details``."""
    df = typed(of_watchlist(last_member(raw.where(buyback_key(F.col("member")) == "programas")), watchlist), schema.PROGRAMMES)
    return keep_last(df, ["id_programa"], ORDER)


def buyback_details(raw: DataFrame, watchlist: DataFrame, spec: TableSpec) -> DataFrame:
    """Amounts or brokers of programmes, by spec; they are published only when all their programmes are there, so load those first."""
    own = buyback_parts(raw)[spec.name.removeprefix("recompra_")]
    return keep_last(typed(of_watchlist(last_member(own), watchlist), spec), list(spec.key), ORDER)


def reference_form(raw: DataFrame, watchlist: DataFrame, spec: TableSpec) -> DataFrame:
    """Capital, shareholders or pay, by spec: rows of the member that belongs to it."""
    own = raw.where(F.lower("member").rlike(f"(^|/)fre_cia_aberta_{FORM_MEMBERS[spec.name]}_[0-9]{{4}}[.]csv$"))
    return keep_last(typed(of_watchlist(own, watchlist), spec), list(spec.key), ORDER)


def buyback_parts(raw: DataFrame) -> dict[str, DataFrame]:
    """Raw rows of the buyback delivery by key: quantidades, intermediarios, programas."""
    return {k: raw.where(buyback_key(F.col("member")) == k) for k in (*BUYBACK_KEYS, "programas")}


def statements(raw: DataFrame, watchlist: DataFrame, source: str, with_period: bool = False) -> DataFrame:
    """Facts of one source (DFP or ITR). An unknown scale is an error when rows are computed.

    Rows equal in key and value are one; of those left the last in file order stays, whatever its period, unless ``with_period`` makes
    the start date part of the key. DFP rows have no start date.
    """
    key = ["CNPJ_CIA", "tipo", "DT_REFER", "VERSAO", "ORDEM_EXERC", "CD_CONTA"]
    df = of_watchlist(raw, watchlist, "CNPJ_CIA").withColumn("tipo", F.upper(F.regexp_extract("member", r"(?i)_aberta_(\w+?)_con_", 1)))
    df = keep_first(df, [*key, "VL_CONTA", *(["DT_INI_EXERC"] if with_period and "DT_INI_EXERC" in df.columns else [])], ORDER)
    value = clean.scaled(clean.to_double(F.col("VL_CONTA")), F.col("ESCALA_MOEDA"))
    start = clean.to_date(F.col("DT_INI_EXERC")) if source == "ITR" and "DT_INI_EXERC" in df.columns else F.lit(None).cast("date")
    df = typed(df, schema.STATEMENTS, {"cnpj_companhia": "CNPJ_CIA", "data_referencia": "DT_REFER", "dt_fim_exerc": "DT_FIM_EXERC"}, {"fonte": F.lit(source), "tipo_doc": F.col("tipo"), "versao": clean.version_or_one(F.col("VERSAO")), "ordem_exercicio": clean.year_order(F.col("ORDEM_EXERC")), "vl_conta": value, "dt_ini_exerc": start})
    return keep_last(df, [*schema.STATEMENTS.key, *(["dt_ini_exerc"] if with_period else [])], ORDER)


def companies(watchlist: DataFrame) -> DataFrame:
    """One row a company; of several tickers the last in the list stays. ``watchlist`` has its ordinal in ``pos``."""
    df = watchlist.select("pos", "cnpj", F.upper(F.trim("ticker")).alias("ticker"), clean.empty_to_null(F.col("codigo_cvm")).alias("codigo_cvm"), F.col("nome_cvm").alias("nome"), "setor", "status_cvm", clean.empty_to_null(F.col("observacao")).alias("observacao"))
    return keep_last(df, ["cnpj"], ["pos"]).drop("pos")


def years(since: int | None, this_year: int, mode: str = "history") -> range:
    """history: since .. now; weekly: last year and this one; current: this year."""
    if mode == "history":
        return range(since or 2010, this_year + 1)
    return range(this_year - (mode == "weekly"), this_year + 1)


def load_each(store: SnapshotStore, spec: TableSpec, parts: Iterable[tuple[str, Callable[[], DataFrame]]], contain: bool = True) -> dict[str, str]:
    """Merges part by part. A part whose data are bad changes nothing; with ``contain`` the others go on, and the result names its error."""
    out = {}
    for name, make in parts:
        try:
            out[name] = "merged" if store.merge(spec, make().drop(*ORDER)) else "empty"
        except Exception as e:
            if not contain:
                raise
            out[name] = f"failed: {str(e).splitlines()[0][:200]}"
    return out
