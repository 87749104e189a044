"""Loose SQL meanings beside SQLite, and stored sketches beside exact values."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from quillon.functions import loose
from quillon.operators import sketches
from quillon.plans import sqltools

NUMBERS = [5, 2, 0, -7, 3, None, 10**15]
TEXTS = ["12abc", "abc", "", "  42", "-3.9x", "1e3", ".5", "5.", "+7", "-", "1_000", "9999999999999999999", "-9999999999999999999", "0x10", "inf", "\t8", None, "1,5", "３"]
PATTERNS = ["abc", "A%", "%b_", "a\\%", "Ç%", "ç%", "%", "", None, "a[b]c", "_"]
WORDS = ["abc", "ABC", "aXc", "a%", "a\\b", "ção", "Ção", "", None, "a[b]c", "İ"]


def lite(sql, *args):
    return sqlite3.connect(":memory:").execute(sql, args).fetchone()[0]


def test_numbers_equal_sqlite(spark):
    pairs = [(a, b) for a in NUMBERS for b in NUMBERS]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = df.select("a", "b", loose.quotient(F.col("a"), F.col("b")).alias("q"), loose.ratio(F.col("a") + 0.5, F.col("b")).alias("r"), loose.remainder(F.col("a"), F.col("b")).alias("m")).collect()
    for r in got:
        a, b = r["a"], r["b"]
        assert (r["q"], r["m"]) == (lite("select ? / ?", a, b), lite("select ? % ?", a, b)), (a, b)
        assert r["r"] == lite("select (? + 0.5) / ?", a, b)


@pytest.mark.parametrize(("f", "kind"), [(loose.to_integer, "integer"), (loose.to_real, "real")])
def test_casts_equal_sqlite(spark, f, kind):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    assert [(r["t"], r["x"]) for r in df.select("t", f(F.col("t")).alias("x")).collect()] == [(t, lite(f"select cast(? as {kind})", t)) for t in TEXTS]


def test_like_equals_sqlite(spark):
    pairs = [(w, p) for w in WORDS for p in PATTERNS]
    got = spark.createDataFrame(pairs, "w string, p string").select(loose.like(F.col("w"), F.col("p")).alias("x")).collect()
    assert [r["x"] for r in got] == [None if (x := lite("select ? like ?", w, p)) is None else bool(x) for w, p in pairs]


def test_bare_columns_beside_an_extreme(spark):
    rows = [("a", 3, "x"), ("a", 9, "y"), ("b", None, "z"), ("b", 1, "w"), (None, 2, "v"), ("c", None, "u")]
    con = sqlite3.connect(":memory:")
    con.execute("create table t(k, v, s)")
    con.executemany("insert into t values (?, ?, ?)", rows)
    df = spark.createDataFrame(rows, "k string, v int, s string")
    for least, f in ((False, "max"), (True, "min")):
        got = sorted((tuple(r) for r in loose.with_extreme(df, ["k"], "v", least).collect()), key=str)
        assert got == sorted(con.execute(f"select k, {f}(v), s from t group by k").fetchall(), key=str)


def test_sql_functions_behind_the_guard(spark):
    spark.createDataFrame([("5x", "ABC"), (None, "b")], "t string, s string").createOrReplaceTempView("loose_table")
    sql = "select loose_quotient(loose_integer(t), 2) q, loose_like(s, 'a%') l, loose_quotient(1, 0) z, loose_ratio(1, 4) r, loose_remainder(7.9, 4) m, loose_real(t) d from loose_table order by s"
    got = list(sqltools.query(spark, sql, loose=True))
    assert got == [{"q": 2, "l": True, "z": None, "r": 0.25, "m": 3, "d": 5.0}, {"q": None, "l": False, "z": None, "r": 0.25, "m": 3, "d": None}]
    with pytest.raises(sqltools.NotAllowed):
        sqltools.query(spark, sql)
    for t in TEXTS:
        literal = "cast(null as string)" if t is None else f"'{t}'"
        assert list(sqltools.query(spark, f"select loose_integer({literal}) i, loose_real({literal}) r", loose=True)) == [{"i": lite("select cast(? as integer)", t), "r": lite("select cast(? as real)", t)}]


def test_sketches_put_together_are_within_their_bounds(spark, tmp_path):
    df = spark.range(60_000).select((F.col("id") % 6 + 2018).alias("ano"), (F.col("id") % 2).alias("kind"), (F.col("id") * 7 % 9_000).alias("company"), F.when(F.col("id") % 10 != 0, F.col("id") * 31 % 10_007).alias("value"))
    sketches.summarise(df, {"ano": F.col("ano"), "kind": F.col("kind")}, ["company"], ["value"]).write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    assert stored.count() == 6
    for some, rows in ((stored.where("ano >= 2020"), df.where("ano >= 2020")), (stored, df)):
        whole = sketches.summarise(rows, {}, ["company"], ["value"])
        for made in (sketches.combined(some), whole):
            r = made.select("n", sketches.distinct_count("company").alias("d"), *(sketches.quantile("value", p).alias(f"q{int(100 * p)}") for p in (0.1, 0.5, 0.9))).first()
            exact = rows.agg(F.count_distinct("company").alias("d")).first()["d"]
            assert r["n"] == rows.count() and abs(r["d"] - exact) <= 3 * sketches.HLL_ERROR * exact
            for p in (0.1, 0.5, 0.9):
                rank = rows.where(F.col("value") <= r[f"q{int(100 * p)}"]).count() / rows.where("value is not null").count()
                assert abs(rank - p) <= sketches.KLL_ERROR
    assert sketches.combined(stored, ["kind"]).count() == 2 and sketches.combined(stored.limit(0), ["kind"]).count() == 0
