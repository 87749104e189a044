"""Full-text query strings beside SQLite's FTS5, and the index's edge cases."""

import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from quillon.operators import fts
from quillon.operators.match import MatchSyntaxError

VOCABULARY = ["ação", "acao", "lucro", "lucros", "dividendo", "fato", "relevante", "a", "b", "conselho"]


@pytest.fixture(scope="module")
def both(spark):
    """The same documents in SQLite and as an index."""
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(VOCABULARY) + rng.choice(["", "", ",", "!"]) for _ in range(rng.randrange(n)))
    docs = [(i, text(6), text(25)) for i in range(120)] + [(120, None, ""), (121, "", None)]
    con = sqlite3.connect(":memory:")
    con.execute("create virtual table t using fts5(subject, body)")
    con.executemany("insert into t(rowid, subject, body) values (?, ?, ?)", docs)
    index = fts.build_index(spark.createDataFrame(docs, "id long, subject string, body string"), "id", ["subject", "body"])
    local = spark.createDataFrame(index.postings.toPandas()).coalesce(1).cache()
    lengths = spark.createDataFrame(index.lengths.toPandas()).coalesce(1).cache()
    return con, fts.FtsIndex(local, lengths, columns=index.columns)


def expected(con, text):
    try:
        return sorted(r[0] for r in con.execute("select rowid from t where t match ?", (text,)))
    except sqlite3.OperationalError:
        return "error"


def found(index, text):
    try:
        return sorted(r["doc"] for r in index.match(text).collect())
    except MatchSyntaxError:
        return "error"


def random_query(rng, depth=0):
    word = lambda: rng.choice(VOCABULARY)

    def phrase():
        kind = rng.random()
        if kind < 0.5:
            return word() + rng.choice(["", "", "", "*"])
        if kind < 0.7:
            return '"' + " ".join(word() for _ in range(rng.randrange(1, 4))) + '"' + rng.choice(["", "*"])
        return " + ".join(word()[: rng.randrange(1, 9)] + rng.choice(["", "*"]) for _ in range(rng.randrange(1, 3)))

    def term():
        out = phrase() if rng.random() < 0.7 else f"NEAR({phrase()} {phrase()}{rng.choice(['', ', 0', ', 2', ', 5'])})"
        if rng.random() < 0.1 and not out.startswith("NEAR"):
            out = "^ " + out
        return rng.choice(["", "", "", "subject : ", "body:", "- body : ", "{subject body}: ", "-{subject} : "]) + out

    if depth > 2 or rng.random() < 0.3:
        return " ".join(term() for _ in range(rng.choice([1, 1, 2])))
    kind = rng.random()
    if kind < 0.8:
        return f"{random_query(rng, depth + 1)} {rng.choice(['AND', 'OR', 'NOT'])} {random_query(rng, depth + 1)}"
    return rng.choice(["", "body : ", "- subject : "]) + f"({random_query(rng, depth + 1)})"


@pytest.mark.parametrize("seed", range(4))
def test_random_queries_equal_fts5(both, seed):
    con, index = both
    rng = random.Random(seed)
    hits = 0
    for _ in range(18):
        text = random_query(rng)
        want = expected(con, text)
        assert found(index, text) == want, text
        hits += want != "error" and len(want) > 0
    assert hits > 5


@pytest.mark.parametrize("text", ["lucro AND", "(lucro", "lucro)", "nowhere : lucro", "NEAR(lucro, x)", "AND lucro", "lucro OR OR fato", '"lucro', "lucro - fato", "(lucro) fato", "lucro + ", "a b OR c d NOT e", "not lucro", "near(a b)", "NEAR", "NEAR lucro", "lucro near fato", '""', '"!!"', 'lucro "!!"', '"!!" lucro', 'lucro AND "!!"', 'lucro OR "!!"', 'lucro NOT "!!"', '"!!" NOT lucro', '"!!" + lucro', 'NEAR("!!" lucro)', "LUCRO", "AÇÃO", "acao*", '"a b"*', "a*+b", "^a b", "body : ^lucro", "{subject} : a", "{} : a", "SUBJECT : lucro", "subject : (body : a)", "subject : (subject : a OR b)", "a;b", "a.b", "'a'", "*", "a**", "_x", "123"])
def test_odd_queries_equal_fts5(both, text):
    con, index = both
    assert found(index, text) == expected(con, text)


@pytest.mark.parametrize("text", ["lucro", "lucro OR fato", "lucro fato conselho", '"a b" OR relevante', "body : acao", "luc* OR dividendo", "lucro AND (fato OR a*)"])
def test_ranks_equal_fts5(both, text):
    con, index = both
    want = {r[0]: round(r[1], 9) for r in con.execute("select rowid, rank from t where t match ?", (text,))}
    assert {r["doc"]: round(r["rank"], 9) for r in index.match_ranked(text).collect()} == want and want


def test_empty_lists_give_no_rows(both):
    _, index = both
    for hits in (index.all_of([]), index.any_of([]), index.phrase([]), index.bm25([]), index.match(" "), index.match_ranked("")):
        assert hits.count() == 0


def test_stored_index_reads_the_same(spark, tmp_path, both, monkeypatch):
    con, _ = both
    monkeypatch.setattr(fts, "PART_WORDS", 100)
    docs = spark.createDataFrame([(r[0], r[1], r[2]) for r in con.execute("select rowid, subject, body from t")], "id long, subject string, body string")
    index = fts.FtsStore(spark, str(tmp_path / "index")).rebuild(docs, "id", ["subject", "body"])
    assert index.buckets > 10 and index.columns == ["subject", "body"]
    read = index.match("lucro fato").select(F.lit(1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in read and "bucket" in read.split("PartitionFilters: [")[1].split("]")[0]
    for text in ("lucro AND fato", "subject : luc*", "NEAR(a b, 2) NOT conselho"):
        assert found(index, text) == expected(con, text)


def test_folded_containment(spark):
    df = spark.createDataFrame([("Aquisição de AÇÕES",), ("nada",), (None,), ("",)], "t string")
    got = [r["x"] for r in df.select(fts.contains_folded(F.col("t"), "aquisicao").alias("x")).collect()]
    assert got == [True, False, None, False]
