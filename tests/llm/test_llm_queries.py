"""The subpackage's registered queries beside their DuckDB statements, and the pipeline beside plain versions of its stages."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from quillon.llm import oracles, queries
from quillon.llm.scratch import Scratch
from test_llm_operators import alnum, brute_hits, brute_measures, lower, words

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or v != v:
        return "-"
    return repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_equals_duckdb(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    df = __spark_entry__.queries()[name](spark, SF)
    got = con.sql(oracles.SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(got.columns)
    a = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    b = sorted(tuple(plain(r[got.columns.index(c)]) for c in cols) for r in got.fetchall())
    assert a == b


def brute_groups(texts, size, num, den):
    """The smallest id of each id's component, by comparing all pairs of sets."""
    sets = {}
    for i, t in texts.items():
        w = words(lower(t or ""))
        sets[i] = {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    low = {i: i for i in sets}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            both = len(sets[x] & sets[y])
            if x < y and both and den * both >= num * (len(sets[x]) + len(sets[y]) - both):
                a, b = sorted((root(x), root(y)))
                low[b] = a
    return {i: root(i) for i in ids}


def test_pipeline_stages_equal_plain_versions(spark):
    """Every stage on what the stage before kept, against brute force (the classifier's verdicts come from its own scores)."""
    docs = queries.table(spark, SF, "documents")
    # Nulls, empty and very long texts, and repeated rows go through all stages.
    odd = spark.createDataFrame([(9_000_001, None, "en", "src0", 0), (9_000_002, "", "en", "src0", 0), (9_000_003, " ".join(f"longword{i}" for i in range(30_000)), None, None, None), (None, " ".join(f"noid{i}" for i in range(90)), None, None, None)], docs.schema)
    docs = docs.unionByName(odd).unionByName(odd.where("doc_id = 9000003"))
    scratch = Scratch(spark, "pipeline-test")
    model = queries.fit_toxicity(docs, queries.table(spark, SF, "labels"), "toxic", queries.fold() != 0)
    scores = {r["doc_id"]: r["score"] for r in queries.score_toxicity(docs, model).collect()}
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(scratch.keep(stage(spark, kept[-1], SF), "stage"))
    assert all(k.columns == docs.columns for k in kept[:-1])
    rows = [k.collect() for k in kept]
    key = lambda x: sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in x)

    assert key(rows[1]) == key([r for r in rows[0] if scores[r["doc_id"]] < 0.5])

    def good(t):
        n_words, chars, symbols, dup, repeat = brute_measures(t)
        lines = [x for x in (t or "").split("\n") if words(x)]
        upper = sum("A" <= c <= "Z" for c in t or "")
        return not (n_words < 50 or 100 * repeat > 50 * n_words or 10 * symbols > n_words or 100 * upper > 35 * chars or 10 * dup > 4 * len(lines))

    assert key(rows[2]) == key([r for r in rows[1] if good(r["text"])])

    groups = brute_groups({r["doc_id"]: r["text"] for r in rows[2] if r["doc_id"] is not None}, 5, 80, 100)
    once = {r["doc_id"]: r for r in rows[2] if r["doc_id"] is not None and groups[r["doc_id"]] == r["doc_id"]}
    assert key(rows[3]) == key([*once.values(), *(r for r in rows[2] if r["doc_id"] is None)])

    items = [(str(r["item_id"]), r["text"]) for r in queries.table(spark, SF, "benchmark").collect()]
    left = {r["doc_id"]: r["text"] for r in rows[4]}
    for r in rows[3]:
        n, hit, _ = brute_hits(r["text"], items, 13)
        assert (r["doc_id"] in left) == (not (hit and 20 * hit >= n))
        if r["doc_id"] in left:
            assert len(alnum(left[r["doc_id"]])) == n - hit and (hit or left[r["doc_id"]] == r["text"])
    assert len(rows[4]) < len(rows[0]) and any(r["doc_id"] is None for r in rows[4])

    assert len(rows[5]) == len(rows[4]) and all(r["lossless"] and r["n_pieces"] == len(r["pieces"]) for r in rows[5])
    assert kept[5].columns == ["doc_id", "lang", "source", "n_pieces", "pieces", "lossless"]


def test_pipeline_of_an_empty_table(spark):
    docs = queries.table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.where(~F.col("lossless")).count() == 0 and out.count() > 0
