"""Running values, as-of and interval joins with hot keys over many partitions, beside window functions and plain loops."""

import datetime
import random
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quillon.operators import dedup, joins, scan

rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def table(spark):
    """One key holds most rows, one is null, some values and orders are null, some rows repeat; column names clash with those inside."""
    rng = random.Random(1)
    out = [(rng.choice(["hot"] * 6 + [None, "b", "c"]), rng.choice([None, *range(40)]), i, rng.choice([None, 1, 2, 5]), "x") for i in range(600)]
    return spark.createDataFrame(out + out[:5], "k string, t int, i int, v int, row string").withColumn("p", F.lit(0)).withColumn("coming", F.lit(1)).repartition(7)


@pytest.mark.parametrize("keys", [["k"], [], ["k", "row"]])
@pytest.mark.parametrize("descending", [False, True])
def test_running_values_equal_a_window(table, keys, descending):
    order = ["t", "i"]
    by = [F.desc(c) if descending else F.asc(c) for c in order]
    # Rows that repeat are equal, so which is first doesn't matter to the set of values.
    w = Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    for f, plain in ((scan.sum_so_far, F.sum("v").over(w)), (scan.last_so_far, F.last("v", ignorenulls=True).over(w))):
        got = f(table, keys, order, F.col("v"), "x", 5, descending)
        assert got.columns == [*table.columns, "x"]
        assert rows(got) == rows(table.withColumn("x", plain))
        assert rows(f(table, keys, order, F.col("v"), "x", None, descending)) == rows(got)


def test_rolling_sums_equal_a_window(table, monkeypatch):
    monkeypatch.setattr(scan, "BIN_ROWS", 3)
    once = table.dropDuplicates()
    for how in ({}, {"rows": 1}, {"rows": 4}, {"rows": 70}):
        assert rows(dedup.rolling(once, ["k"], ["t", "i"], F.col("v"), "x", partitions=6, **how)) == rows(dedup.rolling(once, ["k"], ["t", "i"], F.col("v"), "x", **how))
    timed = once.where("t is not null")
    for span in (1, 7, 100):
        assert rows(dedup.rolling(timed, ["k"], ["t"], F.col("v"), "x", span=span, partitions=6)) == rows(dedup.rolling(timed, ["k"], ["t"], F.col("v"), "x", span=span))


def test_empty_tables(table):
    none = table.limit(0)
    assert scan.sum_so_far(none, ["k"], ["t"], F.col("v"), "x", 3).count() == 0
    assert dedup.rolling(none, ["k"], ["t"], F.col("v"), "x", rows=3, partitions=3).count() == 0
    assert joins.as_of(none, none, "k", "t", "t", "v", "x", ["i"], partitions=3).count() == 0


def test_as_of_over_partitions_equals_one_task(table):
    left, facts = table.select("k", "i", F.coalesce("t", F.lit(3)).alias("t")), table.select("k", F.col("t").alias("at"), "v", "i").where("t is not null")
    a, b = (joins.as_of(left, facts, "k", "t", "at", "v", "x", ["i"], tie="i", partitions=n) for n in (None, 6))
    assert rows(a) == rows(b) and a.count() == left.count()


def test_event_windows_equal_a_loop(spark):
    rng = random.Random(2)
    at = lambda: rng.choice([None, *(datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h) for h in range(0, 400, 3))])
    left = [(i, rng.choice(["a", "a", "b", None]), at()) for i in range(80)]
    events = [(rng.choice(["a", "b", "c", None]), at(), i) for i in range(25)]
    df, ev = spark.createDataFrame(left, "id int, k string, t timestamp"), spark.createDataFrame(events, "k string, u timestamp, e int")
    near = [(r, e) for r in left for e in events if r[1] and r[1] == e[0] and r[2] and e[1] and datetime.timedelta(0) <= e[1] - r[2] <= datetime.timedelta(hours=12)]
    for n in (None, 5):
        assert rows(joins.with_event_within(df, ev, "k", "t", "u", "12 hours", partitions=n).select("id")) == sorted({(r[0],) for r, _ in near}, key=str)
    assert rows(joins.pairs_within(df, ev, "k", "t", "u", 12 * 3600).select("id", "event.e")) == sorted(((r[0], e[2]) for r, e in near), key=str)
    assert near


@pytest.mark.parametrize("partitions", [None, 12])
def test_one_key_with_200000_rows_on_both_sides(spark, partitions):
    """Every row has thousands of events within its window: pairs would be 10**9."""
    start = F.timestamp_seconds(F.col("id") + 1_700_000_000)
    left = spark.range(200_000).select("id", F.lit("k").alias("k"), start.alias("t"))
    events = spark.range(200_000).where("id % 2 = 0").unionByName(spark.range(100_000)).select(F.lit("k").alias("k"), start.alias("u"))
    begun = time.perf_counter()
    assert joins.with_event_within(left, events, "k", "t", "u", "2 hours", partitions=partitions).count() == 199_999
    got = joins.as_of(left, events.withColumn("v", F.unix_timestamp("u")), "k", "t", "u", "v", "x", ["id"], partitions=partitions)
    assert got.where("x = unix_timestamp(t) or (id >= 100000 and id % 2 = 1 and x = unix_timestamp(t) - 1)").count() == 200_000
    assert time.perf_counter() - begun < 60


def test_a_hot_key_lies_in_many_tasks(spark):
    df = spark.range(50_000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    got = scan.sum_so_far(df, ["k"], ["t"], F.lit(1), "x", 10)
    parts = got.groupBy(F.floor(F.col("t") / 5000).alias("b")).agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("b").collect()
    assert [(r["lo"], r["hi"]) for r in parts] == [(5000 * b + 1, 5000 * b + 5000) for b in range(10)]
    assert got.select(F.spark_partition_id().alias("p")).groupBy("p").count().where("count > 0").count() > 2
