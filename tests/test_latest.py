"""The latest version on a stream beside the same over the table so far."""

from quillon.operators import dedup
from quillon.streaming.latest import latest_versions

SCHEMA = "k string, versao long, v string"


def test_state_equals_the_batch_after_each_delivery(spark, tmp_path):
    deliveries = [
        [("a", 1, "x"), ("b", 2, "y"), ("b", 1, "z"), (None, 1, "n"), ("c", None, "w")],
        [("a", 2, "x2"), ("b", 2, "tie"), ("c", 5, None), ("b", 2, "y")],
        [("a", 1, "late"), ("b", 1, "late")],  # nothing new
        [("a", 2, "x2"), (None, 3, "n3"), ("d", 1, "new")],
    ]
    current, handed, so_far = {}, [], None

    def take(df, _):
        rows = df.collect()
        handed.append(len(rows))
        for k in {r["k"] for r in rows}:
            current[k] = sorted(tuple(r) for r in rows if r["k"] == k)

    for i, rows in enumerate(deliveries):
        part = spark.createDataFrame(rows, SCHEMA)
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        so_far = part if so_far is None else so_far.unionByName(part)
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        query = latest_versions(stream, ["k"], "versao").writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).foreachBatch(take).start()
        query.awaitTermination()
        want = {}
        for r in dedup.latest_version(so_far, ["k"], "versao").distinct().collect():
            want.setdefault(r["k"], []).append(tuple(r))
        assert {k: sorted(v, key=str) for k, v in current.items()} == {k: sorted(v, key=str) for k, v in want.items()}, i
    assert handed[2] == 0 and handed[3] == 2
