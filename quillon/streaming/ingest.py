"""Incremental ingestion: new files once, merged by key; and windowed counts over event streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators.merge import SnapshotStore, TableSpec
from quillon.sources.zipsource import zip_stream


def stream_upsert(spark: SparkSession, path: str, schema: str, store: SnapshotStore, spec: TableSpec, checkpoint: str, order: list[str] | None = None):
    """Takes what has arrived under ``path`` since the last run and stops. A batch that is run again merges to the same table."""
    src = spark.readStream.schema(schema).parquet(path)
    return src.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, _: store.merge(spec, df, order)).start()


def stream_deliveries(spark: SparkSession, path: str, columns: list[str], members: str, merge: Callable[[DataFrame], None], checkpoint: str):
    """Takes the ZIP deliveries that are new, or came again changed, since the last run, hands their rows to ``merge`` and stops. A batch that failed is handed over again whole, so ``merge`` should be an upsert."""
    rows = zip_stream(spark, path, columns, members)
    return rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, _: merge(df)).start()


def deduplicated(events: DataFrame, keys: list[str], at: str = "ts", delay: str = "10 minutes") -> DataFrame:
    return events.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def window_counts(events: DataFrame, keys: list[str], at: str = "ts", size: str = "1 hour", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Tumbling, or sliding, counts; a window closes when the watermark has passed it."""
    w = F.window(at, size, slide) if slide else F.window(at, size)
    return events.withWatermark(at, delay).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def session_counts(events: DataFrame, keys: list[str], at: str = "ts", gap: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    return events.withWatermark(at, delay).groupBy(*keys, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n")).select(*keys, F.col("w.start").alias("start"), "n")
