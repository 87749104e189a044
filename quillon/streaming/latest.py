"""The latest version of each key on a stream, kept in the stream's own state.

State holds for each key the rows of its highest version so far, ties included, as ``dedup.latest_version`` gives them for a table. A micro-batch hands out, for each key that its rows
changed, all of the key's latest rows: the last hand-out of a key is its state. Rows of lower versions, and rows that are there already, change nothing, so a delivery that comes
again is harmless. Rows with a null version are left out.

State is in RocksDB (set by ``latest_versions`` for the session) and stays as long as the query's checkpoint; what a task holds is a key's rows of one version.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Latest(StatefulProcessor):
    def __init__(self, schema: StructType, version: str):
        self.schema, self.version = schema, version

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = self.schema.fieldNames()
        at = names.index(self.version)
        held = [tuple(r) for r in self.rows.get()] if self.rows.exists() else []
        best, before = held, set(held)
        for part in rows:
            for row in part[names].astype(object).where(part[names].notna(), None).itertuples(index=False, name=None):
                if not best or row[at] > best[0][at]:
                    best = [row]
                elif row[at] == best[0][at] and row not in best:
                    best = [*best, row]
        if set(best) != before:
            self.rows.put(best)
            yield pd.DataFrame(best, columns=names)

    def close(self) -> None:
        pass


def latest_versions(stream: DataFrame, keys: list[str], version: str) -> DataFrame:
    """A stream, in update mode, of the latest rows of keys that changed."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    own = stream.where(F.col(version).isNotNull())
    return own.groupBy(*keys).transformWithStateInPandas(Latest(stream.schema, version), outputStructType=stream.schema, outputMode="Update", timeMode="None")
