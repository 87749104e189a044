"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``, else the context's checkpoint folder. Only a local session without either (tests) gets a temporary folder, which goes when Python ends."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="quillon-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return _own[app]


class Scratch:
    """Written tables that cut lineage: after a lost executor a reader starts from the files.

    ``drop`` removes a table that nothing lazy refers to any more; what a result still reads goes with the application.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        path, fs = self._path(self.base)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def keep(self, df: DataFrame, name: str = "t", codec: str = "snappy") -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n:03d}-{name}"
        df.write.parquet(path, compression=codec)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = getattr(df, "_scratch_path", None)
        if path:
            p, fs = self._path(path)
            fs.delete(p, True)
