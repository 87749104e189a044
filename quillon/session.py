"""Session defaults: UTC, ANSI, adaptive execution with skew handling."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import SparkSession


def root_path(url: str, base: str) -> str:
    """The folder of the tables: ``sqlite:///`` addresses aren't taken, other schemes are Spark's; a path without a scheme is taken from ``base`` unless absolute."""
    scheme, sep, rest = url.partition("://")
    if not url.strip() or (sep and (not re.fullmatch(r"[a-z][a-z0-9+.-]*", scheme) or scheme in ("sqlite", "http", "https") or not rest)):
        raise ValueError(f"not a folder for tables: {url!r}")
    return url if sep or url.startswith("/") else f"{base.rstrip('/')}/{url}"


def session(name: str = "quillon", **conf: str) -> SparkSession:
    b = SparkSession.builder.appName(name)
    for k, v in {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def with_checkpoints(spark: SparkSession) -> None:
    """Names the context's checkpoint folder where there is none: the cluster's ``spark.checkpoint.dir``. Only a local session without one gets a temporary folder, which goes when Python ends."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="quillon-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    context.setCheckpointDir(named)
