"""Quality classifier: quadratic discriminant analysis with shrunk class covariances over transformed document statistics.

A row's statistics are ratios and logarithms of counts in its whole text. Class moments are sums over all labelled
training rows, so they come from one grouped aggregate and nothing is sampled. Each class covariance S becomes
(1 - a) S + a diag(v) + r I, with v the pooled variances; the inverse of its Cholesky factor is computed once and kept, and a score is the
logistic function of the log-density difference (Mahalanobis terms: squared lengths of that inverse times the centred row) plus the log prior ratio,
divided by ``TEMPER`` so that clear cases keep an order.

Nulls and empty texts have all counts 0 and get a score like any other. Without training rows of both classes each
score is the share of class 1 (0.5 with no row at all). Repeated rows count as often as they come, and an id with both labels counts for both
classes. Columns other than the named ones aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.scratch import Scratch
from quillon.llm.tokens import SPACED, Chunk, chunks, mix

FEATURES = ("log_words", "symbols", "exclamations", "upper", "same_as_last", "distinct", "repeated_lines", "word_length", "digits", "stops")
SHRINK, RIDGE, TEMPER = 0.1, 0.02, 4.0
_KINDS = {"symbols": b"#*$%&|<>", "exclamations": b"!", "upper": bytes(range(65, 91)), "digits": b"0123456789", "stops": b".,;:?"}


def _flags(chars: bytes) -> np.ndarray:
    t = np.zeros(256, np.int64)
    t[list(chars)] = 1
    return t


_FLAGS = {k: _flags(v) for k, v in _KINDS.items()}
_U = np.uint64


def statistics(c: Chunk) -> np.ndarray:
    """One row of FEATURES for each row of the chunk."""
    rows = c.hi - c.lo
    w = c.words(SPACED)
    h = c.hashes(w, fold=False)
    n = np.diff(w.first).astype(float)
    per_word = np.maximum(n, 1)

    def share(kind: str) -> np.ndarray:
        s = np.zeros(len(c.data) + 1, np.int64)
        np.cumsum(_FLAGS[kind][c.data], out=s[1:])
        return (s[c.offsets[1:]] - s[c.offsets[:-1]]) / per_word

    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
    with np.errstate(over="ignore"):
        seen = mix(h + mix(w.doc.astype(np.uint64)))
    _, first = np.unique(seen, return_index=True)
    distinct = np.bincount(w.doc[first], minlength=rows)
    # A line is named by its words' hashes.
    breaks = np.zeros(len(c.data) + 1, np.int64)
    np.cumsum(c.data == 10, out=breaks[1:])
    line = breaks[w.start]
    new = np.ones(len(h), bool)
    new[1:] = (line[1:] != line[:-1]) | (w.doc[1:] != w.doc[:-1])
    at = np.flatnonzero(new)
    dup = np.zeros(rows)
    if len(at):
        with np.errstate(over="ignore"):
            place = np.arange(len(h), dtype=np.uint64) - np.repeat(at, np.diff(np.r_[at, len(h)])).astype(np.uint64)
            sums = np.add.reduceat(mix(h + place * _U(0x9E3779B97F4A7C15)), at)
            sums = mix(sums + mix(w.doc[at].astype(np.uint64)))
        _, own = np.unique(sums, return_index=True)
        lines = np.bincount(w.doc[at], minlength=rows)
        dup = (lines - np.bincount(w.doc[at[own]], minlength=rows)) / np.maximum(lines, 1)
    letters = np.bincount(w.doc, w.end - w.start, rows)
    return np.stack([
        np.log1p(n), np.log1p(10 * share("symbols")), np.log1p(10 * share("exclamations")), np.log1p(share("upper")),
        np.log1p(10 * np.bincount(w.doc, same, rows) / per_word), np.log1p(distinct) - np.log1p(n) * 0.8, np.sqrt(dup),
        np.log1p(letters / per_word), np.log1p(10 * share("digits")), np.log1p(10 * share("stops")),
    ], axis=1)


def with_statistics(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            x = [statistics(c) for c in chunks(b.column("text"))]
            x = np.concatenate(x) if x else np.empty((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([b.column("id"), *map(pa.array, x.T.copy())], names=["id", *FEATURES])

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, " + ", ".join(f"{f} double" for f in FEATURES))


@dataclass
class Discriminant:
    mean: np.ndarray
    #: Inverses of the Cholesky factors.
    whiten: np.ndarray
    log_det: np.ndarray
    log_prior: np.ndarray
    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.mean):
            return np.full(len(x), self.share)
        dens = []
        for k in (0, 1):
            z = (x - self.mean[k]) @ self.whiten[k].T
            dens.append(self.log_prior[k] - 0.5 * (z * z).sum(axis=1) - 0.5 * self.log_det[k])
        return 1 / (1 + np.exp(-np.clip((dens[1] - dens[0]) / TEMPER, -500, 500)))


def fit(rows: DataFrame, label: str) -> Discriminant:
    """``rows`` has FEATURES and a 0/1 label column; others' rows are left out."""
    pairs = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]
    sums = [F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)] + [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}_{j}") for i, j in pairs]
    got = {r["y"]: r for r in rows.where(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("y")).agg(F.count("*").alias("n"), *sums).collect()}
    total = sum(r["n"] for r in got.values())
    if len(got) < 2:
        return Discriminant(np.empty(0), np.empty(0), np.empty(0), np.empty(0), (got[1]["n"] / total if 1 in got else 0.0) if total else 0.5)
    d = len(FEATURES)
    mean = np.array([[got[k][f"s{i}"] / got[k]["n"] for i in range(d)] for k in (0, 1)])
    cov = np.zeros((2, d, d))
    for k in (0, 1):
        for i, j in pairs:
            cov[k, i, j] = cov[k, j, i] = got[k][f"p{i}_{j}"] / got[k]["n"] - mean[k, i] * mean[k, j]
    n = np.array([got[k]["n"] for k in (0, 1)], float)
    pooled = np.diag((n[0] * cov[0] + n[1] * cov[1]) / total).clip(0)
    a = np.minimum(1, SHRINK + d / n)[:, None, None]
    cov = (1 - a) * cov + a * np.diag(pooled) + RIDGE * np.eye(d)
    chol = np.linalg.cholesky(cov)
    return Discriminant(mean, np.linalg.inv(chol), 2 * np.log(np.diagonal(chol, axis1=1, axis2=2)).sum(axis=1), np.log(n / total), n[1] / total)


def classify(df: DataFrame, labels: DataFrame, label: str, train: "object", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row; ``train`` is a Column condition on id_col for the rows whose labels may be learnt."""
    scratch = Scratch(df.sparkSession, "quality")
    stats = scratch.keep(with_statistics(df, id_col, text_col), "statistics")
    known = labels.where(train).where(F.col(label).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label).alias("_y")).distinct()
    model = fit(stats.join(known, "id"), "_y")
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            x = np.stack([b.column(f).to_numpy() for f in FEATURES], axis=1)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(model.score(x))], names=["id", "score"])

    return stats.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
