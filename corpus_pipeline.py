"""Corpus pipeline: toxicity, quality rules, near-duplicates, benchmark decontamination, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next stage's
``docs``. The first four return the columns of documents; the last returns doc_id, lang, source, n_pieces, pieces and lossless (decoding the pieces
gives the text).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.decontaminate import decontaminate
from quillon.llm.jaccard_join import Rule, keep_one_each
from quillon.llm.quality_rules import keep_good
from quillon.llm.queries import PIECE_MODEL, fold, table
from quillon.llm.scratch import Scratch
from quillon.llm.sentencepiece_sampling import encode
from quillon.llm.toxicity import drop_toxic, fit_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose score says toxic."""
    return drop_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels"), "toxic", fold() != 0))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a rule rejects."""
    return keep_good(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return keep_one_each(docs, rule=Rule(size=5, num=80, den=100))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without contaminated documents (a twentieth of the words hit) and, in the others, without the spans hit."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations, and whether they decode to the text."""
    out = encode(docs, PIECE_MODEL, decoded_col="decoded")
    return out.select("doc_id", "lang", "source", F.size("pieces").cast("long").alias("n_pieces"), "pieces", F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


STAGES: list[tuple[str, Stage]] = [("toxicity", toxicity), ("quality rules", quality_rules), ("n-gram Jaccard join", jaccard_join), ("benchmark decontamination", decontamination), ("SentencePiece encoding and decoding", sentencepiece)]

#: A trained classifier and sampled segmentations are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), "stage")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
