"""The registered queries of this subpackage and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import oracles
from quillon.llm.byte_bpe import encode as encode_bytes
from quillon.llm.chat_format import Lane, format_chat, in_lanes
from quillon.llm.decontaminate import find_contamination
from quillon.llm.jaccard_join import Rule, jaccard_components
from quillon.llm.language_model import score_texts
from quillon.llm.phrases import mine_phrases
from quillon.llm.quality_classifier import classify
from quillon.llm.quality_rules import quality_cascade
from quillon.llm.scratch import Scratch
from quillon.llm.sentencepiece_sampling import encode
from quillon.llm.sharding import shard, write_shards
from quillon.llm.toxicity import fit_toxicity, score_toxicity
from quillon.llm.url_filter import filter_urls, parse_rule
from quillon.llm.vector_codes import compress, group_errors

#: Rules of the URL filter query: (verdict, host and path).
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Public SentencePiece model of the decoding query.
PIECE_MODEL = os.environ.get("QUILLON_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: Tool of the chat query: {argument: (type, required)}.
TOOLS = {"reply": {"prompt": ("string", True), "turn": ("integer", True)}}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), rule=Rule(size=4, num=85, den=100)).select("doc_id", "n_shingles", "component_id")


def fold(other: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; -1 where there is no id."""
    return F.coalesce(F.pmod(F.crc32(F.col(other).cast("string").cast("binary")), F.lit(5)), F.lit(-1))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), "toxic", fold() != 0)
    return score_toxicity(docs, model).select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = write_shards(shard(table(spark, sf_dir, "documents"), shards=16), f"{Scratch(spark, 'shards').base}/out")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_texts(table(spark, sf_dir, "documents"), fold() != 1)
    return out.select("doc_id", (fold() == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_cascade(table(spark, sf_dir, "documents"))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (F.col("kept") & ~base).alias("kept"))


def chat_messages(conversations: DataFrame) -> DataFrame:
    """User turns as calls of the tool "reply", named by their turn, after the user turn before; assistant turns as results of the user turn before."""
    rows = conversations.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("\0")))
    rows = in_lanes(rows, ["conv", "turn", F.xxhash64("role", "text")], Scratch(conversations.sparkSession, "turns"))
    asked = F.when((F.col("role") == "user") & F.col("turn").isNotNull(), F.struct("seq", "turn"))
    conversations = Lane(rows).carried(asked, "asked", through=-1)
    last = F.col("asked.turn")
    name = lambda turn: F.concat(F.lit("t"), turn.cast("string"))
    is_user = F.col("role") == "user"
    return conversations.select(
        "conv_id", "turn", "role", "text",
        F.when(is_user, name(F.col("turn"))).alias("call_id"),
        F.when(is_user, F.lit("reply")).alias("name"),
        F.when(is_user, F.to_json(F.struct("turn", F.coalesce("text", F.lit("")).alias("prompt")))).alias("arguments"),
        F.when(F.col("role") == "assistant", name(last)).alias("answers"),
        F.when(is_user, F.array_compact(F.array(name(last)))).alias("after"),
    )


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chat(chat_messages(table(spark, sf_dir, "conversations")), TOOLS)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode(docs, PIECE_MODEL, decoded_col="decoded")
    return out.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), F.xxhash64("pieces").alias("pieces_hash"), F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.sha2(F.array_join("item_ids", ","), 256)
    bad = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), ids.alias("items_sha256"), bad.alias("contaminated"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", fold() != 0)
    return out.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), [parse_rule(*r) for r in URL_RULES])


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # rank files and pattern; only the driver needs them

    ranks = os.environ.get("QUILLON_BPE_RANKS") or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = encode_bytes(docs, ranks, public_tokenizers.PATTERN, decoded_col="decoded")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    rows = group_errors(out.rows.select("vec_id", "label", code.alias("code"), "error"), "label", "label_error")
    return rows.select("vec_id", "code", "error", "label_error", F.lit(out.codebooks_sha256()).alias("codebooks_sha256"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_jaccard_join, op2_toxicity, op3_sharding, op4_lm_scoring, op5_quality_rules, op6_chat_format, op7_sentencepiece, op8_decontamination, op9_quality_classifier, op10_url_filter, op11_byte_bpe, op12_vector_codes, op13_phrases)}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in oracles.SQL.items() if k in queries()}
