"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parityscope.llm import ann, chat_format, exact_search, lexical_search, line_dedup, ngram_join, packing, piece_codec, quality_model, quality_rules, token_files, toxicity, whitening
from parityscope.llm.shared import shared_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ann(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(_table(spark, folder, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one (-1) whose texts hold the template's own control strings."""
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    hard = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], turns.schema)
    return chat_format.digests(chat_format.format_conversations(turns.unionAll(hard)))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.drop_recurring_lines(_table(spark, folder, "documents"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = shared_path(spark, "token-files")
    token_files.write_token_files(_table(spark, folder, "documents"), files, public_tokenizers.path("byte_bpe_50k.json"), 0)
    read = token_files.read_token_files(spark, files)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_rules.judge(_table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


def op7_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded, and its ids decoded again."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    decoded = piece_codec.decode(piece_codec.encode(_table(spark, folder, "documents"), path), path)
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
        F.length("text").cast("long").alias("decoded_chars"),
        F.crc32(F.col("text").cast("binary")).alias("decoded_crc32"),
    )


def op8_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.score(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), 49_408, 2)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.linked(_table(spark, folder, "documents"))


def op11_exact_search(spark: SparkSession, folder: str) -> DataFrame:
    return exact_search.search(_table(spark, folder, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_table(spark, folder, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def queries() -> dict[str, Query]:
    found = (
        op1_ann,
        op2_chat_format,
        op3_line_dedup,
        op4_toxicity,
        op5_token_files,
        op6_quality_rules,
        op7_piece_codec,
        op8_quality_model,
        op9_packing,
        op10_ngram_join,
        op11_exact_search,
        op12_whitening,
        op13_lexical_search,
    )
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat_format": chat_format.ORACLE,
        "op3_line_dedup": line_dedup.ORACLE,
        "op11_exact_search": exact_search.ORACLE,
        "op13_lexical_search": lexical_search.ORACLE,
    }
