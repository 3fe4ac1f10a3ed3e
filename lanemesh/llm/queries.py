"""The queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, embeddings, jaccard, language, line_dedup, mixing, quality, secrets, suffixes, warc
from .common import table, text_or_empty

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def tokenizer_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_captures(table(spark, sf_dir, "pages"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), bpe.load_ranks(tokenizer_path()), tokenizer_pattern())


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicated(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_deduped(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(text_or_empty(), 256).alias("kept_sha256"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(table(spark, sf_dir, "documents"))


def op9_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.linked(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_warc_transactions, op2_byte_bpe, op3_mix_sources, op4_suffix_dedup, op5_line_dedup, op6_secret_scan, op7_quality_rules, op8_jaccard_join, op9_language_crf, op10_embedding_dedup)
}
ORACLES: dict[str, str] = {
    "op1_warc_transactions": warc.ORACLE,
    "op4_suffix_dedup": suffixes.ORACLE,
    "op8_jaccard_join": jaccard.ORACLE,
    "op3_mix_sources": mixing.ORACLE,
    "op6_secret_scan": secrets.ORACLE,
    "op7_quality_rules": quality.ORACLE,
    "op5_line_dedup": line_dedup.ORACLE,
    "op10_embedding_dedup": embeddings.ORACLE,
}
