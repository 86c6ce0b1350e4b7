"""The operators as queries over whole tables, with production parameters, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chatloom.llm import byte_bpe, chunks, codes, packing, pii, suffix, trie
from chatloom.llm.chat import reply_ordered
from chatloom.llm.decontam import contaminated
from chatloom.llm.exact_dedup import exact_groups
from chatloom.llm.langid import detect_language
from chatloom.llm.minhash import near_duplicate_classes
from chatloom.llm.quality import quality_scores


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(suffix.cut_repeats(_table(spark, sf_dir, "documents")))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(_table(spark, sf_dir, "conversations"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack_documents(_table(spark, sf_dir, "documents")))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_language(_table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(_table(spark, sf_dir, "documents")))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(_table(spark, sf_dir, "documents"))


def op10_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.digest(chunks.duplicate_runs(_table(spark, sf_dir, "documents")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.digest(*codes.compress(_table(spark, sf_dir, "embeddings")))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest(byte_bpe.decode(byte_bpe.encode(_table(spark, sf_dir, "documents"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_suffix_dedup, op2_chat_format, op3_packing, op4_exact_dedup, op5_decontamination, op6_language_id, op7_personal_data, op8_quality, op9_minhash, op10_chunk_dedup, op11_prefix_trie, op12_code_compression, op13_byte_bpe)}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
        "op11_prefix_trie": trie.ORACLE,
        "op12_code_compression": codes.oracle(),
    }
