"""The registered queries of the operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm import sql
from lavra.scratch import new_folder

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lavra.llm.token_store import read_documents, write_tokens

    folder = new_folder(spark, "tokens")
    shards = write_tokens(documents(spark, sf_dir), folder, WORD_BPE, end_id=1)
    rows = read_documents(spark, folder).join(shards.select("file", F.col("start").alias("base")), "file")
    return rows.select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lavra.llm.secret_scan import digest, scan_secrets

    return digest(scan_secrets(documents(spark, sf_dir)))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lavra.llm.jaccard import jaccard_components

    return jaccard_components(documents(spark, sf_dir))


def op4_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lavra.llm.decontam import find_contamination

    found = find_contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + (s["end"] - s["first"]))
    named = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(named.cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op5_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lavra.llm.sharding import assign_shards

    return assign_shards(documents(spark, sf_dir), 16).withColumn("grown_shard", F.lit(None).cast("int"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lavra.llm.quality import judge

    return judge(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lavra.llm.license_scan import scan_licenses

    return scan_licenses(documents(spark, sf_dir))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lavra.llm.html_text import extract_text

    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lavra.llm.packing import pack

    return pack(documents(spark, sf_dir), BYTE_BPE, end_id=2, capacity=1024)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lavra.llm.line_dedup import dedup_lines

    docs = documents(spark, sf_dir)
    return dedup_lines(docs, new_folder(spark, "line-store")).kept(docs)


def op11_phrase_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lavra.llm.collocation import mine_phrases

    return mine_phrases(documents(spark, sf_dir), min_count=30, longest=4, share=80, top=2000)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lavra.llm.token_counts import count_tokens

    return count_tokens(documents(spark, sf_dir), BYTE_BPE, limit=512)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lavra.llm.spelling import spelling_forms

    return spelling_forms(documents(spark, sf_dir), min_chars=7, min_count=2, ratio=10, drop_every=31)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_wavelet_tokens,
        op2_secret_scan,
        op3_jaccard_join,
        op4_fm_decontamination,
        op5_lpt_shards,
        op6_quality_rules,
        op7_license_scan,
        op8_html_text,
        op9_best_fit_packing,
        op10_line_dedup,
        op11_phrase_collocation,
        op12_token_counts,
        op13_spelling_variants,
    )
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    """SQL where it can say the same; the other queries are tested against brute force.

    Tokenizers (1, 9, 12), HTML (8), a heap (5), entropy windows with an allow list (2),
    rule suppression (7) and merged sketches (6) are beyond it.
    """
    return {
        "op3_jaccard_join": sql.OP3,
        "op4_fm_decontamination": sql.OP4,
        "op10_line_dedup": sql.OP10,
        "op11_phrase_collocation": sql.OP11,
        "op13_spelling_variants": sql.OP13,
    }
