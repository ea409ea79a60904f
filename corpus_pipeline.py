"""From raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``. :func:`run` writes what a stage returns to
the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm import queries
from lavra.llm.decontam import remove_contamination
from lavra.llm.jaccard import jaccard_components
from lavra.llm.line_dedup import dedup_lines
from lavra.llm.packing import pack
from lavra.llm.quality import keep_good
from lavra.llm.staging import stage
from lavra.scratch import new_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the others stay unchanged."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a smaller document holds go, and documents that lose all their words by that."""
    said = lambda text: F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    marked = docs.select("*", said(F.col("text")).alias("_said_before"))
    cut = dedup_lines(docs, new_folder(spark, "line-store")).kept(marked, with_text=True)
    return cut.where(said(F.col("text")) | ~F.col("_said_before")).drop("_said_before")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least doc_id stays.

    Rows equal in doc_id and text stay once, rows sharing a doc_id with different texts all stay,
    and so do those without a doc_id.
    """
    linked = stage(jaccard_components(docs), "components")
    stay = linked.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.join(stay, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out, and documents go that hold nothing else."""
    return remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 1024 tokens."""
    return pack(docs, queries.BYTE_BPE, end_id=2, capacity=1024)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: A tokenizer cannot be said in SQL; tests compare the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents below ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
