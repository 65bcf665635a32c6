"""The text pipeline over ``documents``: quality rules, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its result is written as Parquet and read again as the next one's ``docs``. All but the last return the columns of ``documents``; the last adds ``copies``, how often the mixture repeats the document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.llm import decontaminate, line_dedup, mix, quality, simhash
from fairlead.llm.common import SPACE, materialize, shared_path, temporary

#: Mixing draws and near copies can't be expressed in SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule, or whose source does, go."""
    return quality.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows are cut; documents of which no word is left go, and n_chars follows the text."""
    cut = line_dedup.dedup_lines(docs)
    left = cut.filter(F.rlike("text", F.lit(f"[^{SPACE}]")))
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near copies stays."""
    return simhash.near_dedup(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mixture takes, with their number of copies."""
    return mix.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontaminate", remove_benchmark),
    ("mix_sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, name)
        with temporary(spark):  # a stage's own steps go when its result is written
            docs = materialize(stage(spark, docs, sf_dir), name, path)
    return docs
