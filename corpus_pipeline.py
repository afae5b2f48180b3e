"""The corpus pipeline: five operators of ``tessera.llm`` in a row over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet to
the shared scratch folder and read back as the next stage's ``docs``, so a lost executor
never costs more than a stage, and no stage's plan holds another's. The stages drop:
documents whose language the model rejects; repeated lines; documents with a near copy of
a smaller id; documents that hold a benchmark passage. The last one encodes what stays.

All stages but the last return the columns of ``docs``, extra ones included. Rows with a
null ``doc_id`` pass the stages that work by id; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, langid, line_dedup, sentencepiece, simhash
from tessera.llm._shared import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accept(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.apply(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedup(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(docs)


STAGES = [("language_id", language), ("line_dedup", lines), ("simhash_near_dedup", near_copies),
          ("benchmark_decontamination", benchmark), ("sentencepiece", encoding)]

#: Models and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
