"""The corpus pipeline: each stage works on all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as
Parquet into the folder that spark.checkpoint.dir names and reads again as the next
stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from canvass.llm import decontaminate, line_dedup, mixing, quality, simhash
from canvass.llm.common import documents, shared_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.apply_quality_rules(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.remove_duplicate_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_per_group(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("mixing", mix),
]

# SimHash, MinHash and tiling have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
