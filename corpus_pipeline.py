"""From raw documents to packed training sequences, each stage on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callstrata.llm import decontaminate, lines, packing, quality, simhash
from callstrata.llm.common import stored, table
from callstrata.llm.queries import END_ID, tokenizer_file


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate(docs, count=None)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, width=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), END_ID)


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: The classifier, the fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
