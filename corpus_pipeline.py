"""Corpus pipeline: rules, quality, near duplicates, decontamination, tokens.

Each stage takes (spark, docs, sf_dir); ``run`` writes each result as Parquet in the shared folder
and reads it again as the next stage's documents. All stages but the last return the columns of their documents.

SQL can't express the classifier, the alignment and the encoder, so there is no ``ORACLE_SQL``; the tests
hold the pipeline against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agendario.llm import bpe, decontaminate, jaccard, pu_quality, quality_rules
from agendario.llm.shared import stored, table

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("quality_classifier", pu_quality.stage),
    ("ngram_jaccard_join", jaccard.stage),
    ("benchmark_decontamination", decontaminate.stage),
    ("byte_bpe", bpe.stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
