"""Corpus preparation: from raw documents to token ids, one operator after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import stages
from gridloom.llm.common import stored, table

STAGES = [
    ("toxicity", stages.without_toxic),
    ("near duplicates", stages.without_copies),
    ("secrets", stages.without_secrets),
    ("mix", stages.mixed),
    ("tokens", stages.tokenized),
]

#: Not SQL: a fitted model and a tokenizer; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
