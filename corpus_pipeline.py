"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and reread as the next one's input.

A stage is a function (spark, docs, sf_dir) -> DataFrame. The first four return
the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txlake.llm.common import scratch, table
from txlake.llm.exact_dedup import exact_dedup
from txlake.llm.mixing import mix_documents
from txlake.llm.ngram_join import drop_near_duplicates
from txlake.llm.packing import pack
from txlake.llm.toxicity import drop_toxic


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents the Kneser-Ney models reject; the others stay."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the longest, then smallest id, stays."""
    return exact_dedup(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at five-word Jaccard 0.8 stays."""
    return drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws the documents' blocks to the sources' target weights."""
    return mix_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what was drawn into sequences of at most 2048 ids."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_join", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Language models, pseudorandom draws and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are a table in
    the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
