"""From raw documents to token files, in five stages; each is written as Parquet before the next reads it.

1. quality: documents that fail the rules go; boilerplate lines leave the others.
2. near duplicates: one document of each group of near copies stays.
3. decontamination: documents that hold a benchmark item go.
4. mixture: documents are chosen for the target weights, each at most once.
5. tokens: the texts are encoded and written as token files, and read back.

All stages but the last return the columns of the documents.  Null texts go in stage 1;
an empty table passes through to an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stepforge.llm import decontaminate, jaccard_rtree, line_quality, mixture, queries, token_files
from stepforge.storage import materialize

MIX_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_rtree.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture.select(docs, percent=MIX_PERCENT, max_epochs=1)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.read_index(token_files.write(docs, queries.tokenizer_path()))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixing),
    ("token files", tokens),
]
ORACLE_SQL = None  # near duplicates, alignments and token ids have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
