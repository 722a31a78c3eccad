"""A corpus pipeline: quality filter, exact and near deduplication, packing.

``STAGES`` lists the stages as (name, function); a function takes
``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns
they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillandsia.llm._common import Scratch
from tillandsia.llm.exact_dedup import exact_dedup
from tillandsia.llm.minhash_dedup import near_dedup
from tillandsia.llm.packing import pack_documents
from tillandsia.llm.quality import keep_good
from tillandsia.llm.queries import SPECIAL
from tillandsia.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier scores under its threshold."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (A-Z lower-cased) the largest doc_id stays."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 5-word shingles at 80 percent the smallest doc_id stays."""
    return near_dedup(docs, words=5, percent=80)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, packed into sequences of 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, SPECIAL)


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("minhash_near_dedup", near),
    ("packing", packing),
]

#: SQL can't express the classifier, the links of shingle sets, or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; the others' are written to the shared folder on the way."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.save(docs, name)
    return docs
