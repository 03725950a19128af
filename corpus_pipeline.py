"""A corpus pipeline of five stages, from raw documents to packed sequences.

Defined cases, for every stage: an empty table passes as an empty one. Null
text counts as empty, so it fails the quality rules. Rows are judged each by
its own text, also where ids are null or repeat; of rows equal in id and text
the first two deduplicating stages keep one. Columns beside ``doc_id`` and
``text`` pass unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from yellowstar.llm import exact_dedup, near_dedup, packing, pii, quality_rules
from yellowstar.llm.common import saved, table
from yellowstar.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.keep_one(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json").decode())


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("pii", private),
    ("best_fit_packing", packed),
]

#: The verdict of the quality stage rests on a 64-bit hash that SQL engines do not share.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
