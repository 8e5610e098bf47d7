"""Training corpus from raw documents: quality, near copies, repeated passages, test items, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.llm import anchors, decontaminate, packing, quality, simhash
from gaugeworks.llm.common import read, stored
from gaugeworks.llm.queries import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts; those it rejects go."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near copies (five-word shingles, 0.8)."""
    return simhash.drop_near_copies(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 13-word windows that an earlier document has."""
    return anchors.drop_repeated_words(docs)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences that hold every remaining document."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("repeated_passages", cut_repeated_passages),
    ("decontamination", drop_test_items),
    ("packing", pack),
]

# SQL cannot express a boosted classifier, fingerprints or a tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
