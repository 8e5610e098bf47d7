"""Small helpers the corpus operators share."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.session import work_path

LAST_ID = 2**63 - 1  # stands for a missing doc_id: it sorts after every other one


def read(spark: SparkSession, directory: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{table}.parquet")


def body(docs: DataFrame, text: str = "text") -> Column:
    """The text of a document; a missing text counts as an empty one."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def slim(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, so that further columns, whatever their names, cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), body(docs).alias("text"))


def held_out(doc_id: Column) -> Column:
    """The fold no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet in the shared folder and read again: cuts lineage, survives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def first_by_hash(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows by the hash of their doc_id. Only rows below a hash that little more than n rows stay under
    are ordered, so the task that orders them gets about n rows, however many tasks there are. Runs counts."""
    place = F.xxhash64("doc_id")
    share = (n + 5 * math.sqrt(n) + 50) / max(rows.count(), 1)
    while share < 1:
        below = rows.where(place < int(share * 2**64) - 2**63)
        if below.count() >= n:
            return below.orderBy(place, "doc_id").limit(n)
        share *= 2
    return rows.orderBy(place, "doc_id").limit(n)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Rows per Arrow batch for the jobs run inside; the session's own setting holds again afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
