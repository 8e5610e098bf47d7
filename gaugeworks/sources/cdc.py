"""Change events: envelope parsing, topic and file readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Operation codes of the envelope.
OPS = {"c": "create", "u": "update", "d": "delete", "r": "snapshot"}


def envelope(row_schema: str) -> str:
    """Schema of a change event around a row schema."""
    return (
        f"before struct<{row_schema}>, after struct<{row_schema}>, "
        "source struct<version:string,connector:string,name:string,ts_ms:long,db:string,"
        "`schema`:string,`table`:string,lsn:long>, op string, ts_ms long"
    )


def read_change_files(spark: SparkSession, path: str, streaming: bool = False, **options) -> DataFrame:
    """Change events stored as one JSON document per line (column ``value``)."""
    reader = spark.readStream if streaming else spark.read
    return reader.options(**options).text(path)


def read_change_topic(spark: SparkSession, servers: str, topic: str, streaming: bool = True) -> DataFrame:
    """Change events of a Kafka topic; needs the Kafka connector on the class path."""
    reader = spark.readStream if streaming else spark.read
    return (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def parse_changes(messages: DataFrame, row_schema: str) -> DataFrame:
    """Envelope fields of each message: before, after, op, ts_ms, lsn, table."""
    parsed = messages.select(F.from_json("value", envelope(row_schema)).alias("e"))
    return parsed.select(
        "e.before",
        "e.after",
        "e.op",
        F.coalesce("e.source.ts_ms", "e.ts_ms").alias("ts_ms"),
        F.col("e.ts_ms").alias("processed_ms"),
        F.col("e.source.lsn").alias("lsn"),
        F.col("e.source.table").alias("table"),
    )


def unwrap(changes: DataFrame) -> DataFrame:
    """New record state of each change, deletes included (with the old row and op ``d``)."""
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return changes.select(row.alias("row"), "op", "ts_ms", "lsn").select("row.*", "op", "ts_ms", "lsn")
