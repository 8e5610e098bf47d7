"""Tab-separated ingest files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks import schemas

_BAD = "_malformed"
_OPTIONS = {
    "sep": "\t",
    "nullValue": "\\N",
    "quote": "",
    "escape": "\0",
    "mode": "PERMISSIVE",
    "columnPruning": "false",  # else a line with too many fields passes when few are read
    "columnNameOfCorruptRecord": _BAD,
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}


def read_ingest(spark: SparkSession, path: str, streaming: bool = False, **options: str) -> DataFrame:
    """Lines of seven tab-separated fields; ``\\N`` and empty fields are null.

    Lines that do not parse keep their text in ``_malformed`` (see ``well_formed`` and ``malformed``).
    """
    reader = spark.readStream if streaming else spark.read
    schema = f"{schemas.INGEST_FILE}, {_BAD} string"
    return reader.schema(schema).options(**{**_OPTIONS, **options}).csv(path)


def well_formed(lines: DataFrame) -> DataFrame:
    """Parsed lines as staged values; the columns an ingest file does not carry are null."""
    good = lines.where(F.col(_BAD).isNull() & F.col("entity_id").isNotNull())
    return good.select(
        "entity_id", "tenant_id", "attribute_id", "value", "value_int", "value_decimal",
        F.lit(None).cast("boolean").alias("value_bool"),
        F.lit(None).cast("date").alias("value_date"),
        F.lit(None).cast("timestamp").alias("value_timestamp"),
        "ingested_at",
    )


def _text() -> Column:
    """A parsed line in the ingest file format."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in schemas.columns(schemas.INGEST_FILE)]
    return F.concat_ws("\t", *text)


def malformed(lines: DataFrame) -> DataFrame:
    """Lines for quarantine: as they came if they did not parse, put together again from their fields if they
    parsed but name no entity."""
    return lines.where(F.col(_BAD).isNotNull() | F.col("entity_id").isNull()).select(
        F.coalesce(_BAD, _text()).alias("line")
    )


def write_ingest(values: DataFrame, path: str) -> None:
    """Write staged values in the ingest file format."""
    values.select(_text().alias("line")).write.mode("overwrite").text(path)
