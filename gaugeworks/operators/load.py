"""Loading: staging flush, idempotent fact load, columnar sinks, archive."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from gaugeworks import schemas
from gaugeworks.functions import timefn
from gaugeworks.functions.relations import latest_by

_HISTORY_KEY = ["tenant_id", "entity_id", "attribute_id", "ingested_at"]


class Flush(NamedTuple):
    moved: DataFrame
    remaining: DataFrame


_TIE_BUCKETS = 4096


def _cut(rows: DataFrame, key: Column, want: int) -> tuple[int | None, int]:
    """The key at which more than ``want`` rows, counted in key order, are reached (None if never), and how
    many rows come before it. A job that brings two numbers back; the counts are walked through in one row."""
    counts = rows.groupBy(key.cast("long").alias("k")).agg(F.count("*").alias("n"))
    walk = F.aggregate(
        F.array_sort(F.collect_list(F.struct("k", "n"))),
        F.struct(F.lit(0).cast("long").alias("before"), F.lit(None).cast("long").alias("at")),
        lambda a, x: F.when(a["at"].isNotNull(), a)
        .when(a["before"] + x["n"] > want, F.struct(a["before"].alias("before"), x["k"].alias("at")))
        .otherwise(F.struct((a["before"] + x["n"]).alias("before"), a["at"].alias("at"))),
    )
    found = counts.agg(walk.alias("c")).first()["c"]
    return found["at"], found["before"]


def flush_staging(staging: DataFrame, *, as_of=None, limit: int = 50_000) -> Flush:
    """The oldest ``limit`` staged rows, ready for history, and the rows that stay.

    The cut is found from counts: per hour, then per second of the hour it falls in, then per microsecond,
    then per hash of rows with one time. Only rows that share the last of these are numbered, so no task
    sees more than the ties of one hash. Everything else moves or stays by a filter. A missing time becomes
    now, after the choice: null times are newest, as in the original. Repeated history keys collapse instead
    of failing the batch.
    """
    now = timefn.ts(timefn.resolve_as_of(as_of))
    time = F.coalesce(F.unix_micros("ingested_at"), F.lit(2**62))
    tie = F.pmod(F.xxhash64(*staging.columns), F.lit(_TIE_BUCKETS))
    keys = [F.floor(time / 3_600_000_000), F.floor(time / 1_000_000), time, tie]
    rows, want, inside, before_cut = staging, limit, F.lit(True), F.lit(False)
    for key in keys:
        at, before = _cut(rows.where(inside), key, want)
        want -= before
        if at is None:  # all rows that are left move
            before_cut, inside = before_cut | inside, F.lit(False)
            break
        before_cut, inside = before_cut | (inside & (key < at)), inside & (key == at)
    numbered = rows.where(inside).withColumn(
        "_place", F.row_number().over(Window.partitionBy("ingested_at").orderBy(*staging.columns))
    )
    chosen = rows.where(before_cut).unionByName(numbered.where(F.col("_place") <= want).drop("_place"))
    remaining = rows.where(~before_cut & ~inside).unionByName(numbered.where(F.col("_place") > want).drop("_place"))
    moved = latest_by(chosen.withColumn("ingested_at", F.coalesce("ingested_at", now)), _HISTORY_KEY, [])
    return Flush(moved, remaining)


class FactLoad(NamedTuple):
    rows: DataFrame
    audit: DataFrame
    quarantine: DataFrame


def load_fact(staging: DataFrame, audit: DataFrame, *, as_of=None, lookback_hours: float = 1) -> FactLoad:
    """Distinct fact rows of batches not loaded within the lookback, and their audit rows.

    A batch replayed after the lookback loads again, as in the original. Rows without a batch id cannot
    be tracked and go to quarantine; the audit counts rows per batch and only lists batches loaded now.
    """
    now = timefn.resolve_as_of(as_of)
    recent = audit.where(
        F.col("loaded_at") >= timefn.ts(now - dt.timedelta(hours=lookback_hours))
    ).select("batch_id").distinct()
    tracked = staging.where(F.col("batch_id").isNotNull())
    fresh = tracked.join(recent, "batch_id", "left_anti")
    # A row repeated over batches is loaded once, under the first batch that brought it.
    rows = fresh.groupBy(*schemas.FACT_COLUMNS).agg(F.min("batch_id").alias("batch_id"))
    counted = fresh.select("batch_id").distinct().join(
        rows.groupBy("batch_id").agg(F.count("*").alias("rows_loaded")), "batch_id", "left"
    )
    audit_rows = counted.select(
        "batch_id", timefn.ts(now).alias("loaded_at"),
        F.coalesce("rows_loaded", F.lit(0)).cast("long").alias("rows_loaded"),
    )
    return FactLoad(rows, audit_rows, staging.where(F.col("batch_id").isNull()))


def write_partitioned(
    rows: DataFrame, path: str, partitions: Sequence[str], sort: Sequence[str]
) -> None:
    """Write rows by partition columns, sorted inside each file for min/max skipping.

    The rebalance hint lets the runtime size the write tasks: a large month is split over many tasks,
    small ones share a task. Only the partitions present in ``rows`` are replaced (dynamic overwrite),
    which makes a repeated write harmless.
    """
    (
        rows.hint("rebalance", *[F.col(c) for c in partitions])
        .sortWithinPartitions(*partitions, *sort)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_fact(rows: DataFrame, path: str, *, partitions: Sequence[str] = ("year_month",)) -> None:
    """Columnar sink by month, each file sorted by (tenant, time)."""
    write_partitioned(rows, path, partitions, ["tenant_id", "ingested_at"])


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The fact table; ``year_month`` is its partition column."""
    return spark.read.schema(schemas.FACT).parquet(path)


def run_fact_load(
    spark: SparkSession, staging: DataFrame, fact_path: str, audit_path: str, *, as_of=None,
    load_id: str | None = None, lookback_hours: float = 1,
) -> None:
    """Load staged batches into the fact table, then record them.

    The fact is partitioned by (month, load). A load that was written but not recorded, because the job
    died in between, is repeated with the same ``load_id`` and writes over itself.
    """
    now = timefn.resolve_as_of(as_of)
    load_id = load_id or f"{now:%Y%m%dT%H%M%S%f}"
    audit = _read_audit(spark, audit_path)
    load = load_fact(staging, audit, as_of=now, lookback_hours=lookback_hours)
    write_fact(
        load.rows.drop("batch_id").withColumn("load_id", F.lit(load_id)),
        fact_path,
        partitions=("year_month", "load_id"),
    )
    # Evaluated before the append makes new files visible to it: the audit read is fixed in the plan.
    load.audit.write.mode("append").parquet(audit_path)


def _read_audit(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(schemas.LOAD_AUDIT).parquet(path)
    except AnalysisException:
        return spark.sql("SELECT '' AS batch_id, now() AS loaded_at, 0L AS rows_loaded WHERE false")


def run_batch_load(
    spark: SparkSession, rows: DataFrame, fact_path: str, audit_path: str, *, batch_id: str, as_of=None,
    lookback_hours: float = 1,
) -> None:
    """``run_fact_load`` of a single batch whose rows do not repeat, under its id as load id.

    The rows are computed and shuffled once, for the write; the audit counts the load in the files written.
    """
    now = timefn.resolve_as_of(as_of)
    since = timefn.ts(now - dt.timedelta(hours=lookback_hours))
    known = _read_audit(spark, audit_path).where((F.col("batch_id") == batch_id) & (F.col("loaded_at") >= since))
    if not known.isEmpty():
        return
    loaded = rows.select(*schemas.FACT_COLUMNS).withColumn("load_id", F.lit(batch_id))
    write_fact(loaded, fact_path, partitions=("year_month", "load_id"))
    written = spark.read.schema(f"{schemas.FACT}, load_id string").parquet(fact_path)
    counted = written.where(F.col("load_id") == batch_id).groupBy("load_id").agg(F.count("*").alias("rows_loaded"))
    counted.select(F.col("load_id").alias("batch_id"), timefn.ts(now).alias("loaded_at"), "rows_loaded").write.mode(
        "append"
    ).parquet(audit_path)


def archive_manifest(values: DataFrame, *, as_of=None, keep_months: int = 12) -> DataFrame:
    """Months of history with row counts and what to do with them: keep or archive."""
    now = timefn.resolve_as_of(as_of)
    oldest = f"{timefn.add_months(timefn.month_start(now), -keep_months):%Y-%m}"
    month = F.col("year_month") if "year_month" in values.columns else timefn.year_month(F.col("ingested_at"))
    return (
        values.groupBy(month.alias("year_month"))
        .agg(F.count("*").alias("row_count"))
        .withColumn("action", F.when(F.col("year_month") < oldest, "archive").otherwise("keep"))
        .orderBy("year_month")
    )


ARCHIVE_LOG = "year_month string, row_count long, action string, at timestamp, load_id string"


def read_archive_log(spark: SparkSession, path: str) -> DataFrame:
    """All decisions on months so far; empty before the first run."""
    try:
        return spark.read.schema(ARCHIVE_LOG).parquet(f"{path}/*")
    except AnalysisException:
        return spark.createDataFrame([], ARCHIVE_LOG)


def folded_manifest(log: DataFrame) -> DataFrame:
    """What holds for each month: archived for good once it was, else what the last run said.

    The rows of an archived month are those of all its loads. Months that live history has no row of any more
    stay listed.
    """
    gone = F.col("action") == "archive"
    kept = F.max_by("row_count", F.when(~gone, F.col("at")))
    return log.groupBy("year_month").agg(
        F.coalesce(F.sum(F.when(gone, F.col("row_count"))), kept).alias("row_count"),
        F.when(F.max(gone.cast("int")) == 1, "archive").otherwise("keep").alias("action"),
    )


def archive_partitions(
    values: DataFrame, archive_path: str, manifest_path: str, *, as_of=None, keep_months: int = 12
) -> DataFrame:
    """Copy expired months to the archive, then log what was done; returns the manifest over all runs.

    The log only grows, by a row per month and run, so a month stays archived when its live folders are gone. Rows
    of an archived month that the archive lacks, late ones, are added as a load of their own; a run that dies
    before it is logged is repeated under the same ``as_of`` and writes over itself. The live files are not
    rewritten: ``live_months`` reads only what the manifest keeps, and the storage can drop the archived month
    folders at any later time.
    """
    spark, now = values.sparkSession, timefn.resolve_as_of(as_of)
    load_id = f"{now:%Y%m%dT%H%M%S%f}"
    log = read_archive_log(spark, manifest_path).where(F.col("load_id") != load_id)
    before = folded_manifest(log).where("action = 'archive'").select("year_month")
    monthly = values.withColumn("year_month", timefn.year_month(F.col("ingested_at")))
    cutoff = timefn.add_months(timefn.month_start(now), -keep_months)
    expired = monthly.where(F.col("ingested_at") < timefn.ts(cutoff))
    fresh = expired.join(before, "year_month", "left_anti").select(monthly.columns)
    again = expired.join(before, "year_month", "left_semi").select(monthly.columns)
    if not before.isEmpty():
        stored = spark.read.parquet(archive_path).where(F.col("load_id") != load_id)
        fresh = fresh.unionByName(again.exceptAll(stored.select(*[F.col(c).cast(t) for c, t in monthly.dtypes])))
    write_fact(fresh.withColumn("load_id", F.lit(load_id)), archive_path, partitions=("year_month", "load_id"))
    told = archive_manifest(values, as_of=now, keep_months=keep_months).where("action = 'keep'")
    try:
        moved = spark.read.parquet(archive_path).where(F.col("load_id") == load_id)
        moved = moved.groupBy(F.col("year_month").cast("string").alias("year_month")).agg(F.count("*").alias("row_count"))
        told = told.unionByName(moved.withColumn("action", F.lit("archive")))
    except AnalysisException:  # nothing was ever archived
        pass
    entry = told.withColumns({"at": timefn.ts(now), "load_id": F.lit(load_id)}).coalesce(1)
    entry.write.mode("overwrite").parquet(f"{manifest_path}/run-{load_id}")
    return folded_manifest(read_archive_log(spark, manifest_path)).orderBy("year_month")


def live_months(monthly: DataFrame, manifest: DataFrame) -> DataFrame:
    """History rows of the months the manifest keeps."""
    kept = manifest.where(F.col("action") == "keep").select("year_month")
    return monthly.join(kept, "year_month", "left_semi")
