"""Time helpers with the semantics of the reference dialect, evaluated in UTC."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def resolve_as_of(as_of: str | dt.datetime | None) -> dt.datetime:
    """The query's "now" as a naive UTC datetime, so that it folds to a literal in the plan."""
    if as_of is None:
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return as_of


def ts(moment: dt.datetime) -> Column:
    """A UTC timestamp literal; pushes down to the Parquet scan."""
    return F.expr(f"TIMESTAMP '{moment:%Y-%m-%d %H:%M:%S.%f}+00:00'")


def date(moment: dt.datetime) -> Column:
    return F.expr(f"DATE '{moment:%Y-%m-%d}'")


def add_months(moment: dt.datetime, months: int) -> dt.datetime:
    """Calendar month arithmetic; the day is clamped to the length of the target month."""
    index = moment.year * 12 + moment.month - 1 + months
    year, month = divmod(index, 12)
    day = min(moment.day, calendar.monthrange(year, month + 1)[1])
    return moment.replace(year=year, month=month + 1, day=day)


def month_start(moment: dt.datetime) -> dt.datetime:
    return moment.replace(day=1, hour=0, minute=0, second=0, microsecond=0)


def datediff_boundary(unit: str, start: Column, end: Column) -> Column:
    """Number of unit boundaries between two timestamps (10:59 to 11:01 is one hour)."""
    if unit == "month":
        months = lambda c: F.year(c) * F.lit(12) + F.month(c)
        return (months(end) - months(start)).cast("long")
    size = _SECONDS[unit]
    if unit == "second":
        return F.unix_seconds(end) - F.unix_seconds(start)
    floor = lambda c: F.floor(F.unix_seconds(c) / F.lit(size))
    return floor(end) - floor(start)


def epoch_seconds(start: Column, end: Column) -> Column:
    """Elapsed seconds with fractions."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def dow0(c: Column) -> Column:
    """Day of week with Sunday as 0."""
    return F.dayofweek(c) - F.lit(1)


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def derived_time_columns(c: Column) -> dict[str, Column]:
    """The six calendar columns of the fact table plus its partition month."""
    return {
        "ingested_date": F.to_date(c),
        "ingested_hour": F.hour(c).cast("short"),
        "ingested_day_of_week": dow0(c).cast("short"),
        "ingested_week": F.to_date(F.date_trunc("week", c)),
        "ingested_month": F.to_date(F.date_trunc("month", c)),
        "year_month": year_month(c).alias("year_month", metadata={"derived": True}),
    }


def since(df, moment: dt.datetime, column: str = "ingested_at", until: dt.datetime | None = None):
    """Rows from ``moment`` on (up to ``until``, exclusive).

    On a table partitioned by ``year_month`` the month predicate is added, which the planner cannot
    derive. A computed ``year_month`` carries the metadata key ``derived`` and is left alone: testing it
    would cost a date format per row and prune nothing.
    """
    kept = df.where(F.col(column) >= ts(moment))
    if until is not None:
        kept = kept.where(F.col(column) < ts(until))
    stored = {f.name: f for f in df.schema.fields}.get("year_month")
    if column == "ingested_at" and stored is not None and not stored.metadata.get("derived"):
        kept = kept.where(F.col("year_month") >= f"{moment:%Y-%m}")
        if until is not None:
            kept = kept.where(F.col("year_month") <= f"{until:%Y-%m}")
    return kept
