"""Relational helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key.

    The largest struct of the order columns and then the others: one aggregate whose buffer is the row. It
    combines before the shuffle, so a key that owns a large part of the rows reaches the reducer as one row
    per task; as the buffer is a struct, Spark sorts each task's rows by key to aggregate them.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*order, *[c for c in rest if c not in order])
    picked = df.groupBy(*keys).agg(F.max(row).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join where null keys match; the key columns come from the left side."""
    keys = list(keys)
    rest = [c for c in right.columns if c not in keys]
    renamed = right.selectExpr(*[f"`{k}` AS `_r_{k}`" for k in keys], *[f"`{c}`" for c in rest])
    condition = F.expr(" AND ".join(f"`{k}` <=> `_r_{k}`" for k in keys))
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_anti", "left_semi") else joined.drop(*[f"_r_{k}" for k in keys])


SLICE_ROWS = 500_000  # rows of a key that one task sorts as they are


def cuts_of_large_keys(df: DataFrame, keys: Sequence[str], at: Column, limit: int = SLICE_ROWS) -> DataFrame | None:
    """Keys with more than ``limit`` rows by the hours of their time, and whether the hour too has more (``_fine``);
    None when there is no such key.

    Runs a job: counts per key and hour, which combine before the shuffle. With the answer known, ordinary data get
    the plain plan, and nothing is scanned or shuffled again for keys that do not exist.
    """
    hours = df.groupBy(*keys, F.date_trunc("hour", at).alias("_hour")).agg(F.count("*").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(*keys))
    cuts = hours.withColumn("_total", total).where(F.col("_total") > limit)
    cuts = cuts.select(*keys, "_hour", (F.col("_n") > limit).alias("_fine"))
    return None if cuts.isEmpty() else cuts


def sliced(df: DataFrame, keys: Sequence[str], at: Column, cuts: DataFrame, unit: str = "second") -> DataFrame:
    """The rows with a column ``_slice``: null for ordinary keys, the hour for those in ``cuts``, and in hours with
    too many rows the time by ``unit``, which is a part of an hour."""
    marked = join_null_safe(df.withColumn("_hour", F.date_trunc("hour", at)), cuts, [*keys, "_hour"], "left")
    cut = F.when(F.col("_fine"), F.date_trunc(unit, at)).when(~F.col("_fine"), F.col("_hour"))
    return marked.withColumn("_slice", cut).drop("_hour", "_fine")


def previous_in_slices(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    take: Sequence[str],
    at: Column,
    cuts: DataFrame | None,
    name: str = "_prev",
    unit: str = "second",
) -> DataFrame:
    """``lag`` of the columns ``take`` per key, safe for a key of any size.

    Without large keys (``cuts_of_large_keys`` of the same rows or more of them) it is a plain ``lag``. The rows of a
    large key, which are in the order of their time ``at``, rising or falling, get it inside their slice; only the
    first row of a slice lacks its predecessor then, the last row of the slice before: these edge rows, two per slice,
    get a second ``lag`` per key. Slices are hours unless an hour has too many rows, so the edges are few against the
    rows of the key. ``order`` must tell any two rows with different ``take`` apart.
    """
    payload = F.struct(*[F.col(c) for c in take])
    across = Window.partitionBy(*keys).orderBy(*order)
    if cuts is None:
        return df.withColumn(name, F.lag(payload).over(across))
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    cut = sliced(df, keys, at, cuts, unit)
    whole = F.col("_slice").isNull()
    lagged = cut.withColumn("_in", F.lag(payload).over(inside))
    told = lagged.where(whole | F.col("_in").isNotNull()).select(*df.columns, F.col("_in").alias(name))
    of_large = cut.where(~whole).withColumns(
        {"_in": F.lag(payload).over(inside), "_next": F.lead(F.lit(1)).over(inside)}
    )
    edges = of_large.where(F.col("_in").isNull() | F.col("_next").isNull())
    firsts = edges.withColumn(name, F.lag(payload).over(across)).where(F.col("_in").isNull())
    return told.unionByName(firsts.select(*df.columns, name))


def asof_backward(
    left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, take: Sequence[str],
    slice_unit: str = "second", limit: int = SLICE_ROWS,
) -> DataFrame:
    """Attach to each left row the newest right row of its key at or before its time.

    Both sides run through one time-ordered stream per key, which carries the last right row forward. The stream
    of a large key (``cuts_of_large_keys``, which runs a job) is cut into slices, and the last row of the slices
    before is joined to a slice. No join on ranges and no task with all rows of a large key.
    """
    payload = F.struct(*take)
    left_columns = left.columns
    events = left.select(
        *keys, at, F.lit(1).alias("_side"), F.struct(*left_columns).alias("_left"),
        F.lit(None).cast(right.select(payload.alias("p")).schema["p"].dataType).alias("_right"),
    ).unionByName(
        right.select(*keys, at, F.lit(0).alias("_side"), payload.alias("_right")),
        allowMissingColumns=True,
    )
    times = left.select(*keys, at).unionByName(right.select(*keys, at))
    cuts = cuts_of_large_keys(times, keys, F.col(at), limit)
    cut = events if cuts is None else sliced(events, keys, F.col(at), cuts, slice_unit)
    inside = (
        Window.partitionBy(*keys, *([] if cuts is None else ["_slice"]))
        .orderBy(at, "_side", "_right")  # of right rows with one time the largest counts, as in the tails
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    here = cut.withColumn("_here", F.last("_right", ignorenulls=True).over(inside)).where(F.col("_side") == 1)
    if cuts is None:
        found = here.withColumn("_found", F.col("_here"))
    else:
        tails = cut.where("_slice IS NOT NULL").groupBy(*keys, "_slice").agg(
            F.max_by("_right", F.when(F.col("_side") == 0, F.struct(at, "_right"))).alias("_tail")
        )
        before = (
            Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        )  # one row per slice
        carried = tails.select(
            *keys, "_slice", F.last("_tail", ignorenulls=True).over(before).alias("_carry")
        )
        found = join_null_safe(here, carried, [*keys, "_slice"], "left")
        found = found.withColumn("_found", F.coalesce("_here", "_carry"))
    return found.select("_left.*", "_found").select(
        *left_columns, *[F.col(f"_found.{c}").alias(c) for c in take]
    )


def exact_mean(c: Column) -> Column:
    """Mean of a decimal column as double: exact sum, one division."""
    return F.sum(c).cast("double") / F.count(c)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null for a zero denominator."""
    return F.try_divide(numerator, denominator)


def with_total(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the sum of a column over all rows, as a scalar subquery."""
    return df.withColumn(name, df.agg(F.sum(column)).scalar())
