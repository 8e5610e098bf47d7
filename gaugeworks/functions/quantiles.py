"""Exact order statistics for groups of any size.

The built-in ``percentile`` holds all distinct values of a group in one buffer. Here a group is first
reduced to (value, count) rows, which spread over the cluster by value. Values fall into buckets of a
fixed relative width, so the counts per bucket are a small histogram; it tells which buckets hold a wanted
rank. A bucket that holds one is cut again, between its least and its largest value, into pieces by its number
of distinct values, since a narrow band of values may lie in one bucket; only the values of pieces that hold a
wanted rank are ordered. The same steps serve groups of all sizes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.relations import join_null_safe

STEPS = 512  # buckets per doubling of a value
PIECE_ROWS = 20_000  # distinct values of a piece if a bucket's values lie evenly
FINER = 16  # pieces are this many times smaller, for values that do not


def value_counts(
    df: DataFrame, keys: Sequence[str], value: Column, weight: Column | None = None
) -> DataFrame:
    """Rows (keys, v, c): how often each non-null value occurs in each group."""
    weighted = F.count("*") if weight is None else F.sum(weight)
    return (
        df.where(value.isNotNull())
        .groupBy(*keys, value.cast("double").alias("v"))
        .agg(weighted.cast("long").alias("c"))
    )


def _interpolate(
    rows: DataFrame, keys: Sequence[str], probs: Mapping[str, float]
) -> DataFrame:
    """Percentiles from value rows that know their rank range [_end - c, _end) and group size _n."""
    position = {name: f"((_n - 1) * {float(p)}D)" for name, p in probs.items()}

    def at(rank: str) -> str:
        return f"max(CASE WHEN {rank} >= _end - c AND {rank} < _end THEN v END)"

    picked = rows.groupBy(*keys).agg(
        F.max("_n").alias("_n"),
        *[F.expr(f"{at(f'floor({pos})')} AS `_lo_{name}`") for name, pos in position.items()],
        *[F.expr(f"{at(f'ceil({pos})')} AS `_hi_{name}`") for name, pos in position.items()],
    )
    return picked.selectExpr(
        *[f"`{k}`" for k in keys],
        *[
            f"`_lo_{name}` + ({pos} - floor({pos})) * (`_hi_{name}` - `_lo_{name}`) AS `{name}`"
            for name, pos in position.items()
        ],
    )


def bucket_of(v: Column) -> Column:
    """Bucket number of a double, monotone in the value: STEPS per power of two, mirrored for negative ones.

    The exponent may come out one too small next to a power of two; the sum is the same then.
    """
    size = F.abs(v)
    exponent = F.floor(F.log2(size))
    step = F.floor(size * F.pow(F.lit(2.0), 9 - exponent))
    number = (exponent + 1100) * STEPS + step
    return F.when(v > 0, number).when(v < 0, -number).otherwise(F.lit(0)).cast("long")


def _ranges(histogram: DataFrame, keys: Sequence[str], group: Sequence[str], number: str, probs: Mapping[str, float]) -> DataFrame:
    """The rows of a histogram (_size per ``number``, within ``group``) that hold a wanted rank, with the rank _start
    of their first value; _base is the rank of the first value of the group, _n the size of the whole."""
    before = Window.partitionBy(*group).orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    holds = " OR ".join(
        f"({near}((_n - 1) * {float(p)}D) BETWEEN _start AND _start + _size - 1)"
        for p in sorted(set(probs.values()))
        for near in ("floor", "ceil")
    )
    start = F.col("_base") + F.coalesce(F.sum("_size").over(before), F.lit(0))
    return histogram.withColumn("_start", start).where(holds)


def pieces(counts: DataFrame, keys: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """The (keys, v, c) rows of the pieces that hold a wanted rank, with _bucket, _piece, _start and _n."""
    placed = counts.withColumn("_bucket", bucket_of(F.col("v")))
    whole = Window.partitionBy(*keys)  # a row per bucket
    buckets = (
        placed.groupBy(*keys, "_bucket")
        .agg(
            F.sum("c").alias("_size"), F.count("*").alias("_rows"),
            F.min("v").alias("_least"), F.max("v").alias("_most"),
        )
        .withColumns({"_n": F.sum("_size").over(whole), "_base": F.lit(0)})
    )
    buckets = _ranges(buckets, keys, keys, "_bucket", probs)
    many = F.when(F.col("_rows") > PIECE_ROWS, F.ceil(F.col("_rows") * FINER / F.lit(PIECE_ROWS))).otherwise(F.lit(1))
    share = (F.col("v") - F.col("_least")) / (F.col("_most") - F.col("_least"))
    piece = F.when(many == 1, F.lit(0)).otherwise(F.floor(share * many)).cast("long")
    held = buckets.select(*keys, "_bucket", "_rows", "_least", "_most", F.col("_start").alias("_base"), "_n")
    cut = join_null_safe(placed, held, [*keys, "_bucket"]).select(
        *keys, "_bucket", "v", "c", piece.alias("_piece"), "_base", "_n"
    )
    group = [*keys, "_bucket"]
    histogram = cut.groupBy(*group, "_piece").agg(F.sum("c").alias("_size"), F.max("_base").alias("_base"), F.max("_n").alias("_n"))
    wanted = _ranges(histogram, keys, group, "_piece", probs).select(*group, "_piece", "_start")
    return join_null_safe(cut, wanted, [*group, "_piece"])


def percentiles_of_counts(counts: DataFrame, keys: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """Continuous percentiles (linear interpolation) from (keys, v, c) rows: keys + one column each."""
    running = (
        Window.partitionBy(*keys, "_bucket", "_piece").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    )
    cut = pieces(counts, keys, probs).select(
        *keys, "v", "c", (F.col("_start") + F.sum("c").over(running)).alias("_end"), "_n"
    )
    return _interpolate(cut, keys, probs)


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    probs: Mapping[str, float],
    weight: Column | None = None,
) -> DataFrame:
    """Continuous percentiles of a column per group; ``weight`` repeats a value that many times."""
    return percentiles_of_counts(value_counts(df, keys, value, weight), keys, probs)


def approx_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    probs: Mapping[str, float],
    accuracy: int = 10_000,
) -> DataFrame:
    """One-pass sketch; the rank error is at most 1/accuracy. Never used in place of the exact form."""
    sketch = F.percentile_approx(value, F.array(*[F.lit(p) for p in probs.values()]), F.lit(accuracy))
    return df.groupBy(*keys).agg(sketch.alias("_p")).select(
        *keys, *[F.col("_p")[i].alias(name) for i, name in enumerate(probs)]
    )


def mode_of_counts(counts: DataFrame, keys: Sequence[str], name: str = "mode_value") -> DataFrame:
    """Most frequent value per group, the smallest one on a tie."""
    return counts.groupBy(*keys).agg(
        F.max_by("v", F.struct(F.col("c"), (-F.col("v")).alias("neg"))).alias(name)
    )
