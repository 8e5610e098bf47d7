"""Distributions, correlation within a time band, baseline rules."""

from __future__ import annotations

import datetime as dt
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions import timefn
from gaugeworks.functions.quantiles import (
    exact_percentiles,
    mode_of_counts,
    percentiles_of_counts,
    value_counts,
)
from gaugeworks.functions.relations import exact_mean, join_null_safe, ratio


def attribute_distribution(
    fact: DataFrame, *, as_of=None, days: int = 7, tenant_id=None, category: str = "performance",
    min_samples: int = 100,
) -> DataFrame:
    """Centre, spread, range and percentiles of a category's values per attribute and entity type."""
    start = timefn.resolve_as_of(as_of) - dt.timedelta(days=days)
    keys = ["attribute_name", "attribute_category", "entity_type"]
    rows = timefn.since(fact, start).where(
        (F.col("attribute_category") == category) & F.col("value_decimal").isNotNull()
    )
    if tenant_id is not None:
        rows = rows.where(F.col("tenant_id") == F.lit(tenant_id))
    value = F.col("value_decimal")
    basic = (
        rows.groupBy(*keys)
        .agg(
            F.count("*").alias("sample_count"),
            F.count_distinct("entity_id").alias("entity_count"),
            exact_mean(value).alias("mean_value"),
            F.stddev(value.cast("double")).alias("stddev_value"),
            F.variance(value.cast("double")).alias("variance_value"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
        )
        .where(F.col("sample_count") > min_samples)
        .withColumn("range_value", F.col("max_value") - F.col("min_value"))
    )
    counts = value_counts(rows, keys, value)
    probs = {
        "median_value": 0.5, "p01": 0.01, "p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75,
        "p95": 0.95, "p99": 0.99,
    }
    ranks = percentiles_of_counts(counts, keys, probs)
    modes = mode_of_counts(counts, keys)
    return join_null_safe(join_null_safe(basic, ranks, keys), modes, keys).orderBy(
        F.desc("entity_count"), F.desc("sample_count"), *keys
    )


def attribute_correlation(
    fact: DataFrame, attributes: list[str], *, as_of=None, days: int = 7, tenant_id=None,
    band_seconds: int = 60, min_pairs: int = 1000,
) -> DataFrame:
    """Correlation and regression between attributes of one entity read within a time band.

    Statistically this is a self join of readings less than ``band_seconds`` apart. No pair is ever
    built. Readings are summed per (entity, second). The sums of the partner attribute within the band
    are the difference of two running sums, at ``second + reach`` and at ``second - reach - 1``: each
    second of the left attribute puts one probe at either point, with opposite signs, into the time
    order of the partner's seconds. All coefficients follow from six totals over the probes. The work is
    a sort, whatever the width of the band; a window group is one day of seconds of one entity, whatever
    the volume. Seconds near midnight are copied into the neighbouring day as partners only.

    As in the original, the left reading must lie in the last days; the right one need not.
    """
    start = timefn.resolve_as_of(as_of) - dt.timedelta(days=days)
    reach = band_seconds - 1
    names = sorted(attributes)
    rows = timefn.since(fact, start - dt.timedelta(seconds=band_seconds)).where(
        F.col("attribute_name").isin(names) & F.col("value_decimal").isNotNull()
    )
    if tenant_id is not None:
        rows = rows.where(F.col("tenant_id") == F.lit(tenant_id))
    # Values are taken from a centre of their attribute, exactly, so that no offset eats the digits of the sums.
    centres = rows.groupBy("attribute_name").agg(F.avg("value_decimal").cast("decimal(20,5)").alias("_centre"))
    rows = rows.join(centres, "attribute_name")
    value = (F.col("value_decimal") - F.col("_centre")).cast("double")
    in_range = F.col("ingested_at") >= timefn.ts(start)

    def sums(i: int, prefix: str, condition: Column) -> list[Column]:
        mine = condition & (F.col("attribute_name") == names[i])
        return [
            F.count(F.when(mine, 1)).alias(f"{prefix}n{i}"),
            F.coalesce(F.sum(F.when(mine, value)), F.lit(0.0)).alias(f"{prefix}s{i}"),
            F.coalesce(F.sum(F.when(mine, value * value)), F.lit(0.0)).alias(f"{prefix}q{i}"),
        ]

    lefts, rights = range(len(names) - 1), range(1, len(names))
    left_columns = [f"a{k}{i}" for i in lefts for k in "nsq"]
    right_columns = [f"b{k}{j}" for j in rights for k in "nsq"]
    seconds = rows.groupBy("tenant_id", "entity_id", F.unix_seconds("ingested_at").alias("sec")).agg(
        *[c for i in lefts for c in sums(i, "a", in_range)],
        *[c for j in rights for c in sums(j, "b", F.lit(True))],
    )

    # One second becomes partner rows (sign 0) in every day it can reach, and two probes in its own day.
    day = lambda c: F.floor(c / F.lit(86400))
    sec = F.col("sec")
    partner_days = F.sequence(day(sec - reach), day(sec + reach))

    def entry(in_day: Column, point: Column, sign: int) -> Column:
        return F.struct(in_day.alias("day"), point.alias("point"), F.lit(sign).alias("sign"))

    entries = F.concat(
        F.transform(partner_days, lambda d: entry(d, sec, 0)),
        F.array(entry(day(sec), sec + reach, 1), entry(day(sec), sec - reach - 1, -1)),
    )
    timeline = seconds.withColumn("e", F.explode(entries)).select(
        "tenant_id", "entity_id", "e.*", *left_columns, *right_columns
    )
    is_probe = F.col("sign") != 0
    so_far = (
        Window.partitionBy("tenant_id", "entity_id", "day")
        .orderBy("point", is_probe)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    probes = timeline.select(
        "sign",
        *left_columns,
        *[
            F.sum(F.when(is_probe, F.lit(0)).otherwise(F.col(c))).over(so_far).alias(c)
            for c in right_columns
        ],
    ).where(is_probe)

    def exact(c: str) -> Column:
        return F.col(c).cast("decimal(19,0)")

    pairs = list(combinations(range(len(names)), 2))
    totals = probes.agg(
        *[
            # The counts are subtracted exactly; as doubles they could lose their last digits.
            F.sum(F.col("sign").cast("decimal(1,0)") * exact(f"an{i}") * exact(f"bn{j}")).alias(f"n_{i}_{j}")
            for i, j in pairs
        ],
        *[
            F.sum(F.col("sign") * F.col(left) * F.col(right)).alias(f"{label}_{i}_{j}")
            for i, j in pairs
            for label, left, right in (
                ("x", f"as{i}", f"bn{j}"), ("y", f"an{i}", f"bs{j}"), ("xy", f"as{i}", f"bs{j}"),
                ("xx", f"aq{i}", f"bn{j}"), ("yy", f"an{i}", f"bq{j}"),
            )
        ],
    )
    listed = totals.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(names[i]).alias("attr1_name"),
                        F.lit(names[j]).alias("attr2_name"),
                        F.col(f"n_{i}_{j}").cast("long").alias("pair_count"),
                        *[
                            F.col(f"{s}_{i}_{j}").cast("double").alias(s)
                            for s in ("n", "x", "y", "xy", "xx", "yy")
                        ],
                    )
                    for i, j in pairs
                ]
            )
        ).alias("p")
    ).select("p.*")
    n, x, y = F.col("n"), F.col("x"), F.col("y")
    co = F.col("xy") - x * y / n
    var_x, var_y = F.col("xx") - x * x / n, F.col("yy") - y * y / n
    correlation = ratio(co, F.sqrt(var_x * var_y))
    slope = ratio(co, var_x)
    centre = lambda k: centres.select(
        F.col("attribute_name").alias(f"attr{k}_name"), F.col("_centre").cast("double").alias(f"_centre{k}")
    )
    return (
        listed.where(F.col("pair_count") > min_pairs)
        .join(centre(1), "attr1_name")
        .join(centre(2), "attr2_name")
        .select(
            "attr1_name",
            "attr2_name",
            F.col("pair_count"),
            correlation.alias("correlation"),
            (co / n).alias("covariance"),
            slope.alias("regression_slope"),
            ((y - slope * x) / n + F.col("_centre2") - slope * F.col("_centre1")).alias("regression_intercept"),
            (correlation * correlation).alias("r_squared"),
        )
        .orderBy(F.desc(F.abs("correlation")))
    )


def baseline_outliers(
    fact: DataFrame, *, as_of=None, recent_days: int = 1, baseline_days: int = 7,
    sigmas: float = 3.0, median_shift: float = 0.25,
) -> DataFrame:
    """Compare the last days with the days before them, per attribute and entity type.

    Rules: values above the baseline p99 (counted), mean above baseline mean + 3 standard deviations,
    median moved by more than a share of the baseline median.
    """
    now = timefn.resolve_as_of(as_of)
    split = now - dt.timedelta(days=recent_days)
    keys = ["attribute_name", "entity_type"]
    value = F.col("value_decimal")
    filled = fact.where(value.isNotNull())
    before = timefn.since(filled, split - dt.timedelta(days=baseline_days), until=split)
    after = timefn.since(filled, split, until=now)

    base = before.groupBy(*keys).agg(
        exact_mean(value).alias("baseline_mean"),
        F.stddev(value.cast("double")).alias("baseline_stddev"),
    )
    base_ranks = exact_percentiles(
        before, keys, value, {"baseline_median": 0.5, "baseline_p99": 0.99}
    )
    baseline = join_null_safe(base, base_ranks, keys)
    # Recent values as counts: outliers are then a weighted sum, and the median needs no second scan.
    counts = value_counts(after, keys, value)
    recent = join_null_safe(counts, baseline, keys).groupBy(*keys, *[
        c for c in baseline.columns if c not in keys
    ]).agg(
        F.sum("c").alias("samples"),
        F.sum(F.when(F.col("v") > F.col("baseline_p99"), F.col("c")).otherwise(F.lit(0))).alias("outliers"),
        (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("recent_mean"),
    )
    medians = percentiles_of_counts(counts, keys, {"recent_median": 0.5})
    joined = join_null_safe(recent, medians, keys)
    return joined.withColumn(
        "mean_alert",
        F.col("recent_mean") > F.col("baseline_mean") + F.lit(sigmas) * F.col("baseline_stddev"),
    ).withColumn(
        "shift_alert",
        F.abs(F.col("recent_median") - F.col("baseline_median"))
        > F.lit(median_shift) * F.abs(F.col("baseline_median")),
    )
