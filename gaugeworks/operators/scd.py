"""Versioned dimensions: merge of changes and lookup as of a point in time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks import schemas
from gaugeworks.functions import timefn
from gaugeworks.functions.relations import asof_backward, cuts_of_large_keys, latest_by, previous_in_slices


def _end_of_time() -> Column:
    return F.expr(f"TIMESTAMP '{schemas.EOT}+00:00'")


def scd2_merge(
    dim: DataFrame,
    changes: DataFrame,
    key: Sequence[str],
    tracked: Sequence[str],
    *,
    as_of=None,
    order: Sequence[str] = (),
) -> DataFrame:
    """New state of a dimension after a batch of changes.

    The last change of a key wins within the batch (``order`` tells which is last). A key whose tracked
    columns differ gets its open version closed at ``as_of`` and a new one opened; equal ones are kept.
    """
    moment = timefn.ts(timefn.resolve_as_of(as_of))
    fresh = latest_by(changes, key, order).select(*key, *tracked)
    incoming = fresh.select(*key, F.struct(*tracked).alias("_new"))
    # One pass over the dimension: history and open versions travel through the same outer join.
    joined = dim.withColumn("_have", F.lit(True)).join(incoming, list(key), "full_outer")
    differs = ~F.struct(*tracked).eqNullSafe(F.col("_new"))
    turned = F.col("_have") & F.col("is_current") & F.col("_new").isNotNull() & differs
    # A key that is absent, or known only through closed versions, is opened by its own branch.
    state = joined.withColumn("_turned", F.coalesce(turned, F.lit(False)))
    kept = F.struct(
        *key, *tracked, "valid_from",
        F.when(F.col("_turned"), moment).otherwise(F.col("valid_to")).alias("valid_to"),
        (F.col("is_current") & ~F.col("_turned")).alias("is_current"),
    )
    opened = F.struct(
        *key, *[F.col(f"_new.{c}").alias(c) for c in tracked],
        moment.alias("valid_from"), _end_of_time().alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    is_new_key = F.col("_have").isNull()
    versions = (
        F.when(is_new_key, F.array(opened))
        .when(F.col("_turned"), F.array(kept, opened))
        .otherwise(F.array(kept))
    )
    merged = state.select(F.explode(versions).alias("v")).select("v.*")
    closed_only = (
        dim.groupBy(*key).agg(F.max("is_current").alias("_open")).where(~F.col("_open"))
        .join(fresh, list(key))
        .select(*key, *tracked, moment.alias("valid_from"), _end_of_time().alias("valid_to"),
                F.lit(True).alias("is_current"))
    )
    return merged.unionByName(closed_only)


def scd2_from_history(
    history: DataFrame, key: Sequence[str], tracked: Sequence[str], at: str
) -> DataFrame:
    """Versions of a dimension from a full change history: consecutive equal states collapse."""
    state = F.struct(*tracked)
    rows = history.select(*key, at, state.alias("_state"))
    cuts = cuts_of_large_keys(rows, key, F.col(at))  # the changes among the rows are fewer
    changed = previous_in_slices(
        rows, key, [at, "_state"], ["_state"], F.col(at), cuts
    ).where(F.col("_prev").isNull() | ~F.col("_prev._state").eqNullSafe(F.col("_state")))
    # The end of a version is the start of the next one: a lag over descending time.
    backwards = changed.drop("_prev").withColumn("_neg", -F.unix_micros(F.col(at)))
    closed = previous_in_slices(backwards, key, ["_neg"], [at], F.col(at), cuts, "_next")
    return closed.select(
        *key,
        "_state.*",
        F.col(at).alias("valid_from"),
        F.coalesce(F.col(f"_next.{at}"), _end_of_time()).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
    )


def scd2_asof(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    at: str,
    take: Sequence[str],
    how: str = "inner",
    *,
    few_versions: bool = True,
    slice_unit: str = "second",
) -> DataFrame:
    """Attach the dimension version valid at the fact's own time (from inclusive, to exclusive).

    Versions never overlap, so a fact meets at most one of them and no row is repeated.

    A dimension whose keys have few versions is looked up by key with the validity as a residual; this
    also works on a stream. With ``few_versions=False`` facts and versions are merged in time order
    instead: the work is linear even when one key has very many facts and very many versions.
    """
    if not few_versions:
        starts = dim.select(*on, F.col("valid_from").alias(at), *take, "valid_to")
        found = asof_backward(facts, starts, on, at, [*take, "valid_to"], slice_unit)
        valid = F.col(at) < F.col("valid_to")
        if how == "inner":
            return found.where(valid).drop("valid_to")
        return found.withColumns({c: F.when(valid, F.col(c)) for c in take}).drop("valid_to")
    versions = dim.select(
        *[F.col(k).alias(f"_d_{k}") for k in on],
        *take,
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
    )
    condition = reduce(
        lambda acc, k: acc & (F.col(k) == F.col(f"_d_{k}")),
        on,
        (F.col(at) >= F.col("_from")) & (F.col(at) < F.col("_to")),
    )
    return facts.join(versions, condition, how).drop("_from", "_to", *[f"_d_{k}" for k in on])
