"""Imputation of missing funnel steps from mean step lags."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import minus_minutes, minutes_between, wall_clock
from sluice.specs import Fill, Lag


def _sample(lag: Lag, floor_column: str, samples_from: date) -> Column:
    delta = minutes_between(F.col(lag.start), F.col(lag.end))
    return F.when(delta.between(0, lag.bound) & (F.col(floor_column) >= F.lit(samples_from)), delta)


def step_lag_samples(
    funnel: DataFrame, lags: Sequence[Lag], keys: Sequence[str], floor_column: str, samples_from: date
) -> DataFrame:
    """Minutes between consecutive steps, null where a lag is not a sample.

    A sample has both steps, lies between 0 and the lag's bound, and belongs to an entity whose
    ``floor_column`` is on or after ``samples_from``. Grain: the funnel's.
    """
    return funnel.select(*keys, *[_sample(lag, floor_column, samples_from).alias(lag.name) for lag in lags])


def step_lag_means(funnel: DataFrame, lags: Sequence[Lag], floor_column: str, samples_from: date) -> DataFrame:
    """Mean of every lag's samples, null without samples. Grain: exactly one row."""
    return funnel.agg(*[F.avg(_sample(lag, floor_column, samples_from)).alias(lag.name) for lag in lags])


def backfill_chain(funnel: DataFrame, means: DataFrame, fills: Sequence[Fill]) -> DataFrame:
    """Impute missing steps from the following, possibly imputed, step.

    ``fills`` runs from the last step of the funnel to the first. Every filled step keeps its input value
    as ``<step>_raw``. The means enter as a scalar subquery: the fill is a projection, without a join or a
    shuffle. Grain: the funnel's.
    """
    steps = {f.step for f in fills}
    mean = means.select(F.struct(*[F.col(c) for c in means.columns])).scalar().alias("_means")
    raw = funnel.select(
        *[F.col(c).alias(f"{c}_raw" if c in steps else c) for c in funnel.columns], mean
    )

    def filled(fill: Fill) -> Column:
        own, kept = (wall_clock(F.col(f"{c}_raw")) for c in (fill.step, fill.kept or fill.step))
        following = wall_clock(F.coalesce(*[F.col(c) for c in fill.following]))
        imputed = minus_minutes(following, F.col("_means")[fill.lag])
        if fill.kept is None:
            value = F.coalesce(kept, imputed)
        else:
            value = F.when(own.isNull() & following.isNotNull(), imputed).otherwise(kept)
        return value if fill.applies is None else F.when(F.expr(fill.applies), value).otherwise(own)

    # Each fill may name the ones before it in the same select.
    return raw.select("*", *[filled(fill).alias(fill.step) for fill in fills]).drop("_means")


def backfill_flag(steps: Sequence[str]) -> Column:
    """1 when any of the steps was imputed, else 0."""
    imputed = [F.col(f"{s}_raw").isNull() & F.col(s).isNotNull() for s in steps]
    return F.when(reduce(or_, imputed), F.lit(1)).otherwise(F.lit(0))


def funnel_publish(filled: DataFrame, columns: Sequence[str], as_of: str) -> DataFrame:
    """The published column list, stamped with the time of the run."""
    return filled.select(F.lit(as_of).cast("timestamp_ntz").alias("last_updated_at"), *columns)
