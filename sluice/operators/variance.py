"""Decline streaks, their impact in lost conversions, and threshold verdicts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.functions import safe_ratio, week_start
from sluice.operators.metrics import METRICS, SERIES
from sluice.specs import REPRODUCE, Metric, Quirks

MAX_DECLINE_WEEKS = 4


def series_partitioning(long: DataFrame, quirks: Quirks = REPRODUCE) -> DataFrame:
    """The long metrics, partitioned so that no window from the lags to the cumulative impact shuffles them again.

    The cumulative impact runs over all cohorts of a metric (K8), so those have to meet, and every other window's
    partitions lie within a metric's. Corrected, each series stands alone. Grain: the input's.
    """
    return long.repartition("metric_number") if quirks.monitor_ignores_cohort else long.repartition(*SERIES)


def decline_streaks(diffs: DataFrame) -> DataFrame:
    """Streak number, weeks of consecutive decline and row index of every metric row.

    Each week without a decline opens a streak, so the rows since then number the decline. Grain: the
    input's.
    """
    series = W.partitionBy(*SERIES).orderBy("week_start")
    so_far = series.rowsBetween(W.unboundedPreceding, W.currentRow)
    in_streak = W.partitionBy(*SERIES, "streak_group").orderBy("week_start")
    opens = F.when(F.col("w1_decline_flag") == 0, 1).otherwise(0)
    numbered = diffs.withColumns(
        {"streak_group": F.sum(opens).over(so_far), "week_index": F.row_number().over(series)}
    )
    weeks = F.when(F.col("w1_decline_flag") == 1, F.row_number().over(in_streak) - 1).otherwise(0)
    return numbered.withColumn("consecutive_decline_weeks", weeks)


def streak_start_value(streaks: DataFrame) -> DataFrame:
    """Value at the row that opened the streak; no self-join. Grain: the input's."""
    in_streak = W.partitionBy(*SERIES, "streak_group").orderBy("week_start")
    return streaks.withColumn(
        "metric_value_at_streak_start",
        F.first("metric_value").over(in_streak.rowsBetween(W.unboundedPreceding, W.currentRow)),
    )


def accumulated_decline(started: DataFrame) -> DataFrame:
    """Decline since the streak began, absolute and relative; null over a missing or zero start."""
    start = F.col("metric_value_at_streak_start")
    return started.withColumns(
        {
            "accumulated_decline": F.when(start != 0, F.col("metric_value") - start),
            "accumulated_decline_pct": F.when(start != 0, safe_ratio(F.col("metric_value"), start) - 1),
        }
    )


def _by_metric(metrics: Sequence[Metric], value: dict[str, Column]) -> Column:
    """The value belonging to the row's metric, null for metrics without one."""
    with_value = [m for m in metrics if m.name in value]
    return reduce(
        lambda chain, m: chain.when(F.col("metric_name") == m.name, value[m.name]),
        with_value[1:],
        F.when(F.col("metric_name") == with_value[0].name, value[with_value[0].name]),
    )


def _weight(metric: Metric, quirks: Quirks) -> Column:
    """Conversions per unit of the rate, from the weekly base row."""
    volume = F.col(f"_base.{metric.volume}").cast("double")
    if metric.onward is None:
        return volume
    numerator, denominator = metric.onward
    if denominator == "1":
        return volume * F.col(f"_base.{numerator}")
    below = F.col(f"_base.{denominator}").cast("double")
    onward = F.col(f"_base.{numerator}").cast("double")
    return volume * (onward / below if quirks.fail_on_zero_volume else F.try_divide(onward, below))


def impact_translation(
    declines: DataFrame, base: DataFrame | None = None, metrics: Sequence[Metric] = METRICS, quirks: Quirks = REPRODUCE
) -> DataFrame:
    """Rate differences as conversions lost or won; null for count metrics.

    Every difference is multiplied by one weight per row. The base rows are those that ``with_base`` sent along; without
    them ``base`` is joined, by week (K8) or, corrected, by cohort and week. The row is kept as ``_base`` for the thresholds
    and the cumulative rates. Grain: the input's while a week has one base row.
    """
    if base is None:
        rows = declines.select(*[c for c in declines.columns if c != "_bases"], F.explode_outer("_bases").alias("_base"))
    else:
        keys = ["week_start"] if quirks.monitor_ignores_cohort else ["cohort", "week_start"]
        of_week = base.select(*keys, F.struct(*[F.col(c) for c in base.columns if c not in keys]).alias("_base"))
        rows = declines.join(of_week, keys, "left")
    weights = {m.name: _weight(m, quirks) for m in metrics if m.volume is not None}
    weighted = rows.withColumn("impact_weight", _by_metric(metrics, weights))
    return weighted.withColumns(
        {
            "impact_wow_diff": F.col("metric_wow_diff") * F.col("impact_weight"),
            "impact_acc_diff": F.col("accumulated_decline") * F.col("impact_weight"),
            "impact_lm_avg_diff": F.col("metric_lm_avg_diff") * F.col("impact_weight"),
        }
    )


def _threshold(metrics: Sequence[Metric]) -> Column:
    return _by_metric(metrics, {m.name: F.lit(float(m.threshold)) for m in metrics if m.threshold is not None})


def variance_thresholds(
    impact: DataFrame, metrics: Sequence[Metric] = METRICS, quirks: Quirks = REPRODUCE
) -> DataFrame:
    """Rate change that costs the tolerated number of conversions, absolute and relative to last week."""
    weight = F.col("impact_weight")
    tolerated = _threshold(metrics)
    absolute = tolerated / weight if quirks.fail_on_zero_volume else F.try_divide(tolerated, weight)
    return impact.withColumn("metric_variance_threshold_abs", absolute).withColumn(
        "metric_variance_threshold_rel", safe_ratio(F.col("metric_variance_threshold_abs"), F.col("metric_value_pw"))
    )


def cumulative_impact(impact: DataFrame, quirks: Quirks = REPRODUCE) -> DataFrame:
    """Running impact inside a streak, and as a change of the top-level rate.

    The summed value is the impact since the streak began (K9); corrected, the weekly impact. The window
    leaves the cohort out (K8) unless corrected. Where the rows are partitioned by ``series_partitioning``, as in
    the report, it needs no shuffle either way.
    """
    keys = ["metric_number", "streak_group"] if quirks.monitor_ignores_cohort else [*SERIES, "streak_group"]
    running = W.partitionBy(*keys).orderBy("week_start").rangeBetween(W.unboundedPreceding, W.currentRow)
    summed = "impact_acc_diff" if quirks.cumulate_accumulated else "impact_wow_diff"
    return (
        impact.withColumn("acc_impact", F.sum(summed).over(running))
        .withColumn("acc_cvr_impact_abs", safe_ratio(F.col("acc_impact"), F.col("_base.applicants")))
        .withColumn("acc_cvr_impact_rel", safe_ratio(F.col("acc_cvr_impact_abs"), F.col("_base.cvr_0_apply_to_fd")))
    )


def guardrails(
    impact: DataFrame,
    metrics: Sequence[Metric] = METRICS,
    max_weeks: int = MAX_DECLINE_WEEKS,
    quirks: Quirks = REPRODUCE,
) -> DataFrame:
    """Verdicts: global threshold (c1-c3), the metric's own (c4-c6), streak length (c7).

    A missing impact is within every threshold (K12); corrected, its verdict is null. Grain: the input's.
    """
    top_level = F.lit(float(next(m.threshold for m in metrics if m.threshold is not None)))
    impacts = {"wow": "impact_wow_diff", "acc": "acc_impact", "lm_avg": "impact_lm_avg_diff"}

    def verdict(value: str, tolerated: Column) -> Column:
        within = F.when(F.col(value) < -tolerated, "No")
        return within.otherwise("Yes") if quirks.verdict_for_counts else within.when(F.col(value).isNotNull(), "Yes")

    names = list(impacts.items())
    return impact.withColumns(
        {f"c{i}_{n}_within_variance_threshold": verdict(v, top_level) for i, (n, v) in enumerate(names, 1)}
        | {f"c{i}_{n}_within_substep_variance_threshold": verdict(v, _threshold(metrics)) for i, (n, v) in enumerate(names, 4)}
        | {"c7_weeks_meet_threshold": F.when(F.col("consecutive_decline_weeks") <= max_weeks, "Yes").otherwise("No")}
    )


def holiday_weeks(weekly: DataFrame, holidays: DataFrame) -> DataFrame:
    """Name of the week's holiday, or 'Not a Holiday'; several names in a week are joined.

    The calendar is reduced to one row per week, so no row is repeated. Grain: the input's.
    """
    named = holidays.groupBy(week_start(F.col("holiday_date")).alias("week_start")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("holiday_date", "holiday_name"))), lambda h: h["holiday_name"]), ", ").alias("_holiday")
    )
    return (
        weekly.join(named, "week_start", "left")
        .withColumn("c8_is_a_holiday_week", F.coalesce("_holiday", F.lit("Not a Holiday")))
        .drop("_holiday")
    )
