"""Week-over-week and versus-last-month monitoring of the weekly conversion metrics."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame

from sluice.operators.metrics import METRICS, metric_base, metric_diffs, metric_lags, metric_long, metric_prev_month, with_base
from sluice.operators.variance import (
    accumulated_decline,
    cumulative_impact,
    decline_streaks,
    guardrails,
    holiday_weeks,
    impact_translation,
    series_partitioning,
    streak_start_value,
    variance_thresholds,
)
from sluice.sources.holidays import holidays
from sluice.specs import REPRODUCE, Metric, Quirks

PUBLISHED = (
    "week_start",
    "metric_number",
    "metric_name",
    "metric_value",
    "metric_value_pw",
    "metric_wow_diff",
    "metric_wow_diff_pct",
    "w1_decline_flag",
    "metric_value_last_month_avg",
    "metric_lm_avg_diff",
    "metric_lm_avg_diff_pct",
    "lm_avg_decline_flag",
    "streak_group",
    "consecutive_decline_weeks",
    "week_index",
    "metric_value_at_streak_start",
    "accumulated_decline",
    "accumulated_decline_pct",
    "impact_wow_diff",
    "impact_acc_diff",
    "impact_lm_avg_diff",
    "metric_variance_threshold_abs",
    "metric_variance_threshold_rel",
    "acc_impact",
    "acc_cvr_impact_abs",
    "acc_cvr_impact_rel",
    "c1_wow_within_variance_threshold",
    "c2_acc_within_variance_threshold",
    "c3_lm_avg_within_variance_threshold",
    "c4_wow_within_substep_variance_threshold",
    "c5_acc_within_substep_variance_threshold",
    "c6_lm_avg_within_substep_variance_threshold",
    "c7_weeks_meet_threshold",
    "c8_is_a_holiday_week",
)
DROPPED = ("cohort", "metric_value_p2w", "metric_value_p3w", "metric_value_p4w")


def declines(long: DataFrame, quirks: Quirks = REPRODUCE) -> DataFrame:
    """Long metrics with lags, baseline, differences, streaks and accumulated decline."""
    compared = metric_diffs(metric_prev_month(metric_lags(long)), quirks)
    return accumulated_decline(streak_start_value(decline_streaks(compared)))


def impacts(base: DataFrame, quirks: Quirks = REPRODUCE, metrics: Sequence[Metric] = METRICS) -> DataFrame:
    """Declines as lost conversions, with thresholds and the cumulative impact."""
    long = series_partitioning(metric_long(with_base(base, quirks), metrics), quirks)
    translated = impact_translation(declines(long, quirks), None, metrics, quirks)
    return cumulative_impact(variance_thresholds(translated, metrics, quirks), quirks)


def variance_report(
    conversions: DataFrame,
    as_of: date,
    where: Column | None = None,
    calendar: DataFrame | None = None,
    quirks: Quirks = REPRODUCE,
    metrics: Sequence[Metric] = METRICS,
) -> DataFrame:
    """The published variance table. Grain: one row per cohort, completed week and metric."""
    judged = guardrails(impacts(metric_base(conversions, as_of, where), quirks, metrics), metrics, quirks=quirks)
    named = holiday_weeks(judged, holidays(conversions.sparkSession) if calendar is None else calendar)
    kept = () if quirks.drop_lags_and_cohort else DROPPED
    return named.select(*PUBLISHED, *kept)
