"""Weekly metrics in long format, their lags, baselines and differences."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.functions import month_start, safe_ratio, week_start
from sluice.specs import REPRODUCE, Metric, Quirks

SERIES = ("cohort", "metric_number")
COUNTS = (
    "applicants",
    "profile_submit",
    "vehicle_submit",
    "idv_submit",
    "idv_approve",
    "bgc_submit",
    "account_activation",
    "first_delivery",
)
# Rates of the weekly base: name -> (numerator, denominator). FIXED VALUES.
RATES = {
    "cvr_0_apply_to_fd": ("first_delivery", "applicants"),
    "cvr_1_1_apply_to_activation": ("account_activation", "applicants"),
    "cvr_1_2_activation_to_fd": ("first_delivery", "account_activation"),
    "cvr_2_1_apply_to_vs": ("vehicle_submit", "applicants"),
    "cvr_2_2_vs_to_idv_submit": ("idv_submit", "vehicle_submit"),
    "cvr_2_3_idv_submit_to_approve": ("idv_approve", "idv_submit"),
    "cvr_2_4_idv_approve_to_bgc_submit": ("bgc_submit", "idv_approve"),
    "cvr_2_5_bgc_submit_to_aa": ("account_activation", "bgc_submit"),
}
# Metric numbers, and for each rate the volume it acts on, the onward rate of that volume as
# (numerator, denominator) and the tolerated loss of conversions. FIXED VALUES.
METRICS = (
    Metric("C1", "applicants", "applicants"),
    Metric("C2", "profile_submit", "profile_submit"),
    Metric("C3", "vehicle_submit", "vehicle_submit"),
    Metric("C4", "idv_submit", "idv_submit"),
    Metric("C5", "idv_approve", "idv_approve"),
    Metric("C6", "bgc_submit", "bgc_submit"),
    Metric("C7", "account_activation", "account_activation"),
    Metric("C8", "first_delivery", "first_delivery"),
    Metric("R0", "cvr_0_apply_to_fd", "cvr_0_apply_to_fd", "applicants", None, 1500),
    Metric(
        "R1.1",
        "cvr_1_1_apply_to_activation",
        "cvr_1_1_apply_to_activation",
        "applicants",
        ("cvr_1_2_activation_to_fd", "1"),
        1200,
    ),
    Metric("R1.2", "cvr_1_2_activation_to_fd", "cvr_1_2_activation_to_fd", "account_activation", None, 650),
    Metric(
        "R2.1", "cvr_2_1_apply_to_vs", "cvr_2_1_apply_to_vs", "applicants", ("first_delivery", "vehicle_submit"), 600
    ),
    Metric(
        "R2.2",
        "cvr_2_2_vs_to_idv_submit",
        "cvr_2_2_vs_to_idv_submit",
        "vehicle_submit",
        ("first_delivery", "idv_submit"),
        350,
    ),
    Metric(
        "R2.3",
        "cvr_2_3_idv_submit_to_approve",
        "cvr_2_3_idv_submit_to_approve",
        "idv_submit",
        ("first_delivery", "idv_approve"),
        550,
    ),
    Metric(
        "R2.4",
        "cvr_2_4_idv_approve_to_bgc_submit",
        "cvr_2_4_idv_approve_to_bgc_submit",
        "idv_approve",
        ("first_delivery", "bgc_submit"),
        400,
    ),
    Metric(
        "R2.5", "cvr_2_5_bgc_submit_to_aa", "cvr_2_5_bgc_submit_to_aa", "bgc_submit", ("cvr_1_2_activation_to_fd", "1"), 800
    ),
)


def metric_base(conversions: DataFrame, as_of: date, where: Column | None = None) -> DataFrame:
    """Weekly sums and tiered rates per cohort, for the weeks completed before ``as_of``'s week.

    Grain: one row per cohort and week.
    """
    used = conversions.filter(F.col("week_start") < week_start(F.lit(as_of)))
    used = used if where is None else used.filter(where)
    sums = used.groupBy("cohort", "week_start").agg(*[F.sum(c).alias(c) for c in COUNTS])
    return sums.withColumns({name: safe_ratio(F.col(n), F.col(d)) for name, (n, d) in RATES.items()})


def with_base(base: DataFrame, quirks: Quirks = REPRODUCE) -> DataFrame:
    """The weekly base with ``_bases``, the base rows that translate a row's differences into conversions.

    Those are all of the row's week, of every cohort (K8), and corrected the row itself. They travel with the metrics
    and their windows, so the base is computed once and never joined to itself. Grain: the base's.
    """
    own = F.struct(*[F.col(c) for c in base.columns if c not in ("cohort", "week_start")])
    if not quirks.monitor_ignores_cohort:
        return base.withColumn("_bases", F.array(own))
    return base.withColumn("_bases", F.collect_list(own).over(W.partitionBy("week_start")))


def metric_long(base: DataFrame, metrics: Sequence[Metric] = METRICS) -> DataFrame:
    """One row per cohort, week and metric, from a single pass over the base, with the ``_bases`` if it has any.
    Grain: (cohort, week, metric)."""
    cells = [
        F.struct(
            F.lit(m.number).alias("metric_number"),
            F.lit(m.name).alias("metric_name"),
            F.expr(m.value).cast("double").alias("metric_value"),
        )
        for m in metrics
    ]
    carried = [c for c in base.columns if c == "_bases"]
    return base.select("cohort", "week_start", *carried, F.inline(F.array(*cells)))


#: Binary digits of one long sum, and the number of such sums: values are summed to 256 bits below the group's largest.
DIGIT_BITS, DIGITS = 32, 8


def exact_mean(df: DataFrame, value: str, into: str, group: Sequence[str]) -> DataFrame:
    """Adds the mean of the group's doubles, which doesn't depend on the order of its additions.

    Every value is scaled by the power of two above the group's largest and cut into ``DIGITS`` whole numbers of
    ``DIGIT_BITS`` binary digits, without rounding. Each is summed as a long, exactly, and the sums are divided by
    the number of rows digit by digit with the remainder carried on. The mean of equal values is therefore that value.
    What lies more than 256 bits below the largest value is cut off. A value that is no finite number makes the mean
    what the usual one is. A group may have 2 ** 30 rows. Grain: the input's.
    """
    over, column = W.partitionBy(*group), F.col(value)
    size = F.abs(column)
    finite = size < float("inf")
    power = F.pow(F.lit(2.0), F.floor(F.log2(F.max(F.when(finite & (size > 0), size)).over(over))))
    scaled = df.withColumn("_scale", F.coalesce(power, F.lit(1.0)))
    unit = F.when(finite, column) / F.col("_scale") / 4

    def whole(k: int) -> Column:
        moved = unit * 2.0 ** (DIGIT_BITS * k)
        return moved - moved % 1

    def digit(k: int) -> Column:
        return (whole(k) - whole(k - 1) * 2.0**DIGIT_BITS).cast("bigint")

    summed = scaled.withColumns(
        {f"_digit{k}": F.sum(digit(k)).over(over) for k in range(1, DIGITS + 1)}
        | {"_rows": F.count(column).over(over), "_usual": F.avg(F.when(~finite, column)).over(over)}
    )
    rows = F.nullif(F.col("_rows"), F.lit(0).cast("bigint"))
    carried, mean = F.lit(0).cast("bigint"), F.lit(0.0)
    for k in range(1, DIGITS + 1):
        current = carried * 2**DIGIT_BITS + F.col(f"_digit{k}")
        mean = mean + F.call_function("div", current, rows).cast("double") * 2.0 ** (-DIGIT_BITS * k)
        carried = current % rows
    dropped = [f"_digit{k}" for k in range(1, DIGITS + 1)]
    return summed.withColumn(into, F.coalesce("_usual", mean * 4 * F.col("_scale"))).drop("_scale", "_rows", "_usual", *dropped)


def metric_monthly_avg(long: DataFrame) -> DataFrame:
    """Mean of every metric over the weeks starting in a month. Grain: (cohort, month, metric)."""
    group = ("cohort", "week_month", "metric_number", "metric_name")
    monthly = long.withColumn("week_month", month_start(F.col("week_start")))
    return exact_mean(monthly, "metric_value", "metric_value_monthly_avg", group).select(*group, "metric_value_monthly_avg").distinct()


def metric_lags(long: DataFrame) -> DataFrame:
    """Values of the one to four preceding weeks with data. Grain: the input's."""
    series = W.partitionBy(*SERIES).orderBy("week_start")
    names = ("metric_value_pw", "metric_value_p2w", "metric_value_p3w", "metric_value_p4w")
    return long.withColumns({name: F.lag("metric_value", n).over(series) for n, name in enumerate(names, 1)})


def metric_prev_month(lagged: DataFrame) -> DataFrame:
    """Mean of the metric over the previous calendar month, null without one.

    The mean of each row's own month comes first; that of the month before is then a window over the month number, one
    month back. Both are in the partitioning that the lags already use: no monthly table and no join. Grain: the input's.
    """
    month = F.year("week_start") * 12 + F.month("week_start")
    before = W.partitionBy(*SERIES).orderBy("_month").rangeBetween(-1, -1)
    means = exact_mean(lagged.withColumn("_month", month), "metric_value", "_month_mean", [*SERIES, "_month"])
    return means.withColumn("metric_value_last_month_avg", F.max("_month_mean").over(before)).drop("_month", "_month_mean")


def metric_diffs(compared: DataFrame, quirks: Quirks = REPRODUCE) -> DataFrame:
    """Week-over-week and versus-last-month differences and decline flags. Grain: the input's.

    A percentage is null over a zero or missing baseline. The last-month flag tests the percentage (K11);
    corrected, it tests the difference like the weekly flag. Both tests are exact: the weekly difference is of two
    single values, and the mean does not depend on the order of its additions.
    """

    def change(baseline: str) -> Column:
        return safe_ratio(F.col("metric_value"), F.nullif(F.col(baseline), F.lit(0.0))) - 1

    def declined(difference: str) -> Column:
        return F.when(F.col(difference) < 0, 1).otherwise(0)

    month_basis = "metric_lm_avg_diff_pct" if quirks.mixed_decline_basis else "metric_lm_avg_diff"
    return compared.withColumns(
        {
            "metric_wow_diff": F.col("metric_value") - F.col("metric_value_pw"),
            "metric_wow_diff_pct": change("metric_value_pw"),
            "metric_lm_avg_diff": F.col("metric_value") - F.col("metric_value_last_month_avg"),
            "metric_lm_avg_diff_pct": change("metric_value_last_month_avg"),
        }
    ).withColumns(
        {
            "w1_decline_flag": declined("metric_wow_diff"),
            "lm_avg_decline_flag": declined(month_basis),
        }
    )
