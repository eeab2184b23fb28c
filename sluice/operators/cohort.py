"""Weekly cohorts and their conversions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.functions import local_time, safe_ratio, week_start
from sluice.specs import REPRODUCE, Measure, Quirks

# Cohort labels. FIXED VALUES.
APPLIED_IN_WEEK = "1. Applied L7D"
APPLIED_MONTH_BEFORE = "2. Applied 7D-30D"
APPLIED_HALF_YEAR_BEFORE = "3. Applied 30D-180D"
APPLIED_EARLIER = "4. Applied 180D+"
APPLIED_LATER = "Applied After Measurement Period"
UNMAPPED = "Unmapped"
#: The published funnel's folders: the month of the applied date.
APPLIED_MONTH = "applied_month"


def week_sequence(start: date, as_of: date) -> Column:
    """Array of the Mondays between two dates, both included."""
    first = F.when(week_start(F.lit(start)) == F.lit(start), F.lit(start)).otherwise(
        F.date_add(week_start(F.lit(start)), 7)
    )
    last = week_start(F.lit(as_of))
    weeks = F.sequence(first, last, F.expr("interval 7 days"))
    return F.when(first <= last, weeks).otherwise(F.array().cast("array<date>"))


def week_spine(calendar: DataFrame, day: str, start: date, as_of: date) -> DataFrame:
    """ISO weeks of a calendar that start between two dates, as Monday and Sunday. Grain: one row per week."""
    weeks = calendar.select(week_start(F.col(day)).alias("week_start"))
    weeks = weeks.filter(F.col("week_start").between(F.lit(start), F.lit(as_of))).distinct()
    return weeks.select("week_start", F.date_add("week_start", 6).alias("week_end"))


def _not_converted(week: Column, converted: Column) -> Column:
    return converted.isNull() | (converted >= week)


def cohort_label(week: Column, applied: Column, converted: Column) -> Column:
    """Cohort of an applicant in the week starting on ``week``.

    ``applied`` may be a timestamp; it is then compared with the week's last day at midnight (K14).
    """
    age_classes = (
        F.when(applied.between(week, F.date_add(week, 6)), APPLIED_IN_WEEK)
        .when(applied.between(F.date_sub(week, 30), F.date_sub(week, 1)), APPLIED_MONTH_BEFORE)
        .when(applied.between(F.date_sub(week, 180), F.date_sub(week, 31)), APPLIED_HALF_YEAR_BEFORE)
        .when(applied < F.date_sub(week, 180), APPLIED_EARLIER)
        .when(applied > F.date_add(week, 6), APPLIED_LATER)
        .otherwise(UNMAPPED)
    )
    return F.when(_not_converted(week, converted), age_classes).otherwise(UNMAPPED)


def _first_monday(day: Column) -> Column:
    """The first Monday on or after a day."""
    return week_start(F.date_add(day, 6))


def cohort_changes(
    funnel: DataFrame,
    start: date,
    as_of: date,
    applied: str = "applied_date",
    converted: str = "first_dash_date",
    entity: str = "applicant_id",
) -> DataFrame:
    """By how much the applicants of each cohort change in each week.

    An applicant's cohort depends on the applied and the conversion time only, and over the weeks it changes a few
    times: from "later" to "in week", and so on, until the conversion. Applicants are counted per combination of both
    times, and each combination gives a change for the first week of a cohort and one for the week after its last:
    at most ten rows, however many weeks are asked for. An applied time inside a day is on the same side of every
    midnight as the end of that day, so a class ends a day earlier for it, and the day between two classes is in none.
    Grain: week and cohort with a change. ``pairs`` counts combinations, ``applicants`` those with an id.
    """
    day = F.col(applied).cast("date")
    counts = (
        funnel.select(entity, day.alias("_day"), (F.col(applied) > day).alias("_later"), F.col(converted))
        .distinct()
        .groupBy("_day", "_later", converted)
        .agg(F.count(entity).alias("applicants"))
    )
    mondays = week_sequence(start, as_of)
    first, behind = F.try_element_at(mondays, F.lit(1)), F.date_add(F.try_element_at(mondays, F.lit(-1)), 7)
    late = F.when(F.col("_later"), 1).otherwise(0)

    def after(days: int, inside: bool = False) -> Column:
        return F.date_add(F.col("_day"), (F.lit(days) + late).cast("int") if inside else F.lit(days))

    # The days on which a week may start, first and last, for each class. None: without an end on that side.
    spans = {
        APPLIED_LATER: (None, after(-7, True)),
        APPLIED_IN_WEEK: (after(-6, True), after(0)),
        APPLIED_MONTH_BEFORE: (after(1, True), after(30)),
        APPLIED_HALF_YEAR_BEFORE: (after(31, True), after(180)),
        APPLIED_EARLIER: (after(181), None),
    }
    until = F.col(converted).cast("date")

    def change(week: Column, cohort: str, sign: int) -> Column:
        return F.struct(
            week.alias("week_start"), F.lit(cohort).alias("cohort"), (F.col("applicants") * sign).alias("applicants"), F.lit(sign).cast("bigint").alias("pairs")
        )

    changes = []
    for cohort, (low, high) in spans.items():
        opens = first if low is None else F.greatest(_first_monday(low), first)
        # ``least`` ignores nulls: without a conversion, and without an end, a class lasts to the last week.
        ends = [F.date_add(d, 1) for d in (high, until) if d is not None]
        closes = F.least(*[_first_monday(d) for d in ends], behind)
        there = first.isNotNull() & F.col("_day").isNotNull() & (opens < closes)
        changes.append(F.when(there, F.array(change(opens, cohort, 1), change(closes, cohort, -1))).otherwise(F.array()))
    all_weeks = F.when(first.isNotNull(), F.array(change(first, UNMAPPED, 1))).otherwise(F.array())
    listed = counts.select("applicants", F.concat(*changes, all_weeks).alias("_changes"))
    moved = listed.select(F.inline("_changes")).groupBy("week_start", "cohort").agg(F.sum("applicants").alias("applicants"), F.sum("pairs").alias("pairs"))
    # Whoever comes into a cohort leaves those without one.
    other = F.struct(F.col("week_start"), F.lit(UNMAPPED).alias("cohort"), (-F.col("applicants")).alias("applicants"), (-F.col("pairs")).alias("pairs"))
    own = F.struct("week_start", "cohort", "applicants", "pairs")
    both = moved.select(F.inline(F.when(F.col("cohort") == UNMAPPED, F.array(own)).otherwise(F.array(own, other))))
    return both.groupBy("week_start", "cohort").agg(F.sum("applicants").alias("applicants"), F.sum("pairs").alias("pairs"))


def cohort_assign_all(
    funnel: DataFrame,
    start: date,
    as_of: date,
    applied: str = "applied_date",
    converted: str = "first_dash_date",
    entity: str = "applicant_id",
) -> DataFrame:
    """Applicants per week and cohort, for every week and every cohort.

    A sweep: the changes of ``cohort_changes`` are summed up over the weeks. What meets the weeks are the six cohorts,
    not the applicants or their dates. Grain: one row per week and cohort that has members.
    """
    changes = cohort_changes(funnel, start, as_of, applied, converted, entity)
    # From each change to the next one of the cohort its numbers stand; the last change stands to the last week.
    series = W.partitionBy("cohort").orderBy("week_start")
    so_far = series.rowsBetween(W.unboundedPreceding, W.currentRow)
    last = F.try_element_at(week_sequence(start, as_of), F.lit(-1))
    states = changes.select(
        "cohort", "week_start", F.lead("week_start").over(series).alias("_next"),
        F.sum("applicants").over(so_far).alias("applicants"), F.sum("pairs").over(so_far).alias("_pairs"),
    )
    stands = F.least(F.date_sub("_next", 7), last)
    weeks = F.sequence(F.col("week_start"), stands, F.expr("interval 7 days"))
    present = states.filter((F.col("_pairs") > 0) & (F.col("week_start") <= stands))
    return present.select(F.explode(weeks).alias("week_start"), "cohort", "applicants")


def cohort_events(
    funnel: DataFrame,
    measures: Sequence[Measure],
    start: date,
    as_of: date,
    applied: str = "applied_date",
    converted: str = "first_dash_date",
    entity: str = "applicant_id",
) -> DataFrame:
    """The weeks in which each applicant reaches a measure, with the cohort that the applicant is in then.

    A measure's time lies in one week, so the week is computed from it and never looked up: as many rows as times.
    Grain: funnel row and measure with a time in a measured week.
    """
    applied_at, converted_on = F.col(applied), F.col(converted)
    cells = [
        F.struct(F.lit(m.name).alias("measure"), week_start(F.expr(m.value)).alias("week_start"), (F.expr(m.extra) if m.extra else F.lit(True)).alias("_counts"))
        for m in measures
    ]
    times = funnel.select(entity, applied_at.alias("_applied"), converted_on.alias("_converted"), F.inline(F.array(*cells)))
    measured = times.filter(F.col("week_start").between(F.lit(start), F.lit(as_of)) & F.col("_counts") & F.col(entity).isNotNull())
    label = cohort_label(F.col("week_start"), F.col("_applied"), F.col("_converted"))
    return measured.select("week_start", label.alias("cohort"), "measure", entity)


def cohort_conversion_all(
    funnel: DataFrame,
    measures: Sequence[Measure],
    start: date,
    as_of: date,
    applied: str = "applied_date",
    converted: str = "first_dash_date",
    entity: str = "applicant_id",
) -> DataFrame:
    """Applicants of every week and cohort, and how many of them reached each measure in that week.

    The members come from the sweep of ``cohort_assign_all``, the conversions from ``cohort_events``: distinct
    applicants are counted in two levels, one row per applicant and measure first. No row meets a week it has no
    event in. Grain: one row per week and cohort that has members.
    """
    members = cohort_assign_all(funnel, start, as_of, applied, converted, entity)
    events = cohort_events(funnel, measures, start, as_of, applied, converted, entity)
    reached = events.distinct().groupBy("week_start", "cohort").agg(
        *[F.count(F.when(F.col("measure") == m.name, F.lit(1))).alias(m.name) for m in measures]
    )
    joined = members.join(reached, ["week_start", "cohort"], "left")
    return joined.select("week_start", "cohort", "applicants", *[F.coalesce(m.name, F.lit(0).cast("bigint")).alias(m.name) for m in measures])


def cohort_assign_l7d(
    funnel: DataFrame,
    start: date,
    as_of: date,
    applied: str = "applied_date",
    converted: str = "first_dash_date",
    quirks: Quirks = REPRODUCE,
) -> DataFrame:
    """Funnel rows with the week they applied in, unless converted before that week.

    An applicant applies in exactly one week, so the week is computed from the applied time instead of
    meeting every week of the calendar: no join and no shuffle. Of a funnel laid out by applied month only the months that
    the weeks touch are read. Grain: the funnel's, filtered.
    """
    if APPLIED_MONTH in funnel.columns:
        months = (F.trunc(F.lit(start), "month"), F.trunc(F.date_add(F.lit(as_of), 6), "month"))
        funnel = funnel.filter(F.col(APPLIED_MONTH).between(*months)).drop(APPLIED_MONTH)
    week = week_start(F.col(applied))
    at = F.col(applied) if quirks.applied_keeps_time else F.col(applied).cast("date")
    weekly = funnel.withColumns({"week_start": week, "week_end": F.date_add(week, 6), "cohort": F.lit(APPLIED_IN_WEEK)})
    return weekly.filter(
        F.col("week_start").between(F.lit(start), F.lit(as_of))
        & (at <= F.col("week_end"))
        & _not_converted(F.col("week_start"), F.col(converted))
    )


def _activation_weeks(funnel: DataFrame, entity: str, activation: str, quirks: Quirks) -> DataFrame:
    """Entity and activation week, with the number of funnel rows behind it (K19)."""
    weeks = funnel.filter(F.col(entity).isNotNull() & F.col(activation).isNotNull()).select(
        entity, week_start(F.col(activation)).alias("_week")
    )
    if quirks.facts_count_per_row:
        return weeks.groupBy(entity, "_week").agg(F.count(F.lit(1)).alias("_rows"))
    return weeks.groupBy(entity).agg(F.min("_week").alias("_week"), F.lit(1).cast("bigint").alias("_rows"))


def activation_week_access(
    access: DataFrame,
    funnel: DataFrame,
    entity: str = "entity_id",
    activation: str = "account_activation",
    quirks: Quirks = REPRODUCE,
) -> DataFrame:
    """Impressions, flagged impressions and their ratio in the entity's activation week.

    The join on entity and week comes first: of years of facts it leaves about one week for the aggregate, whose rows
    are combined before they are shuffled by entity. A hot entity's facts come straight from a shuffle to the join, so
    AQE can split them. Grain: one row per entity with facts in that week.
    """
    facts = access.filter(F.col(entity).isNotNull()).select(entity, week_start(F.col("active_date")).alias("_week"), "is_dash_now")
    joined = facts.join(_activation_weeks(funnel, entity, activation, quirks), [entity, "_week"])
    totals = joined.groupBy(entity).agg(
        F.sum("_rows").alias("n_impressions"),
        F.sum(F.col("is_dash_now") * F.col("_rows")).alias("n_dash_now_impressions"),
    )
    return totals.withColumn(
        "dash_now_impression_rate", safe_ratio(F.col("n_dash_now_impressions"), F.col("n_impressions"))
    )


def activation_week_assignments(
    assignments: DataFrame,
    funnel: DataFrame,
    zone: str | None,
    entity: str = "entity_id",
    activation: str = "account_activation",
    quirks: Quirks = REPRODUCE,
) -> DataFrame:
    """Assignments created in the entity's activation week and the share accepted and kept.

    Grain: one row per entity with assignments in that week.
    """
    accepted = F.col("accepted_at").isNotNull() & F.col("unassigned_at").isNull()
    created = week_start(local_time(F.col("created_at"), zone)).alias("_week")
    facts = assignments.filter(F.col(entity).isNotNull() & F.col("created_at").isNotNull()).select(entity, created, accepted.alias("_kept"))
    joined = facts.join(_activation_weeks(funnel, entity, activation, quirks), [entity, "_week"])
    totals = joined.groupBy(entity).agg(
        F.sum("_rows").alias("assignment_creation_cnt"),
        F.sum(F.when(F.col("_kept"), F.col("_rows")).otherwise(0)).alias("_accepted"),
    )
    rate = safe_ratio(F.col("_accepted"), F.col("assignment_creation_cnt"))
    return totals.select(entity, "assignment_creation_cnt", rate.alias("acceptance_rate"))


def in_week(value: Column) -> Column:
    """The value's date lies in the row's week."""
    return value.cast("date").between(F.col("week_start"), F.col("week_end"))


def cohort_conversion(
    rows: DataFrame,
    segments: Sequence[str],
    applicant: str,
    entity: str,
    measures: Sequence[Measure],
    delivery: Column,
    activated: Column,
    parts: bool = False,
) -> DataFrame:
    """Distinct converting applicants per segment and week, with the additive activation-week facts.

    Two levels: one row per segment and id, where a measure is 0 or 1, then sums. A hot segment is
    pre-aggregated on the map side and no row is multiplied by the number of distinct counts. First
    deliveries count entities instead of applicants (K18): a delivered row adds a second row under its
    entity id, which carries that measure alone. Facts are summed per row (K19). With ``parts`` the mean rate comes
    with its sum and number of rows, for ``cohort_conversion_rollup``.
    Grain: one row per combination of ``segments``.
    """
    flags = {m.name: in_week(F.expr(m.value)) & (F.expr(m.extra) if m.extra else F.lit(True)) for m in measures}
    facts = {
        "_assigned": F.when(activated, F.col("assignment_creation_cnt")),
        "_accepted": F.when(activated, F.col("assignment_creation_cnt") * F.col("acceptance_rate")),
        "_rate": F.when(activated, F.col("dash_now_impression_rate")),
    }
    text = {"applicant": F.col(applicant).cast("string"), "entity": F.col(entity).cast("string")}
    as_applicant = F.struct(F.lit(False).alias("delivered"), text["applicant"].alias("id"))
    as_entity = F.struct(F.lit(True).alias("delivered"), text["entity"].alias("id"))
    counted = rows.select(
        *segments,
        F.explode(F.when(delivery, F.array(as_applicant, as_entity)).otherwise(F.array(as_applicant))).alias("_as"),
        *[F.when(flag, F.lit(1)).otherwise(F.lit(0)).alias(name) for name, flag in flags.items()],
        *[value.alias(name) for name, value in facts.items()],
    )
    by_id = counted.groupBy(*segments, "_as.delivered", "_as.id").agg(
        *[F.max(name).alias(name) for name in flags],
        F.sum("_assigned").alias("_assigned"),
        F.sum("_accepted").alias("_accepted"),
        F.sum("_rate").alias("_rate"),
        F.count("_rate").alias("_rates"),
    )
    an_applicant = ~F.col("delivered") & F.col("id").isNotNull()
    once = ~F.col("delivered")
    return by_id.groupBy(*segments).agg(
        F.count(F.when(an_applicant, F.lit(1))).alias("applicants"),
        *[F.sum(F.when(an_applicant, F.col(name)).otherwise(F.lit(0))).alias(name) for name in flags],
        F.sum(F.when(once, F.col("_assigned"))).alias("assignment_creation_cnt"),
        F.sum(F.when(once, F.col("_accepted"))).alias("assignment_accepted_cnt"),
        F.try_divide(F.sum(F.when(once, F.col("_rate"))), F.sum(F.when(once, F.col("_rates")))).alias(
            "dash_now_access_rate"
        ),
        F.count(F.when(F.col("delivered") & F.col("id").isNotNull(), F.lit(1))).alias("first_delivery"),
        *([F.sum(F.when(once, F.col("_rate"))).alias(RATE_SUM), F.sum(F.when(once, F.col("_rates"))).alias(RATE_ROWS)] if parts else []),
    )


RATE_SUM, RATE_ROWS = "dash_now_access_rate_sum", "dash_now_access_rate_rows"


def cohort_conversion_rollup(conversions: DataFrame, keys: Sequence[str | Column], measures: Sequence[str]) -> DataFrame:
    """Conversions by ``keys``: the sums of ``measures``, the acceptance rate and the mean access rate.

    The keys may be coarser than the segments of ``cohort_conversion``, which has to keep its ``parts``: the mean is taken
    over the rows behind it, not over segments. Grain: one row per combination of ``keys``.
    """
    sums = conversions.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in [*measures, RATE_SUM, RATE_ROWS]])
    rates = {
        "dash_now_access_rate": F.try_divide(F.col(RATE_SUM), F.col(RATE_ROWS)),
        "acceptance_rate": safe_ratio(F.col("assignment_accepted_cnt"), F.col("assignment_creation_cnt")),
    }
    return sums.withColumns(rates).drop(RATE_SUM, RATE_ROWS)
