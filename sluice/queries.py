"""Every operator as a query over the driver's tables: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import schemas
from sluice.functions import week_start
from sluice.operators import backfill, cohort, impressions, metrics, segments, touch, variance
from sluice.operators.joins import left_join_all
from sluice.plans import applicant_funnel as funnel_plan
from sluice.plans import cohort_report as cohort_plan
from sluice.plans import variance_report as variance_plan
from sluice.plans.driver_setup import (
    AS_OF,
    COHORT,
    COHORT_START,
    FUNNEL,
    FUNNEL_DEFAULT_BOUNDS,
    MEMBERSHIPS,
    METRICS,
    ORDERS_AS_OF,
    REGION,
    RISK_RULES,
    START,
    VERIFICATION,
    ZONE,
)
from sluice.plans.order_lifecycle import order_lifecycle
from sluice.plans.verification_funnel import verification_funnel
from sluice.plans.waitlist_report import waitlist_report
from sluice.sources.driver_tables import SCHEMAS, Tables, derived, driver_table
from sluice.sources.holidays import holidays
from sluice.sources.storage import publish, session_staging
from sluice.specs import Measure, Step
from sluice.streaming import first_touch as stream_touch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DIGITS = 9


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def comparable(df: DataFrame) -> DataFrame:
    """Doubles rounded, and zero without a sign, so that the order of additions does not show."""

    def tidy(name: str):
        rounded = F.round(F.col(name), DIGITS)
        return F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)

    return df.withColumns({name: tidy(name) for name, kind in df.dtypes if kind == "double"})


# A. Event to entity timestamps


def _page_steps() -> list[Step]:
    return [
        Step("vehicle_type_rendered", f"page_id = '{FUNNEL.vehicle_page}'"),
        Step("idv_render", f"page_id = '{FUNNEL.identity_page}'"),
        Step("bgc_form_rendered", f"page_id = '{FUNNEL.check_page}'"),
    ]


@query
def first_touch(spark, folder):
    return touch.first_touch(derived(spark, folder, "step_rendered"), "link", _page_steps(), zone=ZONE)


def _streamed(spark, folder) -> Tables:
    """The derived tables over the events as a stream of files."""
    tables = Tables(spark, folder)
    # A pattern, because a stream's path has to be a folder or a pattern.
    tables["events"] = spark.readStream.schema(SCHEMAS["events"]).option("maxFilesPerTrigger", 4).parquet(f"{folder}/event[s].parquet")
    return tables


@query
def first_touch_stream(spark, folder):
    """The first touches of ``first_touch``, kept by a stream."""
    events = _streamed(spark, folder)["step_rendered"]
    return stream_touch.first_touch_stream([(events, "link", _page_steps(), "ts")], "link", session_staging(spark).path, ZONE)


@query
def step_touches_stream(spark, folder):
    """All steps of all sources of the funnel, kept by one stream."""
    sources = list(funnel_plan.step_sources(_streamed(spark, folder), FUNNEL).values())
    return stream_touch.first_touch_stream(sources, "link", session_staging(spark).path, ZONE)


@query
def step_touches(spark, folder):
    return funnel_plan.step_touches(Tables(spark, folder), FUNNEL)


@query
def first_touch_coalesced_id(spark, folder):
    steps = [Step(name, f"name = '{value}'") for name, value in FUNNEL.idv_names.items() if name != "idv_start"]
    events = touch.resolve_identity(derived(spark, folder, "idv_steps"), funnel_plan.IDV_IDS, "any_id")
    return touch.first_touch(events, "any_id", steps, zone=ZONE)


@query
def first_touch_multi(spark, folder):
    columns = {"first_shift_creation": "created_at", "first_shift_check_in": "check_in_time"}
    return touch.first_touch_multi(derived(spark, folder, "shifts"), "entity_id", columns, ZONE)


def _statuses(spark, folder):
    inquiries = derived(spark, folder, "idv_inquiry").filter(F.col("template_id").isin(*FUNNEL.templates))
    return touch.status_summary(inquiries, "reference_id", zone=ZONE)


@query
def status_summary(spark, folder):
    return _statuses(spark, folder)


@query
def latest_status_gate(spark, folder):
    spine = derived(spark, folder, "applicants").select("applicant_id", "link")
    approved = touch.latest_status_gate(_statuses(spark, folder), "reference_id", "idv_approve")
    approved = approved.withColumnRenamed("reference_id", "link")
    return left_join_all(spine, "link", [approved], spine.columns)


def _device_ends(spark, folder):
    where = f"page_id = '{FUNNEL.vehicle_page}' and os_name is not null"
    return touch.first_last_attribute(
        derived(spark, folder, "step_submitted"), "link", ["os_name", "app_version"], where=where
    )


@query
def first_last_attribute(spark, folder):
    return _device_ends(spark, folder)


@query
def attribute_reconcile(spark, folder):
    return touch.attribute_reconcile(_device_ends(spark, folder), "link")


@query
def gated_impressions(spark, folder):
    tables = Tables(spark, folder)
    events = funnel_plan.impression_sources(tables, FUNNEL)
    return impressions.gated_impressions(events, tables["applicants"], zone=ZONE)


@query
def impression_rollup(spark, folder):
    return funnel_plan.impressions(Tables(spark, folder), FUNNEL)


@query
def wide_funnel(spark, folder):
    return funnel_plan.all_steps(Tables(spark, folder), FUNNEL)


@query
def event_type_pivot_funnel(spark, folder):
    return verification_funnel(Tables(spark, folder), VERIFICATION)


# B. Imputation


def _staged_funnel(spark, folder):
    return session_staging(spark)(funnel_plan.all_steps(Tables(spark, folder), FUNNEL))


@query
def step_lag_samples(spark, folder):
    wide = funnel_plan.all_steps(Tables(spark, folder), FUNNEL)
    return backfill.step_lag_samples(
        wide, funnel_plan.lags(FUNNEL), ["applicant_id"], "applied_date", FUNNEL.samples_from
    )


@query
def step_lag_samples_default(spark, folder):
    """Samples within the default bounds of the monitored process."""
    wide = funnel_plan.all_steps(Tables(spark, folder), FUNNEL_DEFAULT_BOUNDS)
    return backfill.step_lag_samples(
        wide, funnel_plan.lags(FUNNEL_DEFAULT_BOUNDS), ["applicant_id"], "applied_date", FUNNEL_DEFAULT_BOUNDS.samples_from
    )


@query
def step_lag_means(spark, folder):
    wide = funnel_plan.all_steps(Tables(spark, folder), FUNNEL)
    return comparable(
        backfill.step_lag_means(wide, funnel_plan.lags(FUNNEL), "applied_date", FUNNEL.samples_from)
    )


@query
def backfill_chain(spark, folder):
    filled = funnel_plan.backfilled_funnel(_staged_funnel(spark, folder), FUNNEL)
    return filled.select("applicant_id", "first_dash_date", *funnel_plan.STEPS)


@query
def backfill_flag(spark, folder):
    filled = funnel_plan.backfilled_funnel(_staged_funnel(spark, folder), FUNNEL)
    return filled.select("applicant_id", *[f"{s}_raw" for s in funnel_plan.STEPS], "backfilled")


@query
def funnel_publish(spark, folder):
    return funnel_plan.applicant_funnel(Tables(spark, folder), FUNNEL, session_staging(spark))


@query
def order_lifecycle_funnel(spark, folder):
    tables = Tables(spark, folder)
    return order_lifecycle(tables["orders"], tables["lineitem"], session_staging(spark))


# C. Segmentation


@query
def membership_sets(spark, folder):
    return segments.membership_sets(derived(spark, folder, "step_rendered"), "link", MEMBERSHIPS)


@query
def membership_flag(spark, folder):
    spine = derived(spark, folder, "applicants").select("applicant_id", "link")
    flagged = segments.membership_flag(spine, derived(spark, folder, "step_rendered"), "link", MEMBERSHIPS)
    return flagged.select("applicant_id", "all_waitlist_flag").distinct()


@query
def daily_membership_counts(spark, folder):
    applicants, rendered = derived(spark, folder, "applicants"), derived(spark, folder, "step_rendered")
    return waitlist_report(applicants, rendered, MEMBERSHIPS, START.replace(day=5), AS_OF)


@query
def risk_bucket(spark, folder):
    return segments.risk_bucket(derived(spark, folder, "risk_linkage"), "applicant_id", RISK_RULES)


@query
def shared_contacts(spark, folder):
    return segments.shared_contacts(derived(spark, folder, "applicants"))


@query
def duplicate_flag(spark, folder):
    applicants = derived(spark, folder, "applicants").select("applicant_id", "phone", "applied_date")
    return segments.duplicate_flag(applicants, segments.shared_contacts(applicants))


@query
def region_label(spark, folder):
    submarket = F.col("submarket_id")
    return derived(spark, folder, "applicants").select(
        "applicant_id",
        segments.region_flag(submarket, REGION).alias("pr_flag"),
        segments.region_label(F.col("country_id"), F.col("country_name"), submarket, REGION).alias("country_region"),
    )


@query
def device_bucket(spark, folder):
    devices = touch.attribute_reconcile(_device_ends(spark, folder), "link")
    return devices.select("link", "device_type", segments.device_bucket(F.col("device_type")).alias("device_bucket"))


# D. Weekly cohort conversion


def _published_funnel(spark, folder):
    staging = session_staging(spark)
    funnel = funnel_plan.applicant_funnel(Tables(spark, folder), FUNNEL, staging)
    return publish(funnel, f"{staging.path}/funnel", schemas.FUNNEL, schemas.BY_APPLIED_MONTH)


@query
def week_spine(spark, folder):
    orders = driver_table(spark, folder, "orders")
    return cohort.week_spine(orders, "o_orderdate", START.replace(year=1996), START.replace(year=2000))


@query
def cohort_assign_all(spark, folder):
    return cohort.cohort_assign_all(_published_funnel(spark, folder), COHORT_START, AS_OF)


@query
def cohort_conversion_all(spark, folder):
    """Every cohort's conversions in every week, not only of those who applied in it."""
    reached = [m for m in cohort_plan.measures(ZONE, COHORT.quirks) if m.extra is None]
    return cohort.cohort_conversion_all(
        _published_funnel(spark, folder), [*reached, Measure("first_dash", "first_dash_date")], COHORT_START, AS_OF
    )


@query
def cohort_assign_l7d(spark, folder):
    members = cohort.cohort_assign_l7d(_published_funnel(spark, folder), COHORT_START, AS_OF)
    return members.select("week_start", "week_end", "cohort", "applicant_id", "applied_date", "first_dash_date")


@query
def activation_week_access(spark, folder):
    access = derived(spark, folder, "access_daily")
    return comparable(cohort.activation_week_access(access, _published_funnel(spark, folder)))


@query
def activation_week_assignments(spark, folder):
    assignments = derived(spark, folder, "assignments")
    return comparable(cohort.activation_week_assignments(assignments, _published_funnel(spark, folder), ZONE))


def _weekly(spark, folder):
    rows = cohort_plan.segmented_rows(_published_funnel(spark, folder), Tables(spark, folder), COHORT)
    return cohort_plan.weekly_conversions(rows, COHORT)


def _rolled_up(spark, folder):
    return cohort_plan.cohort_report(_published_funnel(spark, folder), Tables(spark, folder), COHORT)


@query
def cohort_conversion(spark, folder):
    return comparable(_weekly(spark, folder))


@query
def cohort_conversion_rollup(spark, folder):
    return comparable(_rolled_up(spark, folder))


# E. Variance monitoring


def _orders_base(spark, folder):
    conversions = derived(spark, folder, "order_conversions")
    return metrics.metric_base(conversions, ORDERS_AS_OF, F.col("all_waitlist_flag") == "No Waitlist")


def _lagged(spark, folder):
    return metrics.metric_lags(metrics.metric_long(_orders_base(spark, folder)))


def _streaks(spark, folder):
    return variance.decline_streaks(metrics.metric_diffs(metrics.metric_prev_month(_lagged(spark, folder))))


SERIES_KEYS = ("cohort", "week_start", "metric_number", "metric_name", "metric_value")


@query
def metric_base(spark, folder):
    return comparable(_orders_base(spark, folder))


@query
def metric_long(spark, folder):
    return comparable(metrics.metric_long(_orders_base(spark, folder)))


@query
def metric_monthly_avg(spark, folder):
    return comparable(metrics.metric_monthly_avg(metrics.metric_long(_orders_base(spark, folder))))


@query
def metric_lags(spark, folder):
    return comparable(_lagged(spark, folder))


@query
def metric_prev_month(spark, folder):
    return comparable(
        metrics.metric_prev_month(_lagged(spark, folder)).select(*SERIES_KEYS, "metric_value_last_month_avg")
    )


@query
def metric_diffs(spark, folder):
    diffs = metrics.metric_diffs(metrics.metric_prev_month(_lagged(spark, folder)))
    return comparable(diffs.drop("metric_value_p2w", "metric_value_p3w", "metric_value_p4w"))


@query
def decline_streaks(spark, folder):
    return comparable(
        _streaks(spark, folder).select(
            *SERIES_KEYS, "w1_decline_flag", "streak_group", "consecutive_decline_weeks", "week_index"
        )
    )


@query
def streak_start_value(spark, folder):
    started = variance.streak_start_value(_streaks(spark, folder))
    return comparable(started.select(*SERIES_KEYS, "consecutive_decline_weeks", "metric_value_at_streak_start"))


@query
def accumulated_decline(spark, folder):
    declined = variance_plan.declines(metrics.metric_long(_orders_base(spark, folder)))
    return comparable(declined.select(*SERIES_KEYS, "accumulated_decline", "accumulated_decline_pct"))


def _impacts(spark, folder):
    return variance_plan.impacts(_orders_base(spark, folder), metrics=METRICS)


IMPACT_KEYS = ("week_start", "metric_number", "metric_name")


@query
def impact_translation(spark, folder):
    columns = ("impact_wow_diff", "impact_acc_diff", "impact_lm_avg_diff")
    return comparable(_impacts(spark, folder).select(*IMPACT_KEYS, *columns))


@query
def variance_thresholds(spark, folder):
    columns = ("metric_variance_threshold_abs", "metric_variance_threshold_rel")
    return comparable(_impacts(spark, folder).select(*IMPACT_KEYS, *columns))


@query
def cumulative_impact(spark, folder):
    columns = ("streak_group", "acc_impact", "acc_cvr_impact_abs", "acc_cvr_impact_rel")
    return comparable(_impacts(spark, folder).select(*IMPACT_KEYS, *columns))


@query
def guardrails(spark, folder):
    judged = variance.guardrails(_impacts(spark, folder), METRICS)
    return judged.select(*IMPACT_KEYS, *[c for c in judged.columns if c[0] == "c" and c[1].isdigit()])


@query
def holiday_weeks(spark, folder):
    events = driver_table(spark, folder, "events")
    weekly = events.groupBy(week_start(F.col("ts")).alias("week_start")).agg(F.count(F.lit(1)).alias("events"))
    return variance.holiday_weeks(weekly, holidays(spark))


@query
def variance_report(spark, folder):
    conversions = derived(spark, folder, "order_conversions")
    return comparable(
        variance_plan.variance_report(
            conversions, ORDERS_AS_OF, F.col("all_waitlist_flag") == "No Waitlist", metrics=METRICS
        )
    )


@query
def cohort_variance_report(spark, folder):
    """The three published tables in a row: funnel, weekly conversions, variances."""
    conversions = _rolled_up(spark, folder)
    return comparable(
        variance_plan.variance_report(
            conversions, AS_OF, F.col("all_waitlist_flag") == "No Waitlist", metrics=METRICS
        )
    )


# The published tables, written with their declared schemas and read back


def _published(df: DataFrame, name: str, schema, layout=None) -> DataFrame:
    return publish(df, f"{session_staging(df.sparkSession).path}/{name}", schema, layout).select(*schema.names)


@query
def published_funnel(spark, folder):
    return _published(funnel_publish(spark, folder), "funnel", schemas.FUNNEL, schemas.BY_APPLIED_MONTH)


@query
def published_conversions(spark, folder):
    return comparable(_published(_rolled_up(spark, folder), "conversions", schemas.CONVERSIONS, schemas.BY_WEEK))


@query
def published_variances(spark, folder):
    return _published(variance_report(spark, folder), "variances", schemas.VARIANCES, schemas.BY_WEEK)


@query
def published_verification(spark, folder):
    return _published(event_type_pivot_funnel(spark, folder), "verification", schemas.VERIFICATION)
