"""Weekly conversions of the applicants who applied in the week, by segment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.cohort import (
    activation_week_access,
    activation_week_assignments,
    cohort_assign_l7d,
    cohort_conversion,
    cohort_conversion_rollup,
    in_week,
)
from sluice.operators.segments import (
    device_bucket,
    duplicate_flag,
    membership_flag,
    region_flag,
    region_label,
    risk_bucket,
    shared_contacts,
)
from sluice.operators.joins import left_join_all
from sluice.specs import CohortSpec, Measure, Quirks

SEGMENTS = (
    "week_start",
    "cohort",
    "applied_country_id",
    "applied_country_name",
    "applied_submarket_id",
    "applied_submarket_name",
    "pr_flag",
    "good_or_bad_bucket",
    "good_or_bad_bucket_2",
    "device_type",
    "all_waitlist_flag",
    "phone_duplicate_flag",
)


def measures(zone: str, quirks: Quirks) -> tuple[Measure, ...]:
    """Weekly measures on the published funnel."""
    approve = f"convert_timezone('UTC', '{zone}', idv_approve)" if quirks.approve_converted_twice else "idv_approve"
    return (
        Measure("profile_submit", "profile_submit"),
        Measure("vehicle_submit", "vehicle_type_submit"),
        Measure("idv_submit", "idv_submit"),
        Measure("idv_approve", approve),
        Measure("bgc_submit", "bgc_submit"),
        Measure("account_activation", "account_activation"),
        Measure("first_impression_time", "coalesce(first_impression_time, first_shift_creation)"),
        Measure("first_shift_creation", "coalesce(first_shift_creation, first_shift_check_in)"),
        Measure("first_shift_check_in", "coalesce(first_shift_check_in, first_dash_date)"),
        Measure("has_assignment_creation", "account_activation", "assignment_creation_cnt > 0"),
        Measure("vehicle_type_rendered", "coalesce(vehicle_type_rendered, vehicle_type_submit)"),
        Measure("idv_render", "coalesce(idv_render, idv_submit)"),
        Measure("bgc_form_rendered", "coalesce(bgc_form_rendered, bgc_submit)"),
    )


FUNNEL_COLUMNS = (
    "applicant_id",
    "entity_id",
    "link",
    "first_dash_date",
    "device_type",
    "profile_submit",
    "vehicle_type_rendered",
    "vehicle_type_submit",
    "idv_render",
    "idv_submit",
    "idv_approve",
    "bgc_form_rendered",
    "bgc_submit",
    "account_activation",
    "first_impression_time",
    "first_shift_creation",
    "first_shift_check_in",
)


def segmented_rows(funnel: DataFrame, tables: dict[str, DataFrame], spec: CohortSpec) -> DataFrame:
    """Cohort members with their segment labels and activation-week facts.

    The cohort filter comes first: the inputs of labels, flags and facts are cut to the members before they are
    aggregated. Only shared contacts are counted over all applicants.
    Grain: the funnel's, filtered, times the applicants, labels and flags sharing a key.
    """
    members = cohort_assign_l7d(funnel, spec.start, spec.as_of, quirks=spec.quirks).select(
        "week_start", "week_end", "cohort", *FUNNEL_COLUMNS
    )
    applicants = tables["applicants"]

    def of_members(df: DataFrame, key: str) -> DataFrame:
        return df.join(members.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_semi")

    flagged = of_members(applicants.select("applicant_id", "link"), "applicant_id")
    waitlist = (
        membership_flag(flagged, tables["step_rendered"], "link", spec.memberships)
        .select("applicant_id", "all_waitlist_flag")
        .distinct()
    )
    attributes = duplicate_flag(
        of_members(applicants, "link").select(
            "link",
            F.col("entity_id").alias("applied_entity_id"),
            "phone",
            "applied_date",
            F.col("country_id").alias("applied_country_id"),
            F.col("country_name").alias("applied_country_name"),
            F.col("submarket_id").alias("applied_submarket_id"),
            F.col("submarket_name").alias("applied_submarket_name"),
        ),
        shared_contacts(applicants),
    ).drop("phone", "applied_date")
    risk = risk_bucket(tables["risk_linkage"], "applicant_id", spec.risk_rules)
    # All activations of the members' entities: an entity's facts are summed over its activation weeks (K19).
    activations = of_members(funnel.select("entity_id", "account_activation"), "entity_id")
    access = activation_week_access(tables["access_daily"], activations, quirks=spec.quirks)
    assigned = activation_week_assignments(tables["assignments"], activations, spec.zone, quirks=spec.quirks)

    ids = ("applicant_id", "entity_id", "link")
    joined = left_join_all(members, "link", [attributes], ids)
    joined = left_join_all(joined, "applicant_id", [waitlist, risk], ids)
    joined = left_join_all(joined, "entity_id", [access, assigned], ids)
    submarket = F.col("applied_submarket_id")
    return joined.withColumns(
        {
            "pr_flag": region_flag(submarket, spec.region),
            "good_or_bad_bucket": F.coalesce("good_or_bad_bucket", F.lit("good")),
            "good_or_bad_bucket_2": F.coalesce("good_or_bad_bucket_2", F.lit("good")),
            "device_type": device_bucket(F.col("device_type")),
            # An applicant without a link has no contact either.
            "phone_duplicate_flag": F.coalesce("phone_duplicate_flag", F.lit("Non-Dupe")),
        }
    )


def weekly_conversions(rows: DataFrame, spec: CohortSpec, parts: bool = False) -> DataFrame:
    """Conversions per segment and week. Grain: one row per combination of ``SEGMENTS``."""
    return cohort_conversion(
        rows,
        SEGMENTS,
        "applicant_id",
        "applied_entity_id",
        measures(spec.zone, spec.quirks),
        delivery=F.coalesce(F.col("first_dash_date").between(F.col("week_start"), F.col("week_end")), F.lit(False)),
        activated=in_week(F.col("account_activation")),
        parts=parts,
    )


def rolled_up(conversions: DataFrame, spec: CohortSpec) -> DataFrame:
    """Conversions, with the parts of their means, by the published keys, with country region and acceptance rate."""
    country_region = region_label(
        F.col("applied_country_id"), F.col("applied_country_name"), F.col("applied_submarket_id"), spec.region
    ).alias("country_region")
    return cohort_conversion_rollup(
        conversions.withColumn("country_region", country_region),
        [
            "week_start",
            "applied_country_id",
            "applied_country_name",
            "country_region",
            "cohort",
            "all_waitlist_flag",
            "device_type",
            "good_or_bad_bucket",
            "good_or_bad_bucket_2",
            "applied_submarket_id",
            "applied_submarket_name",
            "phone_duplicate_flag",
        ],
        ["applicants", *[m.name for m in measures(spec.zone, spec.quirks)], "assignment_creation_cnt", "assignment_accepted_cnt", "first_delivery"],
    )


def cohort_report(funnel: DataFrame, tables: dict[str, DataFrame], spec: CohortSpec) -> DataFrame:
    """The published weekly cohort table. ``funnel`` is read three times and should be a written table."""
    return rolled_up(weekly_conversions(segmented_rows(funnel, tables, spec), spec, parts=True), spec)

