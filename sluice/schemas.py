"""The declared schemas of the four published tables, and the layouts that later jobs prune by."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from sluice.operators.cohort import APPLIED_MONTH
from sluice.plans import applicant_funnel, variance_report
from sluice.plans.verification_funnel import EVENT_TYPES
from sluice.sources.storage import Layout

TIME = "timestamp_ntz"
TYPES = {
    TIME: T.TimestampNTZType(), "date": T.DateType(), "string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(),
    "int": T.IntegerType(),
}


def _schema(kinds: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in kinds.items()])


def _kinds(names: Sequence[str], default: str, **others: str) -> dict[str, str]:
    return {name: others.get(name, default) for name in names}


#: The applicant funnel: applicants, first times of all steps, raw values and the provenance flag.
FUNNEL = _schema(
    _kinds(
        ("last_updated_at", *applicant_funnel.PUBLISHED), TIME,
        applicant_id="bigint", entity_id="string", link="string", busy_impression_freq="bigint", total_impression_freq="bigint",
        first_impression_busyness="string", first_dash_date="date", device_type="string", app_version="string",
        applied_date_raw="date", backfilled="int",
    )
)

#: Weekly conversions by segment.
CONVERSIONS = _schema(
    {
        "week_start": "date", "applied_country_id": "int", "applied_country_name": "string", "country_region": "string", "cohort": "string",
        "all_waitlist_flag": "string", "device_type": "string", "good_or_bad_bucket": "string", "good_or_bad_bucket_2": "string",
        "applied_submarket_id": "int", "applied_submarket_name": "string", "phone_duplicate_flag": "string",
        **_kinds(
            (
                "applicants", "profile_submit", "vehicle_submit", "idv_submit", "idv_approve", "bgc_submit", "account_activation",
                "first_impression_time", "first_shift_creation", "first_shift_check_in", "has_assignment_creation",
                "vehicle_type_rendered", "idv_render", "bgc_form_rendered", "assignment_creation_cnt", "assignment_accepted_cnt",
                "first_delivery",
            ),
            "bigint", assignment_accepted_cnt="double",
        ),
        "dash_now_access_rate": "double", "acceptance_rate": "double",
    }
)

#: Variances of the weekly metrics, with the verdicts.
VARIANCES = _schema(
    _kinds(
        variance_report.PUBLISHED, "double",
        week_start="date", metric_number="string", metric_name="string", w1_decline_flag="int", lm_avg_decline_flag="int",
        streak_group="bigint", consecutive_decline_weeks="int", week_index="int",
        **{name: "string" for name in variance_report.PUBLISHED if name[0] == "c" and name[1].isdigit()},
    )
)

#: The identity-verification sub-funnel.
VERIFICATION = _schema(
    _kinds(
        ("applicant_id", "entity_id", "link", "applied_date", "first_dash_date", "device_type", "app_version", *EVENT_TYPES), TIME,
        applicant_id="bigint", entity_id="string", link="string", applied_date="date", first_dash_date="date", device_type="string",
        app_version="string",
    )
)

#: The cohort report reads the months that its weeks touch, the variance report the completed weeks.
BY_APPLIED_MONTH = Layout(APPLIED_MONTH, "cast(trunc(cast(applied_date as date), 'month') as date)")
BY_WEEK = Layout("week_start")
