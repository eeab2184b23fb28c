"""Parameters that fit the tables derived from the driver's data."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from sluice.operators.metrics import METRICS as MONITORED
from sluice.plans.verification_funnel import STEPS as VERIFICATION_STEPS
from sluice.specs import CohortSpec, FunnelSpec, RegionRule, Rule, SubFunnelSpec

ZONE = "America/Los_Angeles"
START = date(2024, 1, 1)
AS_OF = date(2024, 1, 31)
# The cohort weeks begin in the month before, so that the weeks of January have a baseline.
COHORT_START = date(2023, 12, 4)
# Last day the moved order weeks are monitored on; the weeks from here on count as not completed.
ORDERS_AS_OF = date(2029, 6, 20)

# An applicant's events spread evenly over a month, so lags run to days: the bound is two weeks.
FUNNEL = FunnelSpec(
    zone=ZONE,
    as_of="2024-01-31 00:00:00",
    templates=("template-a", "template-b", "template-c"),
    vehicle_page="vehicle",
    identity_page="identity",
    check_page="check",
    check_status_page="check_status",
    idv_names={
        "idv_start": "start",
        "idv_doc_select": "document-camera-select",
        "idv_doc_capture": "document-camera-capture",
        "idv_selfie_select": "selfie-camera-select",
        "idv_selfie_capture": "selfie-camera-capture",
        "idv_selfie_upload": "selfie-record-upload",
        "idv_submit": "complete",
    },
    data_version="current",
    first_lag_bound=20000,
    lag_bound=20000,
    last_lag_bound=20000,
)

# The same funnel with the bounds of the monitored process.
FUNNEL_DEFAULT_BOUNDS = replace(FUNNEL, first_lag_bound=2000, lag_bound=600, last_lag_bound=1000)

MEMBERSHIPS = (
    Rule("legacy_top", "page_id = 'waitlist'"),
    Rule("legacy_bottom", "page_id = 'check' and coalesce(in_experiment, false)"),
    Rule("hard_block_top", "page_id = 'hard_block' and waitlist_step = 'after_vehicle'"),
    Rule("hard_block_bottom", "page_id = 'hard_block' and waitlist_step = 'before_check'"),
    Rule("reserved_top", "page_id = 'limited' and waitlist_step = 'after_vehicle'"),
    Rule("reserved_bottom", "page_id = 'limited' and waitlist_step = 'before_check'"),
)

_DEACTIVATED = tuple(Rule(c, f"{c} = 1") for c in (
    "is_deactivated_email", "is_deactivated_phone", "is_deactivated_licence", "is_deactivated_ssn"
))
RISK_RULES = {
    "good_or_bad_bucket": (
        *_DEACTIVATED,
        Rule("phones", "phone_count > 1"),
        Rule("ssns", "ssn_count > 1"),
    ),
    "good_or_bad_bucket_2": (
        *_DEACTIVATED,
        Rule("emails", "email_count > 1"),
        Rule("phones", "phone_count > 1"),
        Rule("licences", "licence_count > 1"),
        Rule("ssns", "ssn_count > 1"),
        Rule("continent", "continent not in ('AMERICA')"),
    ),
}

REGION = RegionRule(1, (1, 11, 21), "US - Puerto Rico", "US - Other Region")
COHORT = CohortSpec(ZONE, COHORT_START, AS_OF, MEMBERSHIPS, RISK_RULES, REGION)
VERIFICATION = SubFunnelSpec(ZONE, ("template-a", "template-b"), VERIFICATION_STEPS, "inquiry_created", "vehicle")

# Some forty orders a week call for thresholds a thousandth of the default ones.
METRICS = tuple(m if m.threshold is None else replace(m, threshold=m.threshold / 1000) for m in MONITORED)
