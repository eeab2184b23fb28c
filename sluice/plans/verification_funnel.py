"""The identity-verification sub-funnel: one timestamp per verification event type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.assemble import event_type_pivot_funnel
from sluice.plans.applicant_funnel import devices
from sluice.specs import Step, SubFunnelSpec

# Event types and the columns they fill. FIXED VALUES.
EVENT_TYPES = {
    "inquiry_created": "inquiry.created",
    "document_created": "document.created",
    "document_submitted": "document.submitted",
    "document_processed": "document.processed",
    "document_pending": "document.pending",
    "selfie_created": "selfie.created",
    "selfie_submitted": "selfie.submitted",
    "selfie_processed": "selfie.processed",
    "selfie_errored": "selfie.errored",
    "inquiry_failed": "inquiry.failed",
    "inquiry_expired": "inquiry.expired",
    "inquiry_completed": "inquiry.completed",
    "inquiry_marked_for_review": "inquiry.marked-for-review",
    "inquiry_approved": "inquiry.approved",
    "inquiry_declined": "inquiry.declined",
}
STEPS = tuple(Step(name, f"event_type = '{value}'") for name, value in EVENT_TYPES.items())


def verification_funnel(tables: dict[str, DataFrame], spec: SubFunnelSpec) -> DataFrame:
    """The published sub-funnel table, for applicants with the required step. Grain: one row per applicant row."""
    spine = tables["applicants"].select("applicant_id", "entity_id", "link", "applied_date", "first_dash_date")
    return event_type_pivot_funnel(
        spine,
        tables["idv_events"],
        "link",
        "reference_id",
        spec.steps,
        spec.required,
        F.col("template_id").isin(*spec.templates),
        zone=spec.zone,
        parts={"link": [devices(tables["step_submitted"], spec.vehicle_page)]},
    ).select(*spine.columns, "device_type", "app_version", *[s.name for s in spec.steps])
