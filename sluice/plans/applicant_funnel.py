"""The applicant funnel: first touches of every step, imputed where missing, one row per applicant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.assemble import wide_funnel
from sluice.operators.backfill import backfill_chain, backfill_flag, funnel_publish, step_lag_means
from sluice.operators.impressions import gated_impressions, impression_events, impression_rollup
from sluice.operators.touch import (
    attribute_reconcile,
    first_last_attribute,
    first_touch_multi,
    first_touch_sources,
    latest_status_gate,
    resolve_identity,
    status_summary,
    touches_with_ends,
)
from sluice.sources.storage import Staging
from sluice.specs import Fill, FunnelSpec, Lag, Step

IDV_IDS = ("link", "reference_id", "user_id")
IDV_SUBSTEPS = ("idv_doc_select", "idv_doc_capture", "idv_selfie_select", "idv_selfie_capture", "idv_selfie_upload")

# Steps from first to last; these are imputed.
STEPS = (
    "applied_date",
    "profile_submit",
    "vehicle_type_submit",
    "idv_render",
    "idv_start",
    "idv_submit",
    "idv_approve",
    "bgc_form_rendered",
    "bgc_submit",
    "bgc_submit_intl",
    "account_activation",
)

PUBLISHED = (
    "applicant_id",
    "entity_id",
    "link",
    "applied_date",
    "profile_submit",
    "vehicle_type_rendered",
    "vehicle_type_submit",
    "idv_render",
    "idv_start",
    *IDV_SUBSTEPS,
    "idv_submit",
    "idv_approve",
    "bgc_form_rendered",
    "bgc_submit",
    "bgc_submit_intl",
    "account_activation",
    "first_impression_time",
    "busy_impression_freq",
    "total_impression_freq",
    "first_impression_busyness",
    "first_shift_creation",
    "first_shift_check_in",
    "first_dash_date",
    "device_type",
    "app_version",
    *[f"{s}_raw" for s in STEPS],
    "backfilled",
)


def lags(spec: FunnelSpec) -> tuple[Lag, ...]:
    """Lags between consecutive steps, in funnel order."""
    after_approve = "idv_submit" if spec.quirks.approve_lag_from_submit else "idv_approve"
    between = spec.lag_bound
    return (
        Lag("apply_to_profile", "applied_date", "profile_submit", spec.first_lag_bound),
        Lag("profile_to_vehicle", "profile_submit", "vehicle_type_submit", between),
        Lag("vehicle_to_render", "vehicle_type_submit", "idv_render", between),
        Lag("render_to_start", "idv_render", "idv_start", between),
        Lag("start_to_submit", "idv_start", "idv_submit", between),
        Lag("submit_to_approve", "idv_submit", "idv_approve", between),
        Lag("approve_to_form", after_approve, "bgc_form_rendered", between),
        Lag("form_to_check", "bgc_form_rendered", "bgc_submit", between),
        Lag("check_to_activation", "bgc_submit", "account_activation", between),
        Lag("activation_to_dash", "account_activation", "first_dash_date", spec.last_lag_bound),
    )


def fills(spec: FunnelSpec) -> tuple[Fill, ...]:
    """Imputation rules, from the last step back to the first."""
    quirks = spec.quirks
    intl = Fill(
        "bgc_submit_intl",
        ("account_activation",),
        "check_to_activation",
        kept="bgc_submit" if quirks.intl_falls_back_to_domestic else None,
        applies=None if quirks.intl_filled_for_all else spec.intl_applies,
    )
    return (
        Fill("account_activation", ("first_dash_date",), "activation_to_dash"),
        Fill("bgc_submit", ("account_activation",), "check_to_activation"),
        intl,
        Fill("bgc_form_rendered", ("bgc_submit", "bgc_submit_intl"), "form_to_check"),
        Fill("idv_approve", ("bgc_form_rendered",), "approve_to_form"),
        Fill("idv_submit", ("idv_approve",), "submit_to_approve"),
        Fill("idv_start", ("idv_submit",), "start_to_submit"),
        Fill("idv_render", ("idv_start",), "render_to_start"),
        Fill("vehicle_type_submit", ("idv_render",), "vehicle_to_render"),
        Fill("profile_submit", ("vehicle_type_submit",), "profile_to_vehicle"),
        Fill("applied_date", ("profile_submit",), "apply_to_profile"),
    )


Source = tuple[DataFrame, str, list[Step], str]


def step_sources(tables: dict[str, DataFrame], spec: FunnelSpec) -> dict[str, Source]:
    """Events, key column, steps and time column of every source keyed by the applicant's link."""

    def page(name: str, value: str) -> Step:
        return Step(name, f"page_id = '{value}'")

    def named(name: str) -> Step:
        return Step(name, f"name = '{spec.idv_names[name]}'")

    identified = resolve_identity(tables["idv_steps"], IDV_IDS, "any_id")
    if spec.quirks.start_uses_user_id_only:
        is_start = F.col("name") == spec.idv_names["idv_start"]
        identified = identified.withColumn("any_id", F.when(is_start, F.col("user_id")).otherwise(F.col("any_id")))
    verified = [named(s) for s in ("idv_start", *IDV_SUBSTEPS, "idv_submit")]
    rendered = [
        page("vehicle_type_rendered", spec.vehicle_page),
        page("idv_render", spec.identity_page),
        page("bgc_form_rendered", spec.check_page),
    ]
    submitted = [
        page("vehicle_type_submit", spec.vehicle_page),
        page("bgc_submit", spec.check_page),
        page("bgc_submit_intl", spec.check_status_page),
    ]
    return {
        "profile_submitted": (tables["profile_submitted"], "user_id", [Step("profile_submit")], "ts"),
        "step_rendered": (tables["step_rendered"], "link", rendered, "ts"),
        "step_submitted": (tables["step_submitted"], "link", submitted, "ts"),
        "idv_steps": (identified, "any_id", verified, "ts"),
        "activated": (tables["activated"], "link", [Step("account_activation")], "ts"),
    }


def step_touches(tables: dict[str, DataFrame], spec: FunnelSpec) -> DataFrame:
    """First touch of every step, over all sources keyed by the applicant's link. Grain: one row per link."""
    return first_touch_sources(list(step_sources(tables, spec).values()), "link", spec.zone)


def touches_and_devices(tables: dict[str, DataFrame], spec: FunnelSpec) -> DataFrame:
    """First touch of every step, device type and app version, from one scan of each source. Grain: one row per link.

    The device is that of the vehicle step's submits, which the steps read too.
    """
    sources = step_sources(tables, spec)
    found = touches_with_ends(
        list(sources.values()), "link", list(sources).index("step_submitted"), ["os_name", "app_version"],
        device_events(spec.vehicle_page), spec.zone,
    )
    return attribute_reconcile(found, "link", keep=[s.name for _, _, steps, _ in sources.values() for s in steps])


def approvals(tables: dict[str, DataFrame], spec: FunnelSpec) -> DataFrame:
    """Approval time of the links whose latest inquiry status is approved. Grain: one row per such link."""
    summary = status_summary(
        tables["idv_inquiry"].filter(F.col("template_id").isin(*spec.templates)),
        "reference_id",
        zone=spec.zone,
        approved=spec.approved_status,
        declined=spec.declined_status,
        quirks=spec.quirks,
    )
    gated = latest_status_gate(summary, "reference_id", "idv_approve", spec.approved_status, spec.zone, spec.quirks)
    return gated.withColumnRenamed("reference_id", "link")


def device_events(vehicle_page: str) -> str:
    """The submits that tell an applicant's device."""
    return f"page_id = '{vehicle_page}' and os_name is not null"


def devices(submitted: DataFrame, vehicle_page: str) -> DataFrame:
    """Device type and app version at the vehicle step. Grain: one row per link."""
    ends = first_last_attribute(submitted, "link", ["os_name", "app_version"], where=device_events(vehicle_page))
    return attribute_reconcile(ends, "link")


def impression_sources(tables: dict[str, DataFrame], spec: FunnelSpec) -> DataFrame:
    """Impressions of both sources in one relation. Grain: one row per impression."""
    current = tables["access_impressions"].filter(F.col("data_version") == spec.data_version)
    home = impression_events("home", tables["home_loaded"], "received_at", gate_id="user_id", quirks=spec.quirks)
    return home.unionByName(impression_events("access", current, "impression_ts", quirks=spec.quirks))


def impressions(tables: dict[str, DataFrame], spec: FunnelSpec) -> DataFrame:
    """Impressions after orientation, from both sources. Grain: entity and busyness bucket."""
    events = impression_sources(tables, spec)
    gated = gated_impressions(
        events, tables["applicants"], busy=spec.busy_values, zone=spec.zone, quirks=spec.quirks
    )
    return impression_rollup(gated, spec.busy_values, spec.quirks)


def all_steps(tables: dict[str, DataFrame], spec: FunnelSpec) -> DataFrame:
    """Applicants with every raw step timestamp, impressions, shifts and device.

    Grain: one row per distinct applicant row, twice where the impressions of an entity keep two buckets.
    """
    spine = tables["applicants"].select("applicant_id", "entity_id", "link", "applied_date", "first_dash_date")
    shifts = first_touch_multi(
        tables["shifts"],
        "entity_id",
        {"first_shift_creation": "created_at", "first_shift_check_in": "check_in_time"},
        spec.zone,
        spec.quirks,
    )
    return wide_funnel(
        spine,
        {
            "link": [
                touches_and_devices(tables, spec),
                approvals(tables, spec),
            ],
            "entity_id": [impressions(tables, spec), shifts],
        },
    )


def backfilled_funnel(funnel: DataFrame, spec: FunnelSpec) -> DataFrame:
    """The wide funnel with imputed steps, their raw values and the provenance flag. Reads it twice."""
    means = step_lag_means(funnel, lags(spec), "applied_date", spec.samples_from)
    return backfill_chain(funnel, means, fills(spec)).withColumn("backfilled", backfill_flag(STEPS))


def applicant_funnel(tables: dict[str, DataFrame], spec: FunnelSpec, staging: Staging) -> DataFrame:
    """The published funnel table. The wide funnel is written to ``staging``, then read for the means and the fill."""
    return funnel_publish(backfilled_funnel(staging(all_steps(tables, spec)), spec), PUBLISHED, spec.as_of)
