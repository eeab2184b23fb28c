"""An independent SQL statement for every query, to be run by another engine on the same tables.

The statements take the long way on purpose: one correlated lookup per step, every week against every
applicant, self-joins for streaks. Shared pieces are named relations; a statement gets the ones it needs.
"""

from __future__ import annotations

import re
from datetime import date, timedelta

from sluice.sources.driver_tables import TABLES, derivation_sql


def local(value: str) -> str:
    return f"(({value}) AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles')"


def looked_up(source: str, key: str, condition: str, outer: str = "a.link", ts: str = "ts") -> str:
    """Earliest local time of a source's events of the outer row."""
    return f"(SELECT {local(f'min(s.{ts})')} FROM {source} s WHERE s.{key} = {outer} AND {condition})"


def tidy(body: str, *doubles: str) -> str:
    """Doubles rounded, zero without a sign."""
    rounded = ", ".join(f"CASE WHEN round({c}, 9) = 0 THEN 0.0::DOUBLE ELSE round({c}, 9) END AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rounded}) FROM ({body}) tidied"


# The mean of doubles without an order of additions: the sum of their shortest texts as decimals, divided as whole numbers of
# 24 decimal places and rounded half up, and the digits read as a double.
_DIGITS = "CAST(replace(CAST(sum(CAST(CAST(metric_value AS VARCHAR) AS DECIMAL(30, 24))) AS VARCHAR), '.', '') AS HUGEINT)"
_QUOTIENT = f"((2 * {_DIGITS} + count(metric_value)) // (2 * nullif(count(metric_value), 0)))"
_ONE = "1000000000000000000000000::HUGEINT"
_MEAN = f"CAST(({_QUOTIENT} // {_ONE})::VARCHAR || '.' || lpad(({_QUOTIENT} % {_ONE})::VARCHAR, 24, '0') AS DOUBLE)"


def div0(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 AND ({a}) IS NOT NULL THEN 0 ELSE ({a})::DOUBLE / nullif(({b}), 0)::DOUBLE END)"


IDV = {
    "idv_doc_select": "document-camera-select",
    "idv_doc_capture": "document-camera-capture",
    "idv_selfie_select": "selfie-camera-select",
    "idv_selfie_capture": "selfie-camera-capture",
    "idv_selfie_upload": "selfie-record-upload",
    "idv_submit": "complete",
}
STEPS = [
    "applied_date", "profile_submit", "vehicle_type_submit", "idv_render", "idv_start", "idv_submit",
    "idv_approve", "bgc_form_rendered", "bgc_submit", "bgc_submit_intl", "account_activation",
]
LAGS = {
    "apply_to_profile": ("applied_date", "profile_submit"),
    "profile_to_vehicle": ("profile_submit", "vehicle_type_submit"),
    "vehicle_to_render": ("vehicle_type_submit", "idv_render"),
    "render_to_start": ("idv_render", "idv_start"),
    "start_to_submit": ("idv_start", "idv_submit"),
    "submit_to_approve": ("idv_submit", "idv_approve"),
    "approve_to_form": ("idv_submit", "bgc_form_rendered"),
    "form_to_check": ("bgc_form_rendered", "bgc_submit"),
    "check_to_activation": ("bgc_submit", "account_activation"),
    "activation_to_dash": ("account_activation", "first_dash_date"),
}
EVENT_TYPES = [
    "inquiry.created", "document.created", "document.submitted", "document.processed", "document.pending",
    "selfie.created", "selfie.submitted", "selfie.processed", "selfie.errored", "inquiry.failed",
    "inquiry.expired", "inquiry.completed", "inquiry.marked-for-review", "inquiry.approved", "inquiry.declined",
]
RULES = {
    "legacy_top": "page_id = 'waitlist'",
    "legacy_bottom": "page_id = 'check' AND in_experiment IS TRUE",
    "hard_block_top": "page_id = 'hard_block' AND waitlist_step = 'after_vehicle'",
    "hard_block_bottom": "page_id = 'hard_block' AND waitlist_step = 'before_check'",
    "reserved_top": "page_id = 'limited' AND waitlist_step = 'after_vehicle'",
    "reserved_bottom": "page_id = 'limited' AND waitlist_step = 'before_check'",
}
DEVICE_LABEL = """CASE WHEN os_first IS NULL AND os_last IS NULL THEN NULL
    WHEN 'iOS' IN (os_first, os_last) THEN 'iOS'
    WHEN os_first = 'Android' AND os_last = 'Android' THEN 'Android' ELSE os_first || '-' || os_last END"""
VERSION_LABEL = "CASE WHEN v_first = v_last THEN v_last ELSE v_first || '-' || v_last END"

PARTS: dict[str, str] = {name: derivation_sql(name) for name in TABLES}

PARTS["o_links"] = "SELECT DISTINCT link FROM step_rendered"
PARTS["o_identified"] = """
SELECT name, ts, CASE WHEN link IS NOT NULL THEN link WHEN reference_id IS NOT NULL THEN reference_id ELSE user_id END AS any_id
FROM idv_steps"""
PARTS["o_inquiries"] = "SELECT * FROM idv_inquiry WHERE template_id IN ('template-a', 'template-b', 'template-c')"
PARTS["o_statuses"] = f"""
SELECT r.reference_id,
       (SELECT status FROM o_inquiries i WHERE i.reference_id = r.reference_id ORDER BY updated_at LIMIT 1) AS first_status,
       (SELECT min(updated_at) FROM o_inquiries i WHERE i.reference_id = r.reference_id) AS first_updated_at,
       (SELECT min(updated_at) FROM o_inquiries i WHERE i.reference_id = r.reference_id AND status = 'approved') AS first_approved_at,
       (SELECT min(updated_at) FROM o_inquiries i WHERE i.reference_id = r.reference_id AND status = 'declined') AS first_declined_at,
       (SELECT status FROM o_inquiries i WHERE i.reference_id = r.reference_id ORDER BY updated_at DESC LIMIT 1) AS last_status,
       (SELECT {local('max(updated_at)')} FROM o_inquiries i WHERE i.reference_id = r.reference_id) AS last_updated_at
FROM (SELECT DISTINCT reference_id FROM o_inquiries) r"""
PARTS["o_vehicle_submits"] = """
SELECT link, os_name, app_version,
       row_number() OVER (PARTITION BY link ORDER BY ts, event_id) AS nth,
       row_number() OVER (PARTITION BY link ORDER BY ts DESC, event_id DESC) AS nth_last
FROM step_submitted WHERE page_id = 'vehicle' AND os_name IS NOT NULL"""
PARTS["o_ends"] = """
SELECT f.link, f.os_name AS os_first, f.app_version AS v_first, l.os_name AS os_last, l.app_version AS v_last
FROM o_vehicle_submits f JOIN o_vehicle_submits l ON f.link = l.link AND f.nth = 1 AND l.nth_last = 1"""
PARTS["o_devices"] = f"SELECT link, {DEVICE_LABEL} AS device_type, {VERSION_LABEL} AS app_version FROM o_ends"
_GATED = """
SELECT entity_id, seen_at, lower(busyness) AS busyness, row_number() OVER (PARTITION BY entity_id ORDER BY seen_at) AS nth
FROM (SELECT h.entity_id, {at} AS seen_at, h.busyness FROM {source} h JOIN applicants a ON trim(h.{id}) = trim(a.entity_id)
      WHERE {local_at} >= {local_gate} {extra})"""
PARTS["o_home"] = _GATED.format(
    source="home_loaded", id="user_id", at="h.received_at", local_at=local("h.received_at"),
    local_gate=local("a.oriented_at"), extra="",
)
PARTS["o_access"] = _GATED.format(
    source="access_impressions", id="entity_id", at="h.impression_ts", local_at=local("h.impression_ts"),
    local_gate=local("a.oriented_at"), extra="AND data_version = 'current'",
)
_PER_ENTITY = f"""
SELECT entity_id, {local('min(seen_at)')} AS first_impression_time,
       max(busyness) FILTER (WHERE nth = 1) AS first_impression_busyness,
       (count(*) FILTER (WHERE busyness = 'busy' OR busyness = 'very_busy'))::BIGINT AS busy_impression_freq,
       count(*)::BIGINT AS total_impression_freq
FROM {{source}} GROUP BY entity_id"""
PARTS["o_home_firsts"] = _PER_ENTITY.format(source="o_home")
PARTS["o_access_firsts"] = _PER_ENTITY.format(source="o_access")
PARTS["o_source_firsts"] = """
SELECT *, CASE WHEN first_impression_busyness = 'busy' OR first_impression_busyness = 'very_busy' THEN 'busy' ELSE 'not_busy' END AS bucket
FROM (SELECT * FROM o_home_firsts UNION ALL SELECT * FROM o_access_firsts)"""
PARTS["o_impressions"] = """
SELECT g.entity_id, min(g.first_impression_time) AS first_impression_time,
       (SELECT m.first_impression_busyness FROM o_source_firsts m WHERE m.entity_id = g.entity_id AND m.bucket = g.bucket
        ORDER BY m.first_impression_time LIMIT 1) AS first_impression_busyness,
       sum(g.busy_impression_freq)::BIGINT AS busy_impression_freq,
       sum(g.total_impression_freq)::BIGINT AS total_impression_freq,
       CASE WHEN sum(g.busy_impression_freq) > 0 THEN 'has_busy_impression' ELSE 'no_busy_impression' END AS has_busy_impression,
       g.bucket AS first_impression_busyness_bucket
FROM o_source_firsts g GROUP BY g.entity_id, g.bucket"""
_SUBSTEPS = ",\n".join(
    f"{looked_up('o_identified', 'any_id', f'''name = '{value}' ''')} AS {name}" for name, value in IDV.items()
)
PARTS["o_step_events"] = f"""
SELECT user_id AS link, 'profile_submit' AS step, ts FROM profile_submitted
UNION ALL SELECT link, CASE page_id WHEN 'vehicle' THEN 'vehicle_type_rendered' WHEN 'identity' THEN 'idv_render' WHEN 'check' THEN 'bgc_form_rendered' END, ts
    FROM step_rendered
UNION ALL SELECT link, CASE page_id WHEN 'vehicle' THEN 'vehicle_type_submit' WHEN 'check' THEN 'bgc_submit' WHEN 'check_status' THEN 'bgc_submit_intl' END, ts
    FROM step_submitted
UNION ALL SELECT user_id, 'idv_start', ts FROM idv_steps WHERE name = 'start'
UNION ALL SELECT any_id, CASE name {" ".join(f"WHEN '{value}' THEN '{name}'" for name, value in IDV.items())} END, ts FROM o_identified
UNION ALL SELECT link, 'account_activation', ts FROM activated"""
_STEP_NAMES = (
    "profile_submit", "vehicle_type_rendered", "idv_render", "bgc_form_rendered", "vehicle_type_submit", "bgc_submit", "bgc_submit_intl", "idv_start", *IDV, "account_activation",
)
PARTS["o_step_touches"] = (
    "SELECT link, " + ", ".join(f"{local('min(ts) FILTER (step = ' + repr(n) + ')')} AS {n}" for n in _STEP_NAMES)
    + " FROM o_step_events WHERE link IS NOT NULL AND step IS NOT NULL GROUP BY link"
)
PARTS["o_wide"] = f"""
SELECT a.applicant_id, a.entity_id, a.link, a.applied_date, a.first_dash_date,
    {looked_up('profile_submitted', 'user_id', 'true')} AS profile_submit,
    {looked_up('step_rendered', 'link', "page_id = 'vehicle'")} AS vehicle_type_rendered,
    {looked_up('step_submitted', 'link', "page_id = 'vehicle'")} AS vehicle_type_submit,
    {looked_up('step_rendered', 'link', "page_id = 'identity'")} AS idv_render,
    {looked_up('idv_steps', 'user_id', "name = 'start'")} AS idv_start,
    {_SUBSTEPS},
    (SELECT last_updated_at FROM o_statuses t WHERE t.reference_id = a.link AND last_status = 'approved') AS idv_approve,
    {looked_up('step_rendered', 'link', "page_id = 'check'")} AS bgc_form_rendered,
    {looked_up('step_submitted', 'link', "page_id = 'check'")} AS bgc_submit,
    {looked_up('step_submitted', 'link', "page_id = 'check_status'")} AS bgc_submit_intl,
    {looked_up('activated', 'link', 'true')} AS account_activation,
    i.first_impression_time, i.first_impression_busyness, i.busy_impression_freq, i.total_impression_freq,
    i.has_busy_impression, i.first_impression_busyness_bucket,
    {looked_up('shifts', 'entity_id', 'true', 'a.entity_id', 'created_at')} AS first_shift_creation,
    {looked_up('shifts', 'entity_id', 'true', 'a.entity_id', 'check_in_time')} AS first_shift_check_in,
    (SELECT device_type FROM o_devices d WHERE d.link = a.link) AS device_type,
    (SELECT app_version FROM o_devices d WHERE d.link = a.link) AS app_version
FROM (SELECT DISTINCT applicant_id, entity_id, link, applied_date, first_dash_date FROM applicants) a
LEFT JOIN o_impressions i ON i.entity_id = a.entity_id"""
_DELTA = "date_diff('minute', {0}::TIMESTAMP, {1}::TIMESTAMP)"


def _lag_samples(bound: dict[str, int], other: int) -> str:
    """Minutes of each lag within its bound."""
    return "SELECT applicant_id, " + ", ".join(
        f"CASE WHEN {_DELTA.format(a, b)} BETWEEN 0 AND {bound.get(name, other)} AND applied_date >= DATE '2024-01-01' THEN {_DELTA.format(a, b)} END AS {name}"
        for name, (a, b) in LAGS.items()
    ) + " FROM o_wide"


PARTS["o_lags"] = _lag_samples({}, 20000)
PARTS["o_means"] = "SELECT " + ", ".join(f"(SELECT avg({n}) FROM o_lags WHERE {n} IS NOT NULL) AS {n}" for n in LAGS)


def _back(target: str, source: str, lag: str, raw: str | None = None) -> str:
    moved = f"{source} + to_minutes(CAST(round(-m.{lag}) AS BIGINT))"
    return (
        f"CASE WHEN w.{target} IS NULL AND {source} IS NOT NULL THEN {moved} "
        f"ELSE w.{raw or target}::TIMESTAMP END AS f_{target}"
    )


_FILLED = [
    _back("account_activation", "w.first_dash_date", "activation_to_dash"),
    _back("bgc_submit", "f_account_activation", "check_to_activation"),
    _back("bgc_submit_intl", "f_account_activation", "check_to_activation", raw="bgc_submit"),
    _back("bgc_form_rendered", "coalesce(f_bgc_submit, f_bgc_submit_intl)", "form_to_check"),
    _back("idv_approve", "f_bgc_form_rendered", "approve_to_form"),
    _back("idv_submit", "f_idv_approve", "submit_to_approve"),
    _back("idv_start", "f_idv_submit", "start_to_submit"),
    _back("idv_render", "f_idv_start", "render_to_start"),
    _back("vehicle_type_submit", "f_idv_render", "vehicle_to_render"),
    _back("profile_submit", "f_vehicle_type_submit", "profile_to_vehicle"),
    _back("applied_date", "f_profile_submit", "apply_to_profile"),
]
PARTS["o_filled"] = "SELECT w.*, " + ",\n".join(_FILLED) + " FROM o_wide w CROSS JOIN o_means m"
PARTS["o_funnel"] = (
    "SELECT applicant_id, entity_id, link, first_dash_date, vehicle_type_rendered, idv_doc_select, idv_doc_capture, "
    "idv_selfie_select, idv_selfie_capture, idv_selfie_upload, first_impression_time, busy_impression_freq, "
    "total_impression_freq, first_impression_busyness, first_shift_creation, first_shift_check_in, device_type, "
    "app_version, "
    + ", ".join(f"f_{s} AS {s}, {s} AS {s}_raw" for s in STEPS)
    + ", CASE WHEN "
    + " OR ".join(f"({s} IS NULL) <> (f_{s} IS NULL)" for s in STEPS if s != "bgc_submit_intl")
    + " OR (bgc_submit_intl IS NULL AND f_bgc_submit_intl IS NOT NULL) THEN 1 ELSE 0 END AS backfilled FROM o_filled"
)

PARTS["o_flags"] = (
    "SELECT a.applicant_id, a.link, a.applied_date, CASE WHEN "
    + " OR ".join(f"EXISTS (SELECT 1 FROM step_rendered s WHERE s.link = a.link AND {r})" for r in RULES.values())
    + " THEN 'Hit Waitlist' ELSE 'No Waitlist' END AS all_waitlist_flag FROM applicants a"
)
_FOUR = "is_deactivated_email = 1 OR is_deactivated_phone = 1 OR is_deactivated_licence = 1 OR is_deactivated_ssn = 1"
PARTS["o_risk"] = f"""
SELECT DISTINCT applicant_id,
    if({_FOUR} OR greatest(phone_count, ssn_count) > 1, 'bad', 'good') AS good_or_bad_bucket,
    if({_FOUR} OR greatest(email_count, phone_count, licence_count, ssn_count) > 1 OR continent <> 'AMERICA', 'bad', 'good')
        AS good_or_bad_bucket_2
FROM risk_linkage"""
PARTS["o_shared"] = """
SELECT phone, min(applied_date) AS first_applied_date, count(DISTINCT applicant_id) AS applicant_count
FROM applicants GROUP BY phone HAVING count(DISTINCT applicant_id) > 1"""
PARTS["o_dupes"] = """
SELECT a.*, CASE WHEN s.phone IS NULL OR s.first_applied_date = a.applied_date THEN 'Non-Dupe' ELSE 'Dupe' END AS phone_duplicate_flag
FROM applicants a LEFT JOIN o_shared s ON s.phone = a.phone"""
_REGION = "CASE WHEN {0} = 1 AND {1} IN (1, 11, 21) THEN 'US - Puerto Rico' WHEN {0} = 1 THEN 'US - Other Region' ELSE {2} END"
_BUCKET = "CASE WHEN device_type LIKE '%iOS%' THEN '1-iOS' WHEN device_type LIKE '%Android%' THEN '2-Android' ELSE '3-Other' END"

PARTS["o_weeks"] = """
SELECT CAST(d AS DATE) AS week_start, CAST(d AS DATE) + 6 AS week_end
FROM generate_series(TIMESTAMP '2023-12-04', TIMESTAMP '2024-01-31', INTERVAL 7 DAY) g(d)"""
PARTS["o_cohorts"] = """
SELECT w.*, f.*, CASE WHEN f.first_dash_date < w.week_start THEN 'Unmapped'
    WHEN f.applied_date BETWEEN w.week_start AND w.week_end THEN '1. Applied L7D'
    WHEN f.applied_date BETWEEN w.week_start - 30 AND w.week_start - 1 THEN '2. Applied 7D-30D'
    WHEN f.applied_date BETWEEN w.week_start - 180 AND w.week_start - 31 THEN '3. Applied 30D-180D'
    WHEN f.applied_date < w.week_start - 180 THEN '4. Applied 180D+'
    WHEN f.applied_date > w.week_end THEN 'Applied After Measurement Period'
    ELSE 'Unmapped' END AS cohort
FROM o_weeks w CROSS JOIN o_funnel f"""
PARTS["o_access_week"] = f"""
SELECT *, {div0('n_dash_now_impressions', 'n_impressions')} AS dash_now_impression_rate FROM (
    SELECT d.entity_id, count(*)::BIGINT AS n_impressions, sum(is_dash_now)::BIGINT AS n_dash_now_impressions
    FROM access_daily d JOIN o_funnel f ON f.entity_id = d.entity_id
        AND date_trunc('week', d.active_date) = date_trunc('week', f.account_activation)
    GROUP BY d.entity_id)"""
PARTS["o_assigned_week"] = f"""
SELECT s.entity_id, count(*)::BIGINT AS assignment_creation_cnt,
       avg(CASE WHEN accepted_at IS NOT NULL AND unassigned_at IS NULL THEN 1.0 ELSE 0 END)::DOUBLE AS acceptance_rate
FROM assignments s JOIN o_funnel f ON f.entity_id = s.entity_id
    AND date_trunc('week', {local('s.created_at')}) = date_trunc('week', f.account_activation)
GROUP BY s.entity_id"""


def _converted(value: str, identifier: str = "c.applicant_id", extra: str = "true") -> str:
    return f"(count(DISTINCT {identifier}) FILTER (WHERE ({value})::DATE BETWEEN c.week_start AND c.week_end AND {extra}))::BIGINT"


_ACTIVE = "c.account_activation::DATE BETWEEN c.week_start AND c.week_end"
PARTS["o_conversions"] = f"""
SELECT c.week_start, c.cohort, d.country_id AS applied_country_id, d.country_name AS applied_country_name,
    d.submarket_id AS applied_submarket_id, d.submarket_name AS applied_submarket_name,
    CASE WHEN d.submarket_id IN (1, 11, 21) THEN 'Yes' ELSE 'No' END AS pr_flag,
    coalesce(r.good_or_bad_bucket, 'good') AS good_or_bad_bucket,
    coalesce(r.good_or_bad_bucket_2, 'good') AS good_or_bad_bucket_2,
    {_BUCKET.replace('device_type', 'c.device_type')} AS device_type,
    g.all_waitlist_flag, coalesce(d.phone_duplicate_flag, 'Non-Dupe') AS phone_duplicate_flag,
    count(DISTINCT c.applicant_id)::BIGINT AS applicants,
    {_converted('c.profile_submit')} AS profile_submit,
    {_converted('c.vehicle_type_submit')} AS vehicle_submit,
    {_converted('c.idv_submit')} AS idv_submit,
    {_converted(local('c.idv_approve'))} AS idv_approve,
    {_converted('c.bgc_submit')} AS bgc_submit,
    {_converted('c.account_activation')} AS account_activation,
    {_converted('coalesce(c.first_impression_time, c.first_shift_creation)')} AS first_impression_time,
    {_converted('coalesce(c.first_shift_creation, c.first_shift_check_in)')} AS first_shift_creation,
    {_converted('coalesce(c.first_shift_check_in, c.first_dash_date)')} AS first_shift_check_in,
    {_converted('c.account_activation', extra='s.assignment_creation_cnt > 0')} AS has_assignment_creation,
    (sum(s.assignment_creation_cnt) FILTER (WHERE {_ACTIVE}))::BIGINT AS assignment_creation_cnt,
    sum(s.assignment_creation_cnt * s.acceptance_rate) FILTER (WHERE {_ACTIVE}) AS assignment_accepted_cnt,
    avg(e.dash_now_impression_rate) FILTER (WHERE {_ACTIVE}) AS dash_now_access_rate,
    {_converted('c.first_dash_date', 'd.entity_id')} AS first_delivery,
    {_converted('coalesce(c.vehicle_type_rendered, c.vehicle_type_submit)')} AS vehicle_type_rendered,
    {_converted('coalesce(c.idv_render, c.idv_submit)')} AS idv_render,
    {_converted('coalesce(c.bgc_form_rendered, c.bgc_submit)')} AS bgc_form_rendered
FROM o_cohorts c
LEFT JOIN (SELECT DISTINCT applicant_id, all_waitlist_flag FROM o_flags) g ON g.applicant_id = c.applicant_id
LEFT JOIN o_dupes d ON d.link = c.link
LEFT JOIN o_risk r ON r.applicant_id = c.applicant_id
LEFT JOIN o_access_week e ON e.entity_id = c.entity_id
LEFT JOIN o_assigned_week s ON s.entity_id = c.entity_id
WHERE c.cohort = '1. Applied L7D'
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12"""
PARTS["o_rollup"] = f"""
SELECT * EXCLUDE (pr_flag), {_REGION.format('applied_country_id', 'applied_submarket_id', 'applied_country_name')} AS country_region,
    {div0('assignment_accepted_cnt', 'assignment_creation_cnt')} AS acceptance_rate
FROM o_conversions"""

COUNTS = {
    "C1": "applicants", "C2": "profile_submit", "C3": "vehicle_submit", "C4": "idv_submit", "C5": "idv_approve",
    "C6": "bgc_submit", "C7": "account_activation", "C8": "first_delivery",
}
RATES = {
    "R0": ("cvr_0_apply_to_fd", "first_delivery", "applicants"),
    "R1.1": ("cvr_1_1_apply_to_activation", "account_activation", "applicants"),
    "R1.2": ("cvr_1_2_activation_to_fd", "first_delivery", "account_activation"),
    "R2.1": ("cvr_2_1_apply_to_vs", "vehicle_submit", "applicants"),
    "R2.2": ("cvr_2_2_vs_to_idv_submit", "idv_submit", "vehicle_submit"),
    "R2.3": ("cvr_2_3_idv_submit_to_approve", "idv_approve", "idv_submit"),
    "R2.4": ("cvr_2_4_idv_approve_to_bgc_submit", "bgc_submit", "idv_approve"),
    "R2.5": ("cvr_2_5_bgc_submit_to_aa", "account_activation", "bgc_submit"),
}


def _base(source: str, before: str) -> str:
    return (
        "SELECT *, "
        + ", ".join(f"{div0(n, d)} AS {name}" for name, n, d in RATES.values())
        + " FROM (SELECT cohort, week_start, "
        + ", ".join(f"sum({c})::BIGINT AS {c}" for c in COUNTS.values())
        + f" FROM {source} WHERE all_waitlist_flag = 'No Waitlist' AND week_start < DATE '{before}' GROUP BY cohort, week_start)"
    )


# Lost conversions per unit of a rate (null for counts) and the tolerated loss.
WEIGHTS = {
    "R0": ("b.applicants::DOUBLE", 1.5),
    "R1.1": ("b.applicants * b.cvr_1_2_activation_to_fd", 1.2),
    "R1.2": ("b.account_activation::DOUBLE", 0.65),
    "R2.1": ("b.applicants * (b.first_delivery / nullif(b.vehicle_submit, 0))", 0.6),
    "R2.2": ("b.vehicle_submit * (b.first_delivery / nullif(b.idv_submit, 0))", 0.35),
    "R2.3": ("b.idv_submit * (b.first_delivery / nullif(b.idv_approve, 0))", 0.55),
    "R2.4": ("b.idv_approve * (b.first_delivery / nullif(b.bgc_submit, 0))", 0.4),
    "R2.5": ("b.bgc_submit * b.cvr_1_2_activation_to_fd", 0.8),
}
_WEIGHT = "CASE r.metric_number " + " ".join(f"WHEN '{k}' THEN {w}" for k, (w, _) in WEIGHTS.items()) + " END"
_TOLERATED = "CASE r.metric_number " + " ".join(f"WHEN '{k}' THEN {t}" for k, (_, t) in WEIGHTS.items()) + " END"


def _variance_parts(prefix: str, source: str, before: str) -> dict[str, str]:
    """Relations of the variance monitor over one conversion table."""
    names = {**{k: v for k, v in COUNTS.items()}, **{k: v[0] for k, v in RATES.items()}}
    long = " UNION ALL ".join(
        f"SELECT cohort, week_start, '{k}' AS metric_number, '{v}' AS metric_name, {v}::DOUBLE AS metric_value FROM {prefix}_base"
        for k, v in names.items()
    )
    at = "p.cohort = r.cohort AND p.metric_number = r.metric_number"
    change = "r.metric_value / nullif({0}, 0) - 1"
    return {
        f"{prefix}_base": _base(source, before),
        f"{prefix}_long": long,
        f"{prefix}_monthly": f"""
SELECT cohort, CAST(date_trunc('month', week_start) AS DATE) AS week_month, metric_number, metric_name,
       {_MEAN} AS metric_value_monthly_avg
FROM {prefix}_long GROUP BY ALL""",
        f"{prefix}_indexed": f"""
SELECT l.*, (row_number() OVER (PARTITION BY cohort, metric_number ORDER BY week_start))::INTEGER AS week_index FROM {prefix}_long l""",
        f"{prefix}_lagged": f"""
SELECT r.*, """
        + ", ".join(f"p{n}.metric_value AS metric_value_p{'' if n == 1 else n}w" for n in (1, 2, 3, 4))
        + f" FROM {prefix}_indexed r "
        + " ".join(
            f"LEFT JOIN {prefix}_indexed p{n} ON p{n}.cohort = r.cohort AND p{n}.metric_number = r.metric_number AND p{n}.week_index = r.week_index - {n}"
            for n in (1, 2, 3, 4)
        ),
        f"{prefix}_compared": f"""
SELECT r.*, p.metric_value_monthly_avg AS metric_value_last_month_avg
FROM {prefix}_lagged r LEFT JOIN {prefix}_monthly p ON {at} AND p.week_month = date_trunc('month', r.week_start) - INTERVAL 1 MONTH""",
        f"{prefix}_diffs": f"""
SELECT r.*, metric_value - metric_value_pw AS metric_wow_diff, {change.format('metric_value_pw')} AS metric_wow_diff_pct,
    metric_value - metric_value_last_month_avg AS metric_lm_avg_diff,
    {change.format('metric_value_last_month_avg')} AS metric_lm_avg_diff_pct,
    coalesce((metric_value < metric_value_pw)::INTEGER, 0) AS w1_decline_flag,
    coalesce(({change.format('metric_value_last_month_avg')} < 0)::INTEGER, 0) AS lm_avg_decline_flag
FROM {prefix}_compared r""",
        f"{prefix}_opened": f"""
SELECT r.*, (SELECT max(p.week_index) FROM {prefix}_diffs p WHERE {at} AND p.week_index <= r.week_index AND p.w1_decline_flag = 0) AS opened_at,
    (SELECT count(*) FROM {prefix}_diffs p WHERE {at} AND p.week_index <= r.week_index AND p.w1_decline_flag = 0) AS streak_group
FROM {prefix}_diffs r""",
        f"{prefix}_streaks": f"""
SELECT r.* EXCLUDE (opened_at), (r.week_index - r.opened_at)::INTEGER AS consecutive_decline_weeks,
    p.metric_value AS metric_value_at_streak_start
FROM {prefix}_opened r LEFT JOIN {prefix}_indexed p ON {at} AND p.week_index = r.opened_at""",
        f"{prefix}_declines": f"""
SELECT r.*, CASE WHEN metric_value_at_streak_start <> 0 THEN metric_value - metric_value_at_streak_start END AS accumulated_decline,
    metric_value / nullif(metric_value_at_streak_start, 0) - 1 AS accumulated_decline_pct
FROM {prefix}_streaks r""",
        f"{prefix}_weighted": f"""
SELECT r.*, {_WEIGHT} AS weight, {_TOLERATED} AS tolerated, b.applicants AS base_applicants, b.cvr_0_apply_to_fd AS base_rate
FROM {prefix}_declines r LEFT JOIN {prefix}_base b ON b.week_start = r.week_start""",
        f"{prefix}_impacts": f"""
SELECT r.*, metric_wow_diff * weight AS impact_wow_diff, accumulated_decline * weight AS impact_acc_diff,
    metric_lm_avg_diff * weight AS impact_lm_avg_diff, tolerated / nullif(weight, 0) AS metric_variance_threshold_abs,
    {div0('tolerated / nullif(weight, 0)', 'metric_value_pw')} AS metric_variance_threshold_rel
FROM {prefix}_weighted r""",
        f"{prefix}_summed": f"""
SELECT r.*, (SELECT sum(p.impact_acc_diff ORDER BY p.week_start) FROM {prefix}_impacts p WHERE p.metric_number = r.metric_number
    AND p.streak_group = r.streak_group AND p.week_start <= r.week_start) AS acc_impact
FROM {prefix}_impacts r""",
        f"{prefix}_cumulated": f"""
SELECT *, {div0('acc_cvr_impact_abs', 'base_rate')} AS acc_cvr_impact_rel
FROM (SELECT *, {div0('acc_impact', 'base_applicants')} AS acc_cvr_impact_abs FROM {prefix}_summed)""",
        f"{prefix}_judged": f"""
SELECT *,
    if(impact_wow_diff < -1.5, 'No', 'Yes') AS c1_wow_within_variance_threshold,
    if(acc_impact < -1.5, 'No', 'Yes') AS c2_acc_within_variance_threshold,
    if(impact_lm_avg_diff < -1.5, 'No', 'Yes') AS c3_lm_avg_within_variance_threshold,
    if(impact_wow_diff + tolerated < 0, 'No', 'Yes') AS c4_wow_within_substep_variance_threshold,
    if(acc_impact + tolerated < 0, 'No', 'Yes') AS c5_acc_within_substep_variance_threshold,
    if(impact_lm_avg_diff + tolerated < 0, 'No', 'Yes') AS c6_lm_avg_within_substep_variance_threshold,
    if(consecutive_decline_weeks > 4, 'No', 'Yes') AS c7_weeks_meet_threshold
FROM {prefix}_cumulated""",
    }


PARTS |= _variance_parts("v", "order_conversions", "2029-06-18")
PARTS |= _variance_parts("x", "o_rollup", "2024-01-29")
# Holidays by their legal rules: the n-th weekday of a month (n = 5: the last), or a day that moves to Friday from Saturday.
_FLOATING = [
    (1, 0, 3, "Martin Luther King Jr. Day"), (2, 0, 3, "Presidents'' Day"), (5, 0, 5, "Memorial Day"), (9, 0, 1, "Labor Day"),
    (10, 0, 2, "Columbus Day"), (11, 3, 4, "Thanksgiving Day"),
]
_FIXED = [
    (1, 1, "New Year''s Day"), (6, 19, "Juneteenth National Independence Day"), (7, 4, "Independence Day"), (11, 11, "Veterans Day"),
    (12, 25, "Christmas Day"),
]


def _holiday_rows() -> list[tuple[date, str]]:
    rows = []
    for year in (2024, 2025, 2026):
        for month, weekday, nth, name in _FLOATING:
            days = [d for d in (date(year, month, 1) + timedelta(n) for n in range(31)) if d.month == month and d.weekday() == weekday]
            rows.append((days[-1] if nth == 5 else days[nth - 1], name))
        for month, day, name in _FIXED:
            on = date(year, month, day)
            rows.append((on - timedelta(1), f"{name} (Observed)") if on.weekday() == 5 else (on, name))
    return rows


PARTS["o_holidays"] = "SELECT CAST(d AS DATE) AS holiday_date, n AS holiday_name FROM (VALUES " + ", ".join(
    f"('{d}', '{n}')" for d, n in _holiday_rows()
) + ") h(d, n)"
_HOLIDAY = """coalesce((SELECT string_agg(holiday_name, ', ' ORDER BY holiday_date) FROM o_holidays
    WHERE holiday_date BETWEEN {0} AND {0} + 6), 'Not a Holiday') AS c8_is_a_holiday_week"""

_REPORT = [
    "week_start", "metric_number", "metric_name", "metric_value", "metric_value_pw", "metric_wow_diff",
    "metric_wow_diff_pct", "w1_decline_flag", "metric_value_last_month_avg", "metric_lm_avg_diff",
    "metric_lm_avg_diff_pct", "lm_avg_decline_flag", "streak_group", "consecutive_decline_weeks", "week_index",
    "metric_value_at_streak_start", "accumulated_decline", "accumulated_decline_pct", "impact_wow_diff",
    "impact_acc_diff", "impact_lm_avg_diff", "metric_variance_threshold_abs", "metric_variance_threshold_rel",
    "acc_impact", "acc_cvr_impact_abs", "acc_cvr_impact_rel",
]
_INTEGERS = {"w1_decline_flag", "lm_avg_decline_flag", "streak_group", "consecutive_decline_weeks", "week_index"}
_REPORT_DOUBLES = [c for c in _REPORT[3:] if c not in _INTEGERS]
_VERDICTS = [
    "c1_wow_within_variance_threshold", "c2_acc_within_variance_threshold", "c3_lm_avg_within_variance_threshold",
    "c4_wow_within_substep_variance_threshold", "c5_acc_within_substep_variance_threshold",
    "c6_lm_avg_within_substep_variance_threshold", "c7_weeks_meet_threshold",
]
_SERIES = "cohort, week_start, metric_number, metric_name, metric_value"
_KEYS = "week_start, metric_number, metric_name"


def _report(prefix: str) -> str:
    columns = ", ".join([*_REPORT, *_VERDICTS])
    return tidy(f"SELECT {columns}, {_HOLIDAY.format('j.week_start')} FROM {prefix}_judged j", *_REPORT_DOUBLES)


# Orders and their line items.
_O_STEPS = {
    "open_shipped": "l_linestatus = 'O'",
    "none_shipped": "l_returnflag = 'N'",
    "accepted_shipped": "l_returnflag = 'A'",
    "returned_shipped": "l_returnflag = 'R'",
}
_O_NAMES = ["ordered", *_O_STEPS]
PARTS["p_wide"] = "SELECT o.o_orderkey, o.o_orderdate AS ordered, " + ", ".join(
    f"(SELECT min(l_shipdate) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND {c}) AS {n}" for n, c in _O_STEPS.items()
) + " FROM (SELECT DISTINCT o_orderkey, o_orderdate FROM orders) o"
PARTS["p_means"] = "SELECT " + ", ".join(
    f"(SELECT avg(date_diff('minute', {a}, {b})) FROM p_wide WHERE date_diff('minute', {a}, {b}) BETWEEN 0 AND 400000 "
    f"AND ordered >= TIMESTAMP '1995-01-01') AS {a}_to_{b}"
    for a, b in zip(_O_NAMES, _O_NAMES[1:])
)
PARTS["p_filled"] = "SELECT w.*, " + ", ".join(
    f"CASE WHEN w.{a} IS NULL AND {after} IS NOT NULL THEN {after} - to_minutes(CAST(round(m.{a}_to_{b}) AS BIGINT)) "
    f"ELSE w.{a} END AS f_{a}"
    for a, b, after in reversed(
        [(a, b, f"w.{b}" if b == _O_NAMES[-1] else f"f_{b}") for a, b in zip(_O_NAMES, _O_NAMES[1:])]
    )
) + " FROM p_wide w CROSS JOIN p_means m"


STATEMENTS: dict[str, str] = {
    "first_touch": "SELECT * FROM (SELECT a.link, "
    + ", ".join(
        f"{looked_up('step_rendered', 'link', f'''page_id = '{p}' ''')} AS {n}"
        for n, p in (("vehicle_type_rendered", "vehicle"), ("idv_render", "identity"), ("bgc_form_rendered", "check"))
    )
    + " FROM o_links a) WHERE coalesce(vehicle_type_rendered, idv_render, bgc_form_rendered) IS NOT NULL",
    "step_touches": "SELECT * FROM o_step_touches",
    "step_touches_stream": "SELECT * FROM o_step_touches",
    "first_touch_coalesced_id": "SELECT * FROM (SELECT a.any_id, "
    + ", ".join(f"{looked_up('o_identified', 'any_id', f'''name = '{v}' ''', 'a.any_id')} AS {n}" for n, v in IDV.items())
    + " FROM (SELECT DISTINCT any_id FROM o_identified) a) WHERE coalesce(" + ", ".join(IDV) + ") IS NOT NULL",
    "first_touch_multi": f"""
SELECT entity_id, min({local('created_at')}) AS first_shift_creation, min({local('check_in_time')}) AS first_shift_check_in
FROM shifts GROUP BY entity_id""",
    "status_summary": "SELECT * FROM o_statuses",
    "latest_status_gate": """
SELECT a.applicant_id, a.link,
    (SELECT last_updated_at FROM o_statuses s WHERE s.reference_id = a.link AND s.last_status = 'approved') AS idv_approve
FROM applicants a""",
    "first_last_attribute": """
SELECT link, os_first AS os_name_first, v_first AS app_version_first, os_last AS os_name_last, v_last AS app_version_last FROM o_ends""",
    "attribute_reconcile": "SELECT * FROM o_devices",
    "gated_impressions": "SELECT 'home' AS source, * FROM o_home_firsts UNION ALL SELECT 'access', * FROM o_access_firsts",
    "impression_rollup": "SELECT * FROM o_impressions",
    "wide_funnel": "SELECT * FROM o_wide",
    "event_type_pivot_funnel": "SELECT * FROM (SELECT a.applicant_id, a.entity_id, a.link, a.applied_date, a.first_dash_date, "
    + "d.device_type, d.app_version, "
    + ", ".join(
        looked_up("idv_events", "reference_id", f"event_type = '{e}' AND template_id IN ('template-a', 'template-b')", ts="created_at")
        + f" AS {e.replace('.', '_').replace('-', '_')}"
        for e in EVENT_TYPES
    )
    + " FROM applicants a LEFT JOIN o_devices d ON d.link = a.link) WHERE inquiry_created IS NOT NULL",
    "step_lag_samples": "SELECT * FROM o_lags",
    "step_lag_samples_default": _lag_samples({"apply_to_profile": 2000, "activation_to_dash": 1000}, 600),
    "step_lag_means": tidy("SELECT * FROM o_means", *LAGS),
    "backfill_chain": "SELECT applicant_id, first_dash_date, " + ", ".join(f"f_{s} AS {s}" for s in STEPS) + " FROM o_filled",
    "backfill_flag": "SELECT applicant_id, " + ", ".join(f"{s}_raw" for s in STEPS) + ", backfilled FROM o_funnel",
    "funnel_publish": "SELECT TIMESTAMP '2024-01-31 00:00:00' AS last_updated_at, * FROM o_funnel",
    "order_lifecycle_funnel": "SELECT o_orderkey, "
    + ", ".join(f"f_{n} AS {n}, {n} AS {n}_raw" for n in _O_NAMES[:-1])
    + f", {_O_NAMES[-1]}, if("
    + " OR ".join(f"({n} IS NULL AND f_{n} IS NOT NULL)" for n in _O_NAMES[:-1])
    + ", 1, 0) AS backfilled FROM p_filled",
    "membership_sets": "SELECT * FROM (SELECT link, "
    + ", ".join(f"max(if({r}, 1, 0)) AS {n}" for n, r in RULES.items())
    + " FROM step_rendered GROUP BY link) WHERE greatest(" + ", ".join(RULES) + ") = 1",
    "membership_flag": "SELECT DISTINCT applicant_id, all_waitlist_flag FROM o_flags",
    "daily_membership_counts": """
SELECT applied_date, all_waitlist_flag, count(DISTINCT applicant_id) AS applicants_cnt FROM o_flags
WHERE applied_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-31' GROUP BY ALL""",
    "risk_bucket": "SELECT * FROM o_risk",
    "shared_contacts": "SELECT * FROM o_shared",
    "duplicate_flag": "SELECT applicant_id, phone, applied_date, phone_duplicate_flag FROM o_dupes",
    "region_label": f"""
SELECT applicant_id, if(submarket_id IN (1, 11, 21), 'Yes', 'No') AS pr_flag,
    {_REGION.format('country_id', 'submarket_id', 'country_name')} AS country_region FROM applicants""",
    "device_bucket": f"SELECT link, device_type, {_BUCKET} AS device_bucket FROM o_devices",
    "week_spine": """
SELECT w AS week_start, w + 6 AS week_end FROM (SELECT DISTINCT CAST(date_trunc('week', o_orderdate) AS DATE) AS w FROM orders)
WHERE w BETWEEN DATE '1996-01-01' AND DATE '2000-01-01'""",
    "cohort_assign_all": """
SELECT week_start, cohort, count(DISTINCT applicant_id)::BIGINT AS applicants FROM o_cohorts GROUP BY ALL""",
    "cohort_conversion_all": f"""
SELECT c.week_start, c.cohort, count(DISTINCT c.applicant_id)::BIGINT AS applicants,
    {_converted('c.profile_submit')} AS profile_submit,
    {_converted('c.vehicle_type_submit')} AS vehicle_submit,
    {_converted('c.idv_submit')} AS idv_submit,
    {_converted(local('c.idv_approve'))} AS idv_approve,
    {_converted('c.bgc_submit')} AS bgc_submit,
    {_converted('c.account_activation')} AS account_activation,
    {_converted('coalesce(c.first_impression_time, c.first_shift_creation)')} AS first_impression_time,
    {_converted('coalesce(c.first_shift_creation, c.first_shift_check_in)')} AS first_shift_creation,
    {_converted('coalesce(c.first_shift_check_in, c.first_dash_date)')} AS first_shift_check_in,
    {_converted('coalesce(c.vehicle_type_rendered, c.vehicle_type_submit)')} AS vehicle_type_rendered,
    {_converted('coalesce(c.idv_render, c.idv_submit)')} AS idv_render,
    {_converted('coalesce(c.bgc_form_rendered, c.bgc_submit)')} AS bgc_form_rendered,
    {_converted('c.first_dash_date')} AS first_dash
FROM o_cohorts c GROUP BY c.week_start, c.cohort""",
    "cohort_assign_l7d": """
SELECT week_start, week_end, cohort, applicant_id, applied_date, first_dash_date FROM o_cohorts WHERE cohort LIKE '1.%'""",
    "activation_week_access": tidy("SELECT * FROM o_access_week", "dash_now_impression_rate"),
    "activation_week_assignments": tidy("SELECT * FROM o_assigned_week", "acceptance_rate"),
    "cohort_conversion": tidy("SELECT * FROM o_conversions", "assignment_accepted_cnt", "dash_now_access_rate"),
    "cohort_conversion_rollup": tidy(
        "SELECT * FROM o_rollup", "assignment_accepted_cnt", "dash_now_access_rate", "acceptance_rate"
    ),
    "metric_base": tidy("SELECT * FROM v_base", *[r[0] for r in RATES.values()]),
    "metric_long": tidy("SELECT * FROM v_long", "metric_value"),
    "metric_monthly_avg": tidy("SELECT * FROM v_monthly", "metric_value_monthly_avg"),
    "metric_lags": tidy(
        "SELECT * EXCLUDE (week_index) FROM v_lagged",
        "metric_value", "metric_value_pw", "metric_value_p2w", "metric_value_p3w", "metric_value_p4w",
    ),
    "metric_prev_month": tidy(
        f"SELECT {_SERIES}, metric_value_last_month_avg FROM v_compared", "metric_value", "metric_value_last_month_avg"
    ),
    "metric_diffs": tidy(
        "SELECT * EXCLUDE (week_index, metric_value_p2w, metric_value_p3w, metric_value_p4w) FROM v_diffs",
        "metric_value", "metric_value_pw", "metric_value_last_month_avg", "metric_wow_diff", "metric_wow_diff_pct",
        "metric_lm_avg_diff", "metric_lm_avg_diff_pct",
    ),
    "decline_streaks": tidy(
        f"SELECT {_SERIES}, w1_decline_flag, streak_group, consecutive_decline_weeks, week_index FROM v_streaks", "metric_value"
    ),
    "streak_start_value": tidy(
        f"SELECT {_SERIES}, consecutive_decline_weeks, metric_value_at_streak_start FROM v_streaks",
        "metric_value", "metric_value_at_streak_start",
    ),
    "accumulated_decline": tidy(
        f"SELECT {_SERIES}, accumulated_decline, accumulated_decline_pct FROM v_declines",
        "metric_value", "accumulated_decline", "accumulated_decline_pct",
    ),
    "impact_translation": tidy(
        f"SELECT {_KEYS}, impact_wow_diff, impact_acc_diff, impact_lm_avg_diff FROM v_impacts",
        "impact_wow_diff", "impact_acc_diff", "impact_lm_avg_diff",
    ),
    "variance_thresholds": tidy(
        f"SELECT {_KEYS}, metric_variance_threshold_abs, metric_variance_threshold_rel FROM v_impacts",
        "metric_variance_threshold_abs", "metric_variance_threshold_rel",
    ),
    "cumulative_impact": tidy(
        f"SELECT {_KEYS}, streak_group, acc_impact, acc_cvr_impact_abs, acc_cvr_impact_rel FROM v_cumulated",
        "acc_impact", "acc_cvr_impact_abs", "acc_cvr_impact_rel",
    ),
    "guardrails": f"SELECT {_KEYS}, {', '.join(_VERDICTS)} FROM v_judged",
    "holiday_weeks": f"""
SELECT week_start, events, {_HOLIDAY.format('w.week_start')}
FROM (SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, count(*) AS events FROM events GROUP BY 1) w""",
    "variance_report": _report("v"),
    "cohort_variance_report": _report("x"),
}


STATEMENTS |= {
    "first_touch_stream": STATEMENTS["first_touch"],
    "published_funnel": STATEMENTS["funnel_publish"],
    "published_conversions": STATEMENTS["cohort_conversion_rollup"],
    "published_variances": STATEMENTS["variance_report"],
    "published_verification": STATEMENTS["event_type_pivot_funnel"],
}


def statement(name: str) -> str:
    """The statement of a query, with the named relations it uses, directly or through others."""
    order = list(PARTS)
    needed: set[str] = set()
    texts = [STATEMENTS[name]]
    while texts:
        words = set(re.findall(r"\w+", texts.pop()))
        for part in order:
            if part in words and part not in needed:
                needed.add(part)
                texts.append(PARTS[part])
    named = ",\n".join(f"{p} AS MATERIALIZED ({PARTS[p]})" for p in order if p in needed)
    return f"WITH {named}\n{STATEMENTS[name]}" if named else STATEMENTS[name]


def statements() -> dict[str, str]:
    return {name: statement(name) for name in STATEMENTS}
