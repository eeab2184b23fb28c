"""Typed parameters of the operators.

Predicates are Spark SQL expression strings, so a spec can be built before a session exists, compared,
printed and kept in configuration files.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class Step:
    """A funnel step: ``name`` is the output column, ``where`` selects its events (None: every event)."""

    name: str
    where: str | None = None


@dataclass(frozen=True)
class Lag:
    """Minutes from ``start`` to ``end``, kept as a sample when between 0 and ``bound``."""

    name: str
    start: str
    end: str
    bound: int


@dataclass(frozen=True)
class Fill:
    """How a missing ``step`` is imputed: first non-null of ``following`` minus the mean of ``lag``.

    ``kept`` names the column returned when nothing is imputed (by default the step itself). ``applies`` is a condition
    on the row, where ``<step>_raw`` are the input values: elsewhere the step keeps its own input value.
    """

    step: str
    following: tuple[str, ...]
    lag: str
    kept: str | None = None
    applies: str | None = None


@dataclass(frozen=True)
class Rule:
    """A named yes/no rule over one row."""

    name: str
    where: str


@dataclass(frozen=True)
class Measure:
    """A weekly conversion measure: an entity counts when ``when`` holds.

    ``value`` is the timestamp or date expression that has to fall into the week; ``extra`` is a further
    condition.
    """

    name: str
    value: str
    extra: str | None = None


@dataclass(frozen=True)
class RegionRule:
    """Splits one country in two labels by a set of submarkets; other countries keep their name."""

    country_id: int
    submarkets: tuple[int, ...]
    inside: str
    outside: str


@dataclass(frozen=True)
class Metric:
    """A monitored metric.

    ``value`` is an expression over the weekly base row. For a rate, ``volume`` and ``onward`` give the
    entities a change of the rate acts on and the rate at which they go on to convert; their product is
    the weight that turns a rate change into conversions. ``threshold`` is the tolerated loss.
    """

    number: str
    name: str
    value: str
    volume: str | None = None
    onward: tuple[str, str] | None = None
    threshold: float | None = None


@dataclass(frozen=True)
class Quirks:
    """Behaviours kept for like-for-like results. True reproduces, False corrects."""

    intl_falls_back_to_domestic: bool = True  # K1: an existing intl submit is replaced by the domestic one
    approve_lag_from_submit: bool = True  # K2: the approve-to-form lag is measured from submit
    approve_is_last_update: bool = True  # K3: approval time is the last update, not the first approval
    approve_converted_twice: bool = True  # K4: approval time goes through the zone conversion again
    compare_in_local_time: bool = True  # K5: wall clocks are compared after the conversion
    bucket_splits_entity: bool = True  # K6: the per-source busyness is a grouping key of the roll-up
    gate_on_user_id: bool = True  # K7: impressions are gated by user id but grouped by entity id
    monitor_ignores_cohort: bool = True  # K8: cumulative window and base join leave the cohort out
    cumulate_accumulated: bool = True  # K9: the cumulative impact sums already accumulated values
    start_uses_user_id_only: bool = True  # K10: the start step does not resolve the identity
    mixed_decline_basis: bool = True  # K11: one flag tests the difference, the other the percentage
    verdict_for_counts: bool = True  # K12: metrics without an impact get a 'Yes'
    applied_keeps_time: bool = True  # K14: an imputed applied time late on the last day misses the week
    intl_filled_for_all: bool = True  # K15: intl submit is imputed for every activated entity
    fail_on_zero_volume: bool = False  # K16: a zero volume stops the job (corrected unless asked for)
    facts_count_per_row: bool = True  # K19: entities with several funnel rows inflate activation facts
    first_status_in_utc: bool = True  # K24: first status times stay in UTC
    drop_lags_and_cohort: bool = True  # K25: lags 2-4 and the cohort are not published


REPRODUCE = Quirks()
CORRECTED = Quirks(**{name: False for name in Quirks.__dataclass_fields__})


@dataclass(frozen=True)
class Contact:
    """Columns that identify a contact shared between applicants."""

    column: str = "phone"
    date: str = "applied_date"
    entity: str = "applicant_id"


@dataclass(frozen=True)
class FunnelSpec:
    """Everything the applicant funnel is parameterised by.

    Pages, step names and templates are the caller's own; the bounds default to the monitored process.
    """

    zone: str
    as_of: str
    templates: tuple[str, ...]
    vehicle_page: str
    identity_page: str
    check_page: str
    check_status_page: str
    idv_names: dict[str, str]
    data_version: str
    approved_status: str = "approved"
    declined_status: str = "declined"
    busy_values: tuple[str, ...] = ("busy", "very_busy")
    samples_from: date = date(2024, 1, 1)
    first_lag_bound: int = 2000
    lag_bound: int = 600
    last_lag_bound: int = 1000
    intl_applies: str = "bgc_submit_intl_raw IS NOT NULL"  # whose intl submit is imputed when K15 is corrected
    quirks: Quirks = REPRODUCE


@dataclass(frozen=True)
class CohortSpec:
    """Everything the weekly cohort report is parameterised by."""

    zone: str
    start: date
    as_of: date
    memberships: tuple[Rule, ...]
    risk_rules: dict[str, tuple[Rule, ...]]
    region: RegionRule
    quirks: Quirks = REPRODUCE


@dataclass(frozen=True)
class SubFunnelSpec:
    """Everything the identity-verification sub-funnel is parameterised by."""

    zone: str
    templates: tuple[str, ...]
    steps: tuple[Step, ...]
    required: str
    vehicle_page: str
