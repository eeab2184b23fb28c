"""First-touch timestamps, status history and first/last attributes per entity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import local_time
from sluice.specs import REPRODUCE, Quirks, Step


def _wanted(steps: Sequence[Step]) -> Column | None:
    """Condition that holds for every event some step needs; None when a step takes all events."""
    if any(step.where is None for step in steps):
        return None
    return reduce(or_, [F.expr(step.where) for step in steps])


def step_columns(
    events: DataFrame, key: str, steps: Sequence[Step], ts: str = "ts", into: str | None = None
) -> DataFrame:
    """Project events to the key, named ``into``, and one timestamp column per step.

    Grain: one row per event used.
    """
    used = F.col(key).isNotNull()
    wanted = _wanted(steps)
    columns = [
        (F.col(ts) if s.where is None else F.when(F.expr(s.where), F.col(ts))).alias(s.name) for s in steps
    ]
    return events.filter(used if wanted is None else used & wanted).select(F.col(key).alias(into or key), *columns)


def earliest(marked: DataFrame, key: str, steps: Sequence[Step], zone: str | None) -> DataFrame:
    """Earliest value of every step column per key, in local time. Grain: one row per key."""
    firsts = marked.groupBy(key).agg(*[F.min(s.name).alias(s.name) for s in steps])
    return firsts.select(key, *[local_time(F.col(s.name), zone).alias(s.name) for s in steps])


def first_touch(
    events: DataFrame, key: str, steps: Sequence[Step], ts: str = "ts", zone: str | None = None
) -> DataFrame:
    """First time each step was reached: one scan and one aggregate for all steps of a source.

    Grain: one row per key with at least one matching event. Events without a key are dropped.
    """
    return earliest(step_columns(events, key, steps, ts), key, steps, zone)


def first_touch_sources(
    sources: Sequence[tuple[DataFrame, str, Sequence[Step], str]], key: str, zone: str | None = None
) -> DataFrame:
    """First touch over several sources sharing one key space.

    ``sources`` holds ``(events, key column, steps, timestamp column)``. The sources are stacked before
    one aggregate, so all of them together cost one shuffle, and the spine needs one join instead of one
    per source. Grain: one row per key.
    """
    marked = [step_columns(events, source_key, steps, ts, key) for events, source_key, steps, ts in sources]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    return earliest(stacked, key, [s for _, _, steps, _ in sources for s in steps], zone)


def resolve_identity(events: DataFrame, ids: Sequence[str], into: str) -> DataFrame:
    """Add ``into``: the first non-null of several id columns."""
    return events.withColumn(into, F.coalesce(*[F.col(i) for i in ids]))


def first_touch_multi(
    events: DataFrame, key: str, columns: dict[str, str], zone: str | None = None, quirks: Quirks = REPRODUCE
) -> DataFrame:
    """Earliest value of several timestamp columns; ``columns`` maps output to input column.

    The conversion happens inside the minimum when wall clocks are compared (K5), after it otherwise.
    Grain: one row per key.
    """
    if quirks.compare_in_local_time:
        measures = [F.min(local_time(F.col(c), zone)).alias(name) for name, c in columns.items()]
    else:
        measures = [local_time(F.min(c), zone).alias(name) for name, c in columns.items()]
    return events.filter(F.col(key).isNotNull()).groupBy(key).agg(*measures)


def status_summary(
    history: DataFrame,
    key: str,
    status: str = "status",
    updated_at: str = "updated_at",
    tie_break: Sequence[str] = (),
    zone: str | None = None,
    approved: str = "approved",
    declined: str = "declined",
    quirks: Quirks = REPRODUCE,
) -> DataFrame:
    """First, first approved, first declined and last entry of a status history.

    Rows without a time cannot be first or last. Equal times are decided by ``tie_break``, then by the
    status. The history is first reduced to one row per key, status and tie-breaking value, with its first and
    last time: that aggregate hashes, where the end rows themselves, which hold text, would have to be sorted.
    Grain: one row per key.
    """
    at = F.col(updated_at)
    short = history.filter(F.col(key).isNotNull()).groupBy(key, status, *tie_break).agg(F.min(at).alias("_from"), F.max(at).alias("_to"))

    def end(time: str) -> Column:
        order = F.struct(F.col(time).alias(updated_at), *[F.col(c) for c in tie_break], F.col(status))
        return F.when(F.col(time).isNotNull(), order)

    first_zone = None if quirks.first_status_in_utc else zone
    summary = short.groupBy(key).agg(
        F.min(end("_from")).alias("_first"),
        F.min(F.when(F.col(status) == approved, F.col("_from"))).alias("_approved"),
        F.min(F.when(F.col(status) == declined, F.col("_from"))).alias("_declined"),
        F.max(end("_to")).alias("_last"),
    )
    return summary.select(
        key,
        F.col("_first")[status].alias("first_status"),
        local_time(F.col("_first")[updated_at], first_zone).alias("first_updated_at"),
        local_time(F.col("_approved"), first_zone).alias("first_approved_at"),
        local_time(F.col("_declined"), first_zone).alias("first_declined_at"),
        F.col("_last")[status].alias("last_status"),
        local_time(F.col("_last")[updated_at], zone).alias("last_updated_at"),
    )


def latest_status_gate(
    summary: DataFrame,
    key: str,
    into: str,
    approved: str = "approved",
    zone: str | None = None,
    quirks: Quirks = REPRODUCE,
) -> DataFrame:
    """Approval time of the keys whose latest status is ``approved``. Grain: one row per such key.

    The time is the last update (K3); corrected, it is the first approval, which needs the zone because
    the summary keeps first times in UTC (K24).
    """
    if quirks.approve_is_last_update:
        at = F.col("last_updated_at")
    else:
        at = local_time(F.col("first_approved_at"), zone if quirks.first_status_in_utc else None)
    return summary.filter(F.col("last_status") == approved).select(key, at.alias(into))


def first_last_attribute(
    events: DataFrame,
    key: str,
    attributes: Sequence[str],
    ts: str = "ts",
    tie_break: Sequence[str] = (),
    where: str | None = None,
) -> DataFrame:
    """Attribute values at the first and at the last qualifying event of each key.

    Adds ``<attribute>_first`` and ``<attribute>_last``. All attributes come from the same event, so two
    aggregation buffers serve any number of them. The events are first reduced by a hash aggregate to one row per key
    and combination of values, with its first and last time. Grain: one row per key.
    """
    used = events.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    if where is not None:
        used = used.filter(F.expr(where))
    values = [*tie_break, *attributes]
    short = used.groupBy(key, *values).agg(F.min(ts).alias("_from"), F.max(ts).alias("_to"))
    ends = short.groupBy(key).agg(
        *[end(F.struct(F.col(time).alias("_at"), *values)).alias(name) for end, time, name in ((F.min, "_from", "_first"), (F.max, "_to", "_last"))]
    )
    return ends.select(
        key,
        *[F.col("_first")[a].alias(f"{a}_first") for a in attributes],
        *[F.col("_last")[a].alias(f"{a}_last") for a in attributes],
    )


def touches_with_ends(
    sources: Sequence[tuple[DataFrame, str, Sequence[Step], str]],
    key: str,
    ended: int,
    attributes: Sequence[str],
    where: str,
    zone: str | None = None,
) -> DataFrame:
    """First touch over several sources, and the first and last attributes of one of them, from one scan of each.

    ``sources`` as for ``first_touch_sources``; the attributes are those of source number ``ended``, at its first and
    last event with ``where``. An event row carries its step times and, where it qualifies, its time and attributes. Rows
    are first reduced by a hash aggregate to one per key and combination of attributes, which keeps the earliest time of
    every step and both ends of the event times; only those few rows are sorted for the ends. What has no attributes is one
    combination more. Grain: one row per key; ``<attribute>_first`` and ``<attribute>_last`` as by ``first_last_attribute``.
    """
    marked = []
    for i, (events, source_key, steps, ts) in enumerate(sources):
        if i != ended:
            marked.append(step_columns(events, source_key, steps, ts, key))
            continue
        qualifies = F.expr(where) & F.col(ts).isNotNull()
        wanted = _wanted(steps)
        used = F.col(source_key).isNotNull() & (qualifies | (F.lit(True) if wanted is None else wanted))
        times = [(F.col(ts) if s.where is None else F.when(F.expr(s.where), F.col(ts))).alias(s.name) for s in steps]
        ends = [F.when(qualifies, F.col(ts)).alias("_at"), *[F.when(qualifies, F.col(a)).alias(f"_{a}") for a in attributes]]
        marked.append(events.filter(used).select(F.col(source_key).alias(key), *times, *ends))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    names = [s.name for _, _, steps, _ in sources for s in steps]
    values = [f"_{a}" for a in attributes]
    earliest_of = [F.min(name).alias(name) for name in names]
    short = stacked.groupBy(key, *values).agg(*earliest_of, F.min("_at").alias("_from"), F.max("_at").alias("_to"))

    def end(time: str) -> Column:
        return F.when(F.col(time).isNotNull(), F.struct(F.col(time), *values))

    whole = short.groupBy(key).agg(*earliest_of, F.min(end("_from")).alias("_first"), F.max(end("_to")).alias("_last"))
    return whole.select(
        key,
        *[local_time(F.col(name), zone).alias(name) for name in names],
        *[F.col("_first")[f"_{a}"].alias(f"{a}_first") for a in attributes],
        *[F.col("_last")[f"_{a}"].alias(f"{a}_last") for a in attributes],
    )


def device_type(first: Column, last: Column) -> Column:
    """iOS when either end is iOS, Android when both are, otherwise ``first-last``; null without a device."""
    return (
        F.when(first.isNull() & last.isNull(), F.lit(None).cast("string"))
        .when((first == "iOS") | (last == "iOS"), "iOS")
        .when((first == "Android") & (last == "Android"), "Android")
        .otherwise(F.concat(first, F.lit("-"), last))
    )


def version_label(first: Column, last: Column) -> Column:
    """The version when it did not change, otherwise ``first-last``."""
    return F.when(first == last, last).otherwise(F.concat(first, F.lit("-"), last))


def attribute_reconcile(
    ends: DataFrame, key: str, os: str = "os_name", version: str = "app_version", keep: Sequence[str] = ()
) -> DataFrame:
    """One device type and one app version per key from their first and last values, with the columns ``keep``."""
    return ends.select(
        key,
        *keep,
        device_type(F.col(f"{os}_first"), F.col(f"{os}_last")).alias("device_type"),
        version_label(F.col(f"{version}_first"), F.col(f"{version}_last")).alias("app_version"),
    )
