"""Wide one-row-per-applicant relations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.joins import left_join_all
from sluice.operators.touch import first_touch
from sluice.specs import Step


Parts = dict[str, Sequence[DataFrame]]


def _with_parts(left: DataFrame, parts: Parts, spread_by: Sequence[str]) -> DataFrame:
    return reduce(lambda wide, key: left_join_all(wide, key, parts[key], spread_by), parts, left)


def wide_funnel(spine: DataFrame, parts: Parts) -> DataFrame:
    """Spine rows with the columns of every part; ``parts`` holds the relations joined on each key.

    The result has no two equal rows. Only the narrow spine is de-duplicated for that: a part has at most
    one row per key and grouping value, so distinct spine rows stay distinct in the wide result, and the
    wide rows need no shuffle of their own. Grain: one row per spine row and matching part row.
    """
    return _with_parts(spine.dropDuplicates(), parts, spine.columns)


def event_type_pivot_funnel(
    spine: DataFrame,
    events: DataFrame,
    spine_key: str,
    event_key: str,
    steps: Sequence[Step],
    required: str,
    where: Column | None = None,
    ts: str = "created_at",
    zone: str | None = None,
    parts: Parts | None = None,
) -> DataFrame:
    """One timestamp column per event type for the spine rows that reached the step ``required``.

    All event types come from one scan and one aggregate. Entities without the required step are dropped
    before the join, which Catalyst turns into an inner join. Grain: one row per spine row kept.
    """
    used = events if where is None else events.filter(where)
    touched = first_touch(used, event_key, steps, ts, zone).withColumnRenamed(event_key, spine_key)
    reached = left_join_all(spine, spine_key, [touched], spine.columns).filter(F.col(required).isNotNull())
    return _with_parts(reached, parts or {}, spine.columns)
