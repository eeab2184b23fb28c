"""Daily applicants by waitlist membership."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.segments import daily_membership_counts, membership_flag
from sluice.specs import Rule


def waitlist_report(
    applicants: DataFrame, rendered: DataFrame, rules: Sequence[Rule], first_day: date, last_day: date
) -> DataFrame:
    """Distinct applicants per application day and flag. Grain: one row per day and flag.

    The date range is applied before the join, so only its applicants are shuffled.
    """
    in_range = applicants.filter(F.col("applied_date").between(F.lit(first_day), F.lit(last_day)))
    flagged = membership_flag(in_range.select("applicant_id", "link", "applied_date"), rendered, "link", rules)
    return daily_membership_counts(flagged, first_day, last_day)
