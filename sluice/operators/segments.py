"""Segment labels: memberships, quality, duplicate contacts, region and device."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.joins import left_join_all
from sluice.specs import Contact, RegionRule, Rule


def _any(rules: Sequence[Rule]) -> Column:
    return reduce(or_, [F.expr(r.where) for r in rules])


def membership_sets(events: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """One 0/1 column per rule, for every key with at least one event that satisfies a rule.

    A rule that evaluates to null does not hold. Grain: one row per member key.
    """
    holds = [F.max(F.when(F.expr(r.where), F.lit(1)).otherwise(F.lit(0))).alias(r.name) for r in rules]
    return events.filter(F.col(key).isNotNull() & _any(rules)).groupBy(key).agg(*holds)


def membership_flag(
    spine: DataFrame,
    events: DataFrame,
    key: str,
    rules: Sequence[Rule],
    into: str = "all_waitlist_flag",
    member: str = "Hit Waitlist",
    other: str = "No Waitlist",
) -> DataFrame:
    """Spine rows labelled by whether any rule holds for their key.

    Only the union of the rules matters here, so one distinct key list and one join replace a join per
    rule. Grain: the spine's.
    """
    members = events.filter(_any(rules)).select(key).distinct().withColumn("_member", F.lit(True))
    label = F.when(F.col("_member"), member).otherwise(other)
    return left_join_all(spine, key, [members], spine.columns).withColumn(into, label).drop("_member")


def daily_membership_counts(
    flagged: DataFrame,
    first_day: date,
    last_day: date,
    day: str = "applied_date",
    flag: str = "all_waitlist_flag",
    entity: str = "applicant_id",
    into: str = "applicants_cnt",
) -> DataFrame:
    """Distinct entities per day and flag, both ends of the date range included."""
    in_range = flagged.filter(F.col(day).between(F.lit(first_day), F.lit(last_day)))
    return in_range.groupBy(day, flag).agg(F.count_distinct(entity).alias(into))


def risk_bucket(linkage: DataFrame, entity: str, rule_sets: dict[str, Sequence[Rule]]) -> DataFrame:
    """One 'bad'/'good' label per rule set: 'bad' when any of its rules holds.

    A rule that evaluates to null does not hold. Grain: one row per distinct entity and labels.
    """
    labels = [F.when(_any(rules), "bad").otherwise("good").alias(name) for name, rules in rule_sets.items()]
    return linkage.select(entity, *labels).distinct()


def shared_contacts(applicants: DataFrame, contact: Contact = Contact()) -> DataFrame:
    """Contacts used by more than one applicant, with the first application date.

    Applicants without a contact form a group too (K23). Grain: one row per shared contact.
    """
    groups = applicants.groupBy(contact.column).agg(
        F.min(contact.date).alias("first_applied_date"), F.count_distinct(contact.entity).alias("applicant_count")
    )
    return groups.filter(F.col("applicant_count") > 1)


def duplicate_flag(applicants: DataFrame, shared: DataFrame, contact: Contact = Contact()) -> DataFrame:
    """'Non-Dupe' when the contact is not shared or this is its first application, else 'Dupe'.

    A contact may be shared by a large part of all applicants. It has one row in ``shared``, and nothing
    after the join needs its partitioning, so AQE splits it. Grain: the applicants'.
    """
    firsts = shared.select(contact.column, "first_applied_date", F.lit(True).alias("_shared"))
    label = F.when(F.col("_shared").isNull() | (F.col("first_applied_date") == F.col(contact.date)), "Non-Dupe")
    return (
        left_join_all(applicants, contact.column, [firsts], applicants.columns)
        .withColumn("phone_duplicate_flag", label.otherwise("Dupe"))
        .drop("_shared", "first_applied_date")
    )


def region_flag(submarket: Column, rule: RegionRule) -> Column:
    """'Yes' inside the rule's submarkets, else 'No'."""
    return F.when(submarket.isin(*rule.submarkets), "Yes").otherwise("No")


def region_label(country_id: Column, country_name: Column, submarket: Column, rule: RegionRule) -> Column:
    """Country name, with the rule's country split in two."""
    return F.when(
        country_id == rule.country_id, F.when(submarket.isin(*rule.submarkets), rule.inside).otherwise(rule.outside)
    ).otherwise(country_name)


def device_bucket(device: Column) -> Column:
    """Device type by substring; iOS wins over Android."""
    return F.when(device.contains("iOS"), "1-iOS").when(device.contains("Android"), "2-Android").otherwise("3-Other")
