from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from sluice.operators.segments import (
    daily_membership_counts,
    device_bucket,
    duplicate_flag,
    membership_flag,
    membership_sets,
    region_flag,
    region_label,
    risk_bucket,
    shared_contacts,
)
from sluice.specs import RegionRule, Rule

RULES = [Rule("top", "page = 'top'"), Rule("bottom", "page = 'check' and coalesce(flag, false)"), Rule("raw", "flag")]


def test_a_null_flag_is_no_membership(table):
    events = table(
        "link string, page string, flag boolean",
        [("a", "check", None), ("b", "check", True), ("c", "top", False), ("c", "check", None), (None, "top", True)],
    )
    sets = membership_sets(events, "link", RULES).orderBy("link").collect()
    assert [tuple(r) for r in sets] == [("b", 0, 1, 1), ("c", 1, 0, 0)]
    spine = table("id bigint, link string", [(1, "a"), (2, "b"), (3, "c"), (4, None)])
    flagged = membership_flag(spine, events, "link", RULES).orderBy("id").collect()
    assert [r["all_waitlist_flag"] for r in flagged] == ["No Waitlist", "Hit Waitlist", "Hit Waitlist", "No Waitlist"]


def test_daily_counts_are_distinct_and_include_both_ends(table):
    flagged = table(
        "applicant_id bigint, applied_date date, all_waitlist_flag string",
        [(1, "2024-01-01", "y"), (1, "2024-01-01", "y"), (2, "2024-01-01", "n"), (3, "2024-01-03", "y"), (4, "2024-01-04", "y"), (5, None, "y")],
    )
    counts = daily_membership_counts(flagged, date(2024, 1, 1), date(2024, 1, 3)).collect()
    assert sorted(map(tuple, counts)) == [(date(2024, 1, 1), "n", 1), (date(2024, 1, 1), "y", 1), (date(2024, 1, 3), "y", 1)]


def test_risk_rules_with_nulls(table):
    linkage = table("id bigint, n int, continent string", [(1, 2, "NA"), (2, 1, "EU"), (3, None, None), (3, None, None)])
    sets = {"v1": [Rule("n", "n > 1")], "v2": [Rule("n", "n > 1"), Rule("c", "continent not in ('NA')")]}
    labels = risk_bucket(linkage, "id", sets).orderBy("id").collect()
    assert [tuple(r) for r in labels] == [(1, "bad", "bad"), (2, "good", "bad"), (3, "good", "good")]


def test_shared_contacts_and_duplicates(table):
    applicants = table(
        "applicant_id bigint, phone string, applied_date date",
        [
            (1, "p", "2024-01-01"),
            (2, "p", "2024-01-02"),
            (3, "p", None),
            (4, "q", "2024-01-01"),
            (4, "q", "2024-01-05"),
            (5, None, "2024-01-01"),
            (6, None, "2024-01-02"),
        ],
    )
    shared = shared_contacts(applicants)
    assert set(map(tuple, shared.collect())) == {(None, date(2024, 1, 1), 2), ("p", date(2024, 1, 1), 3)}
    flags = duplicate_flag(applicants, shared).orderBy("applicant_id", "applied_date").collect()
    assert [r["phone_duplicate_flag"] for r in flags] == ["Non-Dupe", "Dupe", "Dupe", *["Non-Dupe"] * 4]


def test_region_and_device_labels(table):
    rule = RegionRule(1, (10, 11), "inside", "outside")
    places = table("country int, name string, submarket int", [(1, "US", 10), (1, "US", 12), (1, "US", None), (2, "CA", 10), (None, None, 1)])
    found = places.select(
        region_flag(F.col("submarket"), rule), region_label(F.col("country"), F.col("name"), F.col("submarket"), rule)
    ).collect()
    assert [tuple(r) for r in found] == [("Yes", "inside"), ("No", "outside"), ("No", "outside"), ("Yes", "CA"), ("No", None)]
    devices = table("d string", [("iOS",), ("Web-iOS",), ("Web-Android",), ("Web-Web",), (None,)])
    buckets = [r[0] for r in devices.select(device_bucket(F.col("d"))).collect()]
    assert buckets == ["1-iOS", "1-iOS", "2-Android", "3-Other", "3-Other"]
