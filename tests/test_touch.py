from __future__ import annotations

from conftest import ts
from pyspark.sql import functions as F

from sluice.operators.touch import (
    attribute_reconcile,
    device_type,
    first_last_attribute,
    first_touch,
    first_touch_multi,
    first_touch_sources,
    latest_status_gate,
    resolve_identity,
    status_summary,
    touches_with_ends,
    version_label,
)
from sluice.specs import CORRECTED, Step

LA = "America/Los_Angeles"


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_first_touch_takes_the_earliest_per_step(table):
    events = table(
        "link string, page string, ts timestamp_ntz",
        [
            ("a", "x", "2024-01-01 10:00:00"),
            ("a", "x", "2024-01-01 09:00:00"),
            ("a", "y", "2024-01-01 08:30:00"),
            ("b", "z", "2024-01-01 08:00:00"),
            (None, "x", "2024-01-01 07:00:00"),
        ],
    )
    steps = [Step("x", "page = 'x'"), Step("y", "page = 'y'")]
    assert rows(first_touch(events, "link", steps, zone=LA)) == [("a", ts("2024-01-01 01:00"), ts("2024-01-01 00:30"))]


def test_stacked_sources_equal_separate_ones(table):
    one = table("link string, ts timestamp_ntz", [("a", "2024-01-02 00:00:00"), ("b", "2024-01-03 00:00:00")])
    two = table("uid string, at timestamp_ntz", [("a", "2024-01-01 00:00:00"), (None, "2024-01-01 00:00:00")])
    both = first_touch_sources([(one, "link", [Step("s1")], "ts"), (two, "uid", [Step("s2")], "at")], "link")
    assert rows(both, "link") == [("a", ts("2024-01-02"), ts("2024-01-01")), ("b", ts("2024-01-03"), None)]


def test_identity_is_the_first_id_present(table):
    events = table("l string, r string, u string", [(None, "r1", "u1"), ("l2", None, "u2"), (None, None, "u3"), (None, None, None)])
    resolved = resolve_identity(events, ["l", "r", "u"], "id")
    assert [r["id"] for r in resolved.collect()] == ["r1", "l2", "u3", None]


def test_multi_first_touch_in_the_fold_hour(table):
    """Wall clocks compared: 09:10Z (01:10) is before 08:50Z (01:50). Corrected, the order in UTC counts."""
    shifts = table("e string, c timestamp_ntz", [("a", "2024-11-03 08:50:00"), ("a", "2024-11-03 09:10:00")])
    assert rows(first_touch_multi(shifts, "e", {"c": "c"}, LA)) == [("a", ts("2024-11-03 01:10"))]
    assert rows(first_touch_multi(shifts, "e", {"c": "c"}, LA, CORRECTED)) == [("a", ts("2024-11-03 01:50"))]


HISTORY = [
    ("a", "created", "2024-01-01 10:00:00", 1),
    ("a", "approved", "2024-01-02 10:00:00", 2),
    ("a", "declined", "2024-01-03 10:00:00", 3),
    ("a", "approved", "2024-01-04 10:00:00", 4),
    ("b", "approved", "2024-01-01 10:00:00", 1),
    ("b", "declined", "2024-01-02 10:00:00", 2),
    ("b", "approved", None, 3),
]
HISTORY_SCHEMA = "reference_id string, status string, updated_at timestamp_ntz, seq bigint"


def test_status_summary(table):
    summary = status_summary(table(HISTORY_SCHEMA, HISTORY), "reference_id", zone=LA)
    assert rows(summary, "reference_id") == [
        ("a", "created", ts("2024-01-01 10:00"), ts("2024-01-02 10:00"), ts("2024-01-03 10:00"), "approved", ts("2024-01-04 02:00")),
        ("b", "approved", ts("2024-01-01 10:00"), ts("2024-01-01 10:00"), ts("2024-01-02 10:00"), "declined", ts("2024-01-02 02:00")),
    ]


def test_status_summary_first_times_can_be_local(table):
    summary = status_summary(table(HISTORY_SCHEMA, HISTORY), "reference_id", zone=LA, quirks=CORRECTED)
    assert summary.orderBy("reference_id").first()["first_updated_at"] == ts("2024-01-01 02:00")


def test_equal_times_are_decided_by_the_tie_break(table):
    history = table(HISTORY_SCHEMA, [("a", "x", "2024-01-01 00:00:00", 2), ("a", "y", "2024-01-01 00:00:00", 1)])
    summary = status_summary(history, "reference_id", tie_break=["seq"]).first()
    assert (summary["first_status"], summary["last_status"]) == ("y", "x")


def test_gate_needs_approval_as_latest_status(table):
    history = table(HISTORY_SCHEMA, HISTORY)
    summary = status_summary(history, "reference_id", zone=LA)
    assert rows(latest_status_gate(summary, "reference_id", "at")) == [("a", ts("2024-01-04 02:00"))]
    summary = status_summary(history, "reference_id", zone=LA, quirks=CORRECTED)
    corrected = latest_status_gate(summary, "reference_id", "at", zone=LA, quirks=CORRECTED)
    assert rows(corrected) == [("a", ts("2024-01-02 02:00"))]


def test_first_and_last_attributes_come_from_the_same_events(table):
    events = table(
        "link string, ts timestamp_ntz, id bigint, os string, v string",
        [
            ("a", "2024-01-01 00:00:00", 2, "Web", "1"),
            ("a", "2024-01-01 00:00:00", 1, "iOS", None),
            ("a", "2024-01-02 00:00:00", 3, "Android", "2"),
            ("a", "2024-01-03 00:00:00", 4, None, "3"),
            ("b", None, 5, "iOS", "1"),
        ],
    )
    ends = first_last_attribute(events, "link", ["os", "v"], tie_break=["id"], where="os is not null")
    assert rows(ends.select("link", "os_first", "v_first", "os_last", "v_last")) == [("a", "iOS", None, "Android", "2")]


def test_reconciled_attributes(table):
    ends = table(
        "first string, last string",
        [("iOS", "Android"), ("Android", "Android"), ("X", "Y"), (None, None), ("Android", "iOS"), ("X", None)],
    )
    devices = [r[0] for r in ends.select(device_type(F.col("first"), F.col("last"))).collect()]
    assert devices == ["iOS", "Android", "X-Y", None, "iOS", None]
    versions = [r[0] for r in ends.select(version_label(F.col("first"), F.col("last"))).collect()]
    assert versions == ["iOS-Android", "Android", "X-Y", None, "Android-iOS", None]


def test_reconcile_names(table):
    ends = table("link string, os_name_first string, app_version_first string, os_name_last string, app_version_last string",
                 [("a", "iOS", "1", "iOS", "2")])
    assert rows(attribute_reconcile(ends, "link")) == [("a", "iOS", "1-2")]


def test_ends_come_with_the_touches(table):
    """One aggregate gives what the first touches and the ends give by themselves."""
    submitted = table(
        "link string, page string, ts timestamp_ntz, os string, version string",
        [
            ("a", "v", "2024-01-02 10:00:00", "iOS", "1"), ("a", "v", "2024-01-01 10:00:00", "Android", None), ("a", "c", "2023-12-01 10:00:00", "Web", "9"),
            ("a", "other", "2023-11-01 10:00:00", "Web", "0"), ("b", "v", "2024-01-01 10:00:00", None, "1"), ("b", "v", None, "iOS", "3"), ("c", "c", "2024-01-03 10:00:00", "iOS", "1"),
            ("d", "v", "2024-01-01 10:00:00", "x", "2"), ("d", "v", "2024-01-01 10:00:00", "x", "1"), (None, "v", "2024-01-01 10:00:00", "x", "1"), ("e", "other", "2024-01-01 10:00:00", "iOS", "1"),
        ],
    )
    rendered = table("id string, ts timestamp_ntz", [("a", "2024-01-05 00:00:00"), ("f", "2024-01-04 00:00:00"), (None, "2024-01-01 00:00:00")])
    steps = [Step("v", "page = 'v'"), Step("c", "page = 'c'")]
    where = "page = 'v' and os is not null"
    sources = [(rendered, "id", [Step("seen")], "ts"), (submitted, "link", steps, "ts")]
    found = touches_with_ends(sources, "link", 1, ["os", "version"], where, LA)
    separate = first_touch_sources(sources, "link", LA).join(first_last_attribute(submitted, "link", ["os", "version"], where=where), "link", "left")
    assert found.columns == separate.columns and rows(found, "link") == rows(separate, "link")
    assert {r["link"]: (r["os_first"], r["version_first"], r["os_last"], r["version_last"]) for r in found.collect()}["a"] == ("Android", None, "iOS", "1")


def test_ends_may_be_of_events_that_no_step_takes(table):
    submitted = table("link string, page string, ts timestamp_ntz, os string", [("a", "v", "2024-01-02 10:00:00", "iOS"), ("b", "w", "2024-01-02 10:00:00", "x")])
    found = touches_with_ends([(submitted, "link", [Step("w", "page = 'w'")], "ts")], "link", 0, ["os"], "page = 'v'")
    assert rows(found, "link") == [("a", None, "iOS", "iOS"), ("b", ts("2024-01-02 10:00"), None, None)]
