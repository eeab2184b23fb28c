from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from conftest import ts

from sluice.operators import impressions
from sluice.operators.impressions import daily_impressions, gated_impressions, impression_events, impression_rollup
from sluice.specs import CORRECTED, REPRODUCE

LA = "America/Los_Angeles"
ENTITIES = "entity_id string, oriented_at timestamp_ntz"
HOME = "entity_id string, user_id string, received_at timestamp_ntz, busyness string"


def gate(table, home, entities, **options):
    quirks = {k: v for k, v in options.items() if k == "quirks"}
    events = impression_events("home", table(HOME, home), "received_at", gate_id="user_id", **quirks)
    found = gated_impressions(events, table(ENTITIES, entities), zone=LA, **options)
    return [tuple(r)[1:] for r in found.orderBy("entity_id").collect()]


def test_only_impressions_from_the_milestone_on_count(table):
    home = [
        ("a", " a ", "2024-01-01 09:00:00", "BUSY"),
        ("a", "a", "2024-01-01 10:00:00", "Normal"),
        ("a", "a", "2024-01-01 11:00:00", "Very_Busy"),
        ("b", "b", "2024-01-01 10:00:00", "busy"),
        ("c", "c", None, "busy"),
    ]
    found = gate(table, home, [("a", "2024-01-01 10:00:00"), ("b", None), ("c", "2024-01-01 00:00:00")])
    assert found == [("a", ts("2024-01-01 02:00"), "normal", 1, 2)]


def test_gate_uses_the_user_id_unless_corrected(table):
    home = [("a", "b", "2024-01-01 10:00:00", "busy")]
    entities = [("a", "2024-01-02 00:00:00"), ("b", "2024-01-01 00:00:00")]
    assert gate(table, home, entities) == [("a", ts("2024-01-01 02:00"), "busy", 1, 1)]
    assert gate(table, home, entities, quirks=CORRECTED) == []


def test_gate_compares_wall_clocks_unless_corrected(table):
    home = [("a", "a", "2024-11-03 09:10:00", "busy")]
    entities = [("a", "2024-11-03 08:50:00")]
    assert gate(table, home, entities) == []
    assert len(gate(table, home, entities, quirks=CORRECTED)) == 1


def test_rollup_of_two_sources(table):
    gated = table(
        "source string, entity_id string, first_impression_time timestamp_ntz, first_impression_busyness string, "
        "busy_impression_freq bigint, total_impression_freq bigint",
        [
            ("home", "a", "2024-01-02 00:00:00", "busy", 2, 3),
            ("access", "a", "2024-01-01 00:00:00", "normal", 0, 4),
            ("home", "b", "2024-01-02 00:00:00", None, 0, 1),
            ("access", "b", "2024-01-01 00:00:00", "full", 0, 1),
        ],
    )
    kept = [tuple(r) for r in impression_rollup(gated).orderBy("entity_id", "first_impression_busyness_bucket").collect()]
    assert kept == [
        ("a", ts("2024-01-02"), "busy", 2, 3, "has_busy_impression", "busy"),
        ("a", ts("2024-01-01"), "normal", 0, 4, "no_busy_impression", "not_busy"),
        ("b", ts("2024-01-01"), "full", 0, 2, "no_busy_impression", "not_busy"),
    ]
    corrected = [tuple(r) for r in impression_rollup(gated, quirks=CORRECTED).orderBy("entity_id").collect()]
    assert corrected == [
        ("a", ts("2024-01-01"), "normal", 2, 7, "has_busy_impression", "not_busy"),
        ("b", ts("2024-01-01"), "full", 0, 2, "no_busy_impression", "not_busy"),
    ]


def wall(at: datetime) -> datetime:
    return at.replace(tzinfo=ZoneInfo("UTC")).astimezone(ZoneInfo(LA)).replace(tzinfo=None)


@pytest.mark.parametrize("chunk_bits", [20, 2, 0])
@pytest.mark.parametrize("quirks", [REPRODUCE, CORRECTED])
def test_days_and_single_times_equal_row_by_row(table, monkeypatch, chunk_bits, quirks):
    """Around the hour that a clock repeats, on the milestone's day and others, with repeated milestones and missing values."""
    monkeypatch.setattr(impressions, "CHUNK_BITS", chunk_bits)
    pick = random.Random(chunk_bits)
    start = datetime(2024, 11, 2, 20)
    ids = ["a", "b", "c", "d", None]
    home = [
        (pick.choice(ids), pick.choice([" a", "b ", "c", "zz", None]), pick.choice([None, *[start + timedelta(minutes=pick.randrange(0, 2400, 30))] * 9]), pick.choice(["BUSY", "low", "very_busy", None]))
        for _ in range(400)
    ]
    entities = [("a", start + timedelta(hours=12, minutes=30)), ("a", start + timedelta(hours=13)), ("b", start), ("c", None), ("d", start + timedelta(hours=36)), ("zz", start + timedelta(hours=13, minutes=30))]
    compared = wall if quirks.compare_in_local_time else lambda at: at
    rows = defaultdict(list)
    for entity, user, at, value in home:
        gate_id = user if quirks.gate_on_user_id else entity
        for e, reached in entities:
            if at is not None and reached is not None and gate_id is not None and gate_id.strip() == e and compared(at) >= compared(reached):
                rows[entity].append((at, (value or "").lower() or None))
    expected = []
    for entity, found in rows.items():
        first = min(found, key=lambda x: (x[0], x[1] is not None, x[1] or ""))
        expected.append((entity, wall(first[0]), first[1], sum(v in ("busy", "very_busy") for _, v in found), len(found)))
    own = gated_impressions(impression_events("home", table(HOME, home), "received_at", gate_id="user_id", quirks=quirks), table(ENTITIES, entities), zone=LA, quirks=quirks)
    assert sorted((tuple(r)[1:] for r in own.collect()), key=str) == sorted(expected, key=str)


def test_lists_of_times_are_bounded(spark, monkeypatch):
    """An id's day in a scan task is as many rows as chunks, whatever their number of impressions."""
    monkeypatch.setattr(impressions, "CHUNK_BITS", 8)
    home = spark.range(0, 4000, 1, 2).selectExpr("'hot' entity_id", "'hot' user_id", "timestamp_ntz'2024-01-01 12:00:00' received_at", "'busy' busyness")
    daily = daily_impressions(impression_events("home", home, "received_at", gate_id="user_id"), LA)
    sizes = [len(r["times"]) for r in daily.select("times").collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 256
