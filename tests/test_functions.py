from __future__ import annotations

import pytest
from conftest import ts
from pyspark.sql import functions as F

from sluice.functions import local_time, minus_minutes, minutes_between, month_start, safe_ratio, week_start


def test_minutes_count_boundaries(table):
    rows = table(
        "a timestamp_ntz, b timestamp_ntz",
        [
            ("2024-01-01 00:00:59", "2024-01-01 00:01:01"),
            ("2024-01-01 00:00:00", "2024-01-01 00:00:59.999999"),
            ("2024-01-01 00:01:01", "2024-01-01 00:00:59"),
            ("2023-12-31 23:59:30", "2024-01-02 00:00:10"),
        ],
    )
    assert [r[0] for r in rows.select(minutes_between(F.col("a"), F.col("b"))).collect()] == [1, 0, -1, 1441]


def test_minutes_accept_dates(table):
    rows = table("a date, b timestamp_ntz", [("2024-01-01", "2024-01-01 10:00:00")])
    assert rows.select(minutes_between(F.col("a"), F.col("b"))).first()[0] == 600


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_times_do_not_depend_on_the_session_zone(spark, table, zone):
    """The night of 2024-03-10 has no 02:30 in Los Angeles; wall clocks must not notice."""
    before = spark.conf.get("spark.sql.session.timeZone")
    rows = table("a timestamp_ntz, b timestamp_ntz", [("2024-03-10 01:30:00", "2024-03-10 03:30:00")])
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        a, b = F.col("a"), F.col("b")
        result = rows.select(
            minutes_between(a, b), minus_minutes(b, F.lit(60.0)), local_time(b, "Europe/Berlin"), week_start(b)
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(result) == (120, ts("2024-03-10 02:30"), ts("2024-03-10 04:30"), ts("2024-03-04").date())


def test_fractional_minutes_are_rounded(table):
    rows = table("a timestamp_ntz, m double", [("2024-01-01 00:10:00", 1.6), ("2024-01-01 00:10:00", 2.5), ("2024-01-01 00:10:00", None)])
    moved = [r[0] for r in rows.select(minus_minutes(F.col("a"), F.col("m"))).collect()]
    assert moved == [ts("2024-01-01 00:08"), ts("2024-01-01 00:07"), None]


def test_dst_fold_repeats_the_hour(table):
    rows = table("a timestamp_ntz", [("2024-11-03 08:50:00",), ("2024-11-03 09:10:00",)])
    local = [r[0] for r in rows.select(local_time(F.col("a"), "America/Los_Angeles")).collect()]
    assert local == [ts("2024-11-03 01:50"), ts("2024-11-03 01:10")]


def test_weeks_and_months(table):
    rows = table("a timestamp_ntz", [("2024-12-29 23:59:59",), ("2024-12-30 00:00:00",)])
    found = [tuple(map(str, r)) for r in rows.select(week_start(F.col("a")), month_start(F.col("a"))).collect()]
    assert found == [("2024-12-23", "2024-12-01"), ("2024-12-30", "2024-12-01")]


def test_safe_ratio(table):
    rows = table("a bigint, b bigint", [(0, 0), (5, 0), (None, 2), (None, 0), (3, None), (1, 4)])
    assert [r[0] for r in rows.select(safe_ratio(F.col("a"), F.col("b"))).collect()] == [0, 0, None, None, None, 0.25]
