from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sluice import schemas
from sluice.operators.cohort import (
    APPLIED_IN_WEEK,
    activation_week_access,
    activation_week_assignments,
    cohort_assign_all,
    cohort_assign_l7d,
    cohort_changes,
    cohort_conversion,
    cohort_conversion_all,
    cohort_conversion_rollup,
    cohort_label,
    week_sequence,
    week_spine,
)
from sluice.sources.storage import publish
from sluice.specs import CORRECTED, Measure

START, AS_OF = date(2024, 1, 1), date(2024, 3, 13)
FUNNEL = "applicant_id bigint, applied_date timestamp_ntz, first_dash_date date"


def random_funnel(table, n=600, seed=3):
    rng = random.Random(seed)

    def applied():
        day = datetime(2023, 5, 1) + timedelta(days=rng.randrange(400))
        return rng.choice([None, day, day, day + timedelta(seconds=rng.randrange(86400))])

    def dashed():
        return rng.choice([None, date(2023, 6, 1) + timedelta(days=rng.randrange(330))])

    return table(FUNNEL, [(i, applied(), dashed()) for i in range(n)])


def test_week_spine(table):
    days = table("d timestamp_ntz", [("2024-01-07 23:59:59",), ("2024-01-01 00:00:00",), ("2024-01-15 00:00:00",), ("2023-12-31 00:00:00",), (None,)])
    weeks = week_spine(days, "d", START, date(2024, 1, 15)).orderBy("week_start").collect()
    assert [tuple(map(str, r)) for r in weeks] == [("2024-01-01", "2024-01-07"), ("2024-01-15", "2024-01-21")]


def test_week_sequence_starts_at_the_first_monday(spark):
    weeks = spark.range(1).select(week_sequence(date(2024, 1, 3), date(2024, 1, 17)), week_sequence(date(2024, 1, 3), date(2024, 1, 5))).first()
    assert [str(d) for d in weeks[0]] == ["2024-01-08", "2024-01-15"]
    assert weeks[1] == []


def test_cohort_labels(table):
    rows = table(
        "applied timestamp_ntz, dashed date",
        [
            ("2024-01-08 00:00:00", None),
            ("2024-01-14 10:00:00", None),
            ("2024-01-07 10:00:00", None),
            ("2023-12-09 00:00:00", "2024-01-08"),
            ("2023-12-08 00:00:00", None),
            ("2023-07-12 00:00:00", None),
            ("2023-07-11 00:00:00", None),
            ("2024-01-08 00:00:00", "2024-01-07"),
            (None, None),
        ],
    )
    labels = [r[0] for r in rows.select(cohort_label(F.lit(date(2024, 1, 8)), F.col("applied"), F.col("dashed"))).collect()]
    # 10:00 on a boundary day is after that day's midnight: outside this range, and in none before or after.
    assert labels == [
        "1. Applied L7D", "Applied After Measurement Period", "Unmapped", "2. Applied 7D-30D", "3. Applied 30D-180D",
        "3. Applied 30D-180D", "4. Applied 180D+", "Unmapped", "Unmapped",
    ]


def naive_labels(spark, funnel):
    weeks = spark.range(1).select(F.explode(week_sequence(START, AS_OF)).alias("week_start"))
    label = cohort_label(F.col("week_start"), F.col("applied_date"), F.col("first_dash_date"))
    return weeks.crossJoin(funnel).withColumn("cohort", label)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_counts_per_cohort_equal_every_week_against_every_applicant(spark, table):
    funnel = random_funnel(table)
    naive = naive_labels(spark, funnel).groupBy("week_start", "cohort").agg(F.count_distinct("applicant_id").alias("applicants"))
    assert naive.select("cohort").distinct().count() == 6
    assert same(cohort_assign_all(funnel, START, AS_OF), naive)


def test_applied_week_equals_every_week_against_every_applicant(spark, table):
    funnel = random_funnel(table)
    columns = ["week_start", "applicant_id", "applied_date", "first_dash_date", "cohort"]
    naive = naive_labels(spark, funnel).filter(F.col("cohort") == APPLIED_IN_WEEK).select(columns)
    found = cohort_assign_l7d(funnel, START, AS_OF).select(columns)
    assert naive.count() > 20 and same(found, naive)


def test_applied_late_on_the_last_day_counts_only_when_corrected(table):
    funnel = table(FUNNEL, [(1, "2024-01-07 10:00:00", None), (2, "2024-01-07 00:00:00", "2024-01-01"), (3, "2024-01-03 00:00:00", "2023-12-31")])
    assert [r["applicant_id"] for r in cohort_assign_l7d(funnel, START, AS_OF).collect()] == [2]
    corrected = cohort_assign_l7d(funnel, START, AS_OF, quirks=CORRECTED).orderBy("applicant_id").collect()
    assert [r["applicant_id"] for r in corrected] == [1, 2]


ACTIVATIONS = "entity_id string, account_activation timestamp_ntz"


def test_activation_week_access(table):
    access = table(
        "entity_id string, active_date date, is_dash_now int",
        [("a", "2024-01-01", 1), ("a", "2024-01-07", 0), ("a", "2024-01-08", 1), ("b", "2024-01-02", None), (None, "2024-01-01", 1)],
    )
    funnel = table(ACTIVATIONS, [("a", "2024-01-03 10:00:00"), ("a", "2024-01-04 10:00:00"), ("b", "2024-01-02 00:00:00"), ("c", None)])
    found = [tuple(r) for r in activation_week_access(access, funnel).orderBy("entity_id").collect()]
    assert found == [("a", 4, 2, 0.5), ("b", 1, None, None)]
    corrected = activation_week_access(access, funnel, quirks=CORRECTED).orderBy("entity_id").collect()
    assert [tuple(r) for r in corrected] == [("a", 2, 1, 0.5), ("b", 1, None, None)]


def test_activation_week_assignments_use_the_local_week(table):
    assignments = table(
        "entity_id string, created_at timestamp_ntz, accepted_at timestamp_ntz, unassigned_at timestamp_ntz",
        [
            ("a", "2024-01-08 07:59:00", "2024-01-08 08:00:00", None),
            ("a", "2024-01-08 08:00:00", "2024-01-08 08:00:00", None),
            ("a", "2024-01-02 00:00:00", "2024-01-02 00:00:00", "2024-01-02 00:05:00"),
            ("a", None, None, None),
        ],
    )
    funnel = table(ACTIVATIONS, [("a", "2024-01-03 10:00:00")])
    found = activation_week_assignments(assignments, funnel, "America/Los_Angeles").collect()
    assert [tuple(r) for r in found] == [("a", 2, 0.5)]


def test_conversions_equal_distinct_counts(spark):
    """Two levels against plain distinct counts, with applicants repeated and entities shared."""
    rows = spark.range(3000).select(
        (F.col("id") % 3).alias("segment"),
        F.lit(START).alias("week_start"),
        F.date_add(F.lit(START), 6).alias("week_end"),
        F.when(F.col("id") % 31 != 0, F.col("id") % 700).alias("applicant"),
        F.when(F.col("id") % 37 != 0, F.concat(F.lit("e"), F.col("id") % 500)).alias("entity"),
        F.expr("case when id % 5 < 3 then date_add(date'2023-12-30', cast(id % 13 as int)) end").alias("a"),
        F.expr("case when id % 4 = 0 then date_add(date'2023-12-30', cast(id % 11 as int)) end").alias("b"),
        F.expr("case when id % 7 < 4 then id % 5 end").alias("assignment_creation_cnt"),
        F.expr("(id % 3) / 4").alias("acceptance_rate"),
        F.expr("case when id % 2 = 0 then (id % 9) / 8 end").alias("dash_now_impression_rate"),
    )
    in_a = F.coalesce(F.col("a").between(F.col("week_start"), F.col("week_end")), F.lit(False))
    in_b = F.coalesce(F.col("b").between(F.col("week_start"), F.col("week_end")), F.lit(False))
    found = cohort_conversion(
        rows, ["segment"], "applicant", "entity",
        [Measure("m1", "a"), Measure("m2", "coalesce(b, a)"), Measure("m3", "a", "assignment_creation_cnt > 0")],
        delivery=in_b, activated=in_a,
    )
    either = F.coalesce(F.coalesce("b", "a").between(F.col("week_start"), F.col("week_end")), F.lit(False))
    expected = rows.groupBy("segment").agg(
        F.count_distinct("applicant").alias("applicants"),
        F.count_distinct(F.when(in_a, F.col("applicant"))).alias("m1"),
        F.count_distinct(F.when(either, F.col("applicant"))).alias("m2"),
        F.count_distinct(F.when(in_a & (F.col("assignment_creation_cnt") > 0), F.col("applicant"))).alias("m3"),
        F.sum(F.when(in_a, F.col("assignment_creation_cnt"))).alias("assignment_creation_cnt"),
        F.sum(F.when(in_a, F.col("assignment_creation_cnt") * F.col("acceptance_rate"))).alias("assignment_accepted_cnt"),
        F.avg(F.when(in_a, F.col("dash_now_impression_rate"))).alias("dash_now_access_rate"),
        F.count_distinct(F.when(in_b, F.col("entity"))).alias("first_delivery"),
    )
    assert [tuple(r) for r in found.orderBy("segment").collect()] == [tuple(r) for r in expected.orderBy("segment").collect()]


def test_rollup_sums_and_takes_the_rates_anew(table):
    """The keys are coarser than the segments: two segments of one week give one row."""
    conversions = table(
        "week_start date, segment string, applicants bigint, assignment_creation_cnt bigint, assignment_accepted_cnt double, "
        "dash_now_access_rate double, dash_now_access_rate_sum double, dash_now_access_rate_rows bigint",
        [
            ("2024-01-01", "a", 3, 4, 1.0, 0.5, 1.0, 2), ("2024-01-01", "b", 2, 4, 3.0, 0.2, 1.6, 8), ("2024-01-08", "a", 3, 0, 0.0, None, None, 0),
            ("2024-01-15", "a", 3, None, None, None, None, None),
        ],
    )
    counts = ["applicants", "assignment_creation_cnt", "assignment_accepted_cnt"]
    found = cohort_conversion_rollup(conversions, ["week_start"], counts).orderBy("week_start")
    assert found.columns == ["week_start", *counts, "dash_now_access_rate", "acceptance_rate"]
    assert [tuple(r)[1:] for r in found.collect()] == [(5, 8, 4.0, 0.26, 0.5), (3, 0, 0.0, None, 0.0), (3, None, None, None, None)]




def test_changes_do_not_grow_with_the_weeks(spark, table):
    """A combination of dates changes its cohort a few times, over a month of weeks or a century."""
    funnel = random_funnel(table)
    pairs = funnel.select("applied_date", "first_dash_date").distinct().count()
    few = cohort_changes(funnel, START, AS_OF)
    century = cohort_changes(funnel, date(1970, 1, 1), date(2070, 1, 1))
    assert few.count() <= 6 * len(spark.range(1).select(F.explode(week_sequence(START, AS_OF))).collect()) + 6
    assert century.agg(F.sum(F.abs("pairs"))).first()[0] <= 2 * 10 * pairs + 1
    # All who ever are in a cohort leave it, but for the last ones.
    assert century.filter("cohort <> 'Unmapped'").agg(F.sum("pairs")).first()[0] >= 0


@pytest.mark.parametrize(("start", "as_of"), [(START, AS_OF), (date(2023, 6, 1), date(2024, 9, 3)), (date(2024, 1, 3), date(2024, 1, 4)), (date(2024, 2, 1), date(2024, 1, 1))])
def test_sweep_at_every_boundary(spark, table, start, as_of):
    """Applied and converted at midnight, inside a day, on all days around the classes' limits, with and without ids."""
    days = [date(2024, 1, 1) + timedelta(days=d) for d in (-190, -182, -181, -180, -179, -38, -37, -32, -31, -30, -8, -7, -2, -1, 0, 1, 5, 6, 7, 8, 30, 60)]
    rows = []
    for i, d in enumerate(days):
        for hour in (0, 10):
            for converted in (None, d, d + timedelta(days=3), d + timedelta(days=40), date(2023, 1, 1)):
                rows.append((None if i == 3 else len(rows) // 2, f"{d}T{hour:02}:00:00", None if converted is None else str(converted)))
    rows += [(900, None, None), (901, None, "2024-01-05"), (None, None, None)]
    funnel = table(FUNNEL, rows)
    weeks = spark.range(1).select(F.explode(week_sequence(start, as_of)).alias("week_start"))
    label = cohort_label(F.col("week_start"), F.col("applied_date"), F.col("first_dash_date"))
    found = cohort_assign_all(funnel, start, as_of)
    # One applicant may have several rows here, so ids are counted per row on both sides.
    naive = weeks.crossJoin(funnel.distinct()).withColumn("cohort", label).groupBy("week_start", "cohort").agg(F.count("applicant_id").alias("applicants"))
    assert same(found, naive)


def test_conversions_of_all_cohorts_equal_every_week_against_every_applicant(spark, table):
    pick = random.Random(5)
    funnel = random_funnel(table).select("*", *[(F.col("applied_date") + F.make_dt_interval(F.lit(pick.randint(0, 50)))).alias(c) for c in ("a", "b")])
    funnel = funnel.withColumn("b", F.when(F.col("applicant_id") % 3 > 0, F.col("b")))
    measures = [Measure("a", "a"), Measure("either", "coalesce(b, a)"), Measure("both", "a", "b is not null")]
    label = cohort_label(F.col("week_start"), F.col("applied_date"), F.col("first_dash_date"))
    weekly = spark.range(1).select(F.explode(week_sequence(START, AS_OF)).alias("week_start")).crossJoin(funnel).withColumn("cohort", label)
    inside = {m.name: F.expr(m.value).cast("date").between(F.col("week_start"), F.date_add("week_start", 6)) & (F.expr(m.extra) if m.extra else F.lit(True)) for m in measures}
    naive = weekly.groupBy("week_start", "cohort").agg(
        F.count_distinct("applicant_id").alias("applicants"), *[F.count_distinct(F.when(c, F.col("applicant_id"))).alias(name) for name, c in inside.items()]
    )
    found = cohort_conversion_all(funnel, measures, START, AS_OF)
    assert same(found, naive) and found.agg(F.sum("either")).first()[0] > 20
    assert found.filter("cohort <> '1. Applied L7D' AND a > 0").count() > 0
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in text and "Join Inner" not in text  # weeks meet cohorts, never applicants


def test_funnel_by_month_is_pruned(spark, table, tmp_path):
    funnel = random_funnel(table)
    laid_out = publish(funnel, f"{tmp_path}/funnel", layout=schemas.BY_APPLIED_MONTH)
    found = cohort_assign_l7d(laid_out, START, AS_OF)
    assert "PartitionFilters: [isnotnull(applied_month" in found._jdf.queryExecution().executedPlan().toString()
    assert same(found, cohort_assign_l7d(funnel, START, AS_OF))
    assert sorted(laid_out.columns) == sorted([*funnel.columns, "applied_month"])
    assert same(laid_out.drop("applied_month"), funnel)
