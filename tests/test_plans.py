"""Shapes of the physical plans, and what happens to hot and missing keys."""

from __future__ import annotations

import re
from datetime import date

import pytest
from conftest import ts
from pyspark.sql import functions as F

from sluice import schemas
from sluice.operators.cohort import cohort_assign_l7d, cohort_conversion
from sluice.operators.joins import left_join_all
from sluice.operators.impressions import gated_impressions, impression_events
from sluice.operators.segments import duplicate_flag, membership_sets, shared_contacts
from sluice.operators.touch import first_touch
from sluice.plans import applicant_funnel, cohort_report
from sluice.plans.driver_setup import AS_OF, COHORT, COHORT_START, FUNNEL, MEMBERSHIPS, START
from sluice.plans.variance_report import declines
from sluice.plans.verification_funnel import verification_funnel
from sluice.plans.driver_setup import VERIFICATION
from sluice.queries import QUERIES
from sluice.sources.driver_tables import Tables
from sluice.sources.storage import Staging, publish
from sluice.specs import Measure, Step

FOLDER = "/root/testdata/sf0.001"
#: Queries whose plans hold no written stage.
PLANNED = ("wide_funnel", "step_lag_means", "metric_diffs", "guardrails", "variance_report", "duplicate_flag", "risk_bucket")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def initial(text: str) -> str:
    """The plan before run-time changes."""
    return text.split("== Initial Plan ==")[-1]


def count(text: str, what: str) -> int:
    return len(re.findall(what, initial(text)))


@pytest.fixture(scope="module")
def rendered(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables") / "rendered")
    rows = spark.range(5000).select(
        F.concat(F.lit("l"), F.col("id") % 100).alias("link"),
        F.element_at(F.array(*[F.lit(p) for p in ("check", "vehicle", "other")]), (F.col("id") % 3 + 1).cast("int")).alias("page_id"),
        F.lit("after_vehicle").alias("waitlist_step"),
        F.lit(True).alias("in_experiment"),
        F.lit("unused").alias("payload"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id)").alias("ts"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_all_steps_of_a_source_take_one_pruned_scan(rendered):
    steps = [Step("v", "page_id = 'vehicle'"), Step("c", "page_id = 'check'")]
    text = plan(first_touch(rendered, "link", steps))
    assert count(text, "FileScan") == 1 and count(text, r"Exchange hashpartitioning") == 1
    assert "payload" not in text and "waitlist_step" not in text
    assert re.search(r"PushedFilters: \[.*(In\(page_id|Or\(EqualTo\(page_id)", text)


def test_membership_rules_take_one_scan(rendered):
    text = plan(membership_sets(rendered, "link", MEMBERSHIPS))
    assert count(text, "FileScan") == 1 and "payload" not in text


def test_event_types_take_one_scan(spark):
    text = plan(verification_funnel(Tables(spark, FOLDER), VERIFICATION))
    # The spine's three driver tables, the verification events and the device events.
    assert count(text, "FileScan") == 5


def test_steps_of_all_sources_take_one_shuffle(spark):
    text = plan(applicant_funnel.step_touches(Tables(spark, FOLDER), FUNNEL))
    assert count(text, "Exchange hashpartitioning") == 1 and count(text, "FileScan") == 5


def test_spine_is_shuffled_once_per_key(spark):
    """Without broadcasts: one shuffle of the spine and one of each part, for all four parts and both keys."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(applicant_funnel.all_steps(Tables(spark, FOLDER), FUNNEL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert count(text, r"Exchange hashpartitioning\(_join_key") == 2 + 4


def test_funnel_reads_every_source_once(spark, tmp_path):
    """Each source is scanned once, but for the applicants: they are the spine and hold the milestones."""
    tables = Tables(spark, FOLDER)
    names = ("profile_submitted", "step_rendered", "step_submitted", "idv_steps", "activated", "idv_inquiry", "home_loaded", "access_impressions", "shifts", "applicants")
    written = {}
    for name in names:
        tables[name].write.parquet(f"{tmp_path}/{name}")
        written[name] = spark.read.parquet(f"{tmp_path}/{name}")
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        text = initial(plan(applicant_funnel.all_steps(written, FUNNEL)))
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)
    scans = {name: len(re.findall(rf"FileScan.*{tmp_path}/{name}\b", text)) for name in names}
    assert scans == {name: 2 if name == "applicants" else 1 for name in names}
    found = applicant_funnel.all_steps(written, FUNNEL)
    assert found.exceptAll(applicant_funnel.all_steps(tables, FUNNEL)).isEmpty()


def test_impressions_are_combined_before_they_meet_the_milestones(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["gated_impressions"](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    below = first_below(text, "Exchange hashpartitioning(gate_id", ("HashAggregate", "FileScan"))
    assert "HashAggregate" in below and below.count("FileScan") <= 1  # the other side: the milestones
    assert re.search(r"partial_collect_list\(at", text)


def test_fill_is_a_projection(spark, tmp_path):
    applicant_funnel.all_steps(Tables(spark, FOLDER), FUNNEL).write.parquet(str(tmp_path / "wide"))
    text = plan(applicant_funnel.backfilled_funnel(spark.read.parquet(str(tmp_path / "wide")), FUNNEL))
    outside_subquery = text.split("Subquery")[0]
    assert "Join" not in text and "Exchange" not in outside_subquery.split("== Initial Plan ==")[0]


def test_applied_week_needs_no_join(table):
    funnel = table("applicant_id bigint, applied_date timestamp_ntz, first_dash_date date", [(1, ts("2024-01-02"), None)])
    text = plan(cohort_assign_l7d(funnel, START, AS_OF))
    assert "Join" not in text and "Cartesian" not in text and "Exchange" not in text


def test_conversions_multiply_no_rows(spark):
    rows = spark.range(10).select(
        (F.col("id") % 2).alias("segment"), "id", F.col("id").cast("string").alias("entity"),
        *[F.lit(date(2024, 1, 2)).alias(c) for c in ("week_start", "week_end", "a", "b")],
        *[F.lit(1.0).alias(c) for c in ("assignment_creation_cnt", "acceptance_rate", "dash_now_impression_rate")],
    )
    found = cohort_conversion(rows, ["segment"], "id", "entity", [Measure("a", "a"), Measure("b", "b")], F.lit(True), F.lit(True))
    assert "Expand" not in plan(found)


def test_declines_share_one_partitioning(spark):
    long = spark.range(100).select(
        (F.col("id") % 3).alias("cohort"), (F.col("id") % 2).alias("metric_number"), F.lit("cvr_0_apply_to_fd").alias("metric_name"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") * 7).cast("int")).alias("week_start"),
        F.rand(1).alias("metric_value"),
    )
    text = plan(declines(long))
    assert count(text, "Exchange hashpartitioning") == 1 and "Join" not in text


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_pairs_rows_or_leaves_the_engine(spark, name):
    """No cartesian product or nested loop, and no Python stage."""
    text = plan(QUERIES[name](spark, FOLDER))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "ArrowEval"):
        assert unwanted not in text, f"{unwanted} in {name}"


def first_below(text: str, node: str, stop: tuple[str, ...]) -> list[str]:
    """For each ``node`` of the initial plan, what of ``stop`` comes first below it."""
    lines = initial(text).splitlines()
    depth = [len(line) - len(line.lstrip(" :|+-*()0123456789")) for line in lines]
    found = []
    for i, line in enumerate(lines):
        if node in line:
            below = []
            for j in range(i + 1, len(lines)):
                if depth[j] <= depth[i]:
                    break
                below.append(lines[j])
            found.append(next((s for x in below for s in stop if s in x), ""))
    return found


@pytest.mark.parametrize("name", ["status_summary", "first_last_attribute", "gated_impressions", "attribute_reconcile"])
def test_raw_events_are_hashed_not_sorted(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "HashAggregate" in first_below(text, "Exchange hashpartitioning", ("HashAggregate", "FileScan"))
    below = first_below(text, "SortAggregate", ("Exchange", "FileScan"))
    assert below and set(below) == {"Exchange"}


def test_facts_are_cut_to_activation_weeks_before_they_are_aggregated(spark):
    for name in ("activation_week_access", "activation_week_assignments"):
        text = plan(QUERIES[name](spark, FOLDER))
        # The outermost partial aggregate stands on the join, not on a scan of facts.
        assert first_below(text, "partial_sum(_rows", ("Join", "FileScan"))[0] == "Join"


def test_no_task_takes_all_rows(spark):
    """A single partition only ever holds the one row of an aggregate without keys."""
    for name in PLANNED:
        text = plan(QUERIES[name](spark, FOLDER))
        for below in first_below(text, "SinglePartition", ("Aggregate", "FileScan", "Join", "Window")):
            assert below == "Aggregate", name


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    # As in a session without our settings: a split that costs another shuffle is not taken.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_entity_is_split(spark, small_partitions):
    """One entity with a third of the impressions: its partition is split, and the counts are whole."""
    n = 300_000
    home = spark.range(0, n, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("e"), F.col("id") % 5000)).alias("entity_id"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id)").alias("received_at"),
        F.when(F.col("id") % 2 == 0, "Busy").otherwise("full").alias("busyness"),
    ).withColumn("user_id", F.concat(F.lit(" "), F.col("entity_id")))
    entities = home.select("entity_id").distinct().withColumn("oriented_at", F.lit(ts("2024-01-01 08:00:00")))
    events = impression_events("home", home, "received_at", gate_id="user_id")
    found = gated_impressions(events, entities, zone="America/Los_Angeles")
    rows = {r["entity_id"]: r for r in found.collect()}
    assert "skew=true" in plan(found)
    # Seconds 28,800 to 299,999 qualify; every third is the hot entity's, every sixth of it busy.
    assert rows["hot"]["total_impression_freq"] == len(range(28_800, n, 3))
    assert rows["hot"]["busy_impression_freq"] == len(range(28_800, n, 6))
    assert sum(r["total_impression_freq"] for r in rows.values()) == n - 28_800


def test_hot_contact_is_split(spark, small_partitions):
    n = 200_000
    applicants = spark.range(0, n, 1, 16).select(
        F.col("id").alias("applicant_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("p"), F.col("id"))).alias("phone"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 10).cast("int")).alias("applied_date"),
    )
    found = duplicate_flag(applicants, shared_contacts(applicants))
    counts = dict(map(tuple, found.groupBy("phone_duplicate_flag").count().collect()))
    first_day = len([i for i in range(0, n, 3) if i % 10 == 0])
    assert counts == {"Dupe": len(range(0, n, 3)) - first_day, "Non-Dupe": n - len(range(0, n, 3)) + first_day}
    found.write.format("noop").mode("overwrite").save()
    collected = found.select("applicant_id", "phone_duplicate_flag")
    collected.collect()
    assert "skew=true" in plan(collected)


def test_missing_links_are_spread(spark, small_partitions):
    """A spine where most rows have no link: the rows meet the shuffle under different keys."""
    n = 100_000
    spine = spark.range(0, n, 1, 8).select(
        F.col("id").alias("applicant_id"), F.when(F.col("id") % 10 == 0, F.concat(F.lit("l"), F.col("id"))).alias("link")
    )
    part = spine.filter("link is not null").select("link", F.lit(1).alias("s"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    joined = left_join_all(spine, "link", [part], spine.columns)
    sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == n and joined.filter("s = 1").count() == n // 10
    assert max(sizes) < n / 4


def test_hot_link_is_split(spark, small_partitions):
    """A spine where one link holds a third of the rows, joined to two parts."""
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    n = 300_000
    spine = spark.range(0, n, 1, 16).select(
        F.col("id").alias("applicant_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("l"), F.col("id"))).alias("link"),
    )
    one = spine.groupBy("link").agg(F.count("*").alias("one"))
    two = spine.groupBy("link").agg(F.max("applicant_id").alias("two"))
    joined = left_join_all(spine, "link", [one, two], spine.columns)
    rows = joined.filter("link = 'hot'").agg(F.count("*"), F.min("one"), F.max("two")).first()
    assert tuple(rows) == (n // 3, n // 3, n - 3)
    joined.collect()
    assert "skew=true" in plan(joined)


def test_cohort_report_runs_on_a_funnel_with_repeated_entities(spark, tmp_path):
    tables = Tables(spark, FOLDER)
    with Staging(spark, str(tmp_path)) as staging:
        funnel = publish(applicant_funnel.applicant_funnel(tables, FUNNEL, staging), f"{tmp_path}/funnel", schemas.FUNNEL)
    report = cohort_report.cohort_report(funnel, tables, COHORT)
    sums = report.agg(*[F.sum(c).alias(c) for c in ("applicants", "profile_submit", "first_delivery")]).first()
    members = cohort_assign_l7d(funnel, COHORT_START, AS_OF).select("applicant_id").distinct().count()
    assert sums["applicants"] == members and sums["profile_submit"] <= members and sums["first_delivery"] <= members
