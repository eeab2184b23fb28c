"""The statement-by-statement shape of five jobs against ours, in one session over the same tables.

The plain shape scans a source once per step and joins the results one after the other, pairs every week
with every applicant, counts distinct ids per measure, and stacks one projection per metric. Prints one
JSON line: seconds per job and shape, the median of ``BENCH_RUNS`` runs after a warm-up. Arguments name jobs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from sluice.operators.backfill import backfill_chain, step_lag_means  # noqa: E402
from sluice.operators.cohort import APPLIED_IN_WEEK, cohort_label, in_week, week_sequence  # noqa: E402
from sluice.operators.metrics import METRICS, metric_base, metric_diffs, metric_lags  # noqa: E402
from sluice.operators.touch import first_touch  # noqa: E402
from sluice.operators.variance import decline_streaks  # noqa: E402
from sluice.plans import applicant_funnel, cohort_report, order_lifecycle, variance_report  # noqa: E402
from sluice.plans.driver_setup import AS_OF, COHORT, FUNNEL, ORDERS_AS_OF, START, ZONE  # noqa: E402
from sluice.session import session  # noqa: E402
from sluice.sources.driver_tables import Tables  # noqa: E402
from sluice.sources.storage import Staging  # noqa: E402
from sluice.specs import Step  # noqa: E402


def one_by_one(spine: DataFrame, key: str, steps: list[tuple[DataFrame, str, Step, str]], zone=ZONE) -> DataFrame:
    """One aggregate and one left join per step."""
    for events, source_key, step, ts in steps:
        touched = first_touch(events, source_key, [step], ts, zone).withColumnRenamed(source_key, key)
        spine = spine.join(touched, key, "left")
    return spine


def funnel_steps(tables: Tables) -> list[tuple[DataFrame, str, Step, str]]:
    idv = tables["idv_steps"].withColumn("any_id", F.coalesce("link", "reference_id", "user_id"))
    pages = (
        ("step_rendered", "vehicle_type_rendered", "vehicle"),
        ("step_submitted", "vehicle_type_submit", "vehicle"),
        ("step_rendered", "idv_render", "identity"),
        ("step_rendered", "bgc_form_rendered", "check"),
        ("step_submitted", "bgc_submit", "check"),
        ("step_submitted", "bgc_submit_intl", "check_status"),
    )
    return [
        (tables["profile_submitted"], "user_id", Step("profile_submit"), "ts"),
        (tables["activated"], "link", Step("account_activation"), "ts"),
        *[(tables[t], "link", Step(name, f"page_id = '{page}'"), "ts") for t, name, page in pages],
        *[
            (idv, "user_id" if name == "idv_start" else "any_id", Step(name, f"name = '{value}'"), "ts")
            for name, value in FUNNEL.idv_names.items()
        ],
    ]


def means_one_by_one(wide: DataFrame, lags, floor_column: str, samples_from) -> DataFrame:
    """One scan per lag, joined to one row."""
    rows = [step_lag_means(wide, [lag], floor_column, samples_from) for lag in lags]
    return reduce(lambda a, b: a.crossJoin(b), rows)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(
        "shapes", f"local[{cpus}]", spark__ui__enabled="false", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    applicants = tables["applicants"].select("applicant_id", "entity_id", "link", "applied_date", "first_dash_date")
    stage = Staging(spark, tempfile.mkdtemp(prefix="shapes-"))
    funnel = stage(applicant_funnel.applicant_funnel(tables, FUNNEL, stage))
    rows = stage(cohort_report.segmented_rows(funnel, tables, COHORT))
    conversions = tables["order_conversions"]
    filtered = F.col("all_waitlist_flag") == "No Waitlist"

    def plain_touches():
        return one_by_one(applicants.select("link").distinct(), "link", funnel_steps(tables))

    def our_touches():
        return applicant_funnel.step_touches(tables, FUNNEL)

    def plain_funnel():
        parts = (
            (applicant_funnel.approvals(tables, FUNNEL), "link"),
            (applicant_funnel.devices(tables["step_submitted"], FUNNEL.vehicle_page), "link"),
            (applicant_funnel.impressions(tables, FUNNEL), "entity_id"),
            (tables["shifts"].groupBy("entity_id").agg(F.min("created_at"), F.min("check_in_time")), "entity_id"),
        )
        wide = reduce(lambda w, p: w.join(p[0], p[1], "left"), parts, one_by_one(applicants, "link", funnel_steps(tables)))
        wide = wide.distinct()
        means = means_one_by_one(wide, applicant_funnel.lags(FUNNEL), "applied_date", FUNNEL.samples_from)
        return backfill_chain(wide, means, applicant_funnel.fills(FUNNEL))

    def our_funnel():
        return applicant_funnel.backfilled_funnel(stage(applicant_funnel.all_steps(tables, FUNNEL)), FUNNEL)

    def plain_orders():
        steps = [(tables["lineitem"], "l_orderkey", step, "l_shipdate") for step in order_lifecycle.STEPS]
        wide = one_by_one(order_lifecycle.spine(tables["orders"]), "o_orderkey", steps, None).distinct()
        means = means_one_by_one(wide, order_lifecycle.LAGS, "ordered", order_lifecycle.SAMPLES_FROM)
        return backfill_chain(wide, means, order_lifecycle.FILLS)

    def our_orders():
        return order_lifecycle.order_lifecycle(tables["orders"], tables["lineitem"])

    def plain_conversions():
        weeks = spark.range(1).select(F.explode(week_sequence(START, AS_OF)).alias("week_start"))
        paired = weeks.crossJoin(funnel.select("applicant_id", "applied_date", "first_dash_date"))
        label = cohort_label(F.col("week_start"), F.col("applied_date"), F.col("first_dash_date"))
        members = paired.filter(label == APPLIED_IN_WEEK).select("week_start", "applicant_id").distinct()
        counted = [
            F.count_distinct(F.when(in_week(F.expr(m.value)) & F.expr(m.extra or "true"), F.col("applicant_id"))).alias(m.name)
            for m in cohort_report.measures(ZONE, COHORT.quirks)
        ]
        delivered = F.count_distinct(F.when(in_week(F.col("first_dash_date")), F.col("applied_entity_id")))
        joined = rows.join(members, ["week_start", "applicant_id"])
        return joined.groupBy(*cohort_report.SEGMENTS).agg(
            F.count_distinct("applicant_id").alias("applicants"), *counted, delivered.alias("first_delivery")
        )

    def our_conversions():
        return cohort_report.weekly_conversions(rows, COHORT)

    def plain_variance():
        base = metric_base(conversions, ORDERS_AS_OF, filtered)
        long = reduce(
            DataFrame.unionByName,
            [
                base.select(
                    "cohort", "week_start", F.lit(m.number).alias("metric_number"), F.lit(m.name).alias("metric_name"),
                    F.expr(m.value).cast("double").alias("metric_value"),
                )
                for m in METRICS
            ],
        )
        monthly = long.groupBy("cohort", "metric_number", F.trunc("week_start", "month").alias("month")).agg(
            F.avg("metric_value").alias("metric_value_last_month_avg")
        )
        lagged = metric_lags(long).withColumn("month", F.add_months(F.trunc("week_start", "month"), -1))
        streaks = decline_streaks(metric_diffs(lagged.join(monthly, ["cohort", "metric_number", "month"], "left")))
        start = streaks.select("cohort", "metric_number", F.col("week_index").alias("_at"), F.col("metric_value").alias("start"))
        return streaks.withColumn("_at", F.col("week_index") - F.col("consecutive_decline_weeks")).join(
            start, ["cohort", "metric_number", "_at"], "left"
        )

    def our_variance():
        from sluice.operators.metrics import metric_long

        return variance_report.declines(metric_long(metric_base(conversions, ORDERS_AS_OF, filtered)))

    jobs = {
        "first_touch": (plain_touches, our_touches),
        "funnel_backfill": (plain_funnel, our_funnel),
        "order_lifecycle": (plain_orders, our_orders),
        "cohort_conversion": (plain_conversions, our_conversions),
        "variance": (plain_variance, our_variance),
    }

    def seconds(job) -> float:
        start = time.perf_counter()
        job().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    result = {}
    for name, shapes in jobs.items():
        if sys.argv[1:] and name not in sys.argv[1:]:
            continue
        for label, job in zip(("plain", "ours"), shapes):
            seconds(job)
            result[f"{name}_{label}"] = round(statistics.median(seconds(job) for _ in range(runs)), 2)
    print(json.dumps({"sf": os.path.basename(folder), "seconds": result}))
    spark.stop()


if __name__ == "__main__":
    main()
