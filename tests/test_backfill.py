from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta
from itertools import product

from conftest import ts
from pyspark.sql import functions as F

from sluice.operators.assemble import event_type_pivot_funnel, wide_funnel
from sluice.operators.backfill import backfill_chain, backfill_flag, step_lag_means, step_lag_samples
from sluice.plans.applicant_funnel import STEPS, fills, lags
from sluice.plans.driver_setup import FUNNEL
from sluice.specs import CORRECTED, Fill, Lag, Step

SINCE = date(2024, 1, 1)
FUNNEL_SCHEMA = "id bigint, a date, b timestamp_ntz, c timestamp_ntz"


def test_samples_have_both_steps_and_a_lag_within_bounds(table):
    funnel = table(
        FUNNEL_SCHEMA,
        [
            (1, "2024-01-01", "2024-01-01 01:00:00", None),
            (2, "2024-01-01", "2024-01-01 01:41:00", "2024-01-01 01:41:00"),
            (3, "2024-01-02", "2024-01-01 23:59:00", None),
            (4, "2023-12-31", "2023-12-31 00:10:00", None),
            (5, None, "2024-01-01 00:10:00", "2024-01-01 00:10:00"),
        ],
    )
    steps = [Lag("ab", "a", "b", 100), Lag("bc", "b", "c", 100)]
    samples = step_lag_samples(funnel, steps, ["id"], "a", SINCE).orderBy("id").collect()
    assert [tuple(r)[1:] for r in samples] == [(60, None), (None, 0), (None, None), (None, None), (None, None)]
    assert tuple(step_lag_means(funnel, steps, "a", SINCE).first()) == (60.0, 0.0)


def test_means_are_one_row_without_samples(table):
    means = step_lag_means(table(FUNNEL_SCHEMA, []), [Lag("ab", "a", "b", 100)], "a", SINCE).collect()
    assert [tuple(r) for r in means] == [(None,)]


CHAIN = [Fill("c", ("d",), "cd"), Fill("b", ("c",), "bc"), Fill("a", ("b",), "ab")]


def test_missing_steps_are_filled_from_the_last_one_back(table):
    funnel = table(
        "id bigint, a date, b timestamp_ntz, c timestamp_ntz, d date",
        [
            (1, None, None, None, "2024-01-02"),
            (2, None, "2024-01-01 12:00:00", None, "2024-01-02"),
            (3, None, None, None, None),
            (4, "2024-01-01", None, "2024-01-01 09:00:00", None),
        ],
    )
    means = table("ab double, bc double, cd double", [(60.0, 1.6, 10.0)])
    filled = backfill_chain(funnel, means, CHAIN).withColumn("flag", backfill_flag(["a", "b", "c"]))
    assert [tuple(r) for r in filled.select("a", "b", "c", "a_raw", "flag").orderBy("id").collect()] == [
        (ts("2024-01-01 22:48"), ts("2024-01-01 23:48"), ts("2024-01-01 23:50"), None, 1),
        (ts("2024-01-01 11:00"), ts("2024-01-01 12:00"), ts("2024-01-01 23:50"), None, 1),
        (None, None, None, None, 0),
        (ts("2024-01-01"), ts("2024-01-01 08:58"), ts("2024-01-01 09:00"), date(2024, 1, 1), 1),
    ]


def test_a_lag_without_a_mean_fills_nothing(table):
    funnel = table("a date, b timestamp_ntz, c timestamp_ntz, d date", [(None, None, None, "2024-01-02")])
    means = table("ab double, bc double, cd double", [(60.0, None, 10.0)])
    assert tuple(backfill_chain(funnel, means, CHAIN).select("a", "b", "c").first()) == (None, None, ts("2024-01-01 23:50"))


def funnel_rows(table, rows: list[dict]):
    schema = "applicant_id bigint, first_dash_date date, " + ", ".join(
        f"{s} {'date' if s == 'applied_date' else 'timestamp_ntz'}" for s in STEPS
    )
    names = [c.split()[0] for c in schema.split(", ")]
    return table(schema, [tuple(row.get(n) for n in names) for row in rows])


def means_row(table, **values):
    names = [lag.name for lag in lags(FUNNEL)]
    return table(", ".join(f"{n} double" for n in names), [tuple(values.get(n, 10.0) for n in names)])


def test_intl_submit_quirks(table):
    funnel = funnel_rows(
        table,
        [
            {"applicant_id": 1, "account_activation": "2024-01-02 00:00:00", "bgc_submit_intl": "2024-01-01 00:00:00",
             "bgc_submit": "2024-01-01 06:00:00"},
            {"applicant_id": 2, "account_activation": "2024-01-02 00:00:00"},
        ],
    )
    means = means_row(table)

    def intl(quirks, **more):
        spec = FUNNEL.__class__(**{**FUNNEL.__dict__, "quirks": quirks, **more})
        filled = backfill_chain(funnel, means, fills(spec)).orderBy("applicant_id")
        return [r["bgc_submit_intl"] for r in filled.collect()]

    assert intl(FUNNEL.quirks) == [ts("2024-01-01 06:00"), ts("2024-01-01 23:50")]
    assert intl(CORRECTED) == [ts("2024-01-01 00:00"), None]
    # One of both corrected: K1 only, then K15 only.
    assert intl(replace(FUNNEL.quirks, intl_falls_back_to_domestic=False)) == [ts("2024-01-01 00:00"), ts("2024-01-01 23:50")]
    assert intl(replace(FUNNEL.quirks, intl_filled_for_all=False)) == [ts("2024-01-01 06:00"), None]
    # A condition of the caller's own, for whom the step applies.
    assert intl(CORRECTED, intl_applies="applicant_id = 2") == [ts("2024-01-01 00:00"), ts("2024-01-01 23:50")]


def test_a_domestic_applicant_gets_no_intl_submit(table):
    funnel = funnel_rows(table, [{"applicant_id": 1, "account_activation": "2024-01-02 00:00:00", "bgc_submit": "2024-01-01 06:00:00"}])
    spec = FUNNEL.__class__(**{**FUNNEL.__dict__, "quirks": replace(FUNNEL.quirks, intl_filled_for_all=False)})
    assert backfill_chain(funnel, means_row(table), fills(spec)).first()["bgc_submit_intl"] is None


def test_approve_lag_quirk():
    corrected = FUNNEL.__class__(**{**FUNNEL.__dict__, "quirks": CORRECTED})
    starts = [next(lag.start for lag in lags(spec) if lag.name == "approve_to_form") for spec in (FUNNEL, corrected)]
    assert starts == ["idv_submit", "idv_approve"]


def test_fill_invariants_on_all_null_patterns(table):
    """For each of the 2,048 patterns and with one mean missing: raw values stay, gaps follow the chain."""
    clock = {s: ts("2024-01-01") + timedelta(hours=i) for i, s in enumerate(STEPS)}
    patterns = list(product([True, False], repeat=len(STEPS)))
    funnel = funnel_rows(
        table,
        [
            {"applicant_id": i, "first_dash_date": date(2024, 1, 3)}
            | {s: (clock[s].date() if s == "applied_date" else clock[s]) for s, kept in zip(STEPS, p) if kept}
            for i, p in enumerate(patterns)
        ],
    )
    means = means_row(table, start_to_submit=None)
    spec = fills(FUNNEL)
    filled = backfill_chain(funnel, means, spec).withColumn("flag", backfill_flag(STEPS)).collect()
    assert len(filled) == len(patterns) == 2048
    for row in filled:
        at = {"first_dash_date": ts("2024-01-03")}
        for fill in spec:
            raw = row[f"{fill.step}_raw"]
            raw = ts(str(raw)) if raw is not None else None
            nxt = next((at[f] for f in fill.following if at[f] is not None), None)
            if raw is None and nxt is not None:
                expected = None if fill.lag == "start_to_submit" else nxt - timedelta(minutes=10)
            else:
                expected = row["bgc_submit_raw"] if fill.step == "bgc_submit_intl" else raw
            at[fill.step] = expected
            assert row[fill.step] == expected, (fill, row)
        assert row["flag"] == int(any(row[f"{s}_raw"] is None and at[s] is not None for s in STEPS))


def test_wide_funnel_keeps_rows_without_a_key_and_drops_equal_rows(table):
    spine = table("id bigint, link string, e string", [(1, "a", "x"), (1, "a", "x"), (2, None, "x"), (3, None, "x"), (4, "c", None)])
    one = table("link string, s1 bigint", [("a", 10), ("b", 20), (None, 30)])
    two = table("link string, s2 bigint", [("c", 40)])
    fans_out = table("e string, s3 bigint", [("x", 1), ("x", 2)])
    wide = wide_funnel(spine, {"link": [one, two], "e": [fans_out]}).orderBy("id", "s3").collect()
    assert [tuple(r) for r in wide] == [
        (1, "a", "x", 10, None, 1), (1, "a", "x", 10, None, 2),
        (2, None, "x", None, None, 1), (2, None, "x", None, None, 2),
        (3, None, "x", None, None, 1), (3, None, "x", None, None, 2),
        (4, "c", None, None, 40, None),
    ]


def test_a_stand_in_key_matches_nothing(spark, table):
    spine = table("id bigint, link string", [(7, None)])
    stand_in = spine.select(F.xxhash64("id", "link").cast("string")).first()[0]
    part = table("link string, s bigint", [(stand_in, 1)])
    assert tuple(wide_funnel(spine, {"link": [part]}).first()) == (7, None, None)


def test_pivot_funnel_needs_the_first_step(table):
    events = table(
        "ref string, kind string, template string, created_at timestamp_ntz",
        [
            ("a", "created", "t1", "2024-01-02 00:00:00"),
            ("a", "created", "t1", "2024-01-01 00:00:00"),
            ("a", "done", "t1", "2024-01-03 00:00:00"),
            ("b", "done", "t1", "2024-01-03 00:00:00"),
            ("c", "created", "t9", "2024-01-03 00:00:00"),
        ],
    )
    spine = table("id bigint, link string", [(1, "a"), (2, "b"), (3, "c"), (4, None)])
    steps = [Step("created", "kind = 'created'"), Step("done", "kind = 'done'")]
    found = event_type_pivot_funnel(spine, events, "link", "ref", steps, "created", F.col("template").isin("t1"))
    assert [tuple(r) for r in found.select("id", "created", "done").collect()] == [(1, ts("2024-01-01"), ts("2024-01-03"))]
