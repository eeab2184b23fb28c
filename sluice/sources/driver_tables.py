"""Inputs of the operators, derived from the driver's parquet tables.

The reference's sources are not available, so each is derived from a driver table of the same nature:
customers act as applicants, their events as step events, and every derived table grows with its driver
table. The derivations use the SQL common to Spark and other engines; ``{ntz}`` is the type of a
timestamp without a time zone and ``{text}`` that of a string.

An event belongs to applicant ``user_id * 10 + cents(value) % 10``: ten applicants per user, which covers
the customer keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.sources.storage import read_table

_EVENTS = """(SELECT event_id, ts, event_type, CAST(floor(value) AS BIGINT) AS units,
               CAST(user_id * 10 + CAST(floor(value * 100) AS BIGINT) % 10 AS {text}) AS applicant FROM {events}) e"""

TABLES: dict[str, str] = {
    "applicants": """
        SELECT c_custkey AS applicant_id,
               concat('en', c_custkey) AS entity_id,
               CASE WHEN c_custkey % 40 <> 11 THEN concat('lk', c_custkey) END AS link,
               CASE WHEN c_custkey % 29 = 8 THEN DATE '2023-06-01' + CAST(c_custkey % 23 AS INT)
                    WHEN c_custkey % 29 = 9 THEN DATE '2023-12-04' + CAST(c_custkey % 23 AS INT)
                    WHEN c_custkey % 9 <> 4 THEN DATE '2024-01-01' + CAST(c_custkey % 23 AS INT) END AS applied_date,
               CASE WHEN c_custkey % 17 = 5 THEN DATE '2023-12-10' + CAST(c_custkey % 23 AS INT)
                    WHEN c_custkey % 3 = 0 THEN DATE '2024-01-01' + CAST(c_custkey % 23 + c_custkey % 9 AS INT)
               END AS first_dash_date,
               CASE WHEN c_custkey % 10 <> 6
                    THEN CAST(DATE '2024-01-01' + CAST(c_custkey % 19 AS INT) AS {ntz}) END AS oriented_at,
               CASE WHEN c_custkey % 20 <> 3
                    THEN concat(c_nationkey, '/', c_mktsegment, '/', CAST(floor(c_acctbal / 100) AS BIGINT))
               END AS phone,
               r_regionkey AS country_id, r_name AS country_name,
               n_nationkey AS submarket_id, n_name AS submarket_name
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "step_rendered": f"""
        SELECT concat('lk', applicant) AS link, ts,
               CASE WHEN units % 8 < 2 THEN 'vehicle' WHEN units % 8 < 4 THEN 'identity'
                    WHEN units % 8 < 6 THEN 'check' WHEN units % 32 = 6 THEN 'waitlist'
                    WHEN units % 16 = 7 THEN 'hard_block' WHEN units % 16 = 14 THEN 'limited'
                    ELSE 'other' END AS page_id,
               CASE WHEN event_id % 4 = 0 THEN 'after_vehicle' WHEN event_id % 4 = 1 THEN 'before_check'
               END AS waitlist_step,
               CASE WHEN event_id % 6 = 0 THEN true WHEN event_id % 6 < 4 THEN false END AS in_experiment
        FROM {_EVENTS} WHERE event_type IN ('view', 'click')""",
    "step_submitted": f"""
        SELECT concat('lk', applicant) AS link, ts, event_id,
               CASE WHEN units % 7 < 3 THEN 'vehicle' WHEN units % 7 < 5 THEN 'check'
                    WHEN units % 7 = 5 THEN 'check_status' ELSE 'identity' END AS page_id,
               CASE WHEN event_id % 5 < 2 THEN 'iOS' WHEN event_id % 5 = 2 THEN 'Android'
                    WHEN event_id % 5 = 3 THEN 'Web' END AS os_name,
               CASE WHEN event_id % 11 <> 0 THEN concat('v', event_id % 3) END AS app_version
        FROM {_EVENTS} WHERE event_type IN ('click', 'error')""",
    "profile_submitted": f"""
        SELECT concat('lk', applicant) AS user_id, ts FROM {_EVENTS} WHERE event_type = 'signup'""",
    "idv_steps": f"""
        SELECT CASE WHEN event_id % 3 = 0 THEN concat('lk', applicant) END AS link,
               CASE WHEN event_id % 3 = 1 THEN concat('lk', applicant) END AS reference_id,
               CASE WHEN event_id % 30 <> 2 THEN concat('lk', applicant) END AS user_id,
               split_part('start,document-camera-select,document-camera-capture,selfie-camera-select,'
                   || 'selfie-camera-capture,selfie-record-upload,complete,abandon', ',', CAST(units % 8 + 1 AS INT)) AS name,
               ts
        FROM {_EVENTS} WHERE event_type IN ('signup', 'error', 'view')""",
    "idv_inquiry": f"""
        SELECT concat('lk', applicant) AS reference_id, event_id,
               CASE event_id % 4 WHEN 0 THEN 'template-a' WHEN 1 THEN 'template-b' WHEN 2 THEN 'template-c'
                    ELSE 'template-other' END AS template_id,
               CASE WHEN units % 5 < 3 THEN 'approved' WHEN units % 5 = 3 THEN 'declined' ELSE 'pending' END AS status,
               ts AS updated_at
        FROM {_EVENTS} WHERE event_type IN ('error', 'click')""",
    "activated": f"""
        SELECT concat('lk', applicant) AS link, ts FROM {_EVENTS}
        WHERE event_type = 'purchase' AND units % 3 <> 0""",
    "shifts": f"""
        SELECT concat('en', applicant) AS entity_id, ts AS created_at,
               CASE WHEN units % 3 <> 1 THEN ts + INTERVAL '95' MINUTE END AS check_in_time
        FROM {_EVENTS} WHERE event_type = 'purchase'""",
    "home_loaded": f"""
        SELECT concat('en', applicant) AS entity_id,
               concat(' en', applicant, CASE WHEN event_id % 2 = 0 THEN ' ' ELSE '' END) AS user_id,
               event_id, ts AS received_at,
               CASE units % 6 WHEN 0 THEN 'BUSY' WHEN 1 THEN 'Very_Busy' WHEN 2 THEN 'normal'
                    WHEN 3 THEN 'not_busy' WHEN 4 THEN 'Full' END AS busyness
        FROM {_EVENTS} WHERE event_type = 'view'""",
    "access_impressions": f"""
        SELECT concat('en', applicant) AS entity_id, event_id, ts AS impression_ts,
               CASE units % 5 WHEN 0 THEN 'busy' WHEN 1 THEN 'VERY_BUSY' WHEN 2 THEN 'Normal'
                    WHEN 3 THEN 'not_busy' END AS busyness,
               CASE WHEN event_id % 3 <> 0 THEN 'current' ELSE 'legacy' END AS data_version
        FROM {_EVENTS} WHERE event_type = 'click'""",
    "access_daily": f"""
        SELECT concat('en', applicant) AS entity_id, CAST(ts AS DATE) AS active_date,
               CASE WHEN event_id % 7 <> 0 THEN CAST(event_id % 2 AS INT) END AS is_dash_now
        FROM {_EVENTS} WHERE event_type IN ('view', 'click', 'error')""",
    "assignments": f"""
        SELECT concat('en', applicant) AS entity_id, ts AS created_at,
               CASE WHEN event_id % 3 <> 0 THEN ts + INTERVAL '3' MINUTE END AS accepted_at,
               CASE WHEN event_id % 4 = 0 THEN ts + INTERVAL '9' MINUTE END AS unassigned_at
        FROM {_EVENTS} WHERE event_type IN ('signup', 'click', 'purchase')""",
    "risk_linkage": """
        SELECT c_custkey AS applicant_id,
               CASE WHEN c_custkey % 31 = 0 THEN 1 ELSE 0 END AS is_deactivated_email,
               CASE WHEN c_custkey % 37 = 0 THEN 1 ELSE 0 END AS is_deactivated_phone,
               CASE WHEN c_custkey % 41 = 0 THEN 1 ELSE 0 END AS is_deactivated_licence,
               CASE WHEN c_custkey % 43 = 0 THEN 1 END AS is_deactivated_ssn,
               CAST(c_custkey % 29 AS INT) - 26 AS phone_count, CAST(c_custkey % 23 AS INT) - 20 AS email_count,
               CAST(c_custkey % 19 AS INT) - 16 AS licence_count, CAST(c_custkey % 47 AS INT) - 44 AS ssn_count,
               CASE WHEN c_nationkey % 5 <> 4 THEN r_name END AS continent
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "idv_events": f"""
        SELECT concat('lk', applicant) AS reference_id, ts AS created_at,
               CASE event_id % 3 WHEN 0 THEN 'template-a' WHEN 1 THEN 'template-b' ELSE 'template-other' END AS template_id,
               CASE WHEN units % 21 < 7 THEN 'inquiry.created' ELSE split_part('document.created,document.submitted,'
                   || 'document.processed,document.pending,selfie.created,selfie.submitted,selfie.processed,'
                   || 'selfie.errored,inquiry.failed,inquiry.expired,inquiry.completed,inquiry.marked-for-review,'
                   || 'inquiry.approved,inquiry.declined', ',', CAST(units % 21 - 6 AS INT)) END AS event_type
        FROM {_EVENTS}""",
    # Orders as a funnel with several years of weeks: a priority class counts as a step reached. The weeks
    # are moved by 28 years (1461 weeks), which keeps every weekday and reaches the holiday calendar.
    "order_conversions": """
        SELECT '1. Applied L7D' AS cohort,
               CAST(date_trunc('week', o_orderdate) AS DATE) + 10227 AS week_start,
               CASE WHEN o_custkey % 8 = 0 THEN 'Hit Waitlist' ELSE 'No Waitlist' END AS all_waitlist_flag,
               1 AS applicants,
               CASE WHEN o_orderpriority < '5' THEN 1 ELSE 0 END AS profile_submit,
               CASE WHEN o_orderpriority < '4' THEN 1 ELSE 0 END AS vehicle_submit,
               CASE WHEN o_orderpriority < '3' THEN 1 ELSE 0 END AS idv_submit,
               CASE WHEN o_orderpriority < '3' AND o_orderstatus <> 'P' THEN 1 ELSE 0 END AS idv_approve,
               CASE WHEN o_orderpriority < '3' AND o_orderstatus <> 'P' AND o_totalprice < 400000 THEN 1 ELSE 0 END AS bgc_submit,
               CASE WHEN o_orderpriority < '2' AND o_orderstatus <> 'P' AND o_totalprice < 400000 THEN 1 ELSE 0 END AS account_activation,
               CASE WHEN o_orderpriority < '2' AND o_orderstatus = 'F' AND o_totalprice < 400000 THEN 1 ELSE 0 END AS first_delivery
        FROM {orders}""",
}

# Columns the queries use. A schema given to the reader saves the job that looks it up in the files.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "lineitem": "l_orderkey bigint, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "region": "r_regionkey int, r_name string",
}


def driver_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table under ``folder``."""
    return read_table(spark, folder, name, SCHEMAS[name])


class Tables(dict):
    """Derived and driver tables of a folder by name, each read when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.folder = spark, folder

    def __missing__(self, name: str) -> DataFrame:
        if name in SCHEMAS:
            self[name] = driver_table(self.spark, self.folder, name)
        else:
            text = TABLES[name]
            used = {t: self[t] for t in SCHEMAS if "{" + t + "}" in text}
            text = text.replace("{ntz}", "TIMESTAMP_NTZ").replace("{text}", "STRING")
            self[name] = self.spark.sql(text, **used)
        return self[name]


def derived(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One derived table, reading the driver tables under ``folder``."""
    return Tables(spark, folder)[name]


def derivation_sql(name: str) -> str:
    """The same derivation as plain SQL over views named like the driver tables."""
    return TABLES[name].format(ntz="TIMESTAMP", text="VARCHAR", **{t: t for t in SCHEMAS})
