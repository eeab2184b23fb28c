"""Orders as entities and their line items as step events: first shipping per flag, imputed backwards."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.assemble import wide_funnel
from sluice.operators.backfill import backfill_chain, backfill_flag, step_lag_means
from sluice.operators.touch import first_touch
from sluice.sources.storage import Staging
from sluice.specs import Fill, Lag, Step

STEPS = (
    Step("open_shipped", "l_linestatus = 'O'"),
    Step("none_shipped", "l_returnflag = 'N'"),
    Step("accepted_shipped", "l_returnflag = 'A'"),
    Step("returned_shipped", "l_returnflag = 'R'"),
)
_NAMES = ("ordered", *[s.name for s in STEPS])
LAGS = tuple(Lag(f"{a}_to_{b}", a, b, 400_000) for a, b in zip(_NAMES, _NAMES[1:]))
FILLS = tuple(Fill(lag.start, (lag.end,), lag.name) for lag in reversed(LAGS))
SAMPLES_FROM = date(1995, 1, 1)


def spine(orders: DataFrame) -> DataFrame:
    """Orders with their order date as the first step. Grain: the orders'."""
    return orders.select("o_orderkey", F.col("o_orderdate").alias("ordered"))


def order_lifecycle(orders: DataFrame, lineitem: DataFrame, staging: Staging) -> DataFrame:
    """Orders with first, possibly imputed, shipping times. Grain: one row per distinct order."""
    shipped = first_touch(lineitem, "l_orderkey", STEPS, "l_shipdate").withColumnRenamed("l_orderkey", "o_orderkey")
    wide = staging(wide_funnel(spine(orders), {"o_orderkey": [shipped]}))
    filled = backfill_chain(wide, step_lag_means(wide, LAGS, "ordered", SAMPLES_FROM), FILLS)
    return filled.withColumn("backfilled", backfill_flag([f.step for f in FILLS]))
