"""Impressions seen after an entity reached a milestone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import local_time
from sluice.specs import REPRODUCE, Quirks


def impression_events(
    source: str,
    impressions: DataFrame,
    at: str,
    entity: str = "entity_id",
    gate_id: str = "entity_id",
    busyness: str = "busyness",
    quirks: Quirks = REPRODUCE,
) -> DataFrame:
    """The impressions of one source in the common shape.

    ``gate_id`` is the column matched with the entity's id when it is gated (K7); corrected, the entity
    column is used for both. Ids are compared as trimmed strings. Grain: one row per impression with a time.
    """
    gate = gate_id if quirks.gate_on_user_id else entity
    return impressions.filter(F.col(at).isNotNull()).select(
        F.lit(source).alias("source"),
        F.trim(F.col(gate).cast("string")).alias("gate_id"),
        F.col(entity).alias("entity_id"),
        F.col(at).alias("at"),
        F.lower(busyness).alias("busyness"),
    )


#: Consecutive impressions of a scan that one list of times may come from.
CHUNK_BITS = 20


def daily_impressions(events: DataFrame, zone: str | None = None) -> DataFrame:
    """The impressions of an id, busyness and local day in one row: how many, the first, and all times as one list.

    A raw impression is then eight bytes of a list instead of a row of its own. Rows are combined where they are read:
    a list holds times of one chunk of ``2 ** CHUNK_BITS`` consecutive rows of a scan task, so that it is bounded
    for an id with any number of impressions. Grain: source, gate id, entity, busyness, day and chunk.
    """
    chunk = F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS)
    dated = events.withColumns({"day": local_time(F.col("at"), zone).cast("date"), "_chunk": chunk})
    return (
        dated.groupBy("source", "gate_id", "entity_id", "busyness", "day", "_chunk")
        .agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("n"), F.collect_list("at").alias("times"))
        .drop("_chunk")
    )


def gated_impressions(
    events: DataFrame,
    entities: DataFrame,
    milestone: str = "oriented_at",
    busy: Sequence[str] = ("busy", "very_busy"),
    zone: str | None = None,
    quirks: Quirks = REPRODUCE,
) -> DataFrame:
    """First time, first busyness, busy count and count of the impressions at or after ``milestone``.

    ``events`` stacks all sources, so the milestones are shuffled once. Impressions are combined by day before they are
    shuffled to the milestones: a day after the milestone's counts as a whole, a day before it not at all, and the single
    times are looked at on the day itself. One entity may hold a large part of the impressions: what meets the
    milestones is one row for each of its days and chunks of the scan, and the grouping that follows shuffles
    pre-aggregated rows anyway, so AQE is free to split a hot id. Of several impressions
    at the first time, the smallest busyness is taken. Grain: one row per source and entity.
    """
    compare_zone = zone if quirks.compare_in_local_time else None
    reached = local_time(F.col(milestone), compare_zone)
    gates = entities.filter(F.col(milestone).isNotNull()).select(
        F.trim(F.col("entity_id").cast("string")).alias("gate_id"), reached.alias("_milestone"), reached.cast("date").alias("_day")
    )
    joined = daily_impressions(events, compare_zone).join(gates, "gate_id").filter(F.col("day") >= F.col("_day"))
    on_the_day = F.filter("times", lambda t: local_time(t, compare_zone) >= F.col("_milestone"))
    qualifying = joined.withColumn("times", F.when(F.col("day") == F.col("_day"), on_the_day)).select(
        "source", "entity_id", "busyness",
        F.when(F.col("times").isNull(), F.col("at")).otherwise(F.array_min("times")).alias("at"),
        F.when(F.col("times").isNull(), F.col("n")).otherwise(F.size("times")).alias("_n"),
    ).filter("_n > 0")
    # One row per busyness first: that aggregate hashes, and few rows are left to be sorted for the first one.
    by_value = qualifying.groupBy("source", "entity_id", "busyness").agg(F.min("at").alias("at"), F.sum("_n").alias("_n"))
    firsts = by_value.groupBy("source", "entity_id").agg(
        F.min(F.struct("at", "busyness")).alias("_first"),
        F.sum(F.when(F.col("busyness").isin(*busy), F.col("_n")).otherwise(0)).alias("busy_impression_freq"),
        F.sum("_n").alias("total_impression_freq"),
    )
    return firsts.select(
        "source",
        "entity_id",
        local_time(F.col("_first.at"), zone).alias("first_impression_time"),
        F.col("_first.busyness").alias("first_impression_busyness"),
        "busy_impression_freq",
        "total_impression_freq",
    )


def impression_rollup(
    gated: DataFrame, busy: Sequence[str] = ("busy", "very_busy"), quirks: Quirks = REPRODUCE
) -> DataFrame:
    """Combine the gated impressions of several sources.

    The bucket is taken from each source row's first busyness and is part of the grouping (K6), so an
    entity seen busy first in one source and not busy first in the other keeps two rows. Corrected, the
    bucket follows from the combined first busyness. Grain: one row per entity and bucket, or per entity.
    """

    def bucket(value: Column) -> Column:
        return F.when(value.isin(*busy), "busy").otherwise("not_busy")

    split = [bucket(F.col("_busyness")).alias("first_impression_busyness_bucket")] if quirks.bucket_splits_entity else []
    combined = (
        gated.withColumnRenamed("first_impression_busyness", "_busyness")
        .groupBy("entity_id", *split)
        .agg(
            F.min("first_impression_time").alias("_first"),
            F.min_by("_busyness", F.struct("first_impression_time", "source")).alias("first_impression_busyness"),
            F.sum("busy_impression_freq").alias("busy_impression_freq"),
            F.sum("total_impression_freq").alias("total_impression_freq"),
        )
        .withColumnRenamed("_first", "first_impression_time")
    )
    if not split:
        combined = combined.withColumn("first_impression_busyness_bucket", bucket(F.col("first_impression_busyness")))
    return combined.select(
        "entity_id",
        "first_impression_time",
        "first_impression_busyness",
        "busy_impression_freq",
        "total_impression_freq",
        F.when(F.col("busy_impression_freq") > 0, "has_busy_impression")
        .otherwise("no_busy_impression")
        .alias("has_busy_impression"),
        "first_impression_busyness_bucket",
    )
