"""Left joins of several relations to one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_all(left: DataFrame, key: str, parts: Sequence[DataFrame], spread_by: Sequence[str]) -> DataFrame:
    """``left`` with the columns of every part that has its ``key``.

    Many left rows may have no key. They match nothing, but would all be shuffled to one task; they get a
    stand-in key instead, a hash of their ``spread_by`` columns. (A hash is the same in every attempt of a
    task, unlike a random number.) The prefix tells stand-ins from keys, so they still match nothing.

    A left key may also be hot. AQE splits a hot partition of a sort-merge join when both sides come
    straight from a shuffle. The prefixed key gives a pre-aggregated part such a shuffle: one row per key
    is moved once more, little beside the events it was aggregated from. All parts of a key share the left
    side's shuffle; where AQE splits it anyway, a further part needs another one, which
    ``spark.sql.adaptive.forceOptimizeSkewedJoin`` of the session settings allows.
    Grain: one row per left row and matching part rows.
    """
    present = F.concat(F.lit("k"), F.col(key).cast("string"))
    missing = F.concat(F.lit("n"), F.xxhash64(*[F.col(c) for c in spread_by]).cast("string"))
    joined = left.withColumn("_join_key", F.coalesce(present, missing))
    for part in parts:
        keyed = part.select(present.alias("_join_key"), *[c for c in part.columns if c != key])
        joined = joined.join(keyed, "_join_key", "left")
    return joined.drop("_join_key")
