"""Division that does not fail on a zero denominator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double; 0 over a zero denominator, null if either side is null."""
    return F.when(denominator == 0, F.when(numerator.isNotNull(), F.lit(0.0))).otherwise(
        F.try_divide(numerator.cast("double"), denominator.cast("double"))
    )
