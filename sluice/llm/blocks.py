"""Blocks of rows that follow each other in the order of an id, dealt without sorting the table as a whole."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The most blocks: the driver holds one id for each. Blocks of a larger table hold more rows, which tasks stream.
MOST_BLOCKS = 4096


class Blocks:
    """Cuts the order (id, hash; rows without an id last) into at most about ``MOST_BLOCKS`` blocks of like size.

    The cuts are quantiles of the ids. An id of very many rows is a quantile several times; its rows are dealt over as
    many blocks by the hash's rank, and so are the rows without an id, so that no id makes one large block.
    """

    def __init__(self, table: DataFrame, key: str, rows_each: int):
        numbered = F.count(key)
        found = table.agg(F.count("*").alias("rows"), numbered.alias("numbered")).first()
        self.rows = found.rows
        each = max(rows_each, -(-self.rows // MOST_BLOCKS))
        wanted = -(-found.numbered // each)
        self.cuts: list[int] = []
        if wanted > 1:
            shares = [i / wanted for i in range(1, wanted)]
            self.cuts = sorted(int(x) for x in table.agg(F.percentile_approx(F.col(key).cast("long"), shares, 20 * wanted)).first()[0])
        self.without = -(-(self.rows - found.numbered) // each)
        self.number = len(self.cuts) + 1 + self.without

    def of(self, key: Column, rank: Column) -> Column:
        """The block of a row, 0 to ``number`` - 1: never smaller for a later row. ``rank`` is any 64-bit hash, in its signed order."""
        cuts, without = np.array(self.cuts, np.int64), self.without

        @F.arrow_udf("long")
        def block(key: pa.Array, rank: pa.Array) -> pa.Array:
            part = (rank.to_numpy(zero_copy_only=False) / 2.0**64 + 0.5).clip(0, 1 - 2**-53)
            ids, missing = pc.fill_null(key, 0).to_numpy(zero_copy_only=False), pc.is_null(key).to_numpy(zero_copy_only=False)
            low, high = np.searchsorted(cuts, ids, "left"), np.searchsorted(cuts, ids, "right")
            spread = low + np.where(high > low, 1 + np.floor(part * (high - low)), 0).astype(np.int64)
            spread = np.minimum(spread, high)
            return pa.array(np.where(missing, len(cuts) + 1 + np.floor(part * without).astype(np.int64), spread), pa.int64())

        return block(key, rank)
