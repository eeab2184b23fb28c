"""First touches kept up to date from streams of events.

A first touch is a minimum, and minima may be merged in any order and any number of times. Each micro-batch is therefore
reduced by itself, to one row per key it holds, and stored as a change of its own; the table is the minimum over all
changes, merged when it is read. No operator state grows with the keys, events may come late by any time, and a
batch that is repeated after a failure replaces the change that it wrote before, so the table is as after one run.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluice.functions import local_time
from sluice.operators.touch import step_columns
from sluice.specs import Step


class FirstTouchTable:
    """First touches in a folder that all executors share: ``base/upto=<batch>`` and ``changes/batch=<batch>``.

    A base holds the minima of all batches up to its number. It is written beside the one before, which stays with its
    changes until the next, so that neither a failure while it is written nor a reader that began earlier loses anything.
    Times are kept as they came, in UTC; ``read`` converts them.
    """

    def __init__(self, spark: SparkSession, path: str, key: T.StructField, steps: Sequence[Step], every: int = 50):
        self.spark, self.path, self.key, self.every = spark, path.rstrip("/"), key, every
        self.names = [s.name for s in steps]
        self.schema = T.StructType([key, *[T.StructField(name, T.TimestampNTZType()) for name in self.names]])

    def _merged(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(self.key.name).agg(*[F.min(name).alias(name) for name in self.names])

    def _numbers(self, kind: str, name: str) -> list[int]:
        """The numbers of the written parts, ascending; one that was not finished has no mark of success."""
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        parts = [x.getPath() for x in files.listStatus(folder)]
        done = [p for p in parts if files.exists(context._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName().removeprefix(f"{name}=")) for p in done)

    def _delete(self, parts: list[str]) -> None:
        context = self.spark.sparkContext
        for part in parts:
            place = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)

    def _parts(self, below: int | None = None) -> list[str]:
        """The newest base, below a batch if one is given, and the changes after it, up to that batch."""
        bases = [n for n in self._numbers("base", "upto") if below is None or n < below]
        since = bases[-1] if bases else -1
        changes = [n for n in self._numbers("changes", "batch") if n > since and (below is None or n <= below)]
        return [*[f"base/upto={n}" for n in bases[-1:]], *[f"changes/batch={n}" for n in changes]]

    def _rows(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{p}" for p in parts])

    def merge(self, marked: DataFrame, batch: int) -> None:
        """Stores the minima of a micro-batch of step times; every ``every`` batches a new base is written.

        The same batch again replaces what it stored. For ``foreachBatch``.
        """
        self._merged(marked).select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/changes/batch={batch}")
        if (batch + 1) % self.every == 0:
            self.compact(batch)

    def compact(self, batch: int) -> None:
        """Writes the base of all batches up to one, from the base before it; what that base had replaced is deleted."""
        before = [n for n in self._numbers("base", "upto") if n < batch]
        self._merged(self._rows(self._parts(batch))).write.mode("overwrite").parquet(f"{self.path}/base/upto={batch}")
        if before:
            old = [f"changes/batch={n}" for n in self._numbers("changes", "batch") if n <= before[-1]]
            self._delete([*old, *[f"base/upto={n}" for n in before[:-1]]])

    def read(self, zone: str | None = None) -> DataFrame:
        """The first touches of all batches so far, in local time. Grain: one row per key."""
        found = self._merged(self._rows(self._parts()))
        return found.select(self.key.name, *[local_time(F.col(name), zone).alias(name) for name in self.names])


def marked_events(sources: Sequence[tuple[DataFrame, str, Sequence[Step], str]], key: str) -> DataFrame:
    """The step times of several streams (or tables) with one key, stacked; ``sources`` as for ``first_touch_sources``."""
    marked = [step_columns(events, source_key, steps, ts, key) for events, source_key, steps, ts in sources]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)


def keep_first_touch(marked: DataFrame, table: FirstTouchTable, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Starts keeping ``table`` from a stream of ``marked_events``; ``trigger`` as for ``DataStreamWriter.trigger``, all
    events that are there and no more unless given."""
    writer = marked.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    return writer.foreachBatch(table.merge).start()


def first_touch_stream(
    sources: Sequence[tuple[DataFrame, str, Sequence[Step], str]], key: str, folder: str, zone: str | None = None
) -> DataFrame:
    """First touches of everything that the streams hold now, kept in ``folder``. Grain: one row per key."""
    marked = marked_events(sources, key)
    steps = [s for _, _, own, _ in sources for s in own]
    table = FirstTouchTable(marked.sparkSession, f"{folder}/table", T.StructField(key, marked.schema[key].dataType), steps)
    keep_first_touch(marked, table, f"{folder}/checkpoint").awaitTermination()
    return table.read(zone)
