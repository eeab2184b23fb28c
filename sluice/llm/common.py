"""Helpers of the training-data operators: reading, staging in the shared folder, and slicing Arrow batches."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Text of one slice that a Python function holds at a time, in bytes.
SLICE_BYTES = 1 << 20


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or the context's own. Only a local session without any gets a new one."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: tables that are read again need a shared folder")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """Writes a relation that is read more than once to the shared folder and returns the written table.

    This cuts the lineage: later stages, and repeats of tasks lost with an executor, read files instead of
    computing the relation anew. The table is deleted when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_delete, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def spare(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rows_of(table: DataFrame) -> int:
    """Rows of a staged table; Spark takes the number from the files' footers."""
    return table.count()


def parts(rows: int, each: int, least: int = 1) -> int:
    """How many groups of about ``each`` rows there are."""
    return max(least, -(-rows // each))


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches between rows so that the column ``text`` has about ``most`` bytes in each slice.

    A single longer text makes a slice of its own. No row is dropped.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]
