"""Reading inputs, publishing results, and writing intermediate tables once."""

from __future__ import annotations

import atexit
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import shared_folder


def read_table(spark: SparkSession, folder: str | None, name: str, schema: str | T.StructType | None = None) -> DataFrame:
    """The parquet table ``name`` under ``folder``, or the catalog table ``name`` without a folder.

    With ``schema`` only its columns are read. A column that the table lacks or holds with another type is an error: a
    schema given to the parquet reader itself would turn a missing column into nulls.
    """
    found = spark.read.table(name) if folder is None else spark.read.parquet(f"{folder}/{name}.parquet")
    if schema is None:
        return found
    return conform(found, T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)


@dataclass(frozen=True)
class Layout:
    """How a published table is cut into folders, so that later jobs read those they need: by ``column``, which is one of
    the table or, with ``value``, an SQL expression over it that is stored beside the declared columns."""

    column: str
    value: str | None = None


def publish(df: DataFrame, target: str, schema: T.StructType | None = None, layout: Layout | None = None) -> DataFrame:
    """Replaces the table at ``target`` and returns it as read back: a path if it has a slash, else a catalog table.

    With ``schema``, the result has to match it by name and type. With ``layout`` the rows are dealt by its column before they
    are written, so that a folder has few files; AQE cuts a large folder's rows over several tasks. The layout's own
    column stands last in what is returned, for filters on it.
    """
    if schema is not None:
        df = conform(df, schema)
    names = df.columns
    if layout is not None:
        if layout.value is not None:
            df = df.withColumn(layout.column, F.expr(layout.value))
            names = [*names, layout.column]
        df = df.hint("rebalance", layout.column)
    writer = df.write.mode("overwrite") if layout is None else df.write.mode("overwrite").partitionBy(layout.column)
    if "/" in target:
        writer.parquet(target)
        return df.sparkSession.read.schema(df.schema).parquet(target).select(*names)
    writer.format("parquet").saveAsTable(target)
    return df.sparkSession.read.table(target).select(*names)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order; a missing column or another type is an error."""
    found = {f.name: f.dataType for f in df.schema}
    wrong = [f"{f.name}: {found.get(f.name)} is not {f.dataType}" for f in schema if found.get(f.name) != f.dataType]
    if wrong:
        raise ValueError("; ".join(wrong))
    return df.select(*schema.names)


class Staging:
    """Writes relations that are read several times below a folder that all executors share.

    Losing an executor then costs no recomputation, and later reads prune the written columns. ``close`` deletes all
    that was written; it is called at the end of a ``with`` block. What the plans return reads the staged tables, so
    the block has to hold the action too.
    """

    def __init__(self, spark: SparkSession, folder: str | None):
        if not folder:
            raise ValueError("staging needs a folder that all executors share")
        self.spark, self.path = spark, f"{folder.rstrip('/')}/sluice-{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{self.path}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        context = self.spark.sparkContext
        if context._jsc is not None and not context._jsc.sc().isStopped():
            place = context._jvm.org.apache.hadoop.fs.Path(self.path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *error: object) -> None:
        self.close()


def session_staging(spark: SparkSession) -> Staging:
    """Staging in the session's shared folder, deleted when the application ends. On a cluster without one it is an error."""
    staging = Staging(spark, shared_folder(spark))
    atexit.register(staging.close)
    return staging
