"""Session settings for the funnel jobs."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime re-planning: merge small shuffle partitions, and split skewed ones also where that needs one more shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Switches the settings on in a session made elsewhere, for all of its later work.

    The queries are lazy, so the settings have to last until the caller runs them; ``untuned`` takes them back.
    """
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            _before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)
    return spark


_before: dict[str, str | None] = {}


def shared_folder(spark: SparkSession) -> str | None:
    """The folder for staged tables: ``spark.checkpoint.dir``, or else the context's own checkpoint folder.

    A local session without any gets a new one, as in tests. On a cluster without one there is none.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder and context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sluice-"))
        folder = context.getCheckpointDir()
    return folder


def untuned(spark: SparkSession) -> SparkSession:
    """The session with the settings it had before ``tune``."""
    for key, value in _before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
    _before.clear()
    return spark


# For a session of our own: plans with many stages generate more classes than are kept by default, and
# recording the Python line of every expression takes longer than building the expression.
STARTUP = {
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app: str = "sluice", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` takes further settings with ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STARTUP, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
