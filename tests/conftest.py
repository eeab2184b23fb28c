from __future__ import annotations

import sys
from datetime import date, datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from sluice.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Builds a small table from rows and a schema; dates and times may be given as text."""

    def value(kind: str, v):
        if not isinstance(v, str):
            return v
        if kind == "timestamp_ntz":
            return datetime.fromisoformat(v)
        return date.fromisoformat(v) if kind == "date" else v

    def build(schema: str, rows: list[tuple]):
        kinds = [part.split()[1] for part in schema.split(", ")]
        return spark.createDataFrame([tuple(value(k, v) for k, v in zip(kinds, row)) for row in rows], schema)

    return build


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)
