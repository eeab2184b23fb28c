"""First touches kept from streams, against the batch operator."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.touch import first_touch, first_touch_sources
from sluice.specs import Step
from sluice.streaming.first_touch import FirstTouchTable, first_touch_stream, keep_first_touch, marked_events

LA = "America/Los_Angeles"
SCHEMA = "link string, page string, ts timestamp_ntz"
STEPS = [Step("seen"), Step("v", "page = 'v'"), Step("c", "page = 'c'")]


def events(table, n, seed):
    pick = random.Random(seed)
    start = datetime(2024, 1, 1)
    return table(SCHEMA, [(pick.choice(["a", "b", "c", "d", None]), pick.choice(["v", "c", "x", None]), pick.choice([None, *[start + timedelta(minutes=pick.randrange(90_000))] * 9])) for _ in range(n)])


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def kept(spark, folder, every=50):
    return FirstTouchTable(spark, f"{folder}/kept", T.StructField("link", T.StringType()), STEPS, every)


@pytest.mark.parametrize("every", [50, 2, 1])
def test_stream_equals_batch(spark, table, tmp_path, every):
    """Files in several batches and two runs, events in any order; bases written in between change nothing."""
    for i in range(5):
        events(table, 40, i).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events")

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/events")
        marked = marked_events([(stream, "link", STEPS, "ts")], "link")
        keep_first_touch(marked, kept(spark, tmp_path, every), f"{tmp_path}/checkpoint").awaitTermination()
        batch = first_touch(spark.read.parquet(f"{tmp_path}/events"), "link", STEPS, zone=LA)
        assert same(kept(spark, tmp_path).read(LA), batch)

    run()
    table(SCHEMA, [("a", "v", "2020-01-01 00:00:00"), ("new", "c", "2030-01-01 00:00:00")]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events")
    run()
    parts = {kind: sorted(os.listdir(f"{tmp_path}/kept/{kind}")) if os.path.exists(f"{tmp_path}/kept/{kind}") else [] for kind in ("base", "changes")}
    # The last two bases stay, and the changes that the newest but one does not hold.
    assert parts["base"] == {50: [], 2: ["upto=3", "upto=5"], 1: ["upto=4", "upto=5"]}[every]
    assert parts["changes"] == [f"batch={i}" for i in {50: range(6), 2: (4, 5), 1: (5,)}[every]]


def test_a_repeated_batch_changes_nothing(spark, table, tmp_path):
    """As after a failure between writing and remembering that the batch was written, also where it wrote a base."""
    parts = [events(table, 30, i) for i in range(4)]
    kept_table = kept(spark, tmp_path, every=2)
    for batch in (0, 0, 1, 1, 2, 3, 3):
        kept_table.merge(marked_events([(parts[batch], "link", STEPS, "ts")], "link"), batch)
    whole = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    assert same(kept_table.read(), first_touch(whole, "link", STEPS))


def test_an_unfinished_base_is_not_read(spark, table, tmp_path):
    kept_table = kept(spark, tmp_path)
    part = events(table, 30, 1)
    for batch in range(2):
        kept_table.merge(marked_events([(part, "link", STEPS, "ts")], "link"), batch)
    kept_table.compact(1)
    os.remove(f"{tmp_path}/kept/base/upto=1/_SUCCESS")
    for name in os.listdir(f"{tmp_path}/kept/base/upto=1"):
        if name.endswith(".parquet"):
            os.remove(f"{tmp_path}/kept/base/upto=1/{name}")
    assert same(kept_table.read(), first_touch(part, "link", STEPS))


def test_several_streams_with_one_key(spark, table, tmp_path):
    events(table, 50, 1).write.parquet(f"{tmp_path}/one")
    events(table, 50, 2).withColumnRenamed("link", "user").write.parquet(f"{tmp_path}/two")
    second = [Step("other")]

    def sources(read):
        return [(read(SCHEMA, "one"), "link", STEPS, "ts"), (read(SCHEMA.replace("link", "user"), "two"), "user", second, "ts")]

    streamed = first_touch_stream(sources(lambda s, name: spark.readStream.schema(s).parquet(f"{tmp_path}/{name}")), "link", f"{tmp_path}/kept", LA)
    batch = first_touch_sources(sources(lambda s, name: spark.read.schema(s).parquet(f"{tmp_path}/{name}")), "link", LA)
    assert same(streamed, batch) and streamed.filter(F.col("other").isNotNull()).count() == 4


def test_nothing_yet(spark, tmp_path):
    assert kept(spark, tmp_path).read(LA).count() == 0 and kept(spark, tmp_path).read().columns == ["link", "seen", "v", "c"]
