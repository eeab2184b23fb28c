from __future__ import annotations

import pytest
from pyspark.sql import types as T

from sluice.session import tune, untuned
from sluice.sources import storage
from sluice.specs import CORRECTED, REPRODUCE


def test_staging_writes_below_its_folder_and_leaves_nothing(spark, tmp_path):
    df = spark.range(10).withColumnRenamed("id", "n")
    with storage.Staging(spark, str(tmp_path)) as staging:
        staged = staging(df)
        assert staged.dtypes == df.dtypes and sorted(r["n"] for r in staged.collect()) == list(range(10))
        assert all(f"{tmp_path}/sluice-" in f for f in staged.inputFiles())
    assert not list(tmp_path.iterdir())


def test_staging_needs_a_folder(spark, monkeypatch):
    monkeypatch.setattr(storage, "shared_folder", lambda spark: None)
    with pytest.raises(ValueError, match="folder"):
        storage.session_staging(spark)


def test_tune_is_taken_back(spark):
    key = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    untuned(spark)
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    tune(spark)
    assert spark.conf.get(key) == "true"
    untuned(spark)
    assert spark.conf.get(key) == "false"
    spark.conf.set(key, before)


def test_a_missing_input_column_is_an_error(spark, tmp_path):
    spark.range(3).selectExpr("id a").write.parquet(str(tmp_path / "t.parquet"))
    assert storage.read_table(spark, str(tmp_path), "t", "a bigint").count() == 3
    with pytest.raises(ValueError, match="gone: None"):
        storage.read_table(spark, str(tmp_path), "t", "a bigint, gone string")
    with pytest.raises(ValueError, match="a: LongType"):
        storage.read_table(spark, str(tmp_path), "t", "a string")


def test_publish_to_the_catalog(spark):
    schema = T.StructType([T.StructField("a", T.LongType())])
    assert storage.publish(spark.range(4).selectExpr("id a", "id b"), "published_numbers", schema).count() == 4
    assert storage.publish(spark.range(2).selectExpr("id a"), "published_numbers", schema).columns == ["a"]
    assert storage.read_table(spark, None, "published_numbers", "a bigint").count() == 2
    spark.sql("DROP TABLE published_numbers")


def test_publish_replaces_and_checks_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.LongType())])
    storage.publish(spark.range(5).selectExpr("id a", "id b", "id c"), path, schema)
    storage.publish(spark.range(3).selectExpr("id a", "id b"), path, schema)
    written = spark.read.parquet(path)
    assert written.columns == ["b", "a"] and written.count() == 3
    with pytest.raises(ValueError, match="a: None"):
        storage.publish(spark.range(3).selectExpr("id b"), path, schema)


def test_corrected_is_the_opposite_of_reproduced():
    for name in REPRODUCE.__dataclass_fields__:
        assert getattr(CORRECTED, name) is False
        assert getattr(REPRODUCE, name) is (name != "fail_on_zero_volume")
