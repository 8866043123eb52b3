"""Datasets kept as snapshots: readers see the old rows or the new ones."""

import os

import pytest
from pyspark.sql import functions as F

from claimbrook.sources import lake, storage


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "n long, sample int")


def read(spark, target, **more):
    return sorted(tuple(r) for r in lake.read_dataset(spark, target, **more).collect())


@pytest.fixture
def target(tmp_path):
    return str(tmp_path / "x.parquet")


def test_readers_keep_what_they_resolved(spark, target):
    lake.publish_dataset(rows(spark, (1, 1), (2, 2)), target, 10, "a")
    before = lake.read_dataset(spark, target)
    assert lake.publish_dataset(rows(spark, (3, 1)), target, 10, "b") == 1
    # A reader that resolved the old snapshot goes on with it, a new one sees the new rows only.
    assert sorted(tuple(r) for r in before.collect()) == [(1, 1), (2, 2)]
    assert read(spark, target) == [(3, 1)]
    assert read(spark, target, number=0) == [(1, 1), (2, 2)]
    assert lake.read_dataset(spark, target).columns == ["n", "sample"]


def test_samples_are_published_together(spark, target):
    lake.publish_dataset(rows(spark, (1, 1), (2, 2), (3, 3)), target, 10, "a")
    lake.publish_dataset(rows(spark, (20, 2), (40, 4)), target, 10, "b", samples=[2, 3, 4], keep_others=True)
    assert read(spark, target) == [(1, 1), (20, 2), (40, 4)]
    assert read(spark, target, samples=[2]) == [(20, 2)]
    # Only the folder of the sample asked for is read.
    scan = lake.read_dataset(spark, target, samples=[2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "sample" in scan.split("PartitionFilters")[1].split("]")[0]


@pytest.mark.parametrize("fails", ["row", "check", "pointer"])
def test_a_failing_step_leaves_the_old_rows(spark, target, monkeypatch, fails):
    lake.publish_dataset(rows(spark, (1, 1)), target, 10, "a")
    new, check = rows(spark, (2, 1), (3, 2)), None
    if fails == "row":
        new = new.withColumn("n", F.when(F.col("n") == 3, F.raise_error(F.lit("late")).cast("long")).otherwise(F.col("n")))
    if fails == "check":
        check = lambda: 1 / 0
    if fails == "pointer":
        monkeypatch.setattr(lake, "create_text", lambda *a: 1 / 0)
    with pytest.raises(Exception):  # noqa: B017
        lake.publish_dataset(new, target, 10, "b", check=check)
    assert read(spark, target) == [(1, 1)]
    assert sorted(n for n in os.listdir(target) if not n.startswith(("_", "."))) == ["version=a"]


def test_one_of_two_writers_fails(spark, target, monkeypatch):
    lake.publish_dataset(rows(spark, (1, 1)), target, 10, "a")
    create = storage.create_text

    def overtaken(session, location, text):
        create(session, location, '{"1": "version=a/sample=1"}')
        create(session, location, text)

    monkeypatch.setattr(lake, "create_text", overtaken)
    with pytest.raises(Exception, match="exist"):
        lake.publish_dataset(rows(spark, (2, 1)), target, 10, "b")
    assert read(spark, target) == [(1, 1)]


def test_old_versions_go_on_request(spark, target):
    lake.write_dataset(rows(spark, (7, 1), (8, 2)), target, 10, "z")
    lake.publish_dataset(rows(spark, (1, 1)), target, 10, "a", keep_others=True)
    assert read(spark, target) == [(1, 1), (8, 2)]
    lake.publish_dataset(rows(spark, (2, 2), (3, 3)), target, 10, "b", keep_others=True)
    lake.drop_old_versions(spark, target)
    assert read(spark, target) == [(1, 1), (2, 2), (3, 3)]
    assert sorted(n for n in os.listdir(target) if not n.startswith((".", "_"))) == ["version=a", "version=b"]
    lake.publish_dataset(rows(spark, (9, 9)), target, 10, "c")
    lake.drop_old_versions(spark, target)
    assert sorted(n for n in os.listdir(target) if not n.startswith((".", "_"))) == ["version=c"]
    assert lake.inspect_dataset(spark, target).first()["row_count"] == 1
    assert lake.stored_schema(spark, target).fieldNames() == ["n"]
