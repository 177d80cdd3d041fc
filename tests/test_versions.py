"""Publication by manifest: what readers see when a publication fails, is repeated, or runs while they read."""

from datetime import date

import pytest
from featuremill.sources import versions
from featuremill.sources.sink import WriteRefused
from pyspark.sql import functions as F

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
SCHEMA = "date date, id bigint, x string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def table(spark, path, **which):
    return sorted(tuple(r) for r in versions.read_version(spark, path, frame(spark, []).schema, **which).collect())


@pytest.fixture
def path(spark, tmp_path):
    base = str(tmp_path / "t")
    assert table(spark, base) == []
    assert versions.publish_version(frame(spark, [(D1, 1, "a"), (D2, 2, "b"), (D2, 3, "c")]), base, D1, D3, required=["id"]) == 3
    return base


OLD = [(D1, 1, "a"), (D2, 2, "b"), (D2, 3, "c")]


def test_days_are_replaced_and_others_stay(spark, path):
    assert table(spark, path) == OLD
    versions.publish_version(frame(spark, [(D2, 9, "z")]), path, D2)
    assert table(spark, path) == [(D1, 1, "a"), (D2, 9, "z")]
    versions.publish_version(frame(spark, [(D3, 4, None)]), path, D3)
    assert table(spark, path, start=D2) == [(D2, 9, "z"), (D3, 4, None)] and table(spark, path, end=D2) == [(D1, 1, "a")]
    assert table(spark, path, number=1) == OLD


@pytest.mark.parametrize(
    ("rows", "until", "message"),
    [
        ([(D1, 5, "n"), (D3, 6, "n")], None, "outside"),
        ([(D1, 5, "n"), (None, 6, "n")], None, "outside"),
        ([], None, "0 rows"),
        ([(D1, 5, "n")], D3, "without rows"),
        ([(D1, None, "n")], None, "NULL"),
    ],
)
def test_refused_publications_leave_the_table(spark, path, rows, until, message):
    with pytest.raises(WriteRefused, match=message):
        versions.publish_version(frame(spark, rows), path, D1, until, required=["id"])
    assert table(spark, path) == OLD and versions.manifests(spark, path) == [1]


def test_a_failure_between_rows_and_manifest_leaves_the_table(spark, path, monkeypatch):
    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(versions, "_commit", fail)
        with pytest.raises(OSError, match="lost"):
            versions.publish_version(frame(spark, [(D1, 7, "n"), (D2, 8, "n")]), path, D1, D3)
    assert table(spark, path) == OLD
    assert versions.remove_unlisted(spark, path) == 2 and table(spark, path) == OLD
    versions.publish_version(frame(spark, [(D1, 7, "n"), (D2, 8, "n")]), path, D1, D3)
    assert table(spark, path) == [(D1, 7, "n"), (D2, 8, "n")]


def test_rows_that_fail_while_they_are_written(spark, path):
    bad = frame(spark, [(D1, 7, "n"), (D2, 8, "no number")]).withColumn("id", F.when(F.col("id") == 8, F.col("x").cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        versions.publish_version(bad, path, D1, D3)
    assert table(spark, path) == OLD


def test_a_reader_goes_on_with_its_manifest(spark, path):
    reading = versions.read_version(spark, path, frame(spark, []).schema)
    versions.publish_version(frame(spark, [(D1, 7, "n")]), path, D1)
    assert sorted(tuple(r) for r in reading.collect()) == OLD


def test_the_second_of_two_publishers_is_refused(spark, path, monkeypatch):
    newest = versions.manifests(spark, path)
    versions.publish_version(frame(spark, [(D1, 7, "n")]), path, D1)
    monkeypatch.setattr(versions, "manifests", lambda *_: newest)
    with pytest.raises(WriteRefused, match="another run"):
        versions.publish_version(frame(spark, [(D1, 8, "n")]), path, D1)
    monkeypatch.undo()
    assert table(spark, path) == [(D1, 7, "n"), *OLD[1:]]


def test_old_manifests_go_with_their_folders(spark, path):
    for n in range(3):
        versions.publish_version(frame(spark, [(D1, n, "n")]), path, D1)
    assert versions.remove_unlisted(spark, path, keep=1) == 3
    assert versions.manifests(spark, path) == [4] and table(spark, path) == [(D1, 2, "n"), *OLD[1:]]
