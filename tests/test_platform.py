"""Sinks, schema tools, quality tests, export."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from featuremill.export.features import FeatureGroup, choose, export_frame
from featuremill.plans.publish import publish
from featuremill.plans.tables import TABLES
from featuremill.quality.checks import check_frame
from featuremill.quality.config import DqConfigError, DqSettings, load_settings, make_spec
from featuremill.quality.runner import RESULT_SCHEMA, QualityFailed, result_rows, run_checks, save_results
from featuremill.sources import scan, schema, sink

D = date(2024, 1, 2)


def frame(spark, rows, ddl="date date, id bigint, x double"):
    return spark.createDataFrame(rows, ddl)


def test_overwrite_keeps_other_partitions_and_repeats(spark, tmp_path):
    path = str(tmp_path / "t")
    both = frame(spark, [(date(2024, 1, 1), 1, 1.0), (D, 2, 2.0)])
    sink.overwrite_partitions(both, path)
    new = frame(spark, [(D, 3, 3.0)])
    for _ in range(2):
        sink.overwrite_partitions(new, path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 3]


@pytest.mark.parametrize(
    ("rows", "message"),
    [([], "nothing to write"), ([(date(2024, 1, 1), 1, 1.0)], "partition date"), ([(D, None, 1.0)], "NULL in required")],
)
def test_guards_leave_the_target(spark, tmp_path, rows, message):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    assert sink.guarded_overwrite(frame(spark, [(D, 9, 9.0)]), path, D, staging, ["id"]) == 1
    with pytest.raises(sink.WriteRefused, match=message):
        sink.guarded_overwrite(frame(spark, rows), path, D, staging, ["id"])
    with pytest.raises(sink.WriteRefused, match="missing"):
        sink.guarded_overwrite(frame(spark, [(D, 9, 9.0)]), path, D, staging, ["nope"])
    assert [r.id for r in spark.read.parquet(path).collect()] == [9]


def test_append_new_keys_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.append(frame(spark, [(D, 1, 1.0)]), path)
    for _ in range(2):
        sink.append_new_keys(frame(spark, [(D, 1, 5.0), (D, 2, 2.0)]), spark.read.parquet(path), ["id"], path)
    assert sorted((r.id, r.x) for r in spark.read.parquet(path).collect()) == [(1, 1.0), (2, 2.0)]


def test_append_takes_one_row_per_key_of_a_batch(spark, tmp_path):
    path, batch = str(tmp_path / "t"), frame(spark, [(D, 1, 5.0), (D, 1, 4.0), (D, 2, None)])
    sink.append_new_keys(batch, batch.where("false"), ["id"], path, [F.col("x").desc()])
    assert sorted((r.id, r.x) for r in spark.read.parquet(path).collect()) == [(1, 5.0), (2, None)]


def test_range_of_days(spark, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    days = [date(2024, 1, d) for d in (1, 2, 3)]
    rows = [(d, i, float(i)) for i, d in enumerate(days)]
    sink.overwrite_partitions(frame(spark, [(date(2023, 12, 31), 7, 7.0), (days[0], 8, 8.0)]), path)
    for _ in range(2):
        assert sink.guarded_overwrite(frame(spark, rows), path, days[0], staging, ["id"], until=date(2024, 1, 4)) == 3
    with pytest.raises(sink.WriteRefused, match="days without rows"):
        sink.guarded_overwrite(frame(spark, rows[:2]), path, days[0], staging, until=date(2024, 1, 4))
    with pytest.raises(sink.WriteRefused, match="1 rows do not carry"):
        sink.guarded_overwrite(frame(spark, rows), path, days[0], staging, until=days[2])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 7]
    assert list((tmp_path / "s").iterdir()) == []


def test_publishing_the_change_log_keeps_earlier_changes(spark, tmp_path):
    table, path = TABLES["score_change_log"], str(tmp_path / "log")
    ddl = "date date, query string, sku_group_id bigint, collected_at timestamp, score double"
    first = spark.createDataFrame([(D, "q", i, datetime(2024, 1, 2, 8), 1.0) for i in range(5)], ddl)
    changed = spark.createDataFrame([(D, "q", 3, datetime(2024, 1, 2, 20), 2.0)], ddl)
    for run in (first, changed, changed, first.where("false")):
        publish(table, run, path, D, "")
    assert spark.read.parquet(path).count() == 6


def test_missing_parquet_names_the_path(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere"):
        scan.existing_parquet(spark, str(tmp_path / "nowhere"))


def test_latest_snapshot_of_nothing_is_empty(spark):
    assert scan.latest_snapshot(frame(spark, []), "date").count() == 0


def test_align_cast_evolve(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    target = spark.createDataFrame([], "a bigint, c array<double>, b string").schema
    row = schema.align_to_schema(df, target, retired=["b"]).first()
    assert tuple(row) == (1, None, None)
    with pytest.raises(ValueError, match=r"\['c'\]"):
        schema.align_to_schema(df, target, on_missing="error")
    assert schema.cast_copy(df, spark.createDataFrame([], "b bigint, a bigint").schema).first().b is None
    changes = [schema.AddColumn("n", "int"), schema.RenameColumn("a", "z"), schema.RenameColumn("b", "y", unless_type="string")]
    once = schema.evolve_schema(df, changes)
    assert once.columns == ["z", "b", "n"] == schema.evolve_schema(once, changes).columns


def test_fill_by_type(spark):
    df = spark.createDataFrame([(None, float("nan"), None, None)], "i int, d double, s string, far double")
    assert tuple(schema.fill_by_type(df, {"far": 10.0}).first()) == (0, 0.0, None, 10.0)


def test_table_contracts_have_keys():
    assert len(TABLES) == 49
    for t in TABLES.values():
        assert t.primary_key and t.entity_keys and callable(t.builder)


# --- quality ---------------------------------------------------------------------------------------

def checked(spark, rows, *entries, scope="partition", refs=None, ddl="date date, id bigint, x double"):
    settings = DqSettings(("date", "id"), tuple(make_spec(e) for e in entries), scope=scope)
    return {r.test_key: (r.failed_rows, r.observed) for r in check_frame(frame(spark, rows, ddl), settings, D, refs).collect()}


ROWS = [(D, 1, 1.0), (D, 1, None), (D, None, -1.0), (date(2024, 1, 1), 1, 5.0)]


def test_row_rules(spark):
    got = checked(
        spark, ROWS, {"name": "primary_key_not_null"}, {"name": "primary_key_unique"}, {"name": "row_count_min", "min_rows": 3},
        {"name": "row_count_growth", "max_growth_ratio": 0.5, "direction": "down"}, {"name": "freshness"},
        {"name": "not_null", "columns": ["x"]}, {"name": "null_share_below", "column": "x", "max_share": 0.5},
        {"name": "accepted_values", "column": "x", "values": [1.0], "ignore_nulls": False},
        {"name": "accepted_range", "column": "x", "min": 0}, {"name": "non_negative", "columns": ["x"]},
        {"name": "expression_is_true", "expression": "x > 0"}, {"name": "distinct_count_between", "columns": ["id"], "max": 1},
        {"name": "not_accepted_values", "column": "x", "values": [1.0], "where": "id = 1"},
    )
    assert got == {
        "primary_key_not_null": (1, 1.0), "primary_key_unique": (1, 1.0), "row_count_min": (1, 3.0), "row_count_growth": (0, 2.0),
        "freshness": (0, 0.0), "not_null[x]": (1, 1.0), "null_share_below[x]": (0, pytest.approx(1 / 3)), "accepted_values[x]": (2, 2.0),
        "accepted_range[x]": (1, 1.0), "non_negative[x]": (1, 1.0), "expression_is_true[x > 0]": (2, 2.0),
        "distinct_count_between[id]": (1, 2.0), "not_accepted_values[x]": (1, 1.0),
    }


def test_no_baseline_is_skipped(spark):
    got = checked(spark, [(D, 1, 1.0)], {"name": "row_count_growth"}, {
        "name": "row_count_matches_reference", "reference_table": "r", "reference_date_column": "date"}, refs={"r": frame(spark, [])})
    assert got == {"row_count_growth": (-1, None), "row_count_matches_reference[r]": (-1, None)}


def test_empty_table_is_not_fresh(spark):
    assert checked(spark, [], {"name": "freshness"}) == {"freshness": (1, None)}


def test_relationships_ignore_null(spark):
    parent = spark.createDataFrame([(1, "a")], "pid bigint, k string")
    entry = {"name": "relationships", "column": "id", "to_table": "p", "to_column": "pid"}
    assert checked(spark, [(D, 1, 1.0), (D, None, 1.0), (D, 7, 1.0)], entry, refs={"p": parent}) == {"relationships[id]": (1, 1.0)}


def test_aggregate_tests_share_scans_and_prune(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, ROWS).write.partitionBy("date").parquet(path)
    settings = load_settings(("date", "id"), {"tests": [
        {"name": "primary_key_unique", "enabled": False}, {"name": "non_negative", "columns": ["x"]}, {"name": "not_null", "columns": ["x"]}]})
    plan = check_frame(spark.read.parquet(path), settings, D)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    # One scan of two days for the tests of the partition, one of the dates alone for freshness.
    assert len(scans) == 2
    assert any("2024-01-01" in s and "x:double" in s for s in scans) and any("ReadSchema: struct<>" in s for s in scans)


def test_days_from_folders(spark, tmp_path):
    path = str(tmp_path / "dated")
    rows = [(D, 1, 1.0), (D, 2, 1.0), (date(2023, 12, 30), 3, 1.0), (None, 4, 1.0)]
    sink.overwrite_partitions(frame(spark, rows), path)
    for empty in ("date=2024-02-01", "_staging", "date=2024-03-01/_temporary", "other=1"):
        (tmp_path / "dated" / empty).mkdir(parents=True)
    days = scan.partition_days(spark, path)
    assert [r.date for r in days.collect()] == [date(2023, 12, 30), D]
    assert scan.partition_days(spark, str(tmp_path / "nothing")).collect() == []
    (tmp_path / "dated" / "date=soon" / "id=1").mkdir(parents=True)
    with pytest.raises(ValueError, match="soon"):
        scan.partition_days(spark, path)


def test_tests_on_dates_read_no_rows(spark, tmp_path):
    path = str(tmp_path / "dated")
    sink.overwrite_partitions(frame(spark, [(date(2024, 1, n), n, 1.0) for n in (1, 2, 5)]), path)
    df, days = spark.read.parquet(path), scan.partition_days(spark, path)
    settings = DqSettings(("id",), (make_spec({"name": "freshness"}),), warmup_days=2)
    for on in (D, date(2024, 1, 5), date(2024, 1, 9)):
        by_rows, by_days = (check_frame(df, settings, on, dates=x) for x in (None, days))
        assert by_rows.collect() == by_days.collect()
        assert "Scan parquet" in plan_of(by_rows) and "Scan parquet" not in plan_of(by_days)
        with_days, without = run_checks(df, settings, on, dates=days), run_checks(df, settings, on)
        assert with_days.warmup_active == without.warmup_active
        assert [(r.status, r.severity, r.observed) for r in with_days.results] == [(r.status, r.severity, r.observed) for r in without.results]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().replace("FileScan parquet", "Scan parquet")


def test_runner_status(spark):
    settings = load_settings(("date", "id"), {"warmup_days": 1, "tests": [
        {"name": "non_negative", "columns": ["x"], "severity": "warn"}, {"name": "accepted_range", "column": "x", "max": 0}]})
    out = run_checks(frame(spark, ROWS), settings, D)
    status = {r.spec.key: r.status for r in out.results}
    assert status["non_negative[x]"] == "warned" and status["accepted_range[x]"] == "failed" and out.has_errors
    assert "1.0" in next(r.sample for r in out.results if r.spec.key == "accepted_range[x]")
    # Without earlier partitions the table is warming up: errors are only warnings.
    first = run_checks(frame(spark, [r for r in ROWS if r[0] == D]), settings, D)
    assert first.warmup_active and not first.has_errors
    skipped = {r.spec.key: r.skip_reason for r in first.results if r.status == "skipped"}
    assert skipped == {"row_count_growth": "no baseline data for 2024-01-01"}


def test_tests_that_share_a_label_keep_their_results(spark):
    rows = [(D, i, float(i)) for i in range(10)]
    long = "x + x + x + x + x + x + x + x + x + x + x"
    settings = load_settings(("date", "id"), {"warmup_days": 0, "tests": [
        {"name": "row_count_growth", "enabled": False},
        {"name": "accepted_range", "column": "x", "min": 100}, {"name": "accepted_range", "column": "x", "max": 1000},
        {"name": "expression_is_true", "expression": f"{long} > 70"}, {"name": "expression_is_true", "expression": f"{long} >= 0"},
    ]})
    out = run_checks(frame(spark, rows), settings, D)
    assert [(r.status, r.failed_rows) for r in out.results[-4:]] == [("failed", 10), ("passed", 0), ("failed", 7), ("passed", 0)]
    assert all(r.text for r in out.results) and "1000" in out.results[-3].text
    with pytest.raises(QualityFailed, match="accepted_range"):
        out.raise_for_errors()


def test_runner_switches(spark):
    df = frame(spark, ROWS)
    assert run_checks(df, load_settings(("id",), {"enabled": "no"}), D).results == []
    assert run_checks(df, load_settings(("id",), {"active_from": "2025-01-01"}), D).skipped_by_active_from


@pytest.mark.parametrize(
    "config",
    [
        {"scope": "row"}, {"tests": [{"name": "nope"}]}, {"tests": [{"name": "freshness"}, {"name": "freshness"}]}, {"tests": "x"},
        {"tests": [{"name": "not_null"}]}, {"tests": [{"name": "accepted_range", "column": "x"}]}, {"warmup_days": -1},
        {"tests": [{"name": "row_count_growth", "direction": "sideways"}]}, {"tests": [{"name": "freshness", "x": 1}]}, {"enabled": "maybe"},
    ],
)
def test_bad_quality_config(config):
    with pytest.raises(DqConfigError):
        load_settings(("id",), config)


def test_result_history_is_replaced_per_job(spark, tmp_path):
    out = run_checks(frame(spark, ROWS), load_settings(("date", "id")), D)
    rows = result_rows(spark, out, D, "t", "job", "r1", datetime(2024, 1, 3))
    assert len(rows.columns) == 23 == RESULT_SCHEMA.count(",") + 1
    path = str(tmp_path / "h")
    save_results(rows, path)
    save_results(rows.withColumn("dag_id", F.lit("other")), path)
    save_results(rows, path)
    assert spark.read.parquet(path).groupBy("dag_id").count().orderBy("dag_id").collect()[0]["count"] == len(out.results)


# --- export -------------------------------------------------------------------------------------------

GROUP = FeatureGroup("fs", "t", ("calculated_at", "sku_group_id", "promotion_id"), ("a", "b"), frozenset({"b"}), "calculated_at")


def test_export_latest_snapshot(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1), 1, "p", 9.0, 9.0), (datetime(2024, 1, 2), 1, "p", None, 1.0), (datetime(2024, 1, 2), 2, None, 2.0, 0.0)],
        "calculated_at timestamp_ntz, sku_group_id bigint, promotion_id string, a double, b double",
    )
    got = {r.key: r for r in export_frame(df, GROUP, D).collect()}
    assert set(got) == {"fs|1|p", "fs|2|"}
    assert got["fs|1|p"].features == [0.0, pytest.approx(0.6931471805599453)]
    assert '"update_field":"skuGroupToPromoFeatureSet"' in got["fs|1|p"].value


def test_choose_groups_and_order():
    g = FeatureGroup("fs", "t", ("date", "query"), ("a", "b"), frozenset({"a"}))
    picked = choose([g], [("fs", ["b", "a"])])[0]
    assert picked.features == ("b", "a") and picked.log1p == {"a"}
    assert choose([g], None) == [g]
    with pytest.raises(ValueError, match="unknown feature group"):
        choose([g], [("other", ["a"])])


def test_bad_groups():
    with pytest.raises(ValueError, match="no message type"):
        FeatureGroup("fs", "t", ("date", "shop_id"), ("a",))
    with pytest.raises(ValueError, match="primary key"):
        FeatureGroup("fs", "t", ("query",), ("a",))
