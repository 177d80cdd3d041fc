"""Windows from running totals: equal to sums over the days, late rows included, and without reading the window's days."""

import random
import uuid
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from featuremill.functions.dates import Bound, window_end, window_start
from featuremill.operators.running_sums import RunningSums

from tests.test_state_table import shuffles_above_scans

START = date(2024, 1, 1)
SCHEMA = "date date, k string, j bigint, n bigint, x decimal(20,4)"
NAMES = {"n": "n_{w}", "x": "x_{w}"}
WINDOWS = (1, 3, 7)


def plus(n):
    return START + timedelta(days=n)


def made_rows(days=30):
    """Keys with rows every day, now and then, in two stretches with a pause longer than a window, and never again."""
    rng = random.Random(7)
    rows = []
    for n in range(days):
        rows += [(plus(n), "steady", 1, rng.randint(-5, 50), Decimal(rng.randint(0, 99999)) / 10000) for _ in range(3)]
        rows += [(plus(n), f"k{i}", i % 3, rng.randint(0, 9), Decimal(i)) for i in range(30) if rng.random() < 0.12]
        if n in (2, 3, 14, 15, 29):
            rows.append((plus(n), "back", 2, 100 + n, Decimal("0.1")))
        if n == 4:
            rows.append((plus(n), "gone", 2, 1, None))
    rows += [(plus(5), None, 1, 9, Decimal(9)), (plus(5), "k1", None, 9, Decimal(9)), (plus(6), "steady", 1, None, None), (None, "steady", 1, 9, None)]
    return [*rows, *rows[:20]]


def expected(rows, as_of, bound):
    end, first = window_end(as_of, bound), window_start(as_of, max(WINDOWS), bound)
    sums = defaultdict(lambda: defaultdict(Decimal))
    for on, k, j, n, x in rows:
        if on is None or k is None or j is None or not first <= on <= end:
            continue
        held = sums[k, j]
        for w in WINDOWS:
            inside = on >= window_start(as_of, w, bound)
            held[f"n_{w}"] += n if inside and n else 0
            held[f"x_{w}"] += x if inside and x else 0
    return {key: dict(found) for key, found in sums.items()}


def windows(totals, spark, as_of, bound=Bound.HALF_OPEN):
    frame = totals.windows(spark, as_of, WINDOWS, bound, NAMES, as_type=None)
    return {(r.k, r.j): {c: Decimal(r[c]) for c in frame.columns[2:]} for r in frame.collect()}


@pytest.fixture
def totals(tmp_path):
    keys, measures = {"k": "string", "j": "bigint"}, {"n": "bigint", "x": "decimal(38,4)"}
    return RunningSums(f"sums_{uuid.uuid4().hex}", str(tmp_path / "sums"), keys, measures, span=8, buckets=8)


def stored(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").partitionBy("date").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def days_read(frame):
    """Number of partitions that the scan of a frame without shuffles opens."""
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numPartitions").value()


def test_thirty_days_with_late_rows(spark, totals, tmp_path):
    rows = made_rows()
    daily = stored(spark, rows, str(tmp_path / "daily"))
    for n in range(30):
        assert days_read(totals.unread(daily, plus(n))) == 1
        totals.advance(daily, plus(n))
        if n in (9, 12, 16, 22, 29):
            assert windows(totals, spark, plus(n + 1)) == expected(rows, plus(n + 1), Bound.HALF_OPEN)
    # "back" was left out after its pause and counts from its first day again.
    assert {r["_since"] for r in totals.state.version(spark, plus(29)).where("k = 'back'").collect()} == {plus(29)}
    assert not totals.state.version(spark, plus(29)).where("k = 'gone'").collect()
    for bound in (Bound.CLOSED, Bound.UP_TO):
        assert windows(totals, spark, plus(29), bound) == expected(rows, plus(29), bound)
    # Rows of day 24 come late, some are taken back, and a key appears that day alone.
    late = [r for r in rows if r[0] != plus(24)] + [(plus(24), "steady", 1, 1000, Decimal(1)), (plus(24), "late", 0, 3, Decimal(2)), (plus(24), "back", 2, 5, None)]
    daily = stored(spark, late, str(tmp_path / "again"))
    totals.replace(daily, plus(24))
    for n in (28, 30):
        assert windows(totals, spark, plus(n)) == expected(late, plus(n), Bound.HALF_OPEN)


def test_versions_need_not_be_daily(spark, totals):
    rows = made_rows()
    daily = spark.createDataFrame(rows, SCHEMA)
    as_of = plus(21)
    for on in totals.edges(as_of, WINDOWS, Bound.HALF_OPEN):
        totals.advance(daily, on)
    assert windows(totals, spark, as_of) == expected(rows, as_of, Bound.HALF_OPEN)
    again = [tuple(r) for r in totals.state.version(spark, plus(20)).orderBy("k", "j").collect()]
    totals.advance(daily, plus(20))
    assert [tuple(r) for r in totals.state.version(spark, plus(20)).orderBy("k", "j").collect()] == again


def test_missing_versions_and_too_wide_windows_are_refused(spark, totals):
    daily = spark.createDataFrame([], SCHEMA)
    totals.advance(daily, plus(20))
    with pytest.raises(ValueError, match="no version of 2024-01-14"):
        totals.windows(spark, plus(21), (7,), Bound.HALF_OPEN, NAMES)
    with pytest.raises(ValueError, match="windows of 9 days"):
        totals.windows(spark, plus(21), (9,), Bound.HALF_OPEN, NAMES)
    totals.advance(daily, plus(13))
    assert totals.windows(spark, plus(21), (7,), Bound.HALF_OPEN, NAMES).collect() == []


def test_a_failed_replacement_is_refused_not_mixed(spark, totals, monkeypatch):
    rows = made_rows()
    daily = spark.createDataFrame(rows, SCHEMA)
    for n in range(10, 16):
        totals.advance(daily, plus(n))
    advance = RunningSums.advance

    def failing(self, frame, on):
        if on == plus(14):
            raise OSError("lost")
        return advance(self, frame, on)

    monkeypatch.setattr(RunningSums, "advance", failing)
    with pytest.raises(OSError):
        totals.replace(daily, plus(13))
    assert totals.state.versions(spark) == [plus(n) for n in range(10, 14)]
    with pytest.raises(ValueError):
        totals.windows(spark, plus(16), (1,), Bound.HALF_OPEN, NAMES)


def test_totals_are_not_shuffled(spark, totals):
    daily = spark.createDataFrame(made_rows(), SCHEMA)
    for on in totals.edges(plus(21), WINDOWS, Bound.HALF_OPEN):
        totals.advance(daily, on)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = totals.windows(spark, plus(21), WINDOWS, Bound.HALF_OPEN, NAMES)
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Bucketed: true") == 4 and "Exchange" not in plan and not shuffles_above_scans(plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
