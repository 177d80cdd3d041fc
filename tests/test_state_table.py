"""The score log through a state table: five days equal to the look through the whole log, and no shuffle of the state."""

import json
import random
import uuid
from datetime import date, datetime, timedelta

import pytest
from featuremill.operators.staging import write_stage
from featuremill.operators.state_table import StateTable
from featuremill.plans import search_silver as silver

START = date(2024, 1, 1)
DAYS = [START + timedelta(days=n) for n in range(5)]
EVENTS = "fired_at timestamp_ntz, model_name string, ranking_candidates array<string>, search_query string, external_features string"


def events(spark):
    """Scores of 40 pairs that stay, move a little, move much, come from and go to 0, and pairs that come late."""
    rng, rows = random.Random(2), []
    for n, on in enumerate(DAYS):
        for query in range(8):
            ids = [str(i) for i in range(5 + n)]
            scores = [round(rng.choice([0, 1, 1, 1.01, 1.04, 1.06, 2, -1]) * (1 + int(i)), 4) for i in ids]
            at = datetime(on.year, on.month, on.day, rng.randint(0, 23), rng.randint(0, 59))
            rows.append((at, "search_uni", ids, f"q{query}", json.dumps({"dssm_score": scores})))
    return spark.createDataFrame(rows, EVENTS)


@pytest.fixture
def state(spark, tmp_path):
    return StateTable(f"state_{uuid.uuid4().hex}", str(tmp_path / "state"), silver.SCORE_STATE, silver.SCORE_KEY, buckets=16)


@pytest.fixture
def scored(spark):
    return events(spark)


def at(on):
    return datetime(on.year, on.month, on.day) + timedelta(days=1, hours=2)


def rows(frame):
    return sorted(tuple(r) for r in frame.select("date", "query", "sku_group_id", "collected_at", "dssm_score").collect())


def test_five_days_equal_the_whole_log(spark, scored, state, tmp_path):
    logged = spark.createDataFrame([], "date date, query string, sku_group_id bigint, collected_at timestamp_ntz, dssm_score double")
    for n, on in enumerate(DAYS):
        want = rows(silver.score_change_log(scored, logged, on, at(on)))
        made = silver.run_score_log(scored, state, on, at(on), write_stage(str(tmp_path / f"a{n}")))
        assert rows(made) == want and want
        logged = logged.unionByName(spark.createDataFrame(want, logged.schema))
    newest = {(r.query, r.sku_group_id): r.dssm_score for r in logged.orderBy("date").collect()}
    assert {(r.query, r.sku_group_id): r.dssm_score for r in spark.table(state._table(DAYS[-1])).collect()} == newest


def test_a_day_run_again_gives_the_same(spark, scored, state, tmp_path):
    for n, on in enumerate([*DAYS[:3], DAYS[1], DAYS[2]]):
        made = rows(silver.run_score_log(scored, state, on, at(on), write_stage(str(tmp_path / f"b{n}"))))
        after = sorted(tuple(r) for r in spark.table(state._table(on)).collect())
        if n < 3:
            kept = {**(kept if n else {}), on: (made, after)}
        else:
            assert (made, after) == kept[on]


def test_old_versions_go(spark, scored, state, tmp_path):
    for n, on in enumerate(DAYS):
        silver.run_score_log(scored, state, on, at(on), write_stage(str(tmp_path / f"c{n}")))
    assert state.versions(spark) == DAYS[-3:]


def shuffles_above_scans(plan):
    """Lines of exchanges that have a scan of a state table below them."""
    lines, found = plan.splitlines(), []
    depth = lambda x: len(x) - len(x.lstrip(" :+-|"))
    for i, line in enumerate(lines):
        if "FileScan" in line and "Bucketed: true" in line:
            level = depth(line)
            for above in reversed(lines[:i]):
                if depth(above) < level:
                    level = depth(above)
                    if "Exchange" in above:
                        found.append(above)
    return found


def test_the_state_is_not_shuffled(spark, scored, state, tmp_path):
    silver.run_score_log(scored, state, DAYS[0], at(DAYS[0]), write_stage(str(tmp_path / "d")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = state.before(spark, DAYS[1])
        changes = silver.score_changes(scored, held, DAYS[1], at(DAYS[1]))
        for frame in (changes, state.merged(held, write_stage(str(tmp_path / "e"))(changes))):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan and "Exchange" in plan and not shuffles_above_scans(plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
