from datetime import datetime

import pytest

from opsledger.operators.runs import RUN_SCHEMA, latest_run_state, parquet_sink, stage_run


def states(spark, path):
    events = spark.read.parquet(path)
    assert events.select("run_id").distinct().count() == 1 and events.first()["job"] == "job"
    return [r["state"] for r in events.orderBy("event_time").collect()]


def test_success(spark, tmp_path):
    path = str(tmp_path / "runs")
    with stage_run(spark, "job", parquet_sink(path)) as run_id:
        assert run_id
    assert states(spark, path) == ["START", "COMPLETE"]


@pytest.mark.parametrize("error", [ValueError, KeyboardInterrupt, SystemExit])
def test_failure_is_recorded_and_raised(spark, tmp_path, error):
    path = str(tmp_path / "runs")
    with pytest.raises(error):
        with stage_run(spark, "job", parquet_sink(path)):
            raise error("stop")
    assert states(spark, path) == ["START", "FAIL"]


def test_latest_state(spark):
    at = lambda s: datetime(2026, 1, 1, 0, 0, s)
    rows = [("a", "j", "n", "START", at(1)), ("a", "j", "n", "FAIL", at(4)), ("b", "j", "n", "START", at(2))]
    found = {r["run_id"]: r for r in latest_run_state(spark.createDataFrame(rows, RUN_SCHEMA)).collect()}
    assert (found["a"]["last_state"], found["a"]["duration_s"]) == ("FAIL", 3.0)
    assert (found["b"]["last_state"], found["b"]["ended_at"], found["b"]["duration_s"]) == ("START", None, None)
