import json
import os

import pytest
from pyspark.sql import functions as F

from opsledger.operators.quality import QualityGateError
from opsledger.plans import pipeline
from opsledger.plans.ask import ask, build_index, search
from opsledger.plans.pipeline import Paths
from test_contract import BASE


def send(paths, name, *changes):
    with open(f"{paths.messages}/{name}", "w") as f:
        for change in changes:
            f.write(json.dumps({**BASE, **change}) + "\n")


def late(flight, minutes, ts, **more):
    return {"flight_id": flight, "status": "DELAYED", "delay_reason_code": "ATC", "delay_minutes": minutes, "event_ts": ts, **more}


def run_states(spark, paths):
    return [(r["job"], r["state"]) for r in spark.read.parquet(paths.runs).orderBy("event_time").collect()]


def test_pipeline_end_to_end(spark, tmp_path):
    (tmp_path / "in").mkdir()
    paths = Paths(str(tmp_path / "in"), str(tmp_path / "tables"))
    send(paths, "1.json", late("A", 30, "2026-08-06T10:00:00"), {"flight_id": "B"}, {"flight_id": "C", "status": "CANCELLED"},
         late("A", 20, "2026-08-06T09:00:00"), {"flight_id": "D", "status": "LOST"})
    pipeline.run(spark, paths)
    gold = spark.read.parquet(paths.gold).first()
    assert (gold["airline_code"], gold["total_flights"], gold["delayed_count"], gold["cancelled_count"]) == ("SV", 3, 1, 1)
    assert (gold["avg_delay_minutes"], gold["on_time_pct"]) == (30.0, 33.3)
    assert [s for _, s in run_states(spark, paths)] == ["START", "COMPLETE"] * 5

    # A newer, an older and an equal event; a new flight. Then a run with nothing new.
    send(paths, "2.json", late("A", 90, "2026-08-06T11:00:00"), {"flight_id": "B", "status": "ARRIVED", "event_ts": "2026-08-06T09:00:00"},
         {"flight_id": "C", "event_ts": "2026-08-06T10:00:00"}, {"flight_id": "E"})
    pipeline.run(spark, paths)
    pipeline.run(spark, paths)
    silver = {r["flight_id"]: r for r in pipeline.silver_table(spark, paths).collect()}
    assert sorted(silver) == ["A", "B", "C", "E"]
    assert (silver["A"]["delay_minutes"], silver["B"]["status"], silver["C"]["status"]) == (90, "SCHEDULED", "CANCELLED")
    assert pipeline.silver_versions(spark, paths) == [0, 1]
    assert pipeline.silver_table(spark, paths, 0).count() == 3
    assert pipeline.bronze_table(spark, paths).count() == 8

    # A bad record that slipped into the history halts everything after the gate.
    bad = pipeline.bronze_table(spark, paths).limit(1).withColumn("delay_minutes", F.lit(-500)).drop("batch_id")
    good = pipeline.bronze_table(spark, paths).limit(1).withColumn("flight_id", F.lit("NEW")).drop("batch_id")
    bad.unionByName(good).write.partitionBy("scheduled_date").parquet(f"{paths.bronze}/batch_id=99")
    with pytest.raises(QualityGateError, match="delay_minutes"):
        pipeline.run(spark, paths)
    assert run_states(spark, paths)[-4:] == [
        ("load", "START"), ("load", "COMPLETE"), ("quality_gate_bronze", "START"), ("quality_gate_bronze", "FAIL"),
    ]
    assert pipeline.silver_versions(spark, paths) == [0, 1]

    # The bad row is moved away, and the next run merges what is left of its load.
    assert pipeline.purge(spark, paths) == 1 and pipeline.purge(spark, paths) == 0
    assert [r["delay_minutes"] for r in spark.read.parquet(paths.purged).collect()] == [-500]
    pipeline.run(spark, paths)
    assert pipeline.silver_versions(spark, paths) == [0, 1, 99]
    assert {r["flight_id"] for r in pipeline.silver_table(spark, paths).collect()} == {"A", "B", "C", "E", "NEW"}


def test_a_merge_rewrites_only_the_parts_it_touches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    paths = Paths(str(tmp_path / "in"), str(tmp_path / "tables"))
    send(paths, "0.json", *({"flight_id": f"F{i}"} for i in range(60)))
    pipeline.load(spark, paths, 120)
    pipeline.merge(spark, paths)
    send(paths, "1.json", {"flight_id": "F7", "status": "ARRIVED", "event_ts": "2026-08-07T00:00:00"}, {"flight_id": "G"})
    pipeline.load(spark, paths, 120)
    pipeline.merge(spark, paths)
    first, second = (set(os.listdir(f"{paths.silver}/version={v}")) for v in (0, 1))
    parts = lambda names: {n for n in names if n.startswith("part=")}
    assert len(parts(first)) > 20 and 1 <= len(parts(second)) <= 2
    merged, rebuilt = pipeline.silver_table(spark, paths), pipeline.rebuild_silver(spark, paths)
    assert sorted(map(str, merged.select(rebuilt.columns).collect())) == sorted(map(str, rebuilt.collect()))
    assert pipeline.silver_table(spark, paths, 0).count() == 60 and merged.count() == 61


def test_rebuilt_state_equals_the_merged_one(spark, tmp_path):
    (tmp_path / "in").mkdir()
    paths = Paths(str(tmp_path / "in"), str(tmp_path / "tables"))
    for n in range(3):
        send(paths, f"{n}.json", *(late(f"F{(i * 7 + n) % 11}", i, f"2026-08-06T{(i * 5 + n * 3) % 24:02d}:{n:02d}:{i:02d}") for i in range(15)))
        pipeline.load(spark, paths, 120)
        pipeline.merge(spark, paths)
    columns = pipeline.rebuild_silver(spark, paths).columns
    merged = pipeline.silver_table(spark, paths).select(columns)
    assert sorted(map(str, merged.collect())) == sorted(map(str, pipeline.rebuild_silver(spark, paths).collect()))


def test_ask(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "delays.md").write_text("# Delay Policy\n\n## Weather\nNo refund for weather delays.\n\n## Technical\nRefund for technical delays.\n")
    (docs / "gates.md").write_text("# Gate Changes\n\n## Notice\nA gate change needs thirty minutes notice.\n")
    root = str(tmp_path / "index")
    build_index(spark, f"{docs}/*.md", root)
    asked = spark.createDataFrame([(1, "refund for technical delays?"), (2, "gate change notice for SV123-20260806")], "query_id int, query string")
    found = search(asked, root, top_k=2).orderBy("query_id", "rank").collect()
    assert found[0]["chunk_id"] == "delays::2" and {r["query_id"] for r in found} == {1, 2}
    state = spark.createDataFrame([("SV123-20260806", "BOARDING", "A1", None, None)],
                                  "flight_id string, status string, gate string, delay_minutes int, delay_reason_code string")
    answers = {r["query_id"]: r for r in ask(asked, root, state, top_k=3, top_n=2).collect()}
    assert answers[1]["citations"][0]["citation"] == "Delay Policy > Technical" and len(answers[1]["citations"]) == 2
    assert answers[1]["live_status"] is None and answers[2]["live_status"]["gate"] == "A1"
    assert answers[2]["context"].startswith("[1] ## Notice\nA gate change")
