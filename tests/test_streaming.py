import json
import os
import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsledger.session import checkpoint_dir
from opsledger.sources.streams import Unfinished, append_sink, drain, read_messages, read_rows, run_for, tail_messages
from opsledger.streaming.ingest import accepted_stream, ingest, running_counts
from opsledger.streaming.replay import Replay, replay, tumbling_totals
from opsledger.streaming.windows import counting_drops, hopping_means, severe_delays, tumbling_counts
from test_contract import BASE
from test_windows import T0, at, loop, stream

ROWS = "arrival bigint, airline_code string, event_ts timestamp, delay_minutes int, status string"


def put(folder, name, messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages) + "\n")


def test_ingest_routes_every_message_once(spark, tmp_path):
    raw, bronze, dead = tmp_path / "raw", str(tmp_path / "bronze"), str(tmp_path / "dead")
    go = lambda: drain(ingest(read_messages(spark, str(raw)), bronze, dead, str(tmp_path / "ck")), 120)
    put(raw, "1.json", [BASE, {**BASE, "flight_id": "FL2"}, {**BASE, "status": "LOST"}, "garbage"])
    go()
    assert spark.read.parquet(bronze).count() == 2 and spark.read.parquet(dead).count() == 2
    put(raw, "2.json", [{**BASE, "flight_id": "FL3"}])
    go()
    go()
    assert sorted(r["flight_id"] for r in spark.read.parquet(bronze).collect()) == ["FL123", "FL2", "FL3"]
    assert spark.read.parquet(bronze).groupBy("batch_id").count().count() == 2
    assert {r["original_payload"] for r in spark.read.parquet(dead).collect()} >= {"garbage"}


def test_counts_and_anomalies(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "anomalies")
    late = {**BASE, "status": "DELAYED", "delay_reason_code": "ATC"}
    put(raw, "1.json", [{**late, "delay_minutes": 121}, {**late, "delay_minutes": 120}, {**BASE, "delay_minutes": 500}, "x"])
    messages = read_messages(spark, str(raw))
    drain(append_sink(severe_delays(accepted_stream(messages)), out, str(tmp_path / "ck")), 120)
    found = spark.read.parquet(out)
    assert [r["delay_minutes"] for r in found.collect()] == [121]
    assert found.columns == ["flight_id", "airline_code", "delay_minutes", "event_ts", "detected_at"]
    counted = running_counts(messages).writeStream.outputMode("complete").format("memory").queryName("counted")
    drain(counted.option("checkpointLocation", str(tmp_path / "ck2")), 120)
    assert tuple(spark.table("counted").first()) == (4, 3, 1)


def batches(spark, folder, groups):
    for i, rows in enumerate(groups):
        path = f"{folder}/part-{i:03d}.json"
        with open(path, "w") as f:
            for arrival, key, ts, value in rows:
                row = {"arrival": arrival, "airline_code": key, "event_ts": ts.isoformat(), "delay_minutes": value, "status": "DELAYED"}
                f.write(json.dumps(row) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def test_spark_watermark_drops_whole_windows(spark, tmp_path):
    """The coarser semantics: by micro-batch and window end."""
    folder = tmp_path / "in"
    folder.mkdir()
    seconds = [[0, 10], [6.5, 20], [6.5, 7.5, 15, 30], [16, 18], [40]]
    batches(spark, folder, [[(0, "a", at(s), 1) for s in group] for group in seconds])
    rows = read_rows(spark, str(folder), spark.createDataFrame([], ROWS).schema, "json", maxFilesPerTrigger="1", latestFirst="false")
    counts = tumbling_counts(rows, "event_ts")
    with counting_drops(spark) as counter:
        query = drain(append_sink(counts, str(tmp_path / "out"), str(tmp_path / "ck")), 240)
    found = {r["window_start"]: r["events"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert counter.dropped[str(query.id)] == 2
    assert found[at(0)] == 1 and found[at(10)] == 1 and at(16) not in found and found[at(18)] == 1


def test_hopping_means_on_ordered_input(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    batches(spark, folder, [[(i, "a", at(i), i) for i in range(20)]])
    rows = read_rows(spark, str(folder), spark.createDataFrame([], ROWS).schema, "json")
    means = hopping_means(rows, ["airline_code"], "event_ts", F.col("delay_minutes"), "5 seconds", "1 second")
    query = means.writeStream.outputMode("complete").format("memory").queryName("hops").option("checkpointLocation", str(tmp_path / "ck"))
    drain(query, 120)
    assert spark.table("hops").where(F.col("window_start") == F.lit(at(3))).first()["mean_value"] == 5.0


@pytest.mark.parametrize("per_file", [300, 45])
def test_replay_over_micro_batches_equals_the_event_loop(spark, tmp_path, per_file):
    rows = stream(21)
    late, means, buckets = loop(rows)
    folder, root = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    batches(spark, folder, [rows[i : i + per_file] for i in range(0, len(rows), per_file)])
    source = read_rows(spark, str(folder), spark.createDataFrame([], ROWS).schema, "json", maxFilesPerTrigger="1")
    cfg = Replay(start=T0.isoformat(sep=" "))
    drain(replay(source, root, str(tmp_path / "ck"), cfg), 600)
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    assert {r["arrival"] for r in read("late").collect()} == {a for a, is_late in late.items() if is_late}
    totals = {r["window_start"]: r["events"] for r in tumbling_totals(read("tumbling")).collect()}
    assert totals == dict(buckets)
    rolled = {r["arrival"]: (r["rolling_mean"], r["rolling_count"]) for r in read("rolling").collect()}
    assert rolled == {a: (pytest.approx(m), n) for a, (m, n) in means.items()}
    assert {r["arrival"] for r in read("anomalies").collect()} == {a for a, _, _, v in rows if not late[a] and v > 120}


def test_run_for_stops(spark):
    started = datetime.now()
    query = run_for(spark.readStream.format("rate").load().writeStream.format("noop"), 3)
    assert not query.isActive and (datetime.now() - started).seconds < 60


def test_drops_are_counted_over_more_reports_than_a_query_keeps(spark, tmp_path):
    """One late row in each of 110 batches."""
    folder = tmp_path / "in"
    folder.mkdir()
    batches(spark, folder, [[(0, "a", at(100 + i), 1)] + ([(0, "a", at(1), 1)] if i > 1 else []) for i in range(112)])
    rows = read_rows(spark, str(folder), spark.createDataFrame([], ROWS).schema, "json", maxFilesPerTrigger="1", latestFirst="false")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        unique = rows.withWatermark("event_ts", "3 seconds").dropDuplicates(["arrival", "event_ts"])
        with counting_drops(spark) as counter:
            query = drain(unique.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")), 600)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(query.recentProgress) <= 100 < sum(1 for i in range(112) if i > 1)
    assert counter.dropped[str(query.id)] == 110


def test_an_unfinished_drain_says_so(spark, tmp_path):
    raw = tmp_path / "raw"
    put(raw, "1.json", ["x"])

    def slow(batch, batch_id):
        import time

        time.sleep(20)

    writer = read_messages(spark, str(raw)).writeStream.foreachBatch(slow).option("checkpointLocation", str(tmp_path / "ck"))
    with pytest.raises(Unfinished):
        drain(writer, 2)


def test_a_lost_state_is_an_error(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    rows = stream(4, 20)
    batches(spark, folder, [rows[:10]])
    source = lambda: read_rows(spark, str(folder), spark.createDataFrame([], ROWS).schema, "json")
    drain(replay(source(), root, str(tmp_path / "ck")), 240)
    shutil.move(f"{root}/state_watermark", f"{root}/elsewhere")
    batches(spark, folder, [rows[:10], rows[10:]])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        drain(replay(source(), root, str(tmp_path / "ck")), 240)


def test_a_replay_leaves_no_scratch_tables(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    batches(spark, folder, [stream(4, 20)])
    before = set(os.listdir(checkpoint_dir(spark).removeprefix("file:"))) if os.path.isdir(checkpoint_dir(spark)) else set()
    drain(replay(read_rows(spark, str(folder), spark.createDataFrame([], ROWS).schema, "json"), str(tmp_path / "out"), str(tmp_path / "ck")), 240)
    assert {n for n in os.listdir(checkpoint_dir(spark)) if n.startswith("opsledger-")} <= before


def test_a_tail_starts_with_what_comes_next(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    put(raw, "1.json", ["old"])
    follow = lambda: drain(append_sink(tail_messages(spark, str(raw), str(tmp_path / "seen")), out, str(tmp_path / "ck")), 120)
    follow()
    put(raw, "2.json", ["new"])
    follow()
    assert [r["value"] for r in spark.read.schema("value string").parquet(out).collect()] == ["new"]
