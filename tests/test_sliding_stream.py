"""The stateful sliding mean on a stream, against the batch operator and over restarts."""

import json
import os
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsledger.operators.windows import sliding_mean
from opsledger.sources.streams import append_sink, drain, read_rows
from opsledger.streaming.sliding import frame_means, sliding_means, state_in_rocksdb

SCHEMA = "n bigint, kind string, ts timestamp, value double"
START = datetime(2024, 3, 1)


def write_file(folder, number, rows):
    path = folder / f"{number:03d}.json"
    path.write_text("".join(json.dumps({"n": n, "kind": k, "ts": t.isoformat(), "value": v}) + "\n" for n, k, t, v in rows))
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def run(spark, tmp_path):
    stream = read_rows(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema, "json", maxFilesPerTrigger="1")
    with state_in_rocksdb(spark):
        return drain(append_sink(sliding_means(stream, "kind", "ts", ["n"], "value", "60 seconds", "10 seconds"), str(tmp_path / "out"), str(tmp_path / "ck")), 300)


def ordered(count, seed):
    rng = random.Random(seed)
    at, rows = START, []
    for n in range(count):
        at += timedelta(seconds=rng.choice([0, 0, 1, 3, 40]))
        rows.append((n, rng.choice(["a", "a", "b", None]), at, rng.choice([None, 1.5, 10.0, 1e6 * n])))
    return rows


def test_restarted_stream_equals_batch_on_ordered_input(spark, tmp_path):
    rows = ordered(240, 2)
    (tmp_path / "in").mkdir()
    for number in range(2):
        write_file(tmp_path / "in", number, rows[number * 60 : number * 60 + 60])
    run(spark, tmp_path)
    for number in range(2, 4):  # a new query from the checkpoint
        write_file(tmp_path / "in", number, rows[number * 60 : number * 60 + 60])
    run(spark, tmp_path)
    told = lambda df: {r["n"]: (r["kind"], None if r["rolling_mean"] is None else pytest.approx(r["rolling_mean"]), r["rolling_count"]) for r in df.collect()}
    batch = sliding_mean(spark.createDataFrame(rows, SCHEMA), "kind", "ts", "n", "value", "60 seconds")
    found, expected = told(spark.read.parquet(str(tmp_path / "out"))), told(batch)
    assert len(found) == len(rows) and found == expected
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)


def test_state_of_silent_keys_is_dropped_by_timer(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_file(tmp_path / "in", 0, [(k, f"key{k}", START, 1.0) for k in range(20)])
    write_file(tmp_path / "in", 1, [(20, "late riser", START + timedelta(hours=1), 2.0)])
    write_file(tmp_path / "in", 2, [(21, "late riser", START + timedelta(hours=2), 4.0)])
    write_file(tmp_path / "in", 3, [(22, "key0", START, 1.0)])
    query = run(spark, tmp_path)
    held = [sum(op.numRowsTotal for op in p.stateOperators) for p in query.recentProgress if p.stateOperators]
    assert max(held) >= 20 and held[-1] < 20
    found = {r["n"]: r["rolling_count"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert 22 not in found and found[21] == 1  # row 22 came after the watermark


def test_frames_of_random_rows_equal_a_loop():
    rng = np.random.default_rng(4)
    for _ in range(200):
        at = np.cumsum(rng.integers(-2, 5, 60))  # lateness shorter than the width
        value = np.where(rng.random(60) < 0.2, np.nan, rng.integers(0, 9, 60).astype(float))
        split = int(rng.integers(1, 59))
        first = frame_means(np.empty(0, np.int64), np.empty(0), None, at[:split], value[:split], 20)
        second = frame_means(first[2], first[3], first[4], at[split:], value[split:], 20)
        total, count = np.concatenate([first[0], second[0]]), np.concatenate([first[1], second[1]])
        for i in range(60):
            frame = [v for t, v in zip(at[: i + 1], value[: i + 1]) if t > at[: i + 1].max() - 20 and not np.isnan(v)]
            assert count[i] == len(frame) and total[i] == pytest.approx(sum(frame))


def test_unset_provider_is_put_back(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    with state_in_rocksdb(spark):
        assert spark.conf.get(name) != before
    assert spark.conf.get(name) == before
    assert spark.range(1).select(F.lit(1)).count() == 1
