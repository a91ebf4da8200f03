import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsledger.operators.running import running
from opsledger.operators.windows import flag_late, hopping_mean, severe, sliding_mean, tumbling_count

T0 = datetime(2026, 1, 1)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def stream(seed: int, n: int = 300):
    """(arrival, key, time, value): out of order, one hot key, repeated instants."""
    rng = random.Random(seed)
    clock, rows = 0.0, []
    for i in range(n):
        clock += rng.choice([0, 0.1, 0.5, 1.5])
        key = "hot" if rng.random() < 0.6 else rng.choice("abc")
        rows.append((i * 7, key, at(max(0, clock - rng.choice([0, 0, 1, 2.9, 3, 4, 8]))), rng.randint(0, 300)))
    return rows


def loop(rows, start=T0):
    """The per-event rules, one row at a time."""
    mark, frames, late, means, buckets = start, defaultdict(list), {}, {}, defaultdict(int)
    for arrival, key, ts, value in rows:
        late[arrival] = ts < mark - timedelta(seconds=3)
        if late[arrival]:
            continue
        mark = max(mark, ts)
        buckets[ts.replace(microsecond=0)] += 1
        frames[key].append((ts, value))
        frames[key] = [(t, v) for t, v in frames[key] if t > ts - timedelta(seconds=5)]
        means[arrival] = (sum(v for _, v in frames[key]) / len(frames[key]), len(frames[key]))
    return late, means, buckets


def frame(spark, rows):
    return spark.createDataFrame(rows, "arrival bigint, key string, ts timestamp, value int")


@pytest.mark.parametrize("block", [1, 16, 1 << 16])
def test_running_equals_the_plain_scan(spark, block):
    rows = [(i * 3, "a" if i % 3 else "b", (i * 37) % 101) for i in range(200)]
    df = spark.createDataFrame(rows, "seq bigint, key string, v int")
    totals = {"high": ("max", F.col("v")), "total": ("sum", F.col("v"))}
    found = {r["seq"]: r for r in running(df, "seq", totals, ["key"], block=block).collect()}
    before = {r["seq"]: r["high"] for r in running(df, "seq", {"high": ("max", F.col("v"))}, block=block, exclusive=True).collect()}
    seen = defaultdict(list)
    for seq, key, v in rows:
        assert before[seq] == max((x[2] for x in rows if x[0] < seq), default=None)
        seen[key].append(v)
        assert (found[seq]["high"], found[seq]["total"]) == (max(seen[key]), sum(seen[key]))


@pytest.mark.parametrize("seed", range(4))
def test_replay_equals_the_event_loop(spark, seed):
    rows = stream(seed)
    late, means, buckets = loop(rows)
    flagged = flag_late(frame(spark, rows), "ts", "arrival", "3 seconds", F.lit(T0), block=64)
    assert {r["arrival"]: r["late"] for r in flagged.collect()} == late
    on_time = flagged.where("not late")
    counted = tumbling_count(on_time, "ts", "1 second")
    assert {r["window_start"]: r["events"] for r in counted.collect()} == dict(buckets)
    rolled = sliding_mean(on_time, "key", "ts", "arrival", "value", "5 seconds", block=64, time_block=1 << 18)
    found = {r["arrival"]: (r["rolling_mean"], r["rolling_count"]) for r in rolled.collect()}
    assert found == {a: (pytest.approx(m), n) for a, (m, n) in means.items()}


def test_exactly_at_the_lateness_is_on_time(spark):
    rows = [(0, "a", at(10), 1), (1, "a", at(7), 1), (2, "a", at(6.999), 1), (3, "a", at(2), 1)]
    flagged = flag_late(frame(spark, rows), "ts", "arrival", "3 seconds")
    assert [r["late"] for r in flagged.orderBy("arrival").collect()] == [False, False, True, True]


def test_frames_exclude_their_lower_bound(spark):
    rolled = sliding_mean(frame(spark, [(0, "a", at(0), 10), (1, "a", at(5), 20)]), "key", "ts", "arrival", "value", "5 seconds")
    assert [r["rolling_mean"] for r in rolled.orderBy("arrival").collect()] == [10.0, 20.0]


def test_severe_is_strict(spark):
    rows = frame(spark, [(0, "a", at(0), 120), (1, "a", at(0), 121)])
    assert [r["value"] for r in severe(rows, "value", 120).collect()] == [121]


def test_hopping_mean_copies_panes_not_rows(spark):
    rows = frame(spark, stream(9))
    found = hopping_mean(rows, ["key"], "ts", F.col("value"), "5 seconds", "1 second")
    plain = rows.groupBy("key", F.window("ts", "5 seconds", "1 second").start.alias("w")).agg(F.avg("value").alias("m"))
    expected = {(r["key"], r["w"]): pytest.approx(r["m"]) for r in plain.collect()}
    assert {(r["key"], r["window_start"]): r["mean_value"] for r in found.collect()} == expected


def test_rows_without_a_key_are_a_key_and_without_a_place_an_error(spark):
    rows = [(i, None if i % 3 == 0 else "a", at(i), i) for i in range(30)]
    rolled = sliding_mean(frame(spark, rows), "key", "ts", "arrival", "value", "5 seconds", block=8, time_block=1 << 18)
    found = {r["arrival"]: (r["rolling_mean"], r["rolling_count"]) for r in rolled.collect()}
    _, means, _ = loop(rows)
    assert found == {a: (pytest.approx(m), n) for a, (m, n) in means.items()}
    late = flag_late(frame(spark, [(1, None, at(9), 1), (2, "a", at(1), 1)]), "ts", "arrival", "3 seconds")
    assert [r["late"] for r in late.orderBy("arrival").collect()] == [False, True]
    with pytest.raises(Exception, match="NULL in arrival"):
        flag_late(frame(spark, [(None, "a", at(1), 1), (2, "a", at(1), 1)]), "ts", "arrival", "3 seconds").collect()


@pytest.mark.parametrize("value", [1e-7, 1.2345670000000001e-05, 1e13, 123.456789012345, -2.5e20])
def test_means_keep_the_digits_of_their_values(spark, value):
    rows = [(i, "a", at(i), value * (1 + i)) for i in range(12)]
    df = spark.createDataFrame(rows, "arrival bigint, key string, ts timestamp, value double")
    found = [r["rolling_mean"] for r in sliding_mean(df, "key", "ts", "arrival", "value", "3 seconds").orderBy("arrival").collect()]
    wanted = [sum(v for _, _, _, v in rows[max(0, i - 2) : i + 1]) / min(3, i + 1) for i in range(12)]
    assert found == pytest.approx(wanted, rel=1e-13)


def test_a_value_too_large_to_add_exactly_stops_the_job(spark):
    df = spark.createDataFrame([(1, "a", at(1), 1e33)], "arrival bigint, key string, ts timestamp, value double")
    with pytest.raises(Exception, match="OUT_OF_RANGE|OVERFLOW"):
        sliding_mean(df, "key", "ts", "arrival", "value", "3 seconds").collect()


def test_missing_values_count_for_nothing(spark):
    df = spark.createDataFrame([(1, "a", at(1), None), (2, "a", at(2), 4.0)], "arrival bigint, key string, ts timestamp, value double")
    found = sliding_mean(df, "key", "ts", "arrival", "value", "3 seconds").orderBy("arrival").collect()
    assert [(r["rolling_mean"], r["rolling_count"]) for r in found] == [(None, 0), (4.0, 1)]
