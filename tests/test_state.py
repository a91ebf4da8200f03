import os
import subprocess
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsledger.flights import BRONZE_SCHEMA
from opsledger.operators import layout, state
from opsledger.operators.skew import hot_keys, lookup_join
from opsledger.operators.state import expired_versions, latest_per_key, merge_audit, merge_latest, purge_bad_keys, state_as_of
from opsledger.operators.summary import daily_summary
from opsledger.sources.tables import append, first_rows, read_or_empty, seed, table_exists

T0 = datetime(2026, 8, 5)
SCHEMA = "k string, ts timestamp, v string, batch int"


def t(hours: float) -> datetime:
    return T0 + timedelta(hours=hours)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_merge_updates_only_with_strictly_newer_rows(spark):
    target = spark.createDataFrame([("a", t(1), "old", 0), ("b", t(1), "old", 0), ("c", t(5), "old", 0)], SCHEMA)
    source = spark.createDataFrame(
        [("a", t(2), "new", 1), ("a", t(1.5), "mid", 1), ("b", t(1), "tie", 1), ("c", t(2), "stale", 1), ("d", t(0), "first", 1)],
        SCHEMA,
    )
    merged = merge_latest(target, source, "k", "ts")
    assert rows(merged, "k", "v") == [("a", "new"), ("b", "old"), ("c", "old"), ("d", "first")]
    assert rows(merge_latest(None, source, "k", "ts"), "k", "v") == [("a", "new"), ("b", "tie"), ("c", "stale"), ("d", "first")]


def test_latest_breaks_ties_the_same_way_whatever_the_order(spark):
    data = [("a", t(1), f"v{i}", i % 3) for i in range(20)]
    first = latest_per_key(spark.createDataFrame(data, SCHEMA), "k", "ts", ["batch"])
    again = latest_per_key(spark.createDataFrame(data[::-1], SCHEMA).repartition(7), "k", "ts", ["batch"])
    assert first.collect() == again.collect() and first.first()["batch"] == 2


def test_latest_carries_columns_without_an_order(spark):
    data = [("a", t(1), {"x": 1}), ("a", t(2), {"x": 2}), ("b", t(0), None)]
    df = spark.createDataFrame(data, "k string, ts timestamp, m map<string,int>")
    assert [r["m"] for r in latest_per_key(df, "k", "ts").orderBy("k").collect()] == [{"x": 2}, None]


def test_past_states_and_audit(spark):
    data = [("a", t(1), "1", 0), ("b", t(1), "1", 0), ("a", t(3), "2", 1), ("b", t(0), "0", 1), ("c", t(1), "1", 1), ("a", t(2), "x", 2)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(state_as_of(df, "k", "ts", "batch", F.lit(0)), "k", "v") == [("a", "1"), ("b", "1")]
    assert rows(state_as_of(df, "k", "ts", "batch", F.lit(2)), "k", "v") == [("a", "2"), ("b", "1"), ("c", "1")]
    audit = rows(merge_audit(df, "k", "ts", "batch"), "version", "operation", "inserted", "updated", "stale", "state_rows")
    assert audit == [(0, "WRITE", 2, 0, 0, 2), (1, "MERGE", 1, 1, 1, 3), (2, "MERGE", 0, 0, 1, 3)]


@pytest.mark.parametrize("min_rows", [1, 10**6])
def test_expired_versions_with_and_without_hot_keys(spark, min_rows):
    data = [(i, "hot" if i % 3 else f"k{i % 5}", t(i % 40)) for i in range(300)]
    df = spark.createDataFrame(data, "id bigint, k string, ts timestamp")
    found = {r["id"] for r in expired_versions(df, "k", "ts", F.lit(t(30)), "id", min_rows=min_rows).collect()}
    expected = {
        i for i, k, ts in data if any(k2 == k and (ts, i) < (ts2, i2) and ts2 < t(30) for i2, k2, ts2 in data)
    }
    assert found == expected


def test_lookup_join_spreads_hot_and_missing_keys(spark):
    big = spark.createDataFrame(
        [(i, "hot" if i % 2 else (None if i % 4 else f"k{i}")) for i in range(400)], "id bigint, k string"
    )
    small = spark.createDataFrame([("hot", 1), ("k4", 2), ("other", 3)], "k string, x int")
    joined = lookup_join(big, small, "k", F.col("id"), min_rows=10, salts=8)
    assert joined.count() == 400
    assert rows(joined.groupBy("x").count().where("x is not null"), "x", "count") == [(1, 200), (2, 1)]
    assert [r["k"] for r in hot_keys(big, "k", min_rows=10).collect()] == ["hot"]
    assert lookup_join(big, small, "k", F.col("id"), "inner", min_rows=10, salts=8).count() == 201


def test_purge_removes_rows_and_their_state(spark):
    history = spark.createDataFrame([("a", 1), ("a", -1), ("b", 2), ("c", None)], "k string, v int")
    state = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    clean, left = purge_bad_keys(state, history, "k", F.col("v") < 0)
    assert clean.count() == 3 and rows(left, "k") == [("b",), ("c",)]


def test_summary_matches_known_rows(spark):
    def flights(airline, total, delays, cancelled):
        day = T0.date()
        late = [(airline, day, "DELAYED", d) for d in delays]
        return late + [(airline, day, "CANCELLED", None)] * cancelled + [(airline, day, "ARRIVED", 5)] * (total - cancelled - len(delays))

    data = flights("F3", 55, [153, 154, 154, 153, 154, 153, 154], 7) + flights("SV", 53, [114, 115] * 5, 3) + flights("ZZ", 2, [], 0)
    df = spark.createDataFrame(data, "airline_code string, scheduled_date date, status string, delay_minutes int")
    result = daily_summary(df, ["airline_code", "scheduled_date"], "status", "delay_minutes", "DELAYED", "CANCELLED")
    found = {r["airline_code"]: r for r in result.collect()}
    assert (found["F3"]["on_time_pct"], found["SV"]["on_time_pct"]) == (74.5, 75.5)
    assert found["F3"]["avg_delay_minutes"] == pytest.approx(153.57142857142858)
    assert found["SV"]["avg_delay_minutes"] == 114.5 and found["ZZ"]["avg_delay_minutes"] is None


def bronze(spark, **change):
    row = {
        "flight_id": "SV1", "airline_code": "SV", "flight_number": "1", "scheduled_date": T0.date(), "origin": "RUH",
        "destination": "JED", "status": "ARRIVED", "gate": None, "delay_minutes": None, "delay_reason_code": None,
        "event_ts": T0, "source_feed": "ops", "ingested_at": T0,
    }
    return spark.createDataFrame([tuple(row.values())], BRONZE_SCHEMA).withColumns(change)


def test_append_refuses_what_does_not_fit(spark, tmp_path):
    path = str(tmp_path / "bronze")
    assert not table_exists(spark, path) and read_or_empty(spark, path, BRONZE_SCHEMA).count() == 0
    assert append(bronze(spark), path, BRONZE_SCHEMA) == 1
    wrong = bronze(spark, delay_minutes=F.lit("thirty")).drop("flight_id")
    with pytest.raises(layout.SchemaRefused, match="'flight_id' is missing.*'delay_minutes' is string"):
        append(wrong, path, BRONZE_SCHEMA)
    with pytest.raises(layout.SchemaRefused, match="ops_notes"):
        append(bronze(spark, ops_notes=F.lit("x")), path, BRONZE_SCHEMA)
    with pytest.raises(Exception, match="NULL in required column status"):
        append(bronze(spark, status=F.lit(None).cast("string")), path, BRONZE_SCHEMA)
    assert spark.read.parquet(path).count() == 1
    append(bronze(spark, ops_notes=F.lit("checked")), path, BRONZE_SCHEMA, allow_new=True)
    evolved = spark.read.option("mergeSchema", "true").parquet(path)
    assert sorted(str(r["ops_notes"]) for r in evolved.collect()) == ["None", "checked"]


def test_evolve_union(spark):
    both = layout.evolve_union(bronze(spark), bronze(spark, ops_notes=F.lit("n")))
    assert rows(both.select(F.coalesce("ops_notes", F.lit("-")).alias("n")), "n") == [("-",), ("n",)]


def test_clustered_rewrite_has_disjoint_files(spark, tmp_path):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.lpad(F.xxhash64("id").cast("string"), 21, "0")).alias("k"), "id")
    before = str(tmp_path / "v0")
    df.repartition(12).write.parquet(before)
    old = spark.read.parquet(before)
    new = layout.rewrite_clustered(old, "k", str(tmp_path / "v1"), 4)
    assert layout.layout_change(old, new) == (12, 4)
    spans = sorted(
        (r["minKey"], r["maxKey"], r["numRows"])
        for r in layout.file_metrics(new, "k").select("metrics.minKey", "metrics.maxKey", "metrics.numRows").collect()
    )
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and sum(s[2] for s in spans) == 5000


def test_a_seed_is_the_first_rows_in_order(spark, tmp_path):
    df = spark.range(100).repartition(5).withColumn("half", F.expr("id div 2"))
    path = str(tmp_path / "seed")
    assert seed(df, [F.desc("half"), "id"], 3, path) == 3 and seed(df, [F.desc("half"), "id"], 5, path) == 5
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [94, 96, 97, 98, 99]
    assert [r["id"] for r in first_rows(df, [F.desc("half"), "id"], 3).collect()] == [98, 99, 96]


def test_rows_without_a_key_are_versions_of_one_record(spark):
    rows = [(1, None, 1), (2, None, 2), (3, None, 3), (4, "a", 1), (5, "a", 2)]
    df = spark.createDataFrame(rows, "id int, key string, ts int")
    for min_rows in (1, 1000):
        expired = state.expired_versions(df, "key", "ts", F.lit(9), "id", min_rows=min_rows)
        assert sorted(r["id"] for r in expired.collect()) == [1, 2, 4]


def test_a_broken_table_is_not_an_absent_one(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_text("no parquet")
    assert not table_exists(spark, str(tmp_path / "none"))
    with pytest.raises(Exception):
        table_exists(spark, str(tmp_path / "t"))


def test_arrow_operators_run_from_any_folder(tmp_path):
    """The package travels with the session: no working directory or path has to hold it."""
    code = """
import sys; sys.path.insert(0, {root!r})
from opsledger.session import get_spark
from opsledger.operators.bm25 import postings
spark = get_spark("elsewhere", "local[2]", **{{"spark.ui.enabled": "false"}})
sys.path.remove({root!r})
print("rows", postings(spark.createDataFrame([(1, "a b a")], "doc_id int, text string"), "doc_id", "text").count())
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code.format(root=root)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows 2" in done.stdout, done.stderr[-2000:]


def test_materialize_deletes_what_was_shuffled(spark):
    """A table's shuffle files go when it is written, and the session's own setting stays."""
    from opsledger.session import _CLEANUP, materialize

    def files():
        places = [str(p) for p in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
        return sum(f.startswith("shuffle_") for p in places for _, _, names in os.walk(p) for f in names)

    before, setting = files(), spark.conf.get(_CLEANUP)
    made = materialize(spark.range(1000).selectExpr("id % 10 as k").groupBy("k").count())
    assert files() <= before and spark.conf.get(_CLEANUP) == setting
    assert made.count() == 10
