"""Every operator run on the shared test tables; each entry takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsledger.functions.text import word_overlap
from opsledger.functions.times import micros
from opsledger.operators import answer, bm25, chunks, contract, fusion, knn, layout, quality, runs, segments, state, summary, vector_index, windows
from opsledger.plans.ask import ask, index_chunks
from opsledger.session import checkpoint_dir, materialize
from opsledger.sources.streams import append_sink, drain, read_rows, tail_messages
from opsledger.sources.tables import first_rows, overwrite, read_csv, read_documents, route_batch, seed
from opsledger.streaming import sliding as stream_sliding
from opsledger.streaming import windows as stream_windows
from opsledger.streaming.replay import Replay, replay

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LATENESS, SLIDING, SEVERE = "30 minutes", "60 minutes", 120.0
DIM = 256


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Dates and nullable integers as text, so that results compare alike in any engine."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _k() -> F.Column:
    """The integer every event carries in its JSON properties."""
    return F.get_json_object("props", "$.k").cast("int")


# Summaries


def _orders_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("airline_code"),
        F.to_date("o_orderdate").alias("scheduled_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("delay_minutes"),
    )


@query
def daily_summary(spark: SparkSession, folder: str) -> DataFrame:
    groups = ["airline_code", "scheduled_date"]
    result = summary.daily_summary(_orders_by_day(spark, folder), groups, "status", "delay_minutes", "F", "P")
    return _as_text(result.withColumn("avg_delay_minutes", F.round("avg_delay_minutes", 4)), "scheduled_date")


@query
def summary_head(spark: SparkSession, folder: str) -> DataFrame:
    """The first rows of the daily summary in reading order."""
    return first_rows(daily_summary(spark, folder), ["scheduled_date", "airline_code"], 20)


@query
def seed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A seed table of the first five orders, written and read again."""
    path = f"{_place(spark, 'seed')}"
    seed(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_custkey", "o_orderkey"], 5, path)
    return spark.read.parquet(path)


def _place(spark: SparkSession, name: str) -> str:
    """A new folder that every executor can reach."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The orders as CSV: every row read again, and the first hundred."""
    out = _place(spark, "csv")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    orders.write.csv(out, header=True)
    kinds = "o_orderkey bigint, o_orderstatus string, o_totalprice double"
    first = read_csv(spark, out, kinds, 100).agg(F.count("*").alias("first_rows"))
    return read_csv(spark, out, kinds).agg(F.count("*").alias("row_count"), F.round(F.sum("o_totalprice"), 2).alias("total")).join(F.broadcast(first))


@query
def text_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark text in a file of its own, read whole."""
    out = _place(spark, "files")
    table(spark, folder, "benchmark").select("item_id", "text").write.partitionBy("item_id").text(out)
    files = read_documents(spark, f"{out}/*/*.txt")
    return files.select(F.rtrim(F.col("text"), F.lit("\n")).alias("text"))


@query
def counted_write(spark: SparkSession, folder: str) -> DataFrame:
    """The number of rows a write reports, and the number the table holds."""
    out = _place(spark, "counted")
    written = overwrite(table(spark, folder, "orders").where("o_orderstatus <> 'P'"), out)
    return spark.read.parquet(out).agg(F.lit(written).alias("written"), F.count("*").alias("stored"))


@query
def delay_by_cause(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders_by_day(spark, folder)
    result = summary.delay_by_cause(orders, F.col("scheduled_date"), "airline_code", "status", "delay_minutes", "F")
    return _as_text(result.withColumn("avg_delay_minutes", F.round("avg_delay_minutes", 4)), "day")


# State tables


@query
def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    return state.latest_per_key(table(spark, folder, "events"), "user_id", "ts", ["event_id"])


@query
def latest_merge(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    held = state.latest_per_key(events.where("ts < timestamp_ntz'2024-01-20'"), "user_id", "ts", ["event_id"])
    incoming = events.where("ts >= timestamp_ntz'2024-01-10'").withColumn("event_type", F.upper("event_type"))
    return state.merge_latest(held, incoming, "user_id", "ts", ["event_id"])


@query
def state_as_of(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("batch", F.to_date("ts"))
    past = state.state_as_of(events, "user_id", "ts", "batch", F.lit("2024-01-15").cast("date"), ["event_id"])
    return _as_text(past, "batch")


def _history(spark: SparkSession, folder: str) -> DataFrame:
    """Events that arrive on the day of `ts` about an instant up to 99 hours earlier."""
    return table(spark, folder, "events").select(
        "user_id", F.to_date("ts").alias("batch"), (F.col("ts") - F.make_dt_interval(hours=_k())).alias("event_ts")
    )


@query
def merge_audit(spark: SparkSession, folder: str) -> DataFrame:
    return _as_text(state.merge_audit(_history(spark, folder), "user_id", "event_ts", "batch"), "batch")


@query
def version_range(spark: SparkSession, folder: str) -> DataFrame:
    return state.version_range(state.merge_audit(_history(spark, folder), "user_id", "event_ts", "batch"))


@query
def expired_versions(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", F.nullif("user_id", F.lit(7)).alias("user_id"), "ts")
    expired = state.expired_versions(events, "user_id", "ts", F.expr("timestamp_ntz'2024-01-20'"), "event_id")
    return _as_text(expired, "user_id")


@query
def purge_bad_keys(spark: SparkSession, folder: str) -> DataFrame:
    customers, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    bad = F.col("o_totalprice") < 5000
    history = orders.select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    return state.purge_bad_keys(customers, history, "c_custkey", bad)[1].select("c_custkey", "c_name")


@query
def purge_bad_rows(spark: SparkSession, folder: str) -> DataFrame:
    customers, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    history = orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    return state.purge_bad_keys(customers, history, "c_custkey", F.col("o_totalprice") < 5000)[0]


@query
def schema_evolve_union(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    return layout.evolve_union(suppliers, customers)


@query
def append_refused(spark: SparkSession, folder: str) -> DataFrame:
    """What an append to the events table says of four loads: fitting, changed type, missing and new column."""
    events = table(spark, folder, "events").select("event_id", "user_id", "value")
    target = T.StructType([T.StructField(f.name, f.dataType, f.name != "event_id") for f in events.schema.fields])
    loads = {
        "fits": events,
        "changed": events.withColumn("user_id", F.col("user_id").cast("string")),
        "missing": events.drop("event_id"),
        "new": events.withColumn("extra", F.lit(1)),
    }
    said = {name: "; ".join(layout.schema_problems(load.schema, target)) for name, load in loads.items()}
    rows = [load.agg(F.lit(name).alias("load"), F.count("*").alias("row_count"), F.lit(said[name]).alias("problems")) for name, load in loads.items()]
    return reduce(DataFrame.unionByName, rows)


@query
def clustered_files(spark: SparkSession, folder: str) -> DataFrame:
    """Orders rewritten in ranges of the customer: rows, key range, and whether the files' ranges are disjoint."""
    laid = layout.rewrite_clustered(table(spark, folder, "orders"), "o_custkey", _place(spark, "clustered"), 8)
    files = layout.file_metrics(laid, "o_custkey").select("metrics.*")
    ranges = F.array_sort(F.collect_list(F.struct("minKey", "maxKey")))
    n = F.size("r") - 1
    apart = F.zip_with(F.slice("r", F.lit(1), n), F.slice("r", F.lit(2), n), lambda a, b: a["maxKey"] < b["minKey"])
    folded = files.agg(F.sum("numRows").alias("row_count"), F.min("minKey").alias("min_key"), F.max("maxKey").alias("max_key"), ranges.alias("r"))
    return folded.select("row_count", "min_key", "max_key", F.forall(apart, lambda x: x).alias("disjoint"))


# Quality


@query
def gate_outcome(spark: SparkSession, folder: str) -> DataFrame:
    """Both gates' verdicts."""
    verdicts = [quality.verdict(gate(spark, folder)).withColumn("gate", F.lit(name)) for name, gate in (("bronze", gate_bronze), ("silver", gate_silver))]
    return verdicts[0].unionByName(verdicts[1])


@query
def routed_batch(spark: SparkSession, folder: str) -> DataFrame:
    """A batch that passes and one that fails, each written whole where its verdict sends it."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    limits = {"low": 0.0, "high": 5000.0}
    parts = []
    for name, low in limits.items():
        passed = quality.verdict(quality.run_checks(orders, [quality.between("o_totalprice", low=low)])).first()["passed"]
        places = [_place(spark, place) for place in ("production", "quarantine")]
        went = route_batch(orders, passed, *places)
        kind = "production" if went == places[0] else "quarantine"
        parts.append(spark.read.parquet(went).agg(F.lit(name).alias("batch"), F.lit(kind).alias("place"), F.count("*").alias("row_count")))
    return parts[0].unionByName(parts[1])


@query
def duplicate_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every event twice, half of the copies a microsecond later: only the others are duplicates."""
    events = table(spark, folder, "events").select("event_id", "ts", _k().alias("k"))
    later = F.when(F.col("k") < 50, F.col("ts") + F.expr("INTERVAL '0.000001' SECOND")).otherwise(F.col("ts"))
    twice = events.unionByName(events.withColumn("ts", later))
    return quality.run_checks(twice, [quality.no_duplicate_rows(["event_id", "ts"])])


@query
def gate_bronze(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return quality.run_checks(
        events,
        [
            quality.not_null("user_id"),
            quality.in_set("event_type", ["click", "view", "purchase", "signup"]),
            quality.between("value", low=0.5, high=200.0, mostly=0.9),
            quality.pair_differs("event_id", "user_id"),
        ],
    )


@query
def gate_silver(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").withColumn(
        "promised", F.date_add(F.to_date("l_shipdate"), F.col("l_linenumber") - 3)
    )
    return quality.run_checks(
        lines,
        [
            quality.unique("l_orderkey"),
            quality.regex("l_returnflag", "^[AN]$"),
            quality.regex("l_linestatus", "^[A-Z]$"),
            quality.max_drift("l_shipdate", "promised", 1),
        ],
    )


def _document_scan(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").withColumn("marked", F.nullif("lang", F.lit("de")))
    return quality.run_checks(
        documents,
        [
            quality.null_ratio("marked", 0.05),
            quality.between("n_chars", 20, 10000),
            quality.pair_differs("lang", "source"),
            quality.equals("marked", "en"),
            quality.no_duplicate_rows(["text"]),
            quality.regex("marked", "^[a-z]{2}$", nulls="fail"),
        ],
    )


@query
def dq_scan(spark: SparkSession, folder: str) -> DataFrame:
    return _document_scan(spark, folder)


@query
def dq_verdict(spark: SparkSession, folder: str) -> DataFrame:
    return quality.verdict(_document_scan(spark, folder))


@query
def profile_table(spark: SparkSession, folder: str) -> DataFrame:
    return quality.profile_table(table(spark, folder, "orders"))


@query
def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.value_counts(table(spark, folder, "events"), "event_type")


# Ingest contract


def flight_json(spark: SparkSession, folder: str) -> DataFrame:
    """Each event as a raw flight message. The number in its properties decides what is wrong with it."""
    k = F.col("k")
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    none = F.lit("null")
    day = F.date_format("ts", "yyyy-MM-dd")
    fields = {
        "airline_code": F.when((k == 10) | (k == 61), '"x"').when(k == 11, '"toolong"').when(k == 12, "7").otherwise('"sv"'),
        "flight_number": text(F.col("user_id").cast("string")),
        "scheduled_date": F.when(k == 20, '"2024-13-45"').when(k == 21, "true").otherwise(text(day)),
        "origin": F.when((k == 22) | (k == 60), '""').otherwise('"ruh"'),
        "destination": F.lit('"jed"'),
        "status": F.when((k == 30) | (k == 60), '"ON_APPROACH"')
        .when(F.col("event_type") == "click", '"BOARDING"')
        .when(F.col("event_type") == "signup", '"GATE_CHANGE"')
        .when(F.col("event_type") == "error", '"DELAYED"')
        .when(F.col("event_type") == "purchase", '"DEPARTED"')
        .otherwise('"SCHEDULED"'),
        "gate": F.when(k >= 15, '"A12"').otherwise(none),
        "delay_minutes": F.when((k == 50) | (k == 61), "-15").when(k == 51, "30.5").when(k == 52, '"30"').when(k == 53, "true")
        .when(k == 54, '""').when(k == 55, none).otherwise(F.floor("value").cast("string")),
        "delay_reason_code": F.when(k >= 25, '"ATC"').otherwise(none),
        "event_ts": F.when((k == 70) | (k == 61), '"not-a-timestamp"').when(k == 71, F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
        .otherwise(text(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))),
        "source_feed": F.lit('"ops"'),
        "extra": F.lit("1"),
    }
    head = F.when(k == 80, "{").otherwise(F.concat(F.lit('{"flight_id":"SV'), "user_id", F.lit('",')))
    body = F.concat_ws(",", *(F.concat(F.lit(f'"{name}":'), value) for name, value in fields.items()))
    whole = F.concat(head, body, F.lit("}"))
    # Generators keep the number and the message computed once each, not again in every branch that uses them.
    once = lambda df, name, value: df.select("*", F.inline(F.array(F.struct(value.alias(name)))))
    written = once(once(table(spark, folder, "events"), "k", _k()), "whole", F.concat(head, body, F.lit("}")))
    whole = F.when(k == 93, F.replace("whole", F.lit('"'), F.lit("'"))).otherwise(F.col("whole"))
    tail = F.when(k == 90, " junk}").when(k == 91, F.col("whole")).when(k == 92, "],[{}").when(k == 94, ",{}").otherwise("")
    value = F.when(k == 99, "not json").when(k == 98, "[1]").otherwise(F.concat(whole, tail))
    return written.select("event_id", value.alias("value"))


@query
def contract_accept(spark: SparkSession, folder: str) -> DataFrame:
    judged = contract.validate_events(flight_json(spark, folder))
    accepted = contract.split_accepted(judged, keep=["event_id"])[0]
    timed = accepted.withColumn("event_us", micros(F.col("event_ts"))).drop("event_ts")
    return _as_text(timed, "scheduled_date", "delay_minutes")


@query
def contract_dlq(spark: SparkSession, folder: str) -> DataFrame:
    judged = contract.validate_events(flight_json(spark, folder))
    reasons = F.transform("rejection_reason", lambda r: F.concat_ws("|", r["field"], r["type"], r["msg"]))
    return judged.where(F.size("rejection_reason") > 0).select(
        "event_id", F.size("rejection_reason").alias("problems"), F.array_join(reasons, ";").alias("reasons")
    )


@query
def encode_events(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", F.nullif("event_type", F.lit("view")).alias("event_type"), "ts")
    return contract.encode(events.withColumn("ts", F.col("ts") + F.expr("INTERVAL '0.000123' SECOND")))


@query
def contract_counts(spark: SparkSession, folder: str) -> DataFrame:
    return contract.contract_counts(contract.validate_events(flight_json(spark, folder)))


@query
def ingest_stamp(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted events as rows of the history: all of one load carry one ingestion time."""
    accepted = contract.split_accepted(contract.validate_events(flight_json(spark, folder)))[0]
    return contract.to_bronze(accepted).agg(F.count("ingested_at").alias("row_count"), F.countDistinct("ingested_at").alias("stamps"))


# Run events


@query
def run_latest_state(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    events = table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("run_id"),
        F.when(kind == "signup", runs.START).when(kind == "purchase", runs.COMPLETE).when(kind == "error", runs.FAIL)
        .otherwise("OTHER").alias("state"),
        F.col("ts").alias("event_time"),
    )
    return runs.latest_run_state(events, order=F.col("event_id"))


# Event-time windows


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Events in arrival order, each about an instant up to 99 minutes before it arrived."""
    return table(spark, folder, "events").select(
        "event_id", "event_type", "value", _k().alias("k"), (F.col("ts") - F.make_dt_interval(mins=_k())).alias("event_ts")
    )


def _flagged(spark: SparkSession, folder: str) -> DataFrame:
    start = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    return windows.flag_late(arrivals(spark, folder), "event_ts", "event_id", LATENESS, start)


@query
def late_events(spark: SparkSession, folder: str) -> DataFrame:
    return _flagged(spark, folder).select("event_id", "event_ts", "watermark", "late")


@query
def late_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _flagged(spark, folder).agg(F.count("*").alias("arrived"), F.count_if("late").alias("dropped"))


@query
def tumbling_count(spark: SparkSession, folder: str) -> DataFrame:
    return windows.tumbling_count(table(spark, folder, "events"), "ts", "1 hour")


@query
def hopping_mean(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    result = windows.hopping_mean(events, ["event_type"], "ts", F.col("value"), "1 hour", "15 minutes")
    return result.withColumn("mean_value", F.round("mean_value", 6))


@query
def sliding_mean(spark: SparkSession, folder: str) -> DataFrame:
    """One key is NULL, one has tiny values and one has huge ones; means are shown in the key's own unit."""
    kind = F.col("event_type")
    unit = F.when(kind == "click", 1e-7).when(kind == "view", 1e11).otherwise(1.0)
    delayed = _flagged(spark, folder).where(~F.col("late") & (F.col("k") >= 20)).withColumn("value", F.col("value") * unit)
    keyed = delayed.withColumns({"event_type": F.nullif(kind, F.lit("signup")), "unit": unit})
    result = windows.sliding_mean(keyed, "event_type", "event_ts", "event_id", "value", SLIDING)
    mean = F.round(F.col("rolling_mean") / F.col("unit"), 6)
    return result.select("event_id", "event_type", mean.alias("rolling_mean"), "rolling_count")


@query
def severe_events(spark: SparkSession, folder: str) -> DataFrame:
    return windows.severe(_flagged(spark, folder), "value", SEVERE, "late").select("event_id", "event_type", "value", "event_ts")


# Streams, drained into new tables


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events file as a stream."""
    schema = table(spark, folder, "events").schema
    return read_rows(spark, folder, schema, pathGlobFilter="events.parquet")


@query
def stream_tumbling(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly counts of the windows that the watermark has closed."""
    out = _place(spark, "stream")
    events = _event_stream(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = stream_windows.tumbling_counts(events, "ts", "1 hour", LATENESS)
    drain(append_sink(counts, f"{out}/table", f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/table").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query
def stream_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    out = _place(spark, "stream")
    found = windows.severe(_event_stream(spark, folder), "value", SEVERE).select("event_id", "event_type", "value")
    drain(append_sink(found, f"{out}/table", f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/table")


@query
def stream_tail(spark: SparkSession, folder: str) -> DataFrame:
    """Messages that arrive after the stream was set up; those there before are passed over."""
    out = _place(spark, "tail")
    events = table(spark, folder, "events").select(F.col("event_id").cast("string").alias("value"), "ts")
    early = F.col("ts") < F.expr("timestamp_ntz'2024-01-15'")
    events.where(early).select("value").write.text(f"{out}/in")
    followed = tail_messages(spark, f"{out}/in", f"{out}/seen")
    events.where(~early).select("value").write.mode("append").text(f"{out}/in")
    drain(append_sink(followed, f"{out}/table", f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/table").select(F.col("value").cast("bigint").alias("event_id"))


@query
def stream_late_drops(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that the exact replay drops as late, and those it keeps."""
    out = _place(spark, "stream")
    shifted = (F.col("ts") - F.make_dt_interval(mins=_k())).alias("event_ts")
    rows = _event_stream(spark, folder).select("event_id", "event_type", "value", shifted)
    cfg = Replay(
        ts="event_ts", order="event_id", key="event_type", value="value", delayed="value IS NOT NULL", tumbling="1 hour",
        sliding=SLIDING, lateness=LATENESS, limit=SEVERE, start="2024-01-01 00:00:00",
    )
    drain(replay(rows, f"{out}/tables", f"{out}/checkpoint", cfg))
    flagged = spark.read.parquet(f"{out}/tables/flagged")
    return flagged.agg(F.count("*").alias("arrived"), F.count_if("late").alias("dropped"))


@query
def stream_sliding_mean(spark: SparkSession, folder: str) -> DataFrame:
    """The stateful sliding mean over the events in order of time, arriving week by week."""
    out = _place(spark, "stream")
    events = table(spark, folder, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.nullif("event_type", F.lit("signup")).alias("kind"), "value")
    week = F.weekofyear("ts")
    for (number,) in events.select(week.alias("w")).distinct().orderBy("w").collect():
        events.where(week == number).write.mode("append").parquet(f"{out}/in")
    rows = read_rows(spark, f"{out}/in", events.schema, maxFilesPerTrigger="1")
    means = stream_sliding.sliding_means(rows, "kind", "ts", ["ts", "event_id"], "value", SLIDING, LATENESS)
    with stream_sliding.state_in_rocksdb(spark):
        drain(append_sink(means, f"{out}/table", f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/table").select("event_id", "kind", F.round("rolling_mean", 6).alias("rolling_mean"), "rolling_count")


# Retrieval


def sectioned(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as markdown: a title line, and every further line of the text as a section."""
    text = F.concat(F.lit("# "), "lang", F.lit(" document "), F.col("doc_id").cast("string"), F.lit("\n## "),
                    F.replace("text", F.lit("\n"), F.lit("\n## ")))
    return table(spark, folder, "documents").select("doc_id", text.alias("text"))


@query
def chunk_sections(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.chunk_sections(sectioned(spark, folder), "doc_id", "text")


def questions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def _scored(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.round("score", 6))


@query
def bm25_terms(spark: SparkSession, folder: str) -> DataFrame:
    index = bm25.postings(_documents(spark, folder), "doc_id", "text")
    return bm25.document_frequency(index)


@query
def bm25_topk(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(bm25.bm25_topk(questions(spark, folder), _documents(spark, folder), 10))


def _segmented(spark: SparkSession, folder: str) -> segments.Segments:
    place = _place(spark, "segments")
    segments.apply(spark, place, _documents(spark, folder))
    return segments.read(spark, place)


@query
def bm25_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The lists of `bm25_topk`, blocks of postings that cannot matter being skipped."""
    return _scored(segments.search(questions(spark, folder), _segmented(spark, folder), 10))


@query
def bm25_postings_read(spark: SparkSession, folder: str) -> DataFrame:
    """Postings that match the questions' words, and whether fewer are read."""
    looked = segments.postings_read(questions(spark, folder), _segmented(spark, folder), 10)
    return looked.select("matching", (F.col("read") < F.col("matching")).alias("fewer_read"))


@query
def bm25_three_loads(spark: SparkSession, folder: str) -> DataFrame:
    """An index after three loads: old texts first, then the rest with changed ones, then further changes and deletions; then merged."""
    place, docs = _place(spark, "segments"), _documents(spark, folder)
    turn = F.pmod("doc_id", F.lit(4))
    old = docs.where(turn < 3).withColumn("text", F.when(turn > 0, F.concat(F.lit("old old "), "text")).otherwise(F.col("text")))
    segments.apply(spark, place, old)
    segments.apply(spark, place, docs.where(turn.isin(1, 3)))
    segments.apply(spark, place, docs.where(turn == 2), deleted=docs.where(F.pmod("doc_id", F.lit(10)) == 7))
    segments.merge(spark, place, 3 * docs.count() // 5)
    return _scored(segments.search(questions(spark, folder), segments.read(spark, place), 10))


def centroids(spark: SparkSession, folder: str) -> DataFrame:
    """The mean vector of every label."""
    parts = table(spark, folder, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"])
    return means.groupBy("label").agg(ordered.alias("embedding")).withColumnRenamed("label", "query_id")


@query
def knn_exact(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return _scored(knn.knn_topk(centroids(spark, folder), vectors, 10))


@query
def knn_approx_probed(spark: SparkSession, folder: str) -> DataFrame:
    """Every row whose id is divisible by 100 against all rows, near buckets visited too."""
    vectors = table(spark, folder, "embeddings")
    asked = vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return _scored(knn.knn_approx(asked, vectors, 10))


def _asked_vectors(vectors: DataFrame) -> DataFrame:
    """Every row whose id is divisible by 100, as a query."""
    return vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@query
def knn_exact_all(spark: SparkSession, folder: str) -> DataFrame:
    """Exact neighbours of every row whose id is divisible by 100, in blocks of queries."""
    vectors = table(spark, folder, "embeddings")
    return _scored(knn.knn_topk(_asked_vectors(vectors), vectors, 10, max_queries=10))


@query
def knn_index_recall(spark: SparkSession, folder: str) -> DataFrame:
    """A stored index built over all vectors and asked with every id divisible by 100: what it finds, and what it compares."""
    vectors = table(spark, folder, "embeddings")
    place = _place(spark, "vectors")
    vector_index.build(vectors, place)
    index, asked = vector_index.read(spark, place), _asked_vectors(vectors)
    found = vector_index.search(asked, index, 10).select("query_id", "vec_id", F.lit(1).alias("found"))
    true = knn.knn_topk(asked, vectors, 10).join(found, ["query_id", "vec_id"], "left")
    hit = true.agg(F.countDistinct("query_id").alias("queries"), (F.count("found") >= 0.9 * F.count("*")).alias("recall_reached"))
    looked = vector_index.compared(asked, index, 50)
    return hit.join(F.broadcast(looked)).select("queries", "recall_reached", (F.col("in_full") <= 0.1 * F.col("pairs")).alias("few_in_full"), "pairs")


@query
def embed_hashing(spark: SparkSession, folder: str) -> DataFrame:
    embedded = knn.hashed(_documents(spark, folder), "text", DIM)
    slots = embedded.select("doc_id", F.posexplode_outer("embedding").alias("slot", "w"))
    return slots.where("w > 0").select("doc_id", "slot", F.round(F.col("w").cast("double"), 6).alias("weight"))


@query
def rrf_fusion(spark: SparkSession, folder: str) -> DataFrame:
    asked, docs = questions(spark, folder), _documents(spark, folder)
    embedded = knn.hashed(asked, "query", DIM), knn.hashed(docs, "text", DIM)
    dense = knn.knn_topk(*embedded, 10, item_id="doc_id", metric="dot")
    sparse = bm25.bm25_topk(asked, docs, 10)
    return fusion.rrf([dense, sparse]).withColumn("fused_score", F.round("fused_score", 9))


@query
def rerank_topn(spark: SparkSession, folder: str) -> DataFrame:
    asked, docs = questions(spark, folder), _documents(spark, folder)
    found = answer.fetch_chunks(bm25.bm25_topk(asked, docs, 8), docs, item_id="doc_id").join(asked, "query_id")
    best = fusion.rerank(found, word_overlap(F.col("query"), F.col("text")), 3)
    return best.select("query_id", "doc_id", "rank", "candidate_rank", F.round("rerank_score", 6).alias("rerank_score"))


@query
def rag_context(spark: SparkSession, folder: str) -> DataFrame:
    asked = questions(spark, folder)
    sections = materialize(chunk_sections(spark, folder).withColumn("position", chunks.corpus_order("chunk_id")))
    candidates = bm25.bm25_topk(asked, sections, 8, item_id="position")
    found = answer.fetch_chunks(candidates, sections, item_id="position").join(asked, "query_id")
    best = fusion.rerank(found, word_overlap(F.col("query"), F.col("text")), 3)
    context = answer.build_context(asked, best)
    cited = F.transform("citations", lambda c: F.concat_ws("|", c["citation"], c["excerpt"]))
    return context.select("query_id", "context", "prompt", F.array_join(cited, ";").alias("citations"))


def _answered(spark: SparkSession, folder: str, flight: Callable[[str], Column], customers: DataFrame) -> DataFrame:
    asked = questions(spark, folder).withColumn("query", F.concat("query", F.lit(" and "), flight("query_id")))
    state = customers.select(
        flight("c_custkey").alias("flight_id"), F.col("c_mktsegment").alias("status"), F.lit(None).cast("string").alias("gate"),
        F.col("c_nationkey").cast("int").alias("delay_minutes"), F.lit(None).cast("string").alias("delay_reason_code"),
    )
    root = _place(spark, "index")
    index_chunks(chunk_sections(spark, folder), root)
    found = ask(asked, root, state)
    cited = F.array_join(F.transform("citations", lambda c: c["citation"]), ";")
    return found.select("query_id", "context", cited.alias("citations"), F.col("live_status.status").alias("status"), F.col("live_status.delay_minutes").cast("string").alias("delay_minutes"))


@query
def ask_questions_all(spark: SparkSession, folder: str) -> DataFrame:
    """The whole way of a question: stored index, dense and keyword search, fusion, reranking, context, live status.

    Every customer has a state; the key goes on in the date when its four digits are used up.
    """
    flight = lambda key: F.concat(
        F.lit("SV"), F.lpad((F.col(key) % 10_000).cast("string"), 4, "0"), F.lit("-"), (F.floor(F.col(key) / 10_000) + 20_240_101).cast("string")
    )
    return _answered(spark, folder, flight, table(spark, folder, "customer"))


def _ranked_similarity(spark: SparkSession, folder: str) -> DataFrame:
    found = knn.knn_topk(centroids(spark, folder), table(spark, folder, "embeddings"), 10, metric="cosine")
    return found.withColumnRenamed("score", "similarity")


@query
def retrieval_eval(spark: SparkSession, folder: str) -> DataFrame:
    report = fusion.evaluate_retrieval(_ranked_similarity(spark, folder))
    joined = F.array_join(F.transform("per_chunk_scores", lambda s: F.format_string("%.3f", s)), ",")
    return report.withColumn("per_chunk_scores", joined)


@query
def retrieval_overall(spark: SparkSession, folder: str) -> DataFrame:
    return fusion.overall_retrieval(fusion.evaluate_retrieval(_ranked_similarity(spark, folder)))


@query
def lookup_extracted_key(spark: SparkSession, folder: str) -> DataFrame:
    who = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    asked = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("When do offices open?")).otherwise(
        F.concat(F.lit("What is the balance of "), who, F.lit(" today, not of Customer#000000001?"))
    )
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("query_id"), asked.alias("query"))
    found = answer.lookup_extracted_key(
        orders, table(spark, folder, "customer"), "c_name", pattern=r"(Customer#\d{9})",
        fields=["c_name", "c_acctbal", "c_mktsegment"],
    )
    return found.select("query_id", "live_status.c_name", "live_status.c_acctbal", "live_status.c_mktsegment")
