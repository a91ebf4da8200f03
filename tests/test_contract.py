import json

import pytest

from opsledger.operators.contract import contract_counts, encode, split_accepted, to_bronze, validate_events

BASE = {
    "flight_id": "FL123", "airline_code": "sv", "flight_number": "123", "scheduled_date": "2026-08-06",
    "origin": "ruh", "destination": "jed", "status": "SCHEDULED", "gate": None, "delay_minutes": None,
    "delay_reason_code": None, "event_ts": "2026-08-06T10:00:00", "source_feed": "test-feed",
}
NO_GATE = "Value error, gate is required when status is "
NO_REASON = "Value error, delay_reason_code is required when status is DELAYED"
DELAYED = {"status": "DELAYED", "delay_reason_code": "ATC"}

# (name, changed fields or raw text, expected [(field, type, part of the message)])
CASES = [
    ("base", {}, []),
    ("boarding without gate", {"status": "BOARDING"}, [("", "value_error", NO_GATE + "BOARDING")]),
    ("gate change without gate", {"status": "GATE_CHANGE"}, [("", "value_error", NO_GATE + "GATE_CHANGE")]),
    ("gate empty", {"status": "BOARDING", "gate": ""}, [("", "value_error", "gate is required")]),
    ("boarding with gate", {"status": "BOARDING", "gate": "A12"}, []),
    ("delayed without reason", {"status": "DELAYED", "delay_minutes": 30}, [("", "value_error", NO_REASON)]),
    ("delayed with reason", {**DELAYED, "delay_minutes": 30}, []),
    ("delayed without minutes", DELAYED, []),
    ("negative delay", {**DELAYED, "delay_minutes": -5}, [("delay_minutes", "greater_than_equal", "equal to 0")]),
    ("unknown status", {"status": "NOT_A_REAL_STATUS"}, [("status", "enum", "'ARRIVED' or 'CANCELLED'")]),
    ("status is case-sensitive", {"status": "scheduled"}, [("status", "enum", "Input should be")]),
    ("no flight id", {"flight_id": ...}, [("flight_id", "missing", "Field required")]),
    ("null flight id", {"flight_id": None}, [("flight_id", "string_type", "valid string")]),
    ("number as string field", {"flight_number": 123}, [("flight_number", "string_type", "valid string")]),
    ("empty flight id", {"flight_id": ""}, [("flight_id", "string_too_short", "at least 1 character")]),
    ("long airline", {"airline_code": "ABCD"}, [("airline_code", "string_too_long", "at most 3 characters")]),
    ("empty feed", {"source_feed": ""}, []),
    ("bad time", {"event_ts": "not-a-timestamp"}, [("event_ts", "datetime_from_date_parsing", "datetime or date")]),
    ("hour out of range", {"event_ts": "2026-08-06T25:00:00"}, [("event_ts", "datetime_from_date_parsing", "")]),
    ("null time", {"event_ts": None}, [("event_ts", "datetime_type", "valid datetime")]),
    ("date only", {"event_ts": "2026-08-06"}, []),
    ("epoch", {"event_ts": 1767312000}, []),
    ("zulu lower case", {"event_ts": "2026-08-06t10:00:00z"}, []),
    ("blank around time", {"event_ts": " 2026-08-06T10:00:00"}, [("event_ts", "datetime_from_date_parsing", "")]),
    ("date with midnight", {"scheduled_date": "2026-08-06T00:00:00"}, []),
    ("date with a clock", {"scheduled_date": "2026-08-06T01:00:00"}, [("scheduled_date", "date_from_datetime_inexact", "")]),
    ("no such day", {"scheduled_date": "2026-02-30"}, [("scheduled_date", "date_from_datetime_parsing", "")]),
    ("short day", {"scheduled_date": "2026-1-2"}, [("scheduled_date", "date_from_datetime_parsing", "")]),
    ("boolean date", {"scheduled_date": True}, [("scheduled_date", "date_type", "valid date")]),
    ("delay text", {"delay_minutes": "30"}, []),
    ("delay text fraction", {"delay_minutes": "30.5"}, [("delay_minutes", "int_parsing", "unable to parse")]),
    ("delay whole float", {"delay_minutes": 30.0}, []),
    ("delay fraction", {"delay_minutes": 30.5}, [("delay_minutes", "int_from_float", "fractional part")]),
    ("delay true", {"delay_minutes": True}, []),
    ("delay list", {"delay_minutes": [1]}, [("delay_minutes", "int_type", "valid integer")]),
    ("delay empty", {"delay_minutes": ""}, [("delay_minutes", "int_parsing", "unable to parse")]),
    ("extra field", {"other": 1}, []),
    ("two problems", {"origin": "R", "status": "X"}, [("origin", "string_too_short", ""), ("status", "enum", "")]),
    ("field problem hides record problem", {"status": "BOARDING", "origin": "R"}, [("origin", "string_too_short", "")]),
    ("not json", "garbage", [("", "json_invalid", "")]),
    ("cut off", '{"flight_id": "x", "gate"', [("", "json_invalid", "")]),
    ("empty text", "", [("", "json_invalid", "")]),
    ("array", "[1]", [("", "model_type", "")]),
    ("two objects", "{}{}", [("", "json_invalid", "")]),
    ("text behind", json.dumps(BASE) + " junk}", [("", "json_invalid", "")]),
    ("brace behind", json.dumps(BASE) + " }", [("", "json_invalid", "")]),
    ("object behind a comma", json.dumps(BASE) + ',{"a":1}', [("", "json_invalid", "")]),
    ("bracket that closes the list", json.dumps(BASE) + '],[{"a":1}', [("", "json_invalid", "")]),
    ("list that mimics the mark", json.dumps(BASE) + ',"x"],[1', [("", "json_invalid", "")]),
    ("single quotes", json.dumps(BASE).replace('"', "'"), [("", "json_invalid", "")]),
    ("blanks around", "  " + json.dumps(BASE) + "\n", []),
    ("number", "3", [("", "model_type", "")]),
]


def message(change) -> str:
    if isinstance(change, str):
        return change
    return json.dumps({k: v for k, v in {**BASE, **change}.items() if v is not ...})


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(name, message(change)) for name, change, _ in CASES]
    return validate_events(spark.createDataFrame(rows, "name string, value string")).cache()


@pytest.fixture(scope="module")
def outcome(judged):
    return {r["name"]: r for r in judged.collect()}


@pytest.mark.parametrize("name,_,expected", CASES, ids=[c[0] for c in CASES])
def test_reasons(outcome, name, _, expected):
    found = outcome[name]["rejection_reason"]
    assert [(r["field"], r["type"]) for r in found] == [(field, kind) for field, kind, _ in expected]
    for reason, (_, _, part) in zip(found, expected):
        assert part in reason["msg"]


def test_accepted_values(outcome):
    event = outcome["base"]["event"]
    assert (event["airline_code"], event["origin"], event["destination"]) == ("SV", "RUH", "JED")
    assert str(event["scheduled_date"]) == "2026-08-06"
    minutes = {n: outcome[n]["event"]["delay_minutes"] for n in ("delay text", "delay whole float", "delay true")}
    assert minutes == {"delay text": 30, "delay whole float": 30, "delay true": 1}
    assert str(outcome["epoch"]["event"]["event_ts"]) == "2026-01-02 00:00:00"
    assert str(outcome["zulu lower case"]["event"]["event_ts"]) == "2026-08-06 10:00:00"


def test_every_record_goes_to_exactly_one_side(judged):
    accepted, dead = split_accepted(judged)
    good = sum(1 for _, _, expected in CASES if not expected)
    assert accepted.count() == good and dead.count() == len(CASES) - good
    assert "garbage" in {r["original_payload"] for r in dead.collect()}
    counts = contract_counts(judged).first()
    assert (counts["consumed"], counts["accepted"], counts["rejected"]) == (len(CASES), good, len(CASES) - good)


def test_one_ingestion_time_and_round_trip(judged):
    accepted, _ = split_accepted(judged)
    assert to_bronze(accepted).select("ingested_at").distinct().count() == 1
    again = validate_events(encode(accepted))
    assert contract_counts(again).first()["rejected"] == 0


def test_encoding_keeps_microseconds(spark):
    row = spark.sql("SELECT timestamp'2026-01-02 03:04:05.123456' AS a, timestamp_ntz'2026-01-02 03:04:05.000001' AS b, null AS c")
    assert json.loads(encode(row).first()["value"]) == {"a": "2026-01-02T03:04:05.123456Z", "b": "2026-01-02T03:04:05.000001", "c": None}
