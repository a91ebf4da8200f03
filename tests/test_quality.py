from datetime import date, datetime

import pytest

from opsledger import flights
from opsledger.operators import quality as q
from opsledger.sources.tables import read_csv, route_batch

FLIGHT = "flight_id string, status string, delay_minutes int, origin string, destination string, event_ts timestamp, scheduled_date date"
DAY = date(2026, 8, 6)


def flight(spark, *rows):
    base = ["SV1", "ARRIVED", 0, "RUH", "JED", datetime(2026, 8, 6, 5), DAY]
    names = [c.split()[0] for c in FLIGHT.split(", ")]
    return spark.createDataFrame([[r.get(n, b) for n, b in zip(names, base)] for r in rows], FLIGHT)


def outcome(df, checks):
    found = {r["check"]: (r["success"], r["unexpected_count"]) for r in q.run_checks(df, checks).collect()}
    return {c.name: found[c.name] for c in checks}


def test_bronze_gate_passes_and_counts(spark):
    df = flight(spark, {}, {"delay_minutes": None, "origin": None})
    assert q.gate(q.run_checks(df, q.bronze_checks(flights.STATUSES))) == (2, 4)


@pytest.mark.parametrize(
    "fault,check",
    [
        ({"delay_minutes": -500}, "between\\(delay_minutes\\) \\(1 of"),
        ({"origin": "RUH", "destination": "RUH"}, "pair_differs\\(origin,destination\\) \\(1 of"),
        ({"status": "LOST"}, "in_set\\(status\\) \\(1 of"),
        ({"flight_id": None}, "not_null\\(flight_id\\) \\(1 of"),
    ],
)
def test_bronze_gate_stops(spark, fault, check):
    with pytest.raises(q.QualityGateError, match=f": {check}"):
        q.gate(q.run_checks(flight(spark, {}, fault), q.bronze_checks(flights.STATUSES)))


def test_silver_gate(spark):
    checks = q.silver_checks(flights.AIRPORT_PATTERN, flights.MAX_DRIFT_DAYS)
    good = flight(spark, {}, {"flight_id": "SV2", "event_ts": datetime(2026, 8, 7, 23)}, {"flight_id": None}, {"flight_id": None})
    assert q.gate(q.run_checks(good, checks)) == (4, 4)
    bad = flight(spark, {}, {}, {"flight_id": "SV3", "origin": "ruh", "event_ts": datetime(2026, 7, 27)})
    assert outcome(bad, checks) == {
        "unique(flight_id)": (False, 2),
        "regex(origin)": (False, 1),
        "regex(destination)": (True, 0),
        "max_drift(event_ts,scheduled_date)": (False, 1),
    }


CSV = """YEAR,AIRLINE,TAIL_NUMBER,ORIGIN_AIRPORT,DESTINATION_AIRPORT,DEPARTURE_DELAY
2015,AA,N1,JFK,LAX,-60
2015,AA,N1,JFK,LAX,-60
2015,B6,,JFK,JFK,1500
,ZZZ,N2,,,1501
2016,,N3,ATL,,
"""
COLUMNS = ["YEAR", "AIRLINE", "TAIL_NUMBER", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "DEPARTURE_DELAY"]


def scan():
    return [
        q.null_ratio("TAIL_NUMBER", 0.05),
        q.between("DEPARTURE_DELAY", -60, 1500),
        q.pair_differs("ORIGIN_AIRPORT", "DESTINATION_AIRPORT"),
        q.equals("YEAR", 2015),
        q.no_duplicate_rows(COLUMNS),
        q.regex("AIRLINE", flights.AIRLINE_PATTERN, nulls="fail"),
    ]


@pytest.fixture
def csv(spark, tmp_path):
    (tmp_path / "flights.csv").write_text(CSV)
    schema = "YEAR int, AIRLINE string, TAIL_NUMBER string, ORIGIN_AIRPORT string, DESTINATION_AIRPORT string, DEPARTURE_DELAY double"
    return lambda limit=None: read_csv(spark, str(tmp_path / "flights.csv"), schema, limit)


def test_scan_treats_nulls_as_each_dimension_says(csv):
    assert list(outcome(csv(), scan()).values()) == [(False, 1), (False, 1), (False, 1), (False, 2), (False, 1), (False, 2)]
    skipping = [q.equals("YEAR", 2015, nulls="skip"), q.regex("AIRLINE", flights.AIRLINE_PATTERN)]
    assert list(outcome(csv(), skipping).values()) == [(False, 1), (False, 1)]
    verdict = q.verdict(q.run_checks(csv(1), scan())).first()
    assert verdict["passed"] and verdict["checks_passed"] == 6 and verdict["row_count"] == 1


def test_empty_table(csv):
    empty = csv().where("YEAR = 1900")
    assert [v[0] for v in outcome(empty, scan()).values()] == [False, True, True, True, True, True]


def test_tolerance(csv):
    checks = [q.between("DEPARTURE_DELAY", -60, 1500, mostly=0.75), q.between("DEPARTURE_DELAY", -60, 1500, mostly=0.76)]
    results = q.run_checks(csv(), checks).collect()
    assert [r["success"] for r in results] == [True, False]


def test_routing(spark, csv, tmp_path):
    production, quarantine = str(tmp_path / "production"), str(tmp_path / "quarantine")
    passed = q.verdict(q.run_checks(csv(), scan())).first()["passed"]
    assert route_batch(csv(), passed, production, quarantine) == quarantine
    assert spark.read.parquet(quarantine).count() == 5


def test_profile(csv):
    found = {r["column_name"]: r for r in q.profile_table(csv()).collect()}
    assert (found["AIRLINE"]["null_count"], found["AIRLINE"]["null_pct"], found["AIRLINE"]["row_count"]) == (1, 20.0, 5)
    assert (found["DEPARTURE_DELAY"]["min_value"], found["DEPARTURE_DELAY"]["max_value"]) == ("-60.0", "1501.0")
    assert {r["value"]: r["rows"] for r in q.value_counts(csv(), "YEAR").collect()} == {"2015": 3, "2016": 1, None: 1}
