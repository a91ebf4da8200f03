"""The flight-event configuration of the generic operators: fields, statuses, table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# The status vocabulary and the table columns that downstream users depend on.
STATUSES = ["SCHEDULED", "BOARDING", "GATE_CHANGE", "DEPARTED", "DELAYED", "ARRIVED", "CANCELLED"]
GATE_STATUSES = ["BOARDING", "GATE_CHANGE"]
DELAYED = "DELAYED"
CANCELLED = "CANCELLED"

KEY = "flight_id"
EVENT_TIME = "event_ts"
INGEST_TIME = "ingested_at"

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("flight_id", T.StringType(), False),
        T.StructField("airline_code", T.StringType(), False),
        T.StructField("flight_number", T.StringType(), False),
        T.StructField("scheduled_date", T.DateType(), False),
        T.StructField("origin", T.StringType(), False),
        T.StructField("destination", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("gate", T.StringType(), True),
        T.StructField("delay_minutes", T.IntegerType(), True),
        T.StructField("delay_reason_code", T.StringType(), True),
        T.StructField("event_ts", T.TimestampType(), False),
        T.StructField("source_feed", T.StringType(), False),
    ]
)
BRONZE_SCHEMA = T.StructType([*EVENT_SCHEMA.fields, T.StructField(INGEST_TIME, T.TimestampType(), False)])

AIRPORT_PATTERN = "^[A-Z]{3,4}$"
AIRLINE_PATTERN = "^[A-Z0-9]{2}$"
FLIGHT_ID_PATTERN = r"\b([A-Z]{2}\d{3,4}-\d{8})\b"
LIVE_STATUS_FIELDS = ["flight_id", "status", "gate", "delay_minutes", "delay_reason_code"]

TUMBLING_WIDTH = "1 second"
SLIDING_WIDTH = "5 seconds"
LATENESS = "3 seconds"
SEVERE_DELAY = 120
MAX_DRIFT_DAYS = 1
