"""The ingest contract: one reason per broken rule, computed as column expressions.

Raw JSON text is parsed once, into one VARIANT per field. Every rule is one SQL expression yielding an array of
no or one `struct<field, msg, type>`; the reasons of a record are their concatenation. All field
rules report together, and rules that look at several fields run only when every field passed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.flights import DELAYED, EVENT_SCHEMA, GATE_STATUSES, STATUSES
from opsledger.functions.times import EXACT_TIMES, epoch_timestamp, iso_timestamp, wall_clock, whole_day

NO_REASON = "CAST(array() AS array<struct<field:string,msg:string,type:string>>)"
# Whole numbers as text may carry a sign, blanks, digit groups and a zero fraction.
INT_TEXT = r"^\s*[+-]?\d+(_\d+)*(\.0*)?\s*$"
# Messages users match on.
MISSING = ("Field required", "missing")
NOT_STRING = ("Input should be a valid string", "string_type")
NOT_DATE = ("Input should be a valid date", "date_type")
BAD_DATE = ("Input should be a valid date or datetime", "date_from_datetime_parsing")
INEXACT_DATE = ("Datetimes provided to dates should have zero time - e.g. be exact dates", "date_from_datetime_inexact")
NOT_DATETIME = ("Input should be a valid datetime", "datetime_type")
BAD_DATETIME = ("Input should be a valid datetime or date", "datetime_from_date_parsing")
NOT_INT = ("Input should be a valid integer", "int_type")
BAD_INT_TEXT = ("Input should be a valid integer, unable to parse string as an integer", "int_parsing")
FRACTION = ("Input should be a valid integer, got a number with a fractional part", "int_from_float")
INT_SIZE = ("Input should be a valid integer in the 32-bit range", "int_size")
BAD_JSON = ("Invalid JSON", "json_invalid")
NOT_OBJECT = ("Input should be a valid object", "model_type")


@dataclass(frozen=True)
class Field:
    """One contract field. `kind` is string, enum, date, timestamp or int."""

    name: str
    kind: str
    required: bool = True
    min_length: int | None = None
    max_length: int | None = None
    values: tuple[str, ...] = ()
    minimum: int | None = None
    upper: bool = False


@dataclass(frozen=True)
class RequiredWhen:
    """`field` must be non-empty when `status` has one of `values`; `msg` may name the status with {}."""

    field: str
    status: str
    values: tuple[str, ...]
    msg: str


@dataclass(frozen=True)
class Contract:
    fields: tuple[Field, ...]
    cross: tuple[RequiredWhen, ...] = ()


FLIGHT_CONTRACT = Contract(
    fields=(
        Field("flight_id", "string", min_length=1),
        Field("airline_code", "string", min_length=2, max_length=3, upper=True),
        Field("flight_number", "string", min_length=1),
        Field("scheduled_date", "date"),
        Field("origin", "string", min_length=3, max_length=4, upper=True),
        Field("destination", "string", min_length=3, max_length=4, upper=True),
        Field("status", "enum", values=tuple(STATUSES)),
        Field("gate", "string", required=False),
        Field("delay_minutes", "int", required=False, minimum=0),
        Field("delay_reason_code", "string", required=False),
        Field("event_ts", "timestamp"),
        Field("source_feed", "string"),
    ),
    cross=(
        RequiredWhen("gate", "status", tuple(GATE_STATUSES), "Value error, gate is required when status is {}"),
        RequiredWhen(
            "delay_reason_code", "status", (DELAYED,), "Value error, delay_reason_code is required when status is {}"
        ),
    ),
)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _reason(field: str, what: tuple[str, str]) -> str:
    msg, kind = what
    return f"array(named_struct('field', {_quoted(field)}, 'msg', {_quoted(msg)}, 'type', {_quoted(kind)}))"


def _plural(n: int) -> str:
    return f"{n} character" if n == 1 else f"{n} characters"


def _is_number(f: Field) -> str:
    return f"(_type_{f.name} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith(_type_{f.name}, 'DECIMAL'))"


def _value(f: Field) -> Column:
    """The field read as its kind, NULL where it cannot be. Dates stay clock readings until judged."""
    kind, text = F.col(f"_type_{f.name}"), F.col(f"_text_{f.name}")
    number = F.expr(f"CASE WHEN {_is_number(f)} THEN try_variant_get(_v_{f.name}, '$', 'decimal(38,9)') END")
    if f.kind == "int":
        digits = F.regexp_replace(F.trim(text), "_", "").try_cast("decimal(38,9)")
        flag = text.try_cast("boolean").cast("int").cast("decimal(38,9)")
        return F.when(kind == "STRING", F.when(text.rlike(INT_TEXT), digits)).when(kind == "BOOLEAN", flag).otherwise(number)
    read, target = (wall_clock, "timestamp_ntz") if f.kind == "date" else (iso_timestamp, "timestamp")
    return F.when(kind == "STRING", read(text)).otherwise(epoch_timestamp(number.cast("decimal(30,6)")).cast(target))


def _typed(f: Field) -> Column:
    """The accepted value; only meaningful where the field's rule found nothing."""
    if f.kind == "date":
        return whole_day(F.col(f"_value_{f.name}"))
    if f.kind == "timestamp":
        return F.col(f"_value_{f.name}")
    if f.kind == "int":
        return F.col(f"_value_{f.name}").try_cast("int")
    text = F.when(F.col(f"_type_{f.name}") == "STRING", F.col(f"_text_{f.name}"))
    return F.upper(text) if f.upper else text


def _rule(f: Field) -> str:
    """SQL for the field's reasons: an empty array when it is fine."""
    kind, text, value, number = f"_type_{f.name}", f"_text_{f.name}", f"_value_{f.name}", _is_number(f)
    cases = [(f"{kind} IS NULL", MISSING if f.required else None)]
    if not f.required:
        cases.append((f"{kind} = 'VOID'", None))
    if f.kind == "string":
        cases.append((f"{kind} <> 'STRING'", NOT_STRING))
        if f.min_length is not None:
            short = f"String should have at least {_plural(f.min_length)}"
            cases.append((f"length({text}) < {f.min_length}", (short, "string_too_short")))
        if f.max_length is not None:
            long = f"String should have at most {_plural(f.max_length)}"
            cases.append((f"length({text}) > {f.max_length}", (long, "string_too_long")))
    elif f.kind == "enum":
        named = [f"'{v}'" for v in f.values]
        allowed = ", ".join(_quoted(v) for v in f.values)
        msg = f"Input should be {', '.join(named[:-1])} or {named[-1]}"
        cases.append((f"{kind} <> 'STRING' OR {text} NOT IN ({allowed})", (msg, "enum")))
    elif f.kind == "date":
        cases += [
            (f"{kind} <> 'STRING' AND NOT {number}", NOT_DATE),
            (f"{value} IS NULL", BAD_DATE),
            (f"{value} <> CAST({value} AS DATE)", INEXACT_DATE),
        ]
    elif f.kind == "timestamp":
        cases += [(f"{kind} <> 'STRING' AND NOT {number}", NOT_DATETIME), (f"{value} IS NULL", BAD_DATETIME)]
    elif f.kind == "int":
        cases += [
            (f"{kind} = 'STRING' AND {value} IS NULL", BAD_INT_TEXT),
            (f"{kind} NOT IN ('STRING', 'BOOLEAN') AND NOT {number}", NOT_INT),
            (f"{value} <> floor({value})", FRACTION),
            (f"try_cast({value} AS INT) IS NULL", INT_SIZE),
        ]
        if f.minimum is not None:
            low = f"Input should be greater than or equal to {f.minimum}"
            cases.append((f"{value} < {f.minimum}", (low, "greater_than_equal")))
    else:
        raise ValueError(f"unknown field kind {f.kind!r}")
    branches = " ".join(f"WHEN {when} THEN {_reason(f.name, why) if why else NO_REASON}" for when, why in cases)
    return f"CASE {branches} ELSE {NO_REASON} END"


def _cross_rule(r: RequiredWhen) -> str:
    """Rules over several fields name no field: they belong to the record."""
    values = ", ".join(_quoted(v) for v in r.values)
    msg = f"replace({_quoted(r.msg)}, '{{}}', _text_{r.status})"
    reason = f"array(named_struct('field', '', 'msg', {msg}, 'type', 'value_error'))"
    empty = f"coalesce(_text_{r.field}, '') = ''"
    return f"CASE WHEN _text_{r.status} IN ({values}) AND {empty} THEN {reason} ELSE {NO_REASON} END"


def _settled(df: DataFrame, columns: list[Column]) -> DataFrame:
    """Add columns that are computed once per row.

    As plain projections, a later filter on the reasons would be pushed below them with every
    expression copied into it, JSON parsing included. A generator is where that stops.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def validate_events(raw: DataFrame, contract: Contract = FLIGHT_CONTRACT, value_col: str = "value") -> DataFrame:
    """Add `event` (struct of the typed fields) and `rejection_reason` (array, empty when accepted).

    Fields the contract does not name are ignored. Text that is not JSON, and JSON that is not an
    object, is refused like any other bad record. No shuffle: each row is judged on its own.
    """
    names = [f.name for f in contract.fields]
    # The text is read as the first of two elements, the second being a mark it cannot know: whatever
    # follows the first value, a second object or a bracket that ends the list early, shows in the list.
    mark = F.md5(F.coalesce(F.col(value_col), F.lit("")))
    listed = F.from_json(F.concat(F.lit("["), value_col, F.lit(',"'), mark, F.lit('"]')), "array<variant>", {"allowSingleQuotes": "false"})
    split = raw.select("*", listed.alias("_list"), mark.alias("_mark"))
    whole = (F.size("_list") == 2) & (F.try_variant_get(F.get("_list", F.lit(1)), "$", "string") == F.col("_mark"))
    parsed = _settled(split, [F.when(whole, F.get("_list", F.lit(0))).alias("_json")])
    fields = [F.expr(f"try_variant_get(_json, '$.{n}', 'variant')").alias(f"_v_{n}") for n in names]
    picked = _settled(parsed.drop("_list", "_mark"), [F.schema_of_variant("_json").alias("_shape"), *fields])
    facts = [F.schema_of_variant(f"_v_{n}").alias(f"_type_{n}") for n in names]
    facts += [F.expr(f"try_variant_get(_v_{n}, '$', 'string')").alias(f"_text_{n}") for n in names]
    values = [_value(f).alias(f"_value_{f.name}") for f in contract.fields if f.kind in ("date", "timestamp", "int")]
    flat = _settled(_settled(picked, facts), values)
    field_reasons = f"concat({', '.join(_rule(f) for f in contract.fields)})"
    cross_reasons = f"concat({', '.join([_cross_rule(r) for r in contract.cross] or [NO_REASON])})"
    judged = flat.select("*", F.expr(field_reasons).alias("_field_reasons"))
    reasons = F.expr(
        f"CASE WHEN _shape IS NULL THEN {_reason('', BAD_JSON)} "
        f"WHEN NOT startswith(_shape, 'OBJECT') THEN {_reason('', NOT_OBJECT)} "
        f"WHEN size(_field_reasons) > 0 THEN _field_reasons ELSE {cross_reasons} END"
    )
    return _settled(judged, [reasons.alias("rejection_reason")]).select(
        *raw.columns,
        F.struct(*(_typed(f).alias(f.name) for f in contract.fields)).alias("event"),
        "rejection_reason",
    )


def split_accepted(judged: DataFrame, value_col: str = "value", keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(accepted, dead letters) of `validate_events`; every record is in exactly one of them.

    `keep` names columns of the raw input (an arrival number, say) to carry along with accepted rows.
    """
    accepted = judged.where(F.size("rejection_reason") == 0).select(*keep, "event.*")
    dead = judged.where(F.size("rejection_reason") > 0).select(
        F.col(value_col).alias("original_payload"), "rejection_reason", F.current_timestamp().alias("rejected_at")
    )
    return accepted, dead


def to_bronze(accepted: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """The history's columns: the contract fields plus one ingestion time for the whole load."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return accepted.select(*EVENT_SCHEMA.fieldNames(), stamp.alias("ingested_at"))


def contract_counts(judged: DataFrame) -> DataFrame:
    """One row: records consumed, accepted and rejected."""
    return judged.agg(
        F.count("*").alias("consumed"),
        F.count_if(F.size("rejection_reason") == 0).alias("accepted"),
        F.count_if(F.size("rejection_reason") > 0).alias("rejected"),
    )


def encode(accepted: DataFrame) -> DataFrame:
    """Accepted rows as JSON text, nulls written out and times with all their digits."""
    return accepted.select(F.to_json(F.struct(*accepted.columns), {"ignoreNullFields": "false", **EXACT_TIMES}).alias("value"))
