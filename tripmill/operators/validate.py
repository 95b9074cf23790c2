"""Event validation: JSON payload to typed columns plus the first broken rule."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.contract import DEAD_LETTER_SCHEMA, VALID_SCHEMA, EventSpec, Field
from tripmill.functions.numeric import half_even
from tripmill.functions.text import rfc3339_timestamp, sql_text, strict_json, utf8_text
from tripmill.session import clock, configure, sql_instant

# What counts as the text of a number. Spark's cast would also take the Java
# spellings 1.5d and 0x1p3, and the words NaN and Infinity.
NUMBER_TEXT = r"^[\s0-9.eE+-]+$"
UUID_TEXT = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"

# The order in which conversions are tried decides which field is reported.
CONVERSION_ORDER = (
    "pickup_location_id",
    "dropoff_location_id",
    "passenger_count",
    "payment_type",
    "trip_distance",
    "total_amount",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
)

ROUTING_METRICS = "event_routing"


def validate_events(
    df: DataFrame,
    spec: EventSpec | None = None,
    as_of: datetime | None = None,
    payload: str = "value",
    strict: bool = False,
    metrics: str | None = None,
) -> DataFrame:
    """Check every payload of ``df`` and convert it to typed columns.

    Works the same on batch and streaming frames and never fails on bad input:
    each payload gives exactly one row. ``error_code`` is NULL for a valid
    event, else it names the first rule broken and ``error_reason`` explains
    it. ``strict`` adds the contract checks that the running pipeline leaves
    out (extra keys, UUID ids, JSON types).

    The rows are counted on the way under the observation ``metrics`` (by
    default ``event_routing`` on a stream and a name of its own on a batch, as
    one plan cannot hold two observations of one name). That node also keeps a
    later filter on ``error_code`` from being pushed below the parse, where
    Catalyst would repeat the parse for every rule.
    """
    spec = spec or EventSpec()
    if metrics is None:
        metrics = ROUTING_METRICS if df.isStreaming else f"{ROUTING_METRICS}_{uuid.uuid4().hex}"
    configure(df.sparkSession)
    parsed = df.select(utf8_text(payload).alias("raw_payload")).withColumn(
        "doc", strict_json("raw_payload")
    )
    extracted = parsed.withColumn("event", F.try_variant_get("doc", "$.p", _ddl(spec)))
    typed = extracted.select(
        "raw_payload",
        F.expr("doc IS NOT NULL AS is_json"),
        F.expr("event IS NOT NULL AS is_object"),
        _missing(spec).alias("missing"),
        *[_typed(f).alias(f.name) for f in spec.fields],
        *([_contract_error(spec).alias("contract_error")] if strict else []),
        clock(as_of).alias("processing_time"),
    )
    rules = _rules(spec) + ([CONTRACT_RULE] if strict else [])
    checked = typed.withColumn("broken", _first_broken(rules))
    return checked.select(
        "raw_payload",
        _of_broken([code for code, _, _ in rules]).alias("error_code"),
        _of_broken([reason for _, _, reason in rules]).alias("error_reason"),
        *spec.names,
        "processing_time",
    ).observe(
        metrics,
        F.expr("count(1) AS consumed"),
        F.expr("count_if(error_code IS NULL) AS valid"),
        F.expr("count_if(error_code IS NOT NULL) AS rejected"),
        F.expr("max(CASE WHEN error_code IS NULL THEN ingestion_time END) AS newest_ingestion"),
    )


def enrich(df: DataFrame) -> DataFrame:
    """Add business date, duration and fare per mile to valid events."""
    seconds = "(unix_micros(dropoff_datetime) - unix_micros(pickup_datetime)) / 1e6D"
    return df.withColumns(
        {
            "pickup_date": F.to_date("pickup_datetime"),
            "trip_duration_minutes": half_even(f"{seconds} / 60D"),
            "fare_per_mile": half_even("try_divide(fare_amount, trip_distance)"),
        }
    ).select(*VALID_SCHEMA.names)


def valid_events(validated: DataFrame) -> DataFrame:
    """The accepted rows, enriched: the valid table."""
    return enrich(validated.filter(F.col("error_code").isNull()))


def rejected_events(validated: DataFrame) -> DataFrame:
    """The rejected rows: the dead letter table."""
    rejected = validated.filter(F.col("error_code").isNotNull())
    return rejected.select(*DEAD_LETTER_SCHEMA.names)


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Route validated rows; every row is in exactly one of the two results."""
    return valid_events(validated), rejected_events(validated)


def _ddl(spec: EventSpec) -> str:
    """Struct type read from the document in one pass; a bad field alone becomes NULL."""
    return "struct<" + ",".join(
        f"{f.name}:{'bigint' if f.kind == 'integer' else 'string'}" for f in spec.fields
    ) + ">"


def _typed(field: Field) -> Column:
    value = f"event.{field.name}"
    if field.kind == "timestamp":
        return rfc3339_timestamp(value)
    if field.kind == "number":
        # The boolean true is the number 1, the string "true" is none.
        return F.expr(
            f"CASE WHEN {value} RLIKE r'{NUMBER_TEXT}'"
            f" THEN CASE WHEN abs(try_cast({value} AS DOUBLE)) < double('inf')"
            f" THEN try_cast({value} AS DOUBLE) END"
            f" WHEN {value} IN ('true', 'false')"
            f" THEN try_variant_get(doc, '$.p.{field.name}', 'double') END"
        )
    return F.expr(value)


def _missing(spec: EventSpec) -> Column:
    """Absent required keys, sorted. Keys are listed again only if some field is NULL."""
    any_null = " OR ".join(f"event.{name} IS NULL" for name in spec.names)
    required = ", ".join(sql_text(name) for name in sorted(spec.names))
    return F.expr(
        f"CASE WHEN event IS NOT NULL AND ({any_null})"
        f" THEN array_except(array({required}), json_object_keys(raw_payload)) END"
    )


# Code, SQL condition under which the rule is broken, SQL text of the reason.
Rule = tuple[str, str, str]


def _first_broken(rules: list[Rule]) -> Column:
    """Position of the first rule that fails, NULL for a valid event."""
    cases = " ".join(f"WHEN {fails} THEN {i}" for i, (_, fails, _) in enumerate(rules))
    return F.expr(f"CASE {cases} END")


def _of_broken(texts: list[str]) -> Column:
    """The broken rule's entry of ``texts``: looked up if a literal, else computed."""
    constant = ", ".join(t if t.startswith("'") else "''" for t in texts)
    cases = " ".join(
        f"WHEN broken = {i} THEN {t}" for i, t in enumerate(texts) if not t.startswith("'")
    )
    looked_up = f"get(array({constant}), broken)"
    return F.expr(f"CASE WHEN broken IS NULL THEN NULL {cases} ELSE {looked_up} END")


def _rules(spec: EventSpec) -> list[Rule]:
    """The rules in order of evaluation.

    A condition must not be NULL for a failing row, so each relies on the
    earlier rules having caught the NULL operands.
    """
    start, end = sql_instant(spec.start), sql_instant(spec.end)
    components = [f for f in spec.of_kind("number") if f.minimum is not None]
    listed = ", ".join(f.name for f in components)
    too_low = " OR ".join(f"{f.name} < {f.minimum}" for f in components) or "false"
    least = {f.minimum for f in components}
    bound = "may be negative" if least <= {0} else "may lie below its minimum"
    payments = ", ".join(map(str, spec["payment_type"].allowed))
    source = spec["source_type"].allowed[0]
    converted = [f.name for f in spec.of_kind("integer", "number")]
    order = [n for n in CONVERSION_ORDER if n in converted]
    order += [n for n in converted if n not in order]

    def rule(code: str, fails: str, reason: str) -> Rule:
        return sql_text(code), fails, sql_text(reason)

    rules = [
        rule("INVALID_JSON", "NOT is_json", "payload is not one complete JSON document"),
        rule("NOT_AN_OBJECT", "NOT is_object", "payload must be an object"),
        (
            sql_text("MISSING_FIELDS"),
            "coalesce(size(missing), 0) > 0",
            "concat('missing fields: ', array_join(missing, ', '))",
        ),
    ]
    for name in ("pickup_datetime", "dropoff_datetime", "event_time", "ingestion_time"):
        reason = f"{name} must be a timestamp string with a zone offset"
        rules.append(rule(f"BAD_{name.upper()}", f"{name} IS NULL", reason))
    rules += [
        rule(
            "EVENT_TIME_MISMATCH",
            "event_time <> pickup_datetime",
            "event_time must equal pickup_datetime",
        ),
        rule(
            "INGESTION_IN_FUTURE",
            "ingestion_time > processing_time",
            "ingestion_time must not lie in the future",
        ),
        rule(
            "OUTSIDE_EVENT_PERIOD",
            f"NOT (pickup_datetime >= {start} AND pickup_datetime < {end})",
            f"pickup_datetime is outside the period from {_zulu(spec.start)}"
            f" to before {_zulu(spec.end)}",
        ),
        rule(
            "BAD_DROPOFF_ORDER",
            f"NOT (pickup_datetime < dropoff_datetime AND dropoff_datetime < {end})",
            "dropoff_datetime must lie after pickup_datetime and inside the period",
        ),
    ]
    for name in order:
        kind = "an integer" if spec[name].kind == "integer" else "a finite number"
        rules.append(rule(f"BAD_TYPE:{name}", f"{name} IS NULL", f"{name} is not {kind}"))
    for code, name in (
        ("BAD_PICKUP_LOCATION", "pickup_location_id"),
        ("BAD_DROPOFF_LOCATION", "dropoff_location_id"),
        ("BAD_PASSENGER_COUNT", "passenger_count"),
    ):
        low, high = spec[name].minimum, spec[name].maximum
        outside = f"{name} < {low} OR {name} > {high}"
        rules.append(rule(code, outside, f"{name} must lie in {low} to {high}"))
    rules += [
        rule(
            "BAD_PAYMENT_TYPE",
            f"payment_type NOT IN ({payments})",
            f"payment_type must be one of {payments}",
        ),
        rule(
            "NON_POSITIVE_DISTANCE",
            f"trip_distance <= {spec['trip_distance'].above}",
            "trip_distance must be positive",
        ),
        rule(
            "NEGATIVE_COMPONENT",
            too_low,
            f"none of {listed} {bound}",
        ),
        rule(
            "NON_POSITIVE_TOTAL",
            f"total_amount <= {spec['total_amount'].above}",
            "total_amount must be positive",
        ),
        rule(
            "BAD_SOURCE_TYPE",
            f"NOT (source_type <=> {sql_text(source)})",
            f"source_type must be {source}",
        ),
        rule(
            "BAD_EVENT_ID",
            "event_id IS NULL",
            "event_id is null, but the valid table requires it",
        ),
    ]
    return rules


CONTRACT_RULE: Rule = (
    "contract_error",
    "contract_error IS NOT NULL",
    "'event breaks the written contract'",
)


def _contract_error(spec: EventSpec) -> Column:
    """First breach of the written contract that the running rules do not check."""
    required = ", ".join(sql_text(name) for name in spec.names)
    checks = [
        f"WHEN size(array_except(json_object_keys(raw_payload), array({required}))) > 0"
        " THEN 'CONTRACT_EXTRA_FIELDS'",
        f"WHEN NOT event.event_id RLIKE r'{UUID_TEXT}' THEN 'CONTRACT_EVENT_ID'",
    ]
    for f in spec.of_kind("integer", "number"):
        path = f"'$.p.{f.name}'"
        fits = (
            f"schema_of_variant(try_variant_get(doc, {path}, 'variant'))"
            " RLIKE '^(BIGINT|DECIMAL|DOUBLE)'"
        )
        if f.kind == "integer":
            number = f"try_variant_get(doc, {path}, 'double')"
            fits += f" AND {number} = floor({number})"
        checks.append(f"WHEN NOT coalesce({fits}, false) THEN 'CONTRACT_TYPE:{f.name}'")
    return F.expr(f"CASE {' '.join(checks)} END")


def _zulu(instant: datetime) -> str:
    return instant.astimezone(timezone.utc).isoformat().replace("+00:00", "Z")
