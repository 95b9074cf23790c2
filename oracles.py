"""DuckDB SQL for every registered query, written without the library.

Means are rounded half up in whole numbers, because a mean of cents often lies
exactly between two cents. Sums go through whole ten-thousandths.
"""

from __future__ import annotations

# --- batch side -------------------------------------------------------------

STAGING = """
order_lines AS (
  SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
delivered_lines AS (
  SELECT *, 0 AS delivery FROM order_lines
  UNION ALL
  SELECT *, 1 AS delivery FROM order_lines WHERE l_orderkey % 10 = 0
),
stg_batch AS (
  SELECT
    o_orderdate AS lpep_pickup_datetime,
    l_shipdate AS lpep_dropoff_datetime,
    l_partkey % 270 AS "PULocationID",
    l_orderkey % 270 AS "DOLocationID",
    CAST(nullif(l_linenumber, 7) AS DOUBLE) AS passenger_count,
    CASE WHEN l_orderkey % 103 = 0 THEN 'NaN'::DOUBLE ELSE l_quantity - 1 END AS trip_distance,
    CASE WHEN l_orderkey % 97 = 0 THEN -l_extendedprice
         WHEN l_orderkey % 107 = 0 THEN 'NaN'::DOUBLE ELSE l_extendedprice END AS fare_amount,
    floor(l_extendedprice * l_discount) + delivery AS tip_amount,
    floor(l_extendedprice * l_tax) AS tolls_amount,
    CASE WHEN l_orderkey % 101 = 0 THEN 0.0::DOUBLE
         WHEN l_orderkey % 109 = 0 THEN 'NaN'::DOUBLE
         ELSE l_extendedprice + floor(l_extendedprice * l_tax) END AS total_amount,
    CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS DOUBLE) AS payment_type
  FROM delivered_lines
)"""

IN_PERIOD = "CAST(lpep_pickup_datetime AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"
IN_ORDER = "lpep_dropoff_datetime > lpep_pickup_datetime"
IN_ZONES = '"PULocationID" BETWEEN 1 AND 265 AND "DOLocationID" BETWEEN 1 AND 265'
IN_AMOUNTS = (
    "trip_distance > 0 AND fare_amount >= 0 AND total_amount > 0"
    " AND NOT isnan(trip_distance) AND NOT isnan(fare_amount) AND NOT isnan(total_amount)"
)
BATCH_RULES = f"{IN_PERIOD} AND {IN_ORDER} AND {IN_ZONES} AND {IN_AMOUNTS}"

TRIP_ID = """sha256(
      CAST(lpep_pickup_datetime AS VARCHAR) || '|' || CAST(lpep_dropoff_datetime AS VARCHAR) || '|'
      || CAST("PULocationID" AS VARCHAR) || '|' || CAST("DOLocationID" AS VARCHAR) || '|'
      || replace(CAST(trip_distance AS VARCHAR), 'nan', 'NaN') || '|'
      || replace(CAST(total_amount AS VARCHAR), 'nan', 'NaN'))"""

BATCH = f"""
batch_branch AS (
  SELECT
    {TRIP_ID} AS trip_id,
    lpep_pickup_datetime AS pickup_datetime,
    lpep_dropoff_datetime AS dropoff_datetime,
    CAST(lpep_pickup_datetime AS DATE) AS pickup_date,
    CAST("PULocationID" AS BIGINT) AS pickup_location_id,
    CAST("DOLocationID" AS BIGINT) AS dropoff_location_id,
    CAST(coalesce(passenger_count, 1) AS BIGINT) AS passenger_count,
    trip_distance, fare_amount, tip_amount, tolls_amount, total_amount,
    CAST(payment_type AS BIGINT) AS payment_type,
    'batch' AS source_type,
    TIMESTAMP '2024-03-01 00:00:00' AS ingestion_time
  FROM stg_batch
  WHERE {BATCH_RULES}
)"""

# --- stream side ------------------------------------------------------------

# Expected code of each planted defect that ranks behind the period checks.
LATE_CODES = {
    12: "BAD_TYPE:pickup_location_id",
    13: "BAD_TYPE:dropoff_location_id",
    14: "BAD_TYPE:passenger_count",
    15: "BAD_TYPE:payment_type",
    16: "BAD_TYPE:trip_distance",
    17: "BAD_TYPE:total_amount",
    18: "BAD_TYPE:fare_amount",
    19: "BAD_TYPE:tip_amount",
    20: "BAD_TYPE:tolls_amount",
    21: "BAD_PICKUP_LOCATION",
    22: "BAD_DROPOFF_LOCATION",
    23: "BAD_PASSENGER_COUNT",
    24: "BAD_PAYMENT_TYPE",
    25: "NON_POSITIVE_DISTANCE",
    26: "NEGATIVE_COMPONENT",
    27: "NON_POSITIVE_TOTAL",
    28: "BAD_SOURCE_TYPE",
    30: "BAD_PAYMENT_TYPE",
}

REASONS = {
    "INVALID_JSON": "payload is not one complete JSON document",
    "NOT_AN_OBJECT": "payload must be an object",
    "MISSING_FIELDS": "missing fields: tip_amount",
    "BAD_PICKUP_DATETIME": "pickup_datetime must be a timestamp string with a zone offset",
    "BAD_DROPOFF_DATETIME": "dropoff_datetime must be a timestamp string with a zone offset",
    "BAD_EVENT_TIME": "event_time must be a timestamp string with a zone offset",
    "BAD_INGESTION_TIME": "ingestion_time must be a timestamp string with a zone offset",
    "EVENT_TIME_MISMATCH": "event_time must equal pickup_datetime",
    "INGESTION_IN_FUTURE": "ingestion_time must not lie in the future",
    "OUTSIDE_EVENT_PERIOD": "pickup_datetime is outside the period from "
    "2024-01-01T00:00:00Z to before 2024-01-29T00:00:00Z",
    "BAD_DROPOFF_ORDER": "dropoff_datetime must lie after pickup_datetime and inside the period",
    "BAD_TYPE:pickup_location_id": "pickup_location_id is not an integer",
    "BAD_TYPE:dropoff_location_id": "dropoff_location_id is not an integer",
    "BAD_TYPE:passenger_count": "passenger_count is not an integer",
    "BAD_TYPE:payment_type": "payment_type is not an integer",
    "BAD_TYPE:trip_distance": "trip_distance is not a finite number",
    "BAD_TYPE:total_amount": "total_amount is not a finite number",
    "BAD_TYPE:fare_amount": "fare_amount is not a finite number",
    "BAD_TYPE:tip_amount": "tip_amount is not a finite number",
    "BAD_TYPE:tolls_amount": "tolls_amount is not a finite number",
    "BAD_PICKUP_LOCATION": "pickup_location_id must lie in 1 to 265",
    "BAD_DROPOFF_LOCATION": "dropoff_location_id must lie in 1 to 265",
    "BAD_PASSENGER_COUNT": "passenger_count must lie in 1 to 6",
    "BAD_PAYMENT_TYPE": "payment_type must be one of 1, 2, 3, 4",
    "NON_POSITIVE_DISTANCE": "trip_distance must be positive",
    "NEGATIVE_COMPONENT": "none of fare_amount, tip_amount, tolls_amount may be negative",
    "NON_POSITIVE_TOTAL": "total_amount must be positive",
    "BAD_SOURCE_TYPE": "source_type must be stream",
}

_late = "\n".join(f"      WHEN defect = {n} THEN '{code}'" for n, code in LATE_CODES.items())
_reasons = "\n".join(f"      WHEN '{code}' THEN '{text}'" for code, text in REASONS.items())

EVENTS = f"""
delivered_events AS (
  SELECT *, 0 AS delivery FROM events
  UNION ALL
  SELECT *, 1 AS delivery FROM events WHERE event_id % 7 = 0
),
event_values AS (
  SELECT
    event_id % 50 AS defect,
    CASE WHEN event_id % 50 = 32 THEN 'trip-' ELSE '00000000-0000-4000-8000-' END
      || lpad(lower(to_hex(event_id)), 12, '0') AS event_id,
    date_trunc('second', ts) AS pickup,
    date_trunc('second', ts) + to_seconds(60 + (user_id * 37) % 5400) AS dropoff,
    date_trunc('second', ts) + to_hours(CAST(1 + delivery AS INTEGER))
      + to_milliseconds(CASE WHEN event_id % 50 = 38 THEN 500 ELSE 0 END) AS ingestion,
    1 + event_id % 265 AS pu,
    1 + user_id % 265 AS do_id,
    1 + event_id % 6 AS passengers,
    1 + event_id % 4 AS payment,
    CAST(round(value * 100) AS BIGINT) AS cents,
    CAST(round(value * 100) AS BIGINT) % 500 + 100 * delivery AS tip_cents,
    CASE WHEN user_id % 4 = 0 THEN 694 ELSE 0 END AS toll_cents
  FROM delivered_events
),
event_amounts AS (
  SELECT *,
    CAST(cents // 10 + 20 AS DOUBLE) / 100 AS distance,
    CAST(cents AS DOUBLE) / 100 AS fare,
    CAST(tip_cents AS DOUBLE) / 100 AS tip,
    CAST(toll_cents AS DOUBLE) / 100 AS tolls,
    CAST(cents + tip_cents + toll_cents + 100 AS DOUBLE) / 100 AS total
  FROM event_values
),
judged AS (
  SELECT *,
    CASE
      WHEN defect IN (1, 29, 37) THEN 'INVALID_JSON'
      WHEN defect = 2 THEN 'NOT_AN_OBJECT'
      WHEN defect = 3 THEN 'MISSING_FIELDS'
      WHEN defect = 4 THEN 'BAD_PICKUP_DATETIME'
      WHEN defect = 5 THEN 'BAD_DROPOFF_DATETIME'
      WHEN defect = 6 THEN 'BAD_EVENT_TIME'
      WHEN defect = 7 THEN 'BAD_INGESTION_TIME'
      WHEN defect = 8 THEN 'EVENT_TIME_MISMATCH'
      WHEN defect = 9 THEN 'INGESTION_IN_FUTURE'
      WHEN defect = 10 OR pickup < TIMESTAMP '2024-01-01' OR pickup >= TIMESTAMP '2024-01-29'
        THEN 'OUTSIDE_EVENT_PERIOD'
      WHEN defect = 11 OR dropoff >= TIMESTAMP '2024-01-29' THEN 'BAD_DROPOFF_ORDER'
{_late}
    END AS error_code
  FROM event_amounts
),
valid_events AS (
  SELECT
    event_id,
    pickup AS event_time,
    ingestion AS ingestion_time,
    pickup AS pickup_datetime,
    dropoff AS dropoff_datetime,
    pu AS pickup_location_id,
    do_id AS dropoff_location_id,
    passengers AS passenger_count,
    distance AS trip_distance,
    fare AS fare_amount,
    tip AS tip_amount,
    tolls AS tolls_amount,
    total AS total_amount,
    payment AS payment_type,
    'stream' AS source_type,
    CAST(pickup AS DATE) AS pickup_date,
    CAST(printf('%.2f', CAST(date_sub('second', pickup, dropoff) AS DOUBLE) / 60) AS DOUBLE)
      AS trip_duration_minutes,
    CAST(printf('%.2f', fare / distance) AS DOUBLE) AS fare_per_mile,
    TIMESTAMP '2024-03-01 00:00:00' AS processing_time
  FROM judged
  WHERE error_code IS NULL
)"""

ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S')"
_pickup, _dropoff, _ingestion = (ISO.format(c) for c in ("pickup", "dropoff", "ingestion"))
_next_second = ISO.format("pickup + to_seconds(1)")
_bangkok = ISO.format("pickup + to_hours(7)")

PAYLOADS = f"""
bodies AS (
  SELECT *,
    concat_ws(',',
      '"event_id":"' || event_id || '"',
      '"event_time":' || CASE defect
        WHEN 6 THEN CAST(CAST(epoch(pickup) AS BIGINT) AS VARCHAR)
        WHEN 8 THEN '"' || {_next_second} || 'Z"'
        WHEN 10 THEN '"2024-01-29T00:00:00Z"'
        ELSE '"' || {_pickup} || 'Z"' END,
      '"ingestion_time":' || CASE defect
        WHEN 7 THEN 'null'
        WHEN 9 THEN '"2030-01-01T00:00:00Z"'
        WHEN 38 THEN '"' || {_ingestion} || '.500Z"'
        ELSE '"' || {_ingestion} || 'Z"' END,
      '"pickup_datetime":"' || CASE defect
        WHEN 4 THEN {_pickup}
        WHEN 10 THEN '2024-01-29T00:00:00Z'
        WHEN 36 THEN {_bangkok} || '+07:00'
        ELSE {_pickup} || 'Z' END || '"',
      '"dropoff_datetime":"' || CASE defect
        WHEN 5 THEN strftime(pickup, '%Y-%m-%d')
        WHEN 11 THEN {_pickup} || 'Z'
        ELSE {_dropoff} || 'Z' END || '"',
      '"pickup_location_id":' || CASE defect
        WHEN 12 THEN '"abc"' WHEN 21 THEN '266' ELSE CAST(pu AS VARCHAR) END,
      '"dropoff_location_id":' || CASE defect
        WHEN 13 THEN '[1]' WHEN 22 THEN '0' ELSE CAST(do_id AS VARCHAR) END,
      '"passenger_count":' || CASE defect
        WHEN 14 THEN 'null' WHEN 23 THEN '7'
        WHEN 33 THEN '"' || passengers || '"' WHEN 34 THEN passengers || '.7'
        ELSE CAST(passengers AS VARCHAR) END,
      '"trip_distance":' || CASE defect
        WHEN 16 THEN '"NaN"' WHEN 25 THEN '0' WHEN 35 THEN '"' || distance || '"'
        ELSE CAST(distance AS VARCHAR) END,
      '"fare_amount":' || CASE defect WHEN 18 THEN '"ten"' ELSE CAST(fare AS VARCHAR) END,
      CASE WHEN defect <> 3 THEN '"tip_amount":' || CASE defect
        WHEN 19 THEN '"Infinity"' WHEN 26 THEN '-0.01' ELSE CAST(tip AS VARCHAR) END END,
      '"tolls_amount":' || CASE defect WHEN 20 THEN 'null' ELSE CAST(tolls AS VARCHAR) END,
      '"total_amount":' || CASE defect
        WHEN 17 THEN '{{}}' WHEN 27 THEN '0' ELSE CAST(total AS VARCHAR) END,
      '"payment_type":' || CASE defect
        WHEN 15 THEN '"3.7"' WHEN 24 THEN '5' WHEN 30 THEN '9' ELSE CAST(payment AS VARCHAR) END,
      '"source_type":' || CASE WHEN defect IN (28, 30) THEN '"batch"' ELSE '"stream"' END,
      CASE WHEN defect = 31 THEN '"vendor":2' END
    ) AS body
  FROM judged
),
payloads AS (
  SELECT *,
    CASE defect
      WHEN 1 THEN '{{' || body
      WHEN 2 THEN '[{{' || body || '}}]'
      WHEN 29 THEN '{{' || body || '}} x'
      WHEN 37 THEN '{{' || body || '}}' || chr(65533)
      ELSE '{{' || body || '}}' END AS raw_payload
  FROM bodies
)"""

STREAM = """
stream_branch AS (
  SELECT
    event_id AS trip_id, pickup_datetime, dropoff_datetime, pickup_date, pickup_location_id,
    dropoff_location_id, passenger_count, trip_distance, fare_amount, tip_amount, tolls_amount,
    total_amount, payment_type, source_type, ingestion_time
  FROM valid_events
  WHERE pickup_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-28'
)"""

# --- trips and marts --------------------------------------------------------

UNIFIED = "unified AS (SELECT * FROM batch_branch UNION ALL SELECT * FROM stream_branch)"

RANKED = """
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY trip_id
    ORDER BY ingestion_time DESC NULLS LAST, pickup_datetime NULLS LAST,
      dropoff_datetime NULLS LAST, pickup_date NULLS LAST, pickup_location_id NULLS LAST,
      dropoff_location_id NULLS LAST, passenger_count NULLS LAST, trip_distance NULLS LAST,
      fare_amount NULLS LAST, tip_amount NULLS LAST, tolls_amount NULLS LAST,
      total_amount NULLS LAST, payment_type NULLS LAST, source_type NULLS LAST
  ) AS row_number
  FROM unified
)"""

INT_TRIPS = "int_trips AS (SELECT * EXCLUDE (row_number) FROM ranked WHERE row_number = 1)"


def units(column: str) -> str:
    return f"sum(CAST(round({column} * 10000) AS BIGINT))"


def mean(total_units: str, count: str) -> str:
    """Mean with two decimals, half up, of a sum of ten-thousandths."""
    return (
        f"CAST((2 * {total_units} + 100 * {count}) // (200 * {count}) AS DOUBLE) / 100"
    )


def money(total_units: str) -> str:
    return f"round(CAST({total_units} AS DOUBLE) / 10000, 2)"


_seconds = "sum(date_sub('second', pickup_datetime, dropoff_datetime))"
_measures = f"""
    count(*) AS trip_count,
    {money(units("total_amount"))} AS total_revenue,
    {mean(units("total_amount"), "count(*)")} AS average_total_amount,
    {mean(units("trip_distance"), "count(*)")} AS average_trip_distance"""

MARTS = f"""
mart_daily AS (
  SELECT pickup_date, source_type, {_measures},
    CAST((200 * {_seconds} + 60 * count(*)) // (120 * count(*)) AS DOUBLE) / 100
      AS average_duration_minutes
  FROM int_trips GROUP BY pickup_date, source_type
),
mart_monthly AS (
  SELECT CAST(date_trunc('month', pickup_date) AS DATE) AS pickup_month, source_type, {_measures}
  FROM int_trips GROUP BY ALL
)"""

BATCH_VS_STREAM = f"""
  SELECT source_type,
    CAST(sum(trip_count) AS BIGINT) AS trip_count,
    {money(units("total_revenue"))} AS total_revenue,
    {mean(units("total_revenue"), "sum(trip_count)")} AS revenue_per_trip,
    {mean(units("(average_trip_distance * trip_count)"), "sum(trip_count)")}
      AS average_trip_distance
  FROM mart_daily GROUP BY source_type ORDER BY source_type"""

INVALID_TRIP = """pickup_datetime >= dropoff_datetime OR trip_distance <= 0 OR fare_amount < 0
    OR total_amount <= 0 OR pickup_location_id NOT BETWEEN 1 AND 265
    OR dropoff_location_id NOT BETWEEN 1 AND 265 OR source_type NOT IN ('batch', 'stream')"""

RECONCILED = """
reconciled AS (
  SELECT i.source_type, i.n AS intermediate_rows, m.n AS mart_rows, i.n = m.n AS reconciled
  FROM (SELECT source_type, count(*) AS n FROM int_trips GROUP BY source_type) AS i
  JOIN (SELECT source_type, CAST(sum(trip_count) AS BIGINT) AS n
        FROM mart_daily GROUP BY source_type) AS m USING (source_type)
)"""

TABLES = (
    "benchmark conversations customer documents embeddings events labels lineitem nation orders"
    " pages part region supplier"
).split()


def query(*ctes: str, then: str) -> str:
    return "WITH " + ",\n".join(cte.strip() for cte in ctes) + "\n" + then.strip()


BOTH = (STAGING, BATCH, EVENTS, STREAM, UNIFIED)
TRIPS = (*BOTH, RANKED, INT_TRIPS)

def gate(name: str, observed: str, test: str, table: str) -> str:
    return (
        f"SELECT '{name}' AS gate, ({observed}) {test} AS passed,"
        f" CAST({observed} AS BIGINT) AS observed FROM {table}"
    )


GATE_VALUES = gate("valid_values", f"count(*) FILTER (WHERE {INVALID_TRIP})", "= 0", "{0}")
GATE_UNIQUE = gate("unique_trips", "count(*) - count(DISTINCT trip_id)", "= 0", "{0}")

_required_null = """count(*) FILTER (WHERE lpep_pickup_datetime IS NULL
  OR lpep_dropoff_datetime IS NULL OR "PULocationID" IS NULL OR "DOLocationID" IS NULL)"""

ORACLES: dict[str, str] = {
    "staging_load": query(STAGING, then="SELECT * FROM stg_batch"),
    "batch_rule_counts": query(
        STAGING,
        then=f"""SELECT count(*) AS staged,
          count(*) FILTER (WHERE {IN_PERIOD}) AS period,
          count(*) FILTER (WHERE {IN_ORDER}) AS time_order,
          count(*) FILTER (WHERE {IN_ZONES}) AS zones,
          count(*) FILTER (WHERE {IN_AMOUNTS}) AS amounts,
          count(*) FILTER (WHERE {BATCH_RULES}) AS all_rules FROM stg_batch""",
    ),
    "batch_filter": query(STAGING, then=f"SELECT * FROM stg_batch WHERE {BATCH_RULES}"),
    "trip_fingerprint": query(
        STAGING,
        then=f"""SELECT {TRIP_ID} AS trip_id, lpep_pickup_datetime, lpep_dropoff_datetime,
          "PULocationID", "DOLocationID", trip_distance, total_amount FROM stg_batch""",
    ),
    "batch_conform": query(STAGING, BATCH, then="SELECT * FROM batch_branch"),
    "stream_conform": query(EVENTS, STREAM, then="SELECT * FROM stream_branch"),
    "valid_enriched": query(EVENTS, then="SELECT * FROM valid_events"),
    "dead_letter": query(
        EVENTS,
        PAYLOADS,
        then=f"""SELECT raw_payload, error_code,
          CASE error_code
{_reasons}
          END AS error_reason,
          TIMESTAMP '2024-03-01 00:00:00' AS processing_time
          FROM payloads WHERE error_code IS NOT NULL""",
    ),
    "reject_profile": query(
        EVENTS,
        then="""SELECT error_code, count(*) AS rejected_rows FROM judged
          WHERE error_code IS NOT NULL GROUP BY error_code""",
    ),
    "route_counts": query(
        EVENTS,
        then="""SELECT count(*) AS consumed_rows, count(*) - count(error_code) AS valid_rows,
          count(error_code) AS rejected_rows, true AS accounted FROM judged""",
    ),
    "contract_strict": query(
        EVENTS,
        then="""SELECT code AS error_code, count(*) AS rejected_rows FROM (
          SELECT coalesce(error_code, CASE defect
            WHEN 31 THEN 'CONTRACT_EXTRA_FIELDS'
            WHEN 32 THEN 'CONTRACT_EVENT_ID'
            WHEN 33 THEN 'CONTRACT_TYPE:passenger_count'
            WHEN 34 THEN 'CONTRACT_TYPE:passenger_count'
            WHEN 35 THEN 'CONTRACT_TYPE:trip_distance' END) AS code FROM judged)
          WHERE code IS NOT NULL GROUP BY code""",
    ),
    "unified": query(*BOTH, then="SELECT * FROM unified"),
    "trip_ranking": query(
        *BOTH,
        RANKED,
        then="""SELECT trip_id, ingestion_time, tip_amount,
          CAST(row_number AS INTEGER) AS row_number FROM ranked""",
    ),
    "int_trips": query(*TRIPS, then="SELECT * FROM int_trips"),
    "mart_daily": query(*TRIPS, MARTS, then="SELECT * FROM mart_daily"),
    "mart_monthly": query(*TRIPS, MARTS, then="SELECT * FROM mart_monthly"),
    "report_batch_monthly": query(
        *TRIPS,
        MARTS,
        then="""SELECT * EXCLUDE (source_type) FROM mart_monthly
          WHERE source_type = 'batch' ORDER BY pickup_month""",
    ),
    "report_batch_vs_stream": query(*TRIPS, MARTS, then=BATCH_VS_STREAM),
    "pipeline_report": query(*TRIPS, MARTS, then=BATCH_VS_STREAM),
    "gates_staging": query(
        STAGING,
        then=gate("batch_not_empty", "count(*)", "> 0", "stg_batch")
        + " UNION ALL "
        + gate("batch_required_nulls", _required_null, "= 0", "stg_batch"),
    ),
    "gates_intermediate": query(
        *TRIPS,
        then="SELECT 'required_columns' AS gate, true AS passed, CAST(15 AS BIGINT) AS observed"
        + " UNION ALL "
        + GATE_VALUES.format("int_trips")
        + " UNION ALL "
        + GATE_UNIQUE.format("int_trips")
        + " UNION ALL "
        + gate(
            "stream_present",
            "count(*) FILTER (WHERE pickup_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-28'"
            " AND source_type = 'stream')",
            "> 0",
            "valid_events",
        ),
    ),
    "gates_raw_unified": query(
        *BOTH, then=GATE_VALUES.format("unified") + " UNION ALL " + GATE_UNIQUE.format("unified")
    ),
    "gates_mart": query(
        *TRIPS,
        MARTS,
        RECONCILED,
        then=gate("daily_mart_not_empty", "count(*)", "> 0", "mart_daily")
        + """ UNION ALL SELECT 'mart_reconciles' AS gate, bool_and(reconciled) AS passed,
          count(*) FILTER (WHERE NOT reconciled) AS observed FROM reconciled""",
    ),
    "gate_freshness": query(
        EVENTS,
        then=gate(
            "stream_fresh",
            "count(*) FILTER (WHERE ingestion_time >= TIMESTAMP '2024-03-01' - INTERVAL 40 DAY)",
            "> 0",
            "valid_events",
        ),
    ),
    "reconciliation": query(
        *TRIPS, MARTS, RECONCILED, then="SELECT * FROM reconciled ORDER BY source_type"
    ),
    "coverage": query(
        *TRIPS,
        then="""SELECT source_type, min(pickup_date) AS first_date, max(pickup_date) AS last_date,
          count(*) AS trip_count FROM int_trips GROUP BY source_type ORDER BY source_type""",
    ),
    "lineage_counts": query(
        *TRIPS,
        then="""SELECT source_type, count(*) AS row_count, count(DISTINCT trip_id) AS unique_trips
          FROM int_trips GROUP BY source_type ORDER BY source_type""",
    ),
    "duplicate_rows": query(
        *TRIPS, then="SELECT count(*) - count(DISTINCT trip_id) AS duplicate_rows FROM int_trips"
    ),
    "invalid_rows": query(
        *TRIPS, then=f"SELECT count(*) AS invalid_rows FROM int_trips WHERE {INVALID_TRIP}"
    ),
    "recent_valid": query(
        EVENTS,
        then="""SELECT * FROM valid_events
          ORDER BY processing_time DESC, ingestion_time DESC, event_id LIMIT 10""",
    ),
    "publish_payload": query(
        EVENTS,
        then=f"""SELECT event_id AS key,
          '{{"event_id":"' || event_id
          || '","event_time":"' || {ISO.format("event_time")}
          || 'Z","ingestion_time":"' || {ISO.format("ingestion_time")}
          || CASE WHEN microsecond(ingestion_time) % 1000000 = 0 THEN '' ELSE '.500000' END
          || 'Z","pickup_datetime":"' || {ISO.format("pickup_datetime")}
          || 'Z","dropoff_datetime":"' || {ISO.format("dropoff_datetime")}
          || 'Z","pickup_location_id":' || pickup_location_id
          || ',"dropoff_location_id":' || dropoff_location_id
          || ',"passenger_count":' || passenger_count
          || ',"trip_distance":' || trip_distance
          || ',"fare_amount":' || fare_amount
          || ',"tip_amount":' || tip_amount
          || ',"tolls_amount":' || tolls_amount
          || ',"total_amount":' || total_amount
          || ',"payment_type":' || payment_type
          || ',"source_type":"stream"}}' AS payload,
          'stream' AS source_header FROM valid_events""",
    ),
    "table_row_counts": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_id, count(*) AS row_count FROM {t}" for t in TABLES
    )
    + "\nORDER BY table_id",
    "stream_etl_valid": query(EVENTS, then="SELECT * FROM valid_events"),
    "stream_etl_restart": query(EVENTS, then="SELECT * FROM valid_events"),
    "content_reconciliation": query(
        *TRIPS,
        MARTS,
        then="""SELECT pickup_date, source_type, trip_count AS trip_rows, trip_count AS mart_rows,
          true AS reconciled FROM mart_daily""",
    ),
    "pipeline_tables": query(
        *TRIPS,
        MARTS,
        then="""SELECT 'stg_batch' AS table_id, count(*) AS row_count FROM stg_batch
          UNION ALL SELECT 'stg_stream', count(*) FROM valid_events
          UNION ALL SELECT 'int_trips', count(*) FROM int_trips
          UNION ALL SELECT 'mart_daily', count(*) FROM mart_daily
          UNION ALL SELECT 'mart_monthly', count(*) FROM mart_monthly""",
    ),
}
ORACLES["release_tables"] = f"""SELECT CAST(1 AS BIGINT) AS release, table_id, row_count
  FROM (SELECT CASE table_id WHEN 'stg_stream' THEN 'trip_sums' ELSE table_id END AS table_id,
    CASE table_id WHEN 'stg_stream' THEN (max(row_count) FILTER (table_id = 'mart_daily') OVER ())
      ELSE row_count END AS row_count FROM ({ORACLES["pipeline_tables"]}))"""
ORACLES["stream_etl_rejects"] = ORACLES["reject_profile"]
ORACLES["stream_etl_accounting"] = ORACLES["route_counts"]
ORACLES["stream_ledger"] = ORACLES["route_counts"]
ORACLES["gates_ledger"] = f"""SELECT 'ledger_balanced' AS gate, accounted AS passed FROM ({ORACLES["route_counts"]})
  UNION ALL SELECT 'ledger_complete', true UNION ALL SELECT gate, passed FROM ({ORACLES["gate_freshness"]})"""
ORACLES["refresh_trips"] = ORACLES["int_trips"]
ORACLES["refresh_marts"] = query(
    *TRIPS,
    MARTS,
    then="""SELECT 'daily' AS mart, pickup_date AS first_day, * EXCLUDE (pickup_date, average_duration_minutes)
      FROM mart_daily UNION ALL SELECT 'monthly', * FROM mart_monthly""",
)
ORACLES["clustered_lookup"] = query(
    *TRIPS,
    then="SELECT * FROM int_trips WHERE payment_type = 2 AND pickup_location_id BETWEEN 100 AND 120",
)
