"""Trip-shaped inputs derived from the driver's general tables.

Every row of the source tables is kept. Remainders of the keys decide which
rows are also delivered a second time and which payloads carry a defect.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.contract import BATCH_SCHEMA, EventSpec, PipelineConfig, utc
from tripmill.functions.text import sql_text
from tripmill.operators.validate import valid_events, validate_events
from tripmill.session import configure, workers
from tripmill.sources.tables import to_schema

CONFIG = PipelineConfig(
    batch_start=date(1996, 1, 1),
    batch_end=date(1998, 12, 31),
    event=replace(EventSpec(), start=utc(2024, 1, 1), end=utc(2024, 1, 29)),
    as_of=utc(2024, 3, 1),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, as it is stored."""
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def deliveries(again: str) -> str:
    """0 for the first delivery of a row, and 1 as well for rows delivered again."""
    return f"explode(CASE WHEN {again} THEN array(0, 1) ELSE array(0) END) AS delivery"


def batch_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch staging rows: a trip per order line; lines of every tenth order come twice.

    The second copy has another tip, which is not part of a trip's identity.
    Some orders have NaN as distance, fare or total.
    """
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    trips = lines.selectExpr("*", deliveries("l_orderkey % 10 = 0")).selectExpr(
        "o_orderdate AS lpep_pickup_datetime",
        "l_shipdate AS lpep_dropoff_datetime",
        "l_partkey % 270 AS PULocationID",
        "l_orderkey % 270 AS DOLocationID",
        "nullif(l_linenumber, 7) AS passenger_count",
        "CASE WHEN l_orderkey % 103 = 0 THEN double('NaN') ELSE l_quantity - 1 END"
        " AS trip_distance",
        "CASE WHEN l_orderkey % 97 = 0 THEN -l_extendedprice"
        " WHEN l_orderkey % 107 = 0 THEN double('NaN') ELSE l_extendedprice END AS fare_amount",
        "floor(l_extendedprice * l_discount) + delivery AS tip_amount",
        "floor(l_extendedprice * l_tax) AS tolls_amount",
        "CASE WHEN l_orderkey % 101 = 0 THEN 0D WHEN l_orderkey % 109 = 0 THEN double('NaN')"
        " ELSE l_extendedprice + floor(l_extendedprice * l_tax) END AS total_amount",
        "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS payment_type",
    )
    return to_schema(trips, BATCH_SCHEMA)


# SQL of each payload field's JSON text, and of the text that replaces it in a
# payload with the defect of that number.
PERIOD_END = sql_text(CONFIG.event.end.strftime('"%Y-%m-%dT%H:%M:%SZ"'))
PAYLOAD_FIELDS: dict[str, tuple[str, dict[int, str]]] = {
    "event_id": (
        """concat('"00000000-0000-4000-8000-', hex_id, '"')""",
        {32: """concat('"trip-', hex_id, '"')"""},
    ),
    "event_time": (
        """concat('"', pickup_text, 'Z"')""",
        {
            6: "unix_seconds(pickup)",
            8: """concat('"', date_format(pickup + INTERVAL 1 SECOND, iso), 'Z"')""",
            10: PERIOD_END,
        },
    ),
    "ingestion_time": (
        """concat('"', date_format(ingestion, iso), 'Z"')""",
        {
            7: "'null'",
            9: """'"2030-01-01T00:00:00Z"'""",
            38: """concat('"', date_format(ingestion, iso), '.500Z"')""",
        },
    ),
    "pickup_datetime": (
        """concat('"', pickup_text, 'Z"')""",
        {
            4: """concat('"', pickup_text, '"')""",
            10: PERIOD_END,
            36: """concat('"', date_format(pickup + INTERVAL 7 HOURS, iso), '+07:00"')""",
        },
    ),
    "dropoff_datetime": (
        """concat('"', date_format(dropoff, iso), 'Z"')""",
        {
            5: """concat('"', date_format(pickup, 'yyyy-MM-dd'), '"')""",
            11: """concat('"', pickup_text, 'Z"')""",
        },
    ),
    "pickup_location_id": ("pu", {12: """'"abc"'""", 21: "'266'"}),
    "dropoff_location_id": ("do", {13: "'[1]'", 22: "'0'"}),
    "passenger_count": (
        "passengers",
        {
            14: "'null'",
            23: "'7'",
            33: """concat('"', passengers, '"')""",
            34: "concat(passengers, '.7')",
        },
    ),
    "trip_distance": (
        "distance",
        {16: """'"NaN"'""", 25: "'0'", 35: """concat('"', distance, '"')"""},
    ),
    "fare_amount": ("fare", {18: """'"ten"'"""}),
    "tip_amount": ("tip", {3: "NULL", 19: """'"Infinity"'""", 26: "'-0.01'"}),
    "tolls_amount": ("tolls", {20: "'null'"}),
    "total_amount": ("total", {17: "'{}'", 27: "'0'"}),
    "payment_type": ("payment", {15: """'"3.7"'""", 24: "'5'", 30: "'9'"}),
    "source_type": ("""'"stream"'""", {28: """'"batch"'""", 30: """'"batch"'"""}),
}


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload bytes, one JSON event per row of ``events``; every seventh comes twice.

    The second delivery was ingested an hour later and has a higher tip.
    ``event_id % 50`` from 1 to 30 plants a defect, one per validation rule in
    the order of the rules (29: text after the object, 30: two defects). From
    31 to 36 the event is valid at run time in an unusual spelling. At 37 a byte
    that is not UTF-8 follows the object, at 38 a time has a fraction of a second.

    The narrow rows are dealt out before their payloads are built: a file of few
    row groups would else build and validate all of its payloads in as few tasks.
    """
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    # By place: equal and null keys are spread as well, a rerun deals alike, and nothing is sorted as in a round robin.
    parts = workers(spark)
    placed = events.withColumn("part", (F.monotonically_increasing_id() % parts).cast("int"))
    dealt = placed.repartitionById(parts, "part")
    delivered = dealt.drop("part").selectExpr("*", deliveries("event_id % 7 = 0"))
    cents = delivered.selectExpr(
        "*",
        "CAST(round(value * 100) AS BIGINT) AS cents",
        "date_trunc('second', CAST(ts AS TIMESTAMP)) AS pickup",
        "CASE WHEN user_id % 4 = 0 THEN 694 ELSE 0 END AS toll_cents",
    ).selectExpr("*", "cents % 500 + 100 * delivery AS tip_cents")
    values = cents.selectExpr(
        "event_id % 50 AS defect",
        "pickup",
        "timestamp_seconds(unix_seconds(pickup) + 60 + user_id * 37 % 5400) AS dropoff",
        "timestamp_millis(1000 * (unix_seconds(pickup) + 3600 * (1 + delivery))"
        " + CASE WHEN event_id % 50 = 38 THEN 500 ELSE 0 END) AS ingestion",
        "lpad(lower(hex(event_id)), 12, '0') AS hex_id",
        "1 + event_id % 265 AS pu",
        "1 + user_id % 265 AS do",
        "1 + event_id % 6 AS passengers",
        "1 + event_id % 4 AS payment",
        "(floor(cents / 10) + 20) / 100 AS distance",
        "cents / 100 AS fare",
        "tip_cents / 100 AS tip",
        "toll_cents / 100 AS tolls",
        "(cents + tip_cents + toll_cents + 100) / 100 AS total",
        r"'yyyy-MM-dd\'T\'HH:mm:ss' AS iso",
    ).selectExpr("*", "date_format(pickup, iso) AS pickup_text")

    def field(name: str, right: str, defects: dict[int, str]) -> str:
        cases = " ".join(f"WHEN {n} THEN CAST({text} AS STRING)" for n, text in defects.items())
        return f"concat('\"{name}\":', CASE defect {cases} ELSE CAST({right} AS STRING) END)"

    fields = ", ".join(field(name, *entry) for name, entry in PAYLOAD_FIELDS.items())
    extra = """CASE WHEN defect = 31 THEN '"vendor":2' END"""
    bodies = values.selectExpr("defect", f"concat_ws(',', {fields}, {extra}) AS body")
    return bodies.selectExpr(
        """CAST(CASE defect
             WHEN 1 THEN concat('{', body)
             WHEN 2 THEN concat('[{', body, '}]')
             WHEN 29 THEN concat('{', body, '} x')
             ELSE concat('{', body, '}') END AS BINARY)
           || CASE WHEN defect = 37 THEN X'FF' ELSE X'' END AS value"""
    )


def validated_events(spark: SparkSession, sf_dir: str, strict: bool = False) -> DataFrame:
    return validate_events(raw_events(spark, sf_dir), CONFIG.event, CONFIG.as_of, strict=strict)


def stream_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid-event table, as the stream would have written it."""
    return valid_events(validated_events(spark, sf_dir))
