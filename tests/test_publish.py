import json

from conftest import AS_OF, GOOD, event
from pyspark.sql import functions as F

from tripmill.operators.validate import split_valid, validate_events
from tripmill.sources.events import encode_events


def test_encoded_events_round_trip(spark):
    frame = spark.createDataFrame([(event().encode(),)], "value binary")
    valid, _ = split_valid(validate_events(frame, as_of=AS_OF))
    message = encode_events(valid).first()
    text = bytes(message.value).decode()
    assert text.startswith('{"event_id":"') and ", " not in text and '": ' not in text
    assert json.loads(text) == GOOD
    assert message.key == GOOD["event_id"]
    headers = {h.key: bytes(h.value).decode() for h in message.headers}
    assert headers == {"event_id": GOOD["event_id"], "source_type": "stream"}
    again, _ = split_valid(validate_events(encode_events(valid).select("value"), as_of=AS_OF))
    assert again.collect() == valid.collect()


def test_null_fields_stay_present(spark):
    frame = spark.createDataFrame([(event().encode(),)], "value binary")
    valid, _ = split_valid(validate_events(frame, as_of=AS_OF))
    message = encode_events(valid.withColumn("tip_amount", F.lit(None).cast("double")))
    assert json.loads(bytes(message.first().value))["tip_amount"] is None
    checked = validate_events(message.select("value"), as_of=AS_OF).first()
    assert checked.error_code == "BAD_TYPE:tip_amount"


def test_messages_have_the_columns_of_a_topic(spark):
    frame = spark.createDataFrame([(event().encode(),)], "value binary")
    valid, _ = split_valid(validate_events(frame, as_of=AS_OF))
    types = dict(encode_events(valid).dtypes)
    assert types["value"] == "binary"
    assert types["headers"] == "array<struct<key:string,value:binary>>"
