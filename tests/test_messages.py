from datetime import datetime

import pytest
from frames import messages, one, rows_of
from pyspark.sql import functions as F

from haulmark.functions.messages import encoded, parsed, point_in
from haulmark.operators import ingest
from haulmark.schemas import DELIVERY_UPDATE, DRIVER_PING, TRAFFIC_UPDATE

MALFORMED = [
    "not json",
    "[]",
    None,
    '{"driver_id":"A"',
    '{"driver_id":"X"}',
    '{"driver_id":"X","speed":"abc","latitude":1.5}',
    '{"timestamp":"bad","driver_id":"Y"}',
    '{"timestamp":"2024-01-01T10:00:00+05:30"}',
    '{"timestamp":"2024-01-01T10:00:00.123456","driver_id":"Z","unknown":1}',
]


def test_malformed_text_keeps_its_row_and_bad_fields_are_null_alone(spark):
    got = [tuple(r) for r in parsed(messages(spark, MALFORMED), DRIVER_PING).collect()]
    nothing = (None,) * 7
    assert got[:3] == [nothing] * 3
    assert got[4] == ("X", None, None, None, None, None, None)
    assert got[5] == ("X", 1.5, None, None, None, None, None)
    assert got[6] == ("Y", None, None, None, None, None, None)
    assert len(got) == len(MALFORMED)


def test_times_with_and_without_a_zone(spark):
    stamps = parsed(messages(spark, MALFORMED[-2:]), DRIVER_PING).select(
        F.col("timestamp").cast("timestamp_ntz").alias("t")
    )
    assert [r.t for r in stamps.collect()] == [
        datetime(2024, 1, 1, 4, 30),
        datetime(2024, 1, 1, 10, 0, 0, 123456),
    ]


def test_times_without_a_zone_are_in_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        text = messages(spark, ['{"timestamp":"2024-01-01T10:00:00"}'])
        seconds = parsed(text, DRIVER_PING).select(F.unix_seconds("timestamp").alias("s"))
        assert one(seconds).s == int(datetime(2024, 1, 1, 4, 30).timestamp())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_corrupt_text_is_kept_on_request(spark):
    got = parsed(messages(spark, MALFORMED), DRIVER_PING, corrupt="_corrupt").select("_corrupt").collect()
    kept = [r[0] for r in got]
    assert kept[0] == "not json" and kept[1] == "[]" and kept[2] is None
    assert kept[4] is None and kept[5] == MALFORMED[5]


def test_encoded_leaves_nulls_out_and_writes_six_digits(spark):
    frame = spark.createDataFrame(
        [("a", None, datetime(2024, 1, 1, 0, 0, 7))], "k string, n int, t timestamp_ntz"
    )
    text = one(encoded(frame).select(F.col("value").cast("string").alias("v"))).v
    assert text == '{"k":"a","t":"2024-01-01T00:00:07.000000"}'


@pytest.mark.parametrize("n", [0, 1])
def test_encode_and_parse_round_trip(spark, n):
    rows = [("A_001", datetime(2024, 1, 1, 1, 2, 3, 4), "low", 0.1 + n, n, "fog"), (None,) * 6]
    frame = spark.createDataFrame(rows, TRAFFIC_UPDATE)
    assert rows_of(ingest.traffic_updates(encoded(frame))) == rows_of(frame)


def test_point_in_text(spark):
    texts = ['{"lat":12.97,"lng":77.59}', '{"lat":1}', "NYC", "{}", "[]", None, '{"lat":"x"}']
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(point_in(F.col("t")).alias("p"))
    got = [None if r.p is None else tuple(r.p) for r in frame.collect()]
    assert got == [(12.97, 77.59), (1.0, None), None, None, None, None, None]


def test_delivery_update_shape(spark):
    texts = [
        '{"order_id":"O1","delivery_id":"X","location":{"lat":1.5,"lng":2.5},"delay_minutes":7}',
        '{"delivery_id":"O2","location":"NYC","customer_id":"C"}',
    ]
    frame = ingest.delivery_updates(messages(spark, texts))
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in DELIVERY_UPDATE]
    first, second = frame.collect()
    assert first.order_id == "O1" and tuple(first.location) == (1.5, 2.5) and first.delay_minutes == 7
    assert first.location_text == '{"lat":1.5,"lng":2.5}'
    assert second.order_id == "O2" and second.location is None and second.location_text == "NYC"


def test_narrow_read_of_delivery_updates(spark):
    texts = ['{"delivery_id":"O2","status":"delivered","driver_id":"D","timestamp":"2024-01-01T00:00:00Z"}']
    frame = ingest.delivery_states(messages(spark, texts))
    assert frame.columns == ["order_id", "status", "timestamp", "driver_id"]
    assert one(frame).order_id == "O2"


def test_corrupt_column_passes_through_delivery_updates(spark):
    frame = ingest.delivery_updates(messages(spark, ["junk"]), corrupt="bad")
    assert one(frame).bad == "junk"
