from datetime import datetime

from frames import one
from pyspark.sql import functions as F

from haulmark.functions import columns as c


def value(spark, column):
    return one(spark.range(1).select(column.alias("v"))).v


def test_padded_ids_pad_and_never_cut(spark):
    frame = spark.createDataFrame([(7,), (0,), (9999,), (10000,), (123456,), (-5,), (None,)], "n long")
    got = [r.v for r in frame.select(c.padded_id(c.DRIVER_ID, F.col("n")).alias("v")).collect()]
    assert got == ["DRV_0007", "DRV_0000", "DRV_9999", "DRV_10000", "DRV_123456", "DRV_-005", None]


def test_prefixed_ids(spark):
    assert value(spark, c.prefixed_id("driver_", F.lit(13), 5)) == "driver_3"
    assert value(spark, c.prefixed_id("del_", F.lit(13))) == "del_13"


def test_status_by_remainder(spark):
    frame = spark.range(4).select(c.status_by_remainder(F.col("id")).alias("v"))
    assert [r.v for r in frame.orderBy("v").collect()] == ["delivered", "delivered", "in_transit", "picked_up"]


def test_rescaling(spark):
    assert value(spark, c.rescaled(F.lit(0.5), 20.0, 60.0)) == 50.0
    assert value(spark, c.rescaled_around(F.lit(0.5), 40.7128, 0.1)) == 40.7128
    assert value(spark, c.rescaled_around(F.lit(0.0), 10.0, 4.0)) == 8.0


def test_rounding_is_half_up_and_means_default_to_zero(spark):
    assert value(spark, c.to_one_decimal(F.lit(2.25))) == 2.3
    assert value(spark, c.mean_or_zero(F.lit(None).cast("double"))) == 0.0


def test_minutes(spark):
    time = F.lit("2024-02-28 23:50:00").cast("timestamp_ntz")
    assert value(spark, c.minutes_after(time, F.lit(15))) == datetime(2024, 2, 29, 0, 5)
    assert value(spark, c.minutes_before(time, F.lit(1440))) == datetime(2024, 2, 27, 23, 50)


def test_alert_type_defaults(spark):
    for text, kind in [
        ('{"anomaly_type":"cancellation"}', "cancellation"),
        ("{}", "unknown"),
        ('{"anomaly_type":null}', "unknown"),
        ("junk", "unknown"),
    ]:
        assert value(spark, c.alert_type(F.lit(text))) == kind
