"""Rows go to Python workers in batches bounded by their bytes."""

import pyarrow as pa
from pyspark.sql import functions as F

from haulmark.llm import ship


def test_long_texts_reach_workers_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, str(1 << 30))
        ship.bound_batches(spark)
        rows = spark.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("text "), 2000).alias("text"))

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"rows": pa.array([batch.num_rows]), "size": pa.array([batch.nbytes])})

        found = rows.mapInArrow(sizes, "rows long, size long").collect()
        assert sum(r.rows for r in found) == 4000 and max(r.size for r in found) < 2 * ship.BATCH_BYTES
        spark.conf.set(key, "1000000")
        ship.bound_batches(spark)
        assert spark.conf.get(key) == "1000000"
    finally:
        spark.conf.set(key, before)
