"""Counts with state in RocksDB: stopped and started again, they equal the counts of the table."""

import pytest
from frames import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from haulmark import settings
from haulmark.operators import kpis
from haulmark.plans import stand_ins as si
from haulmark.sources.messages import replay
from haulmark.streaming import sinks, stored


@pytest.fixture
def rocksdb(spark):
    keys = [f"spark.sql.streaming.stateStore.{k}" for store in settings.STATE_STORES.values() for k in store]
    settings.use_state_store(spark, "rocksdb")
    yield
    for key in keys:
        spark.conf.unset(key)


def test_counts_go_on_after_a_restart(spark, sf_dir, tmp_path, rocksdb):
    events = si.events(spark, sf_dir).withColumn("part", F.ntile(4).over(Window.orderBy("ts")))
    counts = lambda: kpis.status_counts(si.updates(si.with_stream_time(replay(spark, f"{tmp_path}/in/*", events.drop("part").schema, files_per_trigger=1))))
    state = None
    for part in range(1, 5):
        # Each run is a new query on the checkpoint folder of the last, which died after its batch.
        events.where(F.col("part") == part).drop("part").coalesce(1).write.parquet(f"{tmp_path}/in/part={part}")
        query = sinks.fold_counts(counts(), f"{tmp_path}/counts", "counts", f"{tmp_path}/state", every=None)
        query.awaitTermination()
        state = query.lastProgress.stateOperators[0]
    assert "rocksdbCommitFlushLatency" in state.customMetrics or any("rocksdb" in k.lower() for k in state.customMetrics)
    now = stored.current_rows(spark, f"{tmp_path}/counts", counts().schema)
    twin = kpis.status_counts(si.updates(si.with_stream_time(events.drop("part"))))
    assert rows_of(now.drop("kpi_calculated_at")) == rows_of(twin.drop("kpi_calculated_at"))


