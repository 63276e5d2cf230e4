"""Progress and source lag of streaming queries, as frames."""

from __future__ import annotations

import threading
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from haulmark.operators import lag
from haulmark.streaming.stored import stored_table

PROGRESS = T.StructType(
    [
        T.StructField("query_name", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("state_rows", T.LongType()),
        T.StructField("removed_rows", T.LongType()),
        T.StructField("late_rows_dropped", T.LongType()),
    ]
)

SOURCE_OFFSETS = T.StructType(
    [
        T.StructField("query_name", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("end_offset", T.StringType()),
        T.StructField("latest_offset", T.StringType()),
    ]
)


class ProgressLog(StreamingQueryListener):
    """Appends a record per batch to parquet tables below ``path``, for all queries of a session.

    Add it to the session before the queries start. Records are held until there are
    ``hold`` of them, a query ends or ``flush`` is called; nothing is dropped, however many
    batches there are.
    """

    def __init__(self, spark: SparkSession, path: str, hold: int = 100):
        self._spark, self._path, self._hold = spark, path, hold
        self._progress: list[tuple] = []
        self._offsets: list[tuple] = []
        self._newest: dict[str, list[tuple]] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        states = p.stateOperators
        with self._changed:
            self._progress.append(
                (
                    p.name,
                    p.batchId,
                    p.numInputRows,
                    p.eventTime.get("watermark"),
                    sum(s.numRowsTotal for s in states),
                    sum(s.numRowsRemoved for s in states),
                    sum(s.numRowsDroppedByWatermark for s in states),
                )
            )
            self._newest[p.name] = [(p.name, p.batchId, s.endOffset, s.latestOffset) for s in p.sources]
            self._offsets += self._newest[p.name]
            if len(self._progress) >= self._hold:
                self._write()

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._write()
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def _write(self) -> None:
        for rows, schema, name in ((self._progress, PROGRESS, "progress"), (self._offsets, SOURCE_OFFSETS, "offsets")):
            if rows:
                self._spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self._path}/{name}")
                rows.clear()

    def flush(self, ended: Iterable[StreamingQuery] = (), seconds: int = 60) -> None:
        """Write what is held, after the last records of the given queries have come."""
        runs = {str(q.runId) for q in ended}
        with self._changed:
            if not self._changed.wait_for(lambda: runs <= self._ended, seconds):
                raise TimeoutError("the last progress of a query has not come")
            self._write()

    def rows(self) -> DataFrame:
        """One row per query and batch."""
        return stored_table(self._spark, f"{self._path}/progress", PROGRESS)

    def newest_offsets(self) -> DataFrame:
        """The offsets of the last batch of each query, without reading the table."""
        with self._changed:
            rows = [row for of_query in self._newest.values() for row in of_query]
        return self._spark.createDataFrame(rows, SOURCE_OFFSETS)

    def source_offsets(self) -> DataFrame:
        """Per query, batch and source the offsets read up to, and those there were."""
        return stored_table(self._spark, f"{self._path}/offsets", SOURCE_OFFSETS)


def topic_offsets(offsets: DataFrame) -> DataFrame:
    """Broker offsets unpacked: ``query_name, batch_id, topic, partition, end_offset,
    committed_offset``, the last two as the lag report wants them."""
    per_topic = T.MapType(T.StringType(), T.MapType(T.StringType(), T.LongType()))
    read = F.from_json("end_offset", per_topic)
    there = F.from_json("latest_offset", per_topic)
    return (
        offsets.select("query_name", "batch_id", read.alias("read"), F.explode(there).alias("topic", "ends"))
        .select("*", F.explode("ends").alias("partition", "end"))
        .select(
            "query_name",
            "batch_id",
            "topic",
            F.col("partition").cast("int").alias("partition"),
            F.col("end").alias("end_offset"),
            F.col("read")[F.col("topic")][F.col("partition")].alias("committed_offset"),
        )
    )


def topic_lag(offsets: DataFrame) -> DataFrame:
    """Lag per query, topic and partition from the newest offsets of each query."""
    return lag.partition_lag(topic_offsets(offsets))
