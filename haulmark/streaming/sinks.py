"""Where streams go. Every query is named and keeps its own checkpoint folder, so a
restart under the same name goes on where it stopped."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from haulmark.operators.kpis import COUNT_KEY, LATE_BY
from haulmark.streaming import stored

# How often the streams fire and how many rows the console shows.
INGEST_EVERY = "10 seconds"
KPI_EVERY = "30 seconds"
INGEST_CONSOLE_ROWS = 10
KPI_CONSOLE_ROWS = 20

# How the producer delivers.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.retry.backoff.ms": "1000",
}


def writer(
    stream: DataFrame, name: str, checkpoints: str, *, mode: str = "append", every: str | None = INGEST_EVERY
) -> DataStreamWriter:
    """A named writer. ``every=None`` handles what there is now, then ends."""
    out = (
        stream.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", f"{checkpoints}/{name}")
    )
    return out.trigger(availableNow=True) if every is None else out.trigger(processingTime=every)


def append_to_tables(
    stream: DataFrame,
    targets: Mapping[str, Callable[[DataFrame], DataFrame]],
    name: str,
    checkpoints: str,
    *,
    every: str | None = INGEST_EVERY,
    by: Sequence[str] = ("event_date",),
    others: str = stored.REFUSE,
) -> StreamingQuery:
    """One stream into several tables, each with rows of its own made of the same batch.

    ``targets`` maps the path of a table to what makes its rows. The source is read, and its
    messages are parsed, once per batch. A batch that runs again overwrites its own
    folders in every table, so each holds each row once. Rows of a batch are brought together
    by date. Read the tables with ``stored_table``. If a table holds rows of a stream with another
    checkpoint folder the query fails, unless ``others`` says to keep them beside its own or
    to replace them.
    """
    claimed: set[str] = set()

    def write(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        writer_id = stored.query_id(spark)
        rows = rows.persist() if len(targets) > 1 else rows
        try:
            for path, shaped in targets.items():
                if path not in claimed:
                    stored.claim(spark, path, writer_id, others)
                    claimed.add(path)
                stored.write_batch(shaped(rows), path, writer_id, batch, by)
        finally:
            if len(targets) > 1:
                rows.unpersist()

    return writer(stream, name, checkpoints, every=every).foreachBatch(write).start()


def append_to_table(
    stream: DataFrame,
    path: str,
    name: str,
    checkpoints: str,
    *,
    every: str | None = INGEST_EVERY,
    by: Sequence[str] = ("event_date",),
    others: str = stored.REFUSE,
) -> StreamingQuery:
    """Each row once, in parquet files below date folders: ``append_to_tables`` for one table."""
    return append_to_tables(stream, {path: lambda rows: rows}, name, checkpoints, every=every, by=by, others=others)


def show_on_console(
    stream: DataFrame,
    name: str,
    checkpoints: str,
    *,
    mode: str = "append",
    rows: int = INGEST_CONSOLE_ROWS,
    every: str | None = INGEST_EVERY,
) -> StreamingQuery:
    out = writer(stream, name, checkpoints, mode=mode, every=every).format("console")
    return out.option("truncate", False).option("numRows", rows).start()


def fold_counts(
    stream: DataFrame,
    path: str,
    name: str,
    checkpoints: str,
    *,
    every: str | None = KPI_EVERY,
    others: str = stored.REFUSE,
) -> StreamingQuery:
    """The counts of ``kpis.status_counts`` (update mode), one row per window and status.

    Counts of a stream with another checkpoint folder can be refused or replaced; they
    cannot stay, as both may have counted the same rows.
    """
    if others == stored.KEEP:
        raise ValueError("counts of two streams cannot stand side by side")

    claimed = False

    def write(changes: DataFrame, batch: int) -> None:
        nonlocal claimed
        writer_id = stored.query_id(changes.sparkSession)
        if not claimed:
            stored.claim(changes.sparkSession, path, writer_id, others)
            claimed = True
        stored.fold_changes(changes, path, writer_id, batch, COUNT_KEY, "window_start", "window_end", LATE_BY)

    return writer(stream, name, checkpoints, mode="update", every=every).foreachBatch(write).start()


def topic_options(servers: str, topic: str, **more: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **PRODUCER_OPTIONS, **more}


def send_to_topic(messages: DataFrame, servers: str, topic: str, **more: str) -> None:
    """A table of encoded messages to a topic; the Kafka package must be present."""
    messages.write.format("kafka").options(**topic_options(servers, topic, **more)).save()


def stream_to_topic(
    messages: DataFrame,
    servers: str,
    topic: str,
    name: str,
    checkpoints: str,
    *,
    every: str | None = INGEST_EVERY,
    **more: str,
) -> StreamingQuery:
    out = writer(messages, name, checkpoints, every=every).format("kafka")
    return out.options(**topic_options(servers, topic, **more)).start()
