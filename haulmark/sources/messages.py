"""Message streams: a Kafka topic, or a replay of stored files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from haulmark.schemas import MESSAGE

# A first start reads new messages only, and lost offsets do not stop it.
START_OPTIONS = {"startingOffsets": "latest", "failOnDataLoss": "false"}


def kafka_options(servers: str, topic: str, **more: str) -> dict[str, str]:
    """Options of the Kafka source. ``more`` adds or replaces single options, such
    as ``maxOffsetsPerTrigger`` or ``minPartitions`` to split a hot partition."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, **START_OPTIONS, **more}


def kafka_messages(spark: SparkSession, servers: str, topic: str, **more: str) -> DataFrame:
    """A topic as a stream with a binary ``value``; the Kafka package must be present."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **more)).load()


def replay(
    spark: SparkSession, path: str, schema: T.StructType, *, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files as a stream, oldest first, all of them.

    ``path`` is a directory or a glob. Without ``files_per_trigger`` everything
    there is comes in the first batch.
    """
    reader = spark.readStream.schema(schema).option("latestFirst", "false")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def message_stream(
    spark: SparkSession,
    topic: str,
    *,
    servers: str | None = None,
    replay_root: str | None = None,
    files_per_trigger: int | None = None,
    **more: str,
) -> DataFrame:
    """The messages of a topic: from the broker, or from ``replay_root/<topic>``."""
    if (servers is None) == (replay_root is None):
        raise ValueError("give either servers or replay_root")
    if servers is not None:
        return kafka_messages(spark, servers, topic, **more)
    return replay(spark, f"{replay_root}/{topic}", MESSAGE, files_per_trigger=files_per_trigger)
