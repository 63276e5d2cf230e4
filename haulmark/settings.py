"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: What a session for these streams and reports should be started with. Broadcast
#: joins stay behind Spark's own size estimate (autoBroadcastJoinThreshold). The
#: state of the counts is a few rows per open minute, so the default store will do;
#: see ``use_state_store`` for more.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    return builder


#: Where counting streams keep their state: on the heap of the executors, or in RocksDB on
#: their disks, whose changes go to the checkpoint folder batch by batch.
STATE_STORES = {
    "heap": {"providerClass": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"},
    "rocksdb": {
        "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "rocksdb.changelogCheckpointing.enabled": "true",
    },
}


def use_state_store(spark: SparkSession, store: str) -> None:
    """The store of streams that start from now on; a checkpoint folder stays with that of its first start."""
    for key, value in STATE_STORES[store].items():
        spark.conf.set(f"spark.sql.streaming.stateStore.{key}", value)


_named: list[str] = []


def name_folder(path: str) -> None:
    """The folder of local sessions that set no ``spark.checkpoint.dir``."""
    _named[:] = [path.rstrip("/")]


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. A local session may go without if the
    program has named a folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if _named and spark.conf.get("spark.master", "").startswith("local"):
        return _named[0]
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared root; nothing is created yet."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
