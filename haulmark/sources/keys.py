"""The keys of a table beside it, bucketed, so that incoming rows meet them without a shuffle of the table.

Only the incoming side of a join is then shuffled, into as many partitions as there are buckets. Give
at least as many buckets as ``spark.sql.shuffle.partitions``, or Spark may deal the table anew.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def key_table(spark: SparkSession, path: str, key: T.StructType, buckets: int) -> DataFrame:
    """The keys stored at ``path``, known to the session under a name of their own."""
    return spark.table(_known(spark, path, key, buckets))


def add_keys(rows: DataFrame, path: str, key: Sequence[str], buckets: int) -> None:
    """Store the distinct keys of ``rows`` too; for one writer at a time. Keys may repeat between calls.

    One file per bucket and call: call it for many rows at once. A key with a null is no key.
    """
    spark = rows.sparkSession
    keys = rows.select(*key)
    name = _known(spark, path, keys.schema, buckets)
    keys.dropna().distinct().repartition(buckets, *key).write.insertInto(name)


def _known(spark: SparkSession, path: str, key: T.StructType, buckets: int) -> str:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in key.fields)
    names = ", ".join(f"`{f.name}`" for f in key.fields)
    name = f"keys_{hashlib.sha256(f'{path} {columns} {buckets}'.encode()).hexdigest()[:20]}"
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets} BUCKETS LOCATION '{place}'")
    spark.catalog.refreshTable(name)
    return name
