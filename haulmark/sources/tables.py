"""Stored tables as frames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parquet_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A parquet table; a given schema saves the job that reads one from a file."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def jdbc_options(
    url: str,
    table: str,
    *,
    split_on: str | None = None,
    low: str | None = None,
    high: str | None = None,
    splits: int | None = None,
    **more: str,
) -> dict[str, str]:
    """Options of a JDBC read. With ``split_on`` the read runs as ``splits`` ranges of
    that column; rows outside ``low..high`` fall into the first and last range."""
    options = {"url": url, "dbtable": table, **more}
    if split_on is not None:
        if low is None or high is None or splits is None:
            raise ValueError("split_on needs low, high and splits")
        options |= {
            "partitionColumn": split_on,
            "lowerBound": low,
            "upperBound": high,
            "numPartitions": str(splits),
        }
    return options


def jdbc_table(spark: SparkSession, url: str, table: str, **how: str | int) -> DataFrame:
    """A database table; filters and columns are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **how)).load()


def register(tables: Mapping[str, DataFrame]) -> None:
    """Make frames known to SQL under their names."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)


def records_with_prefix(
    records: DataFrame, prefix: str, schema: T.StructType, *, keep: tuple[str, ...] = ("key",)
) -> DataFrame:
    """Key/value records whose key starts with ``prefix``, the JSON value decoded.

    The prefix reaches the parquet scan. A value that is no JSON object gives
    nulls for that record alone.
    """
    # A generated row is not computed again by the filters that follow, as a projected one is.
    nothing = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    data = F.coalesce(F.from_json("value", schema), nothing)
    return records.where(F.col("key").startswith(prefix)).select(*keep, F.inline(F.array(data)))
