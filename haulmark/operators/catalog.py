"""Which tables there are, and how many rows they hold."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_tables(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """Names of the tables and views of a schema, by default the current one."""
    where = f" IN {schema}" if schema else ""
    return spark.sql(f"SHOW TABLES{where}").select(F.col("tableName").alias("table_name"))


def named_tables(spark: SparkSession, names: Iterable[str]) -> dict[str, DataFrame | None]:
    """Tables and views by name, ``None`` for those there are not."""
    return {name: spark.table(name) if spark.catalog.tableExists(name) else None for name in names}


def row_counts(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows per table in one job; a table that is missing (``None``) has a null count.

    The scans read no column, so parquet answers from its footers.
    """
    counts = []
    for name, frame in tables.items():
        if frame is None:
            count = spark.range(1).select(F.lit(None).cast("bigint").alias("row_count"))
        else:
            count = frame.agg(F.count(F.lit(1)).alias("row_count"))
        counts.append(count.select(F.lit(name).alias("table_name"), "row_count"))
    return reduce(DataFrame.unionAll, counts)
