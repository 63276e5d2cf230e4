"""The rows that models learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str | Column) -> Column:
    """Every fifth document by checksum of its id as text; a null id is not held out."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def bounded_sample(rows: DataFrame, by: str, key: str, limit: int) -> DataFrame:
    """About ``limit`` rows per value of ``by``, or all where there are fewer.

    Rows are chosen by a hash of ``key`` against a share per value, so nothing is sorted;
    the size is bounded in expectation (standard deviation: the root of ``limit``).
    """
    found = rows.groupBy(by).count().collect()
    share = F.lit(0.0)
    for row in found:
        share = F.when(F.col(by) == F.lit(row[by]), F.lit(min(1.0, limit / row["count"]))).otherwise(share)
    spot = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.where(spot < share)
