"""How far consumers are behind, per topic partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BY = ["topic", "partition"]


def partition_lag(end_offsets: DataFrame, committed: DataFrame | None = None) -> DataFrame:
    """``end - committed`` for each partition; all of it when nothing is committed.

    Without ``committed`` the first frame holds both, as ``topic_offsets`` gives them, and
    its other columns stay.
    """
    rows = end_offsets if committed is None else end_offsets.join(committed, _BY, "left")
    others = [c for c in rows.columns if c not in (*_BY, "end_offset", "committed_offset")] if committed is None else []
    done = F.coalesce("committed_offset", F.lit(0))
    return rows.select(*others, *_BY, "end_offset", "committed_offset", (F.col("end_offset") - done).alias("lag"))
