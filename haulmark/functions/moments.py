"""Conditions on event time, relative to a given moment.

Every bound is a literal or the current time by the time the optimizer sees it,
so it reaches the parquet scan as a pushed filter. Tables stored by date carry an
``event_date`` column; for those each condition also names the date folders.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_DATE = "event_date"

# Date folders follow the writer's session zone. Two zones never differ by more
# than 26 hours, so two days of slack make the folder bound safe for any reader.
DATE_SLACK = 2


def moment(as_of: datetime | Column | None, kind: T.DataType) -> Column:
    """``as_of`` as a column of the given timestamp type; ``None`` is now."""
    if as_of is None:
        return F.localtimestamp() if isinstance(kind, T.TimestampNTZType) else F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast(kind)
    text = F.lit(as_of.isoformat(sep=" "))
    return text.cast(kind) if as_of.tzinfo is None else text.cast("timestamp").cast(kind)


def newer_than(
    frame: DataFrame, within: timedelta, as_of: datetime | Column | None = None, time: str = "timestamp"
) -> Column:
    """``time`` strictly after ``as_of - within``. Rows from the future pass."""
    bound = moment(as_of, frame.schema[time].dataType) - F.lit(within)
    newer = F.col(time) > bound
    if EVENT_DATE in frame.columns:
        newer &= F.col(EVENT_DATE) >= F.date_sub(F.to_date(bound), DATE_SLACK)
    return newer


def on_day_of(
    frame: DataFrame, as_of: datetime | Column | None = None, time: str = "timestamp"
) -> Column:
    """``time`` on the calendar day of ``as_of`` in the session zone, as a range."""
    kind = frame.schema[time].dataType
    day = F.to_date(moment(as_of, kind))
    same_day = (F.col(time) >= day.cast(kind)) & (F.col(time) < F.date_add(day, 1).cast(kind))
    if EVENT_DATE in frame.columns:
        same_day &= F.col(EVENT_DATE).between(
            F.date_sub(day, DATE_SLACK), F.date_add(day, DATE_SLACK)
        )
    return same_day


def latest_time(frame: DataFrame, time: str = "timestamp") -> datetime | None:
    """The newest event time, as a literal for ``as_of``: one value, one job.

    As a literal it prunes row groups and date folders; a scalar subquery in the
    same place would leave the scan whole. Of a table stored by date only the newest
    folders are read (found by their names, without a column), so a row with a date
    in the far future decides, as its time would.
    """
    if EVENT_DATE in frame.columns:
        day = frame.agg(F.max(EVENT_DATE)).first()[0]
        if day is not None:
            frame = frame.where(F.col(EVENT_DATE) >= F.lit(day - timedelta(days=DATE_SLACK)))
    newest = F.max(time)
    if isinstance(frame.schema[time].dataType, T.TimestampNTZType):
        return frame.agg(newest).first()[0]
    micros = frame.agg(F.unix_micros(newest)).first()[0]
    if micros is None:
        return None
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)
