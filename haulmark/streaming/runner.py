"""Several streaming queries in one session."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql.streaming import StreamingQuery


def start_all(starts: Iterable[Callable[[], StreamingQuery]]) -> list[StreamingQuery]:
    """Start every query; if one cannot start, stop the others and raise."""
    queries: list[StreamingQuery] = []
    try:
        for start in starts:
            queries.append(start())
    except BaseException:
        stop_all(queries)
        raise
    return queries


def wait_for_all(
    queries: Iterable[StreamingQuery],
    *,
    look_every: int = 1,
    report: Callable[[], None] | None = None,
    report_every: int = 60,
) -> None:
    """Wait until all have ended. The first that fails raises, whichever it is, and
    the others are stopped; an interrupt stops them too. ``report`` is called every
    ``report_every`` seconds meanwhile, and once at the end."""
    queries = list(queries)
    running = queries
    due = time.monotonic() + report_every
    try:
        while running:
            running = [q for q in running if not q.awaitTermination(look_every)]
            if report and (time.monotonic() >= due or not running):
                due += report_every
                report()
    finally:
        stop_all(queries)


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        query.stop()
