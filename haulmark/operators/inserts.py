"""Insert rows whose key a table does not hold yet."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import replace
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.functions.moments import EVENT_DATE
from haulmark.streaming import stored
from haulmark.streaming.ledger import Ledger

#: Types whose minimum fits a hash aggregate.
_FIXED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def absent_rows(
    incoming: DataFrame, existing: DataFrame, key: Sequence[str], first_by: Sequence[str] = ()
) -> DataFrame:
    """The rows of ``incoming`` to append: one per key that ``existing`` lacks.

    Of rows with the same key the first by ``first_by`` and then by the other
    columns stays (nulls first), so a rerun of a lost task picks the same one. As in
    SQL, a null in the key is no conflict: such rows all stay.

    Held keys go first. If the first column of ``first_by`` has a fixed width, its least
    value per key is found by hash in each task, and only rows that have it meet to be
    told apart: a key with a third of all rows costs one row per task, and nothing is
    sorted before a shuffle. Otherwise rows are compared as a whole, which sorts them.

    Only the keys of ``existing`` are read. Where Spark estimates the incoming keys
    small enough to broadcast, the semi join runs inside the scan and the table is
    not shuffled; else its keys are made distinct before the shuffle.
    ``incoming`` is read more than once, mostly for its key columns only; write it to a
    table first where it is costly to compute.
    """
    key = list(key)
    no_key = reduce(or_, [F.col(name).isNull() for name in key])
    rest = [*first_by, *[c for c in incoming.columns if c not in key and c not in first_by]]

    keyed = incoming.where(~no_key)
    held = existing.select(*key).distinct()
    held = held.join(keyed.select(*key).distinct(), key, "left_semi")
    fresh = keyed.join(held, key, "left_anti")
    if not rest:
        once = fresh.distinct()
    elif isinstance(incoming.schema[rest[0]].dataType, _FIXED):
        once = _first_rows(fresh, key, rest)
    else:
        once = fresh.groupBy(*key).agg(F.min(F.struct(*rest)).alias("kept"))
        once = once.select(*key, "kept.*")
    return once.select(*incoming.columns).unionByName(incoming.where(no_key))


def _first_rows(rows: DataFrame, key: list[str], rest: list[str]) -> DataFrame:
    """Per key the least row by ``rest``, nulls first."""
    lead = rest[0]
    # A null is least, and counts as one; min() itself would pass it over.
    least = rows.groupBy(*key).agg(
        F.min(lead).alias("_least"), F.max(F.col(lead).isNull()).alias("_null")
    )
    least = least.select(*[F.col(k).alias(f"_{k}") for k in key], F.when(~F.col("_null"), F.col("_least")).alias("_least"))
    same = [F.col(f"_{k}") == F.col(k) for k in key]
    tied = rows.join(least, reduce(and_, [*same, F.col("_least").eqNullSafe(F.col(lead))]))
    order = Window.partitionBy(*key).orderBy(*[F.asc_nulls_first(c) for c in rest])
    # The first row of a key has none before it. (A rank would be cut by a sort ahead of the shuffle.)
    tied = tied.select(*rows.columns, F.lag(F.lit(1)).over(order).alias("_before"))
    return tied.where("_before IS NULL").drop("_before")


def insert_if_absent(
    incoming: DataFrame, path: str, key: Sequence[str], first_by: Sequence[str] = ()
) -> None:
    """Append the absent rows to the table at ``path``, made where there is none.

    Rows with an ``event_date`` go below their date folder, beside those that streams write,
    and are read with ``stored_table``. Several inserts may run at once: rows are written first
    and count once the table's ledger names their writer. Who finds that another insert was faster
    looks at what that one added only, drops the keys it holds, and tries again. Streams
    append without a look at keys. A plain parquet table stays one, for one writer at a time.
    ``incoming`` is persisted meanwhile, unless the caller has done so, who keeps it then.
    """
    spark = incoming.sparkSession
    level = incoming.storageLevel
    held = level.useMemory or level.useDisk
    incoming = incoming if held else incoming.persist()
    try:
        if stored.is_plain(spark, path):
            rows = absent_rows(incoming, stored.stored_table(spark, path, incoming.schema), key, first_by)
            rows.write.mode("append").parquet(path)
        else:
            _insert(incoming, path, list(key), first_by)
    finally:
        if not held:
            incoming.unpersist()


def _insert(incoming: DataFrame, path: str, key: list[str], first_by: Sequence[str]) -> None:
    spark, schema = incoming.sparkSession, incoming.schema
    by = (EVENT_DATE,) if EVENT_DATE in incoming.columns else ()
    log = Ledger(spark, path)
    state = log.opened(stored.committed_inserts(spark, path))
    own: str | None = None
    held = stored.stored_table(spark, path, schema)
    while True:
        writer = f"{stored.INSERT}{uuid.uuid4().hex}"
        rows = incoming if own is None else stored.written_by(spark, path, [own], schema)
        stored.write_batch(absent_rows(rows, held, key, first_by), path, writer, 0, by)
        if own is not None:
            stored.forget(spark, path, own)
        own = writer
        if not stored.leaves(spark, path, own):
            return  # no row is absent
        if log.commit(replace(state, number=state.number + 1, inserts=[*state.inserts, own])):
            return
        newest = log.newest()
        added = log.inserted_since(state, newest)
        state = newest
        held = stored.stored_table(spark, path, schema) if added is None else stored.written_by(spark, path, added, schema)
