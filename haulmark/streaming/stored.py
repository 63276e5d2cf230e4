"""Tables that micro-batches and inserts write, each into folders of its own.

Below its date folder, every row lies under the id of its writer and the batch:
``<path>/event_date=.../writer=.../batch_id=...``. A batch that runs again overwrites its own
folders and nothing else, there is no log of all files, and what one writer adds another
never hides. Streams are known to the table by their persistent id, so a stream that starts
anew (with a new checkpoint folder) is noticed.

Where rows are inserted or compacted, a ledger says what counts: the inserts that came
through, and the bases, folders with a negative batch that stand for all batches up to one. Everything
else under a writer's name is valid as it stands.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.streaming import ledger
from haulmark.streaming.files import Files

WRITER, BATCH = "writer", "batch_id"
_WRITERS = "_writers"
#: Writers of single inserts, and the writer of their rows once they are compacted.
INSERT, INSERTED = "insert-", "inserts"
#: Columns a table may be divided by, at most.
_DEPTH = 2

#: What a stream does about rows that streams of another id have left in its table.
REFUSE, KEEP, REPLACE = "refuse", "keep", "replace"


class OtherWriter(RuntimeError):
    """A table holds rows of another stream, and nobody said what to do about them."""


def query_id(spark: SparkSession) -> str:
    """Within ``foreachBatch``: the id that the checkpoint folder gives the stream."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def claim(spark: SparkSession, path: str, writer: str, others: str) -> None:
    """Make the writer known to the table; once known, it stays so."""
    files = Files(spark, path)
    known = files.names(f"{path}/{_WRITERS}")
    if writer in known:
        return
    if known and others == REFUSE:
        raise OtherWriter(f"{path} holds rows of {', '.join(known)}; say whether to keep or replace them")
    if others == REPLACE:
        for other in known:
            for folder in (*files.found(f"{path}/{WRITER}={other}"), *files.found(f"{path}/*=*/{WRITER}={other}")):
                files.delete(folder)
            files.delete(f"{path}/{_WRITERS}/{other}")
    files.make(f"{path}/{_WRITERS}/{writer}")


def write_batch(rows: DataFrame, path: str, writer: str | Column, batch: int, by: Sequence[str]) -> None:
    """Put rows into the folders of a batch, in place of what these held.

    Rows are brought together by ``by``, so there are few files per folder, and a heavy date is
    split. Spark writes to a place of the job's own and moves folders at its end, so jobs of several
    writers don't meet (appends of two jobs to one path would), and rows may come from the table itself.
    """
    writer = F.lit(writer) if isinstance(writer, str) else writer
    marked = rows.withColumns({WRITER: writer, BATCH: F.lit(batch)})
    if by:
        marked = marked.hint("rebalance", *(F.col(c) for c in by))
    out = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy(*by, WRITER, BATCH).parquet(path)


def is_plain(spark: SparkSession, path: str) -> bool:
    """Whether a table has its files side by side instead."""
    return any(name.endswith(".parquet") for name in Files(spark, path).names(path))


@dataclass(frozen=True)
class Leaf:
    """The folder of a batch: ``<by>/writer=.../batch_id=...``."""

    path: str
    by: tuple[str, ...]  # such as event_date=2024-01-01
    writer: str
    batch: int

    @property
    def unit(self) -> str:
        return "/".join((*self.by, f"{WRITER}={self.writer}"))

    def counts(self, state: ledger.State) -> bool:
        if self.writer.startswith(INSERT):
            merged = state.bases.get("/".join((*self.by, f"{WRITER}={INSERTED}")))
            return self.writer in state.inserts and not (merged and self.writer in merged["of"])
        base = state.bases.get(self.unit)
        return self.batch >= 0 if base is None else self.batch == base["base"] or self.batch > base["upto"]


def leaves(spark: SparkSession, path: str, writer: str = "*") -> list[Leaf]:
    """All batch folders of a table, or of one writer, whether they count or not."""
    files, out = Files(spark, path), []
    for depth in range(_DEPTH + 1):
        for found in files.found(f"{path}{'/*=*' * depth}/{WRITER}={writer}/{BATCH}=*"):
            *by, whose, batch = found.split("/")[-depth - 2 :]
            out.append(Leaf(found, tuple(by), whose.split("=", 1)[1], int(batch.split("=", 1)[1])))
    return out


def committed_inserts(spark: SparkSession, path: str) -> list[str]:
    """The inserts of a table without a ledger."""
    return sorted({leaf.writer for leaf in leaves(spark, path, f"{INSERT}*")})


def _valid_folders(spark: SparkSession, path: str, state: ledger.State) -> list[str]:
    """Folders that hold all rows that count, as few as will do."""
    folders: dict[tuple[str, ...], list[Leaf]] = {}
    for leaf in leaves(spark, path):
        folders.setdefault(leaf.by, []).append(leaf)
    out = []
    for by, held in folders.items():
        valid = [leaf.path for leaf in held if leaf.counts(state)]
        out += [held[0].path.rsplit("/", 2)[0]] if by and len(valid) == len(held) else valid
    return out


def written_by(spark: SparkSession, path: str, writers: Sequence[str], schema: T.StructType) -> DataFrame:
    """The rows of some writers, whether they count or not."""
    folders = [leaf.path for writer in writers for leaf in leaves(spark, path, writer)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.names)


def forget(spark: SparkSession, path: str, writer: str) -> None:
    """Delete the folders of a writer whose rows never counted."""
    files = Files(spark, path)
    for leaf in leaves(spark, path, writer):
        files.delete(leaf.path.rsplit("/", 1)[0])


def stored_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a table; empty where nothing has been written yet.

    What is read is settled when this is called: later batches, inserts and compactions change
    nothing in the frame.
    """
    names = Files(spark, path).names(path)
    nothing = not any(name.endswith(".parquet") or "=" in name for name in names)
    state = ledger.Ledger(spark, path).newest() if ledger.FOLDER in names else None
    reader = spark.read.schema(schema)
    if state is None:
        return spark.createDataFrame([], schema) if nothing else reader.parquet(path).select(*schema.names)
    folders = _valid_folders(spark, path, state)
    if not folders:
        return spark.createDataFrame([], schema)
    return reader.option("basePath", path).parquet(*folders).select(*schema.names)


# --- counts, folded ---------------------------------------------------------

#: So many closed folders become one.
MERGED = 16
#: Rows per file of folded counts, about.
FILE_ROWS = 1_000_000


def _files_for(rows: int) -> int:
    return 1 + rows // FILE_ROWS


def _spans(names: Sequence[str]) -> dict[str, tuple[int, int]]:
    """The batches that each closed folder stands for, its first and last."""
    spans = {}
    for name in names:
        if name.startswith(f"{BATCH}="):
            spans[name] = (int(name.split("=")[1]),) * 2
        elif name.startswith("batches-"):
            spans[name] = tuple(map(int, name.split("-")[1:]))
    return spans


def _standing(names: Sequence[str]) -> list[str]:
    """Without the folders that a wider one stands for."""
    out, spans, last = [], _spans(names), -1
    for name, (first, end) in sorted(spans.items(), key=lambda item: (item[1][0], -item[1][1])):
        if end > last:
            out.append(name)
            last = end
    return out


def _merge_closed(spark: SparkSession, files: Files, root: str, batch: int, schema: T.StructType) -> None:
    """Merge the closed folders before ``batch`` where it ends a span of ``MERGED``, ``MERGED`` squared and so on.

    These batches are done and never run again. The merged folder gets its name when it is whole;
    what it stands for stays until the next merge, for readers that have begun.
    """
    width = MERGED
    while batch and batch % width == 0:
        names = files.names(f"{root}/closed")
        spans = _spans(names)
        first, last = batch - width, batch - 1
        inside = [n for n in _standing(names) if first <= spans[n][0] and spans[n][1] <= last]
        name = f"batches-{first}-{last}"
        if inside and name not in names:
            draft = f"{root}/_draft-{name}"
            rows = spark.read.schema(schema).parquet(*(f"{root}/closed/{n}" for n in inside))
            rows.coalesce(_files_for(rows.count())).write.mode("overwrite").parquet(draft)
            files.rename(draft, f"{root}/closed/{name}")
        if width == MERGED:
            kept = set(_standing(names))
            for old in (n for n in names if n not in kept):
                files.delete(f"{root}/closed/{old}")
        width *= MERGED


def fold_changes(changes: DataFrame, path: str, writer: str, batch: int, key: Sequence[str], window_start: str, window_end: str, late_by: str) -> None:
    """Merge a batch's changes into ``open``, and move windows that ended into ``closed``.

    ``open`` of the last batch holds one row per key of the windows that may still change,
    ``closed`` one per key of the others: a window is closed when it ended ``late_by`` before
    the newest window of the last batch began. Rows for it are too late from the next batch on, as
    these are held against the watermark of the batch before theirs. Each
    batch reads what the one before left open and writes folders of its own, so running it
    again gives the same. Closed folders of past batches are merged, ``MERGED`` into one and so
    on, so their number grows with the logarithm of the batches.

    The state of the stream is updated in its own partitions, before rows are brought together in
    few files: one task that did both would hold the memory of all partitions at once.
    """
    spark = changes.sparkSession
    root = f"{path}/{WRITER}={writer}"
    files = Files(spark, path)
    left = [int(n.split("=")[1]) for n in files.names(f"{root}/open") if n.startswith(f"{BATCH}=")]
    before = max((n for n in left if n < batch), default=None)
    changes = changes.persist()
    try:
        merged, newest, count = changes, None, changes.count()
        if before is not None:
            held = spark.read.schema(changes.schema).parquet(f"{root}/open/{BATCH}={before}")
            merged = held.join(changes.select(*key), [held[k].eqNullSafe(changes[k]) for k in key], "left_anti").unionByName(changes)
            newest, more = held.agg(F.max(window_start), F.count(F.lit(1))).first()
            count += more
        ended = F.lit(False) if newest is None else F.col(window_end) <= F.lit(newest) - F.expr(f"INTERVAL {late_by}")
        for rows, name in ((merged.where(ended), "closed"), (merged.where(~ended), "open")):
            rows.repartition(_files_for(count), *key).write.mode("overwrite").parquet(f"{root}/{name}/{BATCH}={batch}")
    finally:
        changes.unpersist()
    _merge_closed(spark, files, root, batch, changes.schema)
    for old in left:
        # The one before stays, in case this batch runs again.
        if before is not None and old < before:
            files.delete(f"{root}/open/{BATCH}={old}")


def current_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per key of what ``fold_changes`` has written, whatever the number of batches."""
    files = Files(spark, path)
    rows = spark.createDataFrame([], schema)
    for writer in (n for n in files.names(path) if n.startswith(f"{WRITER}=")):
        root = f"{path}/{writer}"
        left = [int(n.split("=")[1]) for n in files.names(f"{root}/open") if n.startswith(f"{BATCH}=")]
        if left:
            names = files.names(f"{root}/closed")
            # A batch that failed after its first write may have left closed rows that are open still.
            closed = [n for n in _standing(names) if _spans([n])[n][1] <= max(left)]
            folders = [f"{root}/open/{BATCH}={max(left)}", *(f"{root}/closed/{n}" for n in closed)]
            rows = rows.unionByName(spark.read.schema(schema).parquet(*folders))
    return rows
