"""Exact duplicates by deterministic block naming.

Each normalised text is cut into blocks of fixed size. The distinct blocks are sorted and
get integer names; then adjacent names are paired, the distinct pairs sorted and named
again, until one name is left per document. Equal names at a level mean equal texts: no
name rests on a fingerprint alone.

The sort key of a block is 128 bits of hash. One aggregate over the blocks themselves shows
that no two different blocks share a key (else the keys are drawn again with another seed),
so every later sort and join moves keys and integers, and the texts are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.scratch import Scratch

BLOCK = 4096
NO_RIGHT = -1


def normalised(text: str | Column) -> Column:
    """White space runs as one blank; null as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _keys(block: Column, seed: int, bits: int) -> list[Column]:
    keys = [F.xxhash64(block, F.lit(2 * seed + k)) for k in (0, 1)]
    return [F.shiftrightunsigned(key, 64 - bits).alias(f"k{k}") if bits < 64 else key.alias(f"k{k}") for k, key in enumerate(keys)]


def _in_order(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Rows sorted by their keys over all partitions, with ascending integers as names."""
    ordered = distinct.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return ordered.select(*keys, F.monotonically_increasing_id().alias("name"))


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", block: int = BLOCK, key_bits: int = 64) -> DataFrame:
    """Of every row: ``doc_id, keep_id, group_size, kept, text_sha256, level, name``.

    Texts are equal if they are after white space runs became one blank; null counts as
    empty. ``keep_id`` is the smallest id of the group, ``kept`` is true for one row that
    has it. Rows that repeat an id and a text are rows of one group; a null id is kept only
    in a group without any other id. ``(level, name)`` is the identity of the text within
    this result. Ids are integers. Further columns are ignored. ``key_bits`` is smaller in tests only.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    clean = docs.select(F.col(doc_id).alias("id"), normalised(text).alias("t"))
    pieces = F.regexp_extract_all("t", F.lit(rf"(?s).{{1,{block}}}"), F.lit(0))
    pieces = F.when(F.length("t") == 0, F.array(F.lit(""))).otherwise(pieces)
    blocks = clean.select(F.explode(pieces).alias("block"))
    seed = 0
    while True:
        contents = blocks.groupBy("block").agg(F.count("*").alias("n")).select(*_keys(F.col("block"), seed, key_bits))
        keys = scratch.store(contents.groupBy("k0", "k1").agg(F.count("*").alias("contents")), "keys")
        if keys.where("contents > 1").isEmpty():
            break
        scratch.drop(keys)
        seed, key_bits = seed + 1, 64
    names = scratch.store(_in_order(keys, ["k0", "k1"]), "names")
    rows = clean.select("id", F.sha2("t", 256).alias("sha"), pieces.alias("blocks")).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("id"),
        F.unhex("sha").alias("sha"),
        F.transform("blocks", lambda b: F.struct(*_keys(b, seed, key_bits))).alias("keys"),
        F.size("blocks").alias("n"),
    )
    rows = scratch.store(rows, "rows")
    places = rows.select("row", "n", F.posexplode("keys").alias("at", "key")).select("row", "n", "at", "key.k0", "key.k1")
    level = scratch.store(places.join(names, ["k0", "k1"]).select("row", "n", "at", "name"), "level")
    longest = rows.agg(F.max("n")).first()[0] or 1
    done, depth = [level.where("n <= 1").select("row", F.lit(0).alias("level"), "name")], 0
    while 1 << depth < longest:
        depth += 1
        open_rows = level.where(F.col("n") > 1 << (depth - 1))
        halves = open_rows.groupBy("row", "n", F.shiftright("at", 1).alias("half"))
        odd = F.col("at") % 2 == 1
        pairs = halves.agg(F.max(F.when(~odd, F.col("name"))).alias("left"), F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(NO_RIGHT)).alias("right"))
        pairs = scratch.store(pairs, "pairs")
        names = scratch.store(_in_order(pairs.select("left", "right").distinct(), ["left", "right"]), "names")
        level = scratch.store(pairs.join(names, ["left", "right"]).select("row", "n", F.col("half").alias("at"), "name"), "level")
        done.append(level.where(F.col("n") <= 1 << depth).select("row", F.lit(depth).alias("level"), "name"))
    found = done[0]
    for more in done[1:]:
        found = found.unionAll(more)
    whole = scratch.store(rows.select("row", "id", "sha").join(found, "row"), "identities")
    # Of rows that repeat the smallest id any one may stay: min_by takes one of them.
    by_id = F.coalesce(F.col("id").cast("long"), F.lit(2**63 - 1))
    groups = whole.groupBy("level", "name").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"), F.min_by("row", by_id).alias("keep_row"))
    return whole.join(groups, ["level", "name"]).select(
        F.col("id").alias(doc_id),
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "level",
        "name",
    )

