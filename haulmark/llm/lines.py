"""Cross-site boilerplate lines by distinct-site spread.

Per line hash, a HyperLogLog sketch of the sites is built in every task and merged by
aggregation. Lines whose estimate is clearly above the threshold are boilerplate, clearly
below not; those near it are counted exactly. Boilerplate lines leave all documents but
the one with the smallest id, so no content is lost altogether.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.scratch import Scratch

#: A handful of sites that have nothing to do with each other: what stands on so many is no
#: one's text. Fewer would take quotations between two or three sites for boilerplate.
LEAST_SITES = 5
#: Buckets of the lines that leave a text; each line is looked for in one of them.
BUCKETS = 256
#: log2 of a sketch's registers; its relative standard error is 1.04 / 2 ** (LG / 2).
LG = 12
BLANKS = " \t\r\x0b\x0c"


def _line(part: Column) -> Column:
    return F.btrim(part, F.lit(BLANKS))


def _key(part: Column) -> Column:
    """128 bits of a line's hash."""
    return F.struct(F.xxhash64(_line(part)).alias("a"), F.xxhash64(_line(part), F.lit(1)).alias("b"))


def _stays(hit: Column, line: Column) -> Column:
    """Whether no bucket of ``hit`` has the line."""
    key = _key(line)
    return ~F.coalesce(F.array_contains(F.try_element_at(hit, F.pmod(key["a"], F.lit(BUCKETS))), key), F.lit(False))


def boilerplate_lines(docs: DataFrame, least_sites: int = LEAST_SITES, text: str = "text", site: str = "source", doc_id: str = "doc_id", scratch: Scratch | None = None) -> DataFrame:
    """``a, b, keep_id, exact``: hashes of the lines on at least ``least_sites`` sites.

    Lines are compared without blanks around them; blank lines don't count. A null site is no
    site. ``exact`` tells whether the sites were counted or estimated beyond doubt.
    """
    scratch = scratch or Scratch(docs.sparkSession, "lines")
    parts = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("id"), F.col(site).cast("string").alias("site"), F.explode(F.split(F.col(text), "\n")).alias("line"))
    held = parts.where(_line(F.col("line")) != "").select("id", "site", _key(F.col("line")).alias("key")).select("id", "site", "key.a", "key.b")
    spread = held.groupBy("a", "b").agg(F.count("site").alias("n"), F.min("id").alias("keep_id"), F.hll_sketch_agg("site", F.lit(LG)).alias("sites"))
    # A line has at most as many sites as places, so rarer ones need no estimate.
    spread = spread.where(F.col("n") >= least_sites).select("a", "b", "keep_id", F.hll_sketch_estimate("sites").alias("sites"))
    spread = scratch.store(spread, "spread")
    band = max(2.0, 8 * 1.04 / 2 ** (LG / 2) * least_sites)
    clear = spread.where(F.col("sites") >= least_sites + band).select("a", "b", "keep_id", F.lit(False).alias("exact"))
    near = spread.where((F.col("sites") < least_sites + band) & (F.col("sites") >= least_sites - band))
    # Distinct (line, site) first: a line that holds many rows is one row per task and site.
    counted = held.where("site IS NOT NULL").join(near.select("a", "b"), ["a", "b"], "left_semi").groupBy("a", "b", "site").agg(F.count("*").alias("n"))
    counted = counted.groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= least_sites)
    exact = near.join(counted.select("a", "b"), ["a", "b"]).select("a", "b", "keep_id", F.lit(True).alias("exact"))
    return scratch.store(clear.unionAll(exact), "boilerplate")


def remove_boilerplate(docs: DataFrame, least_sites: int = LEAST_SITES, text: str = "text", site: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` with the text cleaned, and ``n_lines, n_removed`` (in place of
    such columns of ``docs``).

    A null text stays null with no lines; an empty one has one blank line. Rows that repeat
    an id are treated alike. Of rows without id none is a first holder unless all are.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    known = boilerplate_lines(docs, least_sites, text, site, doc_id, scratch)
    parts = F.split(F.col(text), "\n")
    places = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("id"), F.explode(parts).alias("line")).select("id", _key(F.col("line")).alias("key")).select("id", "key.a", "key.b")
    hits = places.join(known.select("a", "b", "keep_id"), ["a", "b"]).where(~F.col("id").eqNullSafe(F.col("keep_id")))
    bucket = F.pmod("a", F.lit(BUCKETS)).alias("bucket")
    hits = hits.groupBy("id", bucket).agg(F.collect_set(F.struct("a", "b")).alias("hit"))
    hits = hits.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "hit"))).alias("hit"))
    hits = scratch.store(hits.select(F.struct("id", "hit").alias("found")), "hits")
    # All columns as one, so that none can be taken for another.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(doc_id).alias("own"), F.col(text).alias("body"))
    # Hits grow with the texts: one plan for every size, where texts are shuffled by id once.
    joined = whole.join(hits.hint("merge"), F.col("own").eqNullSafe(F.col("found.id")), "left")
    parts = F.split("body", "\n")
    kept = F.when(F.col("found").isNull(), parts).otherwise(F.filter(parts, partial(_stays, F.col("found.hit"))))
    rest = joined.select("doc", "body", "found", parts.alias("parts"), kept.alias("kept"))
    n_lines = F.when(F.col("body").isNull(), F.lit(0)).otherwise(F.size("parts")).cast("long")
    n_kept = F.when(F.col("body").isNull(), F.lit(0)).otherwise(F.size("kept")).cast("long")
    clean = F.when(F.col("found").isNull(), F.col("body")).otherwise(F.array_join("kept", "\n"))
    counts = {"n_lines": n_lines, "n_removed": n_lines - n_kept}
    columns = [clean.alias(c) if c == text else F.col("doc").getField(c).alias(c) for c in docs.columns if c not in counts]
    return rest.select(*columns, *[value.alias(name) for name, value in counts.items()])
