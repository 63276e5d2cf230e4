"""Personal data by bootstrapped contextual extraction.

Seeds are the identifiers that fixed expressions find. The words before them are lexical
patterns. Patterns and the identifiers that follow them form a graph: an identifier is as
sure as the patterns that lead to it, a pattern as sure as the identifiers it leads to.
Some rounds of joins and aggregates score both; patterns that reach a high score mark
further identifiers that no expression describes.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.scratch import Scratch

KINDS = ("email", "ip", "card", "phone")

# Fixed expressions. Each matches what its plain form does: a match can only begin where a run
# of its first characters does (or the match before ended), and possessive loops neither
# go back nor nest, so time is linear and the stack flat on texts of any length.
_NAME, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EXPRESSIONS = {
    "email": rf"(?:\G|(?<!{_NAME})){_NAME}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What each expression cannot do without; texts that lack it are not searched.
NEEDED = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_SIGN = "[A-Za-z0-9._%+@-]"
#: A run without blanks that may be an identifier: at least one digit among letters and joining signs.
PART = rf"(?<!{_SIGN}){_SIGN}*[0-9][A-Za-z0-9]*"
#: A whole one: letters with @, or such a run, perhaps in brackets, and the groups of digits joined to it.
CANDIDATE = (
    rf"(?<!{_SIGN})(?:{_NAME}++@[A-Za-z0-9]++(?:[.-][A-Za-z0-9]++)*+"
    rf"|(?:\((?=[0-9]++\)))?{_SIGN}*[0-9][A-Za-z0-9]*+(?:(?:[\x20-]|\x20?\(|\)[\x20-]?)[0-9]++(?!\.?[A-Za-z0-9_%+@]))*+)"
)
#: Digits of a candidate without @.
DIGITS = 4
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
LEFT = 48
#: Matches that the text before a candidate may reach back over.
BACK = LEFT // 2
#: Lengths that are summed up one by one.
SUMMED = 128


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _valid_span(kind: str, span: Column) -> Column:
    return _valid(kind, span["value"])


def _matches(text: Column, expression: str, needed: str | None, first: str = "[0-9]") -> tuple[Column, Column]:
    """All matches of an expression, and the pieces of text around them (one more)."""
    there = text.contains(needed) if needed else text.rlike(first)
    found = F.when(there, F.regexp_extract_all(text, F.lit(expression), F.lit(0)))
    return found, F.when(there, F.split(text, expression, -1))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda total, x: total + x)


def _enough(value: Column) -> Column:
    return (F.length(F.regexp_replace(value, "[^0-9]", "")) >= DIGITS) | value.contains("@")


def _with_spans(rows: DataFrame, name: str, number: int, back: int = 0) -> DataFrame:
    """Adds ``start, kind, end, value, pattern`` of each match of a kind; places follow from the lengths.

    A pattern may begin before up to ``back`` earlier matches, else only after the last one.

    Lengths are summed by blocks first, so a text with very many matches costs little more
    than their number. Each step is a projection of its own, so that none is computed again
    for every match.
    """
    found, gaps = F.col(f"{name}_m"), F.col(f"{name}_g")
    both = F.arrays_zip(found.alias("m"), F.slice(gaps, F.lit(1), F.size(found)).alias("g"))
    rows = rows.withColumn(f"{name}_z", F.when(F.size(found) > 0, both))
    rows = rows.withColumn(f"{name}_l", F.transform(f"{name}_z", lambda x: (F.length(x["g"]) + F.length(x["m"])).cast("bigint")))
    lengths = F.col(f"{name}_l")
    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / SUMMED).cast("int"))
    rows = rows.withColumn(f"{name}_s", F.when(lengths.isNotNull(), F.transform(blocks, lambda b: _sum(F.slice(lengths, b * SUMMED + 1, F.lit(SUMMED))))))
    sums = F.col(f"{name}_s")
    rows = rows.withColumn(f"{name}_p", F.transform(sums, lambda _, b: _sum(F.slice(sums, F.lit(1), b))))

    def before_it(x: Column, at: Column) -> Column:
        earlier = F.slice(f"{name}_z", F.greatest(at - back, F.lit(0)) + 1, F.least(at, F.lit(back)))
        ends = F.transform(earlier, lambda y: F.concat(F.substring(y["g"], -LEFT, LEFT), F.substring(y["m"], -LEFT, LEFT)))
        return F.when(x["g"].rlike(r"\p{L}") | (at == 0), x["g"]).otherwise(F.concat(F.array_join(ends, ""), x["g"]))

    def span(x: Column, at: Column) -> Column:
        block = F.floor(at / SUMMED).cast("int")
        before = F.get(f"{name}_p", block) + _sum(F.slice(lengths, block * SUMMED + 1, at - block * SUMMED))
        start = before + F.length(x["g"])
        return F.struct(
            start.alias("start"),
            F.lit(number).alias("kind"),
            (start + F.length(x["m"])).alias("end"),
            x["m"].alias("value"),
            (F.when(_enough(x["m"]), pattern_before(before_it(x, at))).otherwise("") if back else pattern_before(x["g"])).alias("pattern"),
        )

    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:string,pattern:string>>")
    return rows.withColumn(name, F.coalesce(F.transform(f"{name}_z", span), empty))


def pattern_before(gap: Column) -> Column:
    """The last word before an identifier in lower case, with the signs between them."""
    tail = F.lower(F.substring(gap, -LEFT, LEFT))
    return F.regexp_replace(F.regexp_extract(tail, r"([\p{L}]+[^\p{L}]*)$", 1), r"[\s0-9]+", " ")


def find_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``row, id, base, rest`` of every row: seed spans, and candidates that no seed overlaps.

    Of a whole candidate that a seed overlaps, the runs without blanks that none overlaps are left.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("id"), body.alias("t"))
    columns = []
    for kind in (*KINDS, "rest"):
        found, gaps = _matches(F.col("t"), EXPRESSIONS.get(kind, CANDIDATE), NEEDED.get(kind), "[0-9@]" if kind == "rest" else "[0-9]")
        columns += [found.alias(f"{kind}_m"), gaps.alias(f"{kind}_g")]
    rows = rows.select("id", "t", *columns)
    for number, kind in enumerate((*KINDS, "rest")):
        rows = _with_spans(rows, kind, number, 0 if kind in KINDS else BACK)
    base = [F.filter(kind, partial(_valid_span, kind)) for kind in KINDS]
    rows = rows.select("id", "t", F.array_sort(F.concat(*base)).alias("base"), F.filter("rest", lambda s: _enough(s["value"])).alias("rest"))
    meets = lambda c, others: F.exists(others, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    rows = rows.select("id", "t", "base", F.filter("rest", lambda c: ~meets(c, "base")).alias("free"), F.filter("rest", lambda c: meets(c, "base")).alias("lost"))
    found, gaps = (F.when(F.size("lost") > 0, x) for x in _matches(F.col("t"), PART, None))
    rows = _with_spans(rows.select("id", "base", "free", "lost", found.alias("part_m"), gaps.alias("part_g")), "part", len(KINDS), BACK)
    left = F.filter("part", lambda c: _enough(c["value"]) & meets(c, "lost") & ~meets(c, "base"))
    rows = rows.select("id", "base", F.concat("free", left).alias("rest"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", "base", "rest")


def score_patterns(found: DataFrame, scratch: Scratch, rounds: int = 3, support: int = 3, smooth: float = 0.5) -> DataFrame:
    """``pattern, kind, score`` after some rounds over the graph of patterns and identifiers.

    An identifier's score for a kind is 1 if it is a seed of it, else the largest score of
    its patterns. A pattern's score is the mean of its identifiers' scores, where ``smooth``
    unsure ones are added; it needs ``support`` different seeds. Equal identifiers count once
    per pattern, so copies of documents don't make a pattern sure.
    """
    seeds = found.select(F.explode("base").alias("s")).select("s.pattern", "s.value", "s.kind")
    others = found.select(F.explode("rest").alias("s")).select("s.pattern", "s.value", F.lit(None).cast("int").alias("kind"))
    edges = seeds.unionAll(others).where("pattern <> ''").groupBy("pattern", "value").agg(F.max("kind").alias("seed"))
    edges = scratch.store(edges, "edges")
    all_of = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    own = edges.where("seed IS NOT NULL").groupBy("pattern", F.col("seed").alias("kind")).agg(F.count("*").alias("seeds"))
    led = scratch.store(own.where(F.col("seeds") >= support).join(all_of, "pattern"), "patterns")
    scores = led.select("pattern", "kind", (F.col("seeds") / (F.col("n") + smooth)).alias("score"))
    unsure = edges.where("seed IS NULL").select("pattern", "value").join(led.select("pattern").distinct(), "pattern", "left_semi")
    unsure = scratch.store(unsure, "unsure")
    for _ in range(rounds - 1):
        scores = scratch.store(scores, "scores")
        instances = unsure.join(scores, "pattern").groupBy("value", "kind").agg(F.max("score").alias("score"))
        gained = unsure.join(instances, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("gained"))
        scores = led.join(gained, ["pattern", "kind"], "left").select("pattern", "kind", ((F.col("seeds") + F.coalesce("gained", F.lit(0.0))) / (F.col("n") + smooth)).alias("score"))
    return scratch.store(scores, "scores")


def extract(docs: DataFrame, sure: float = 0.8, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, base, spans`` of every row of ``docs``, from its whole text.

    Both are arrays of ``start, kind, end`` in code points, end exclusive, by start and kind;
    ``kind`` is a place in ``KINDS``. ``base`` holds the seeds; ``spans`` also what patterns
    with a score of at least ``sure`` led to, of their best kind. A null text counts as
    empty. Ids may be null or repeat; further columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    found = scratch.store(find_spans(docs, text, doc_id), "found")
    best = score_patterns(found, scratch).where(F.col("score") >= sure).groupBy("pattern").agg(F.max_by("kind", "score").alias("kind"))
    new = found.where(F.size("rest") > 0).select("row", F.explode("rest").alias("s")).select("row", "s.pattern", "s.start", "s.end").join(best, "pattern")
    new = new.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("new"))
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    rows = found.select("row", "id", plain.alias("base")).join(new, "row", "left")
    every = F.when(F.col("new").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "new")))
    return rows.select(F.col("id").alias(doc_id), "base", every.alias("spans"))


def as_text(spans: str) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
