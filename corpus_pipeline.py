"""Raw documents to token ids: the stages of a training-data pipeline.

Each stage takes what the one before kept and returns the columns of ``documents``; the last
returns the encoded texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.llm import bpe, decontaminate, jaccard, lines, toxicity
from haulmark.llm.queries import VOCABULARY, table
from haulmark.llm.scratch import Scratch
from haulmark.llm.ship import bound_batches

#: A column of a stage's own, the name of a row.
KEY = "__key"
WORDS = r"[^\x20\x09-\x0D]"


def row_name(*columns: Column) -> Column:
    """A number for a row; unlike rows may share it."""
    return F.xxhash64(*columns)


def named(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` with ``KEY``, equal for rows of one id and text and for no others.

    Rows are told apart by two numbers. The first is their name where the second agrees for all
    that have it; the few others, usually none, are named by the second.
    """
    first, second = row_name("doc_id", "text"), F.xxhash64(F.lit("second"), "text", "doc_id")
    both = docs.select(first.alias(KEY), second.alias("second"))
    unlike = both.groupBy(KEY).agg(F.min("second").alias("low"), F.max("second").alias("high")).where("low < high")
    unlike = scratch.store(unlike.select(F.col(KEY).alias("shared")), "unlike")
    rows = docs.withColumns({KEY: first, "__second": second}).join(unlike, F.col(KEY) == F.col("shared"), "left")
    return rows.withColumn(KEY, F.when(F.col("shared").isNull(), F.col(KEY)).otherwise(F.col("__second"))).select(*docs.columns, KEY)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below 0.5; the field learns from the labels of rows not held out."""
    field = toxicity.learn_from_folds(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(docs, field) < 0.5)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without cross-site lines; rows of which these were all are dropped."""
    cleaned = lines.remove_boilerplate(docs).where((F.col("n_removed") == 0) | F.col("text").rlike(WORDS))
    columns = [F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return cleaned.select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class: that with the smallest id, one without id only if all are.

    Texts without words stay. Rows are known by their id and text, so ids may be null or repeat; of rows
    that repeat both, that with the least other columns counts.
    """
    scratch = Scratch(spark, "near")
    has_words = F.coalesce("text", F.lit("")).rlike(WORDS)
    keyed = named(docs.where(has_words), scratch)
    found = jaccard.near_duplicates(keyed.select(F.col(KEY).alias("doc_id"), "text"))
    found = found.select(F.col("doc_id").alias(KEY), F.col("component_id").alias("class")).distinct()
    # Like the texts, these grow with the corpus: the same plan at every size.
    ids = keyed.select(KEY, F.struct(F.col("doc_id").isNull(), "doc_id", KEY).alias("place")).distinct()
    ids = ids.join(found.hint("merge"), KEY)
    first = ids.groupBy("class").agg(F.min("place").alias("first"))
    others = ids.join(first.hint("merge"), "class").where("place <> first").select(KEY)
    # Repeated rows meet in each task before they are shuffled.
    rest = keyed.groupBy(KEY).agg(F.min(F.struct(*[c for c in docs.columns if c != "text"], "text")).alias("row"))
    rest = rest.join(others.hint("merge"), KEY, "left_anti").select(*(F.col("row")[c].alias(c) for c in docs.columns))
    return rest.unionByName(docs.where(~has_words))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain no benchmark item, which depends on the text only; each is judged where it lies."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every row."""
    bound_batches(spark)
    return bpe.encode_corpus(docs, public_tokenizers.path(VOCABULARY), with_text=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: Classifiers, components, latent spaces and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        kept = scratch.store(stage(spark, docs, sf_dir), name)
        if before is not None:
            scratch.drop(before)
        before = docs = kept
    return docs
