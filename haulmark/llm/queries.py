"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.llm import bottomk, bpe, decontaminate, divergence, exact, jaccard, language, lines, periodic, pii, substrings, token_counts, toxicity
from haulmark.llm.folds import held_out
from haulmark.llm.ship import bound_batches, ship

VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_held_out(table(spark, sf_dir, "documents"))


def op2_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.extract(table(spark, sf_dir, "documents"))
    counts = [pii.count_kind("base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.as_text("base"), 256).alias("base_sha256"), pii.as_text("spans").alias("spans"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_corpus(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), with_text=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.remove_boilerplate(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(text, 256).alias("kept_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = toxicity.learn_from_folds(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, field)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", predicted, F.array_join("spans", ",").alias("spans"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.near_duplicates(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(table(spark, sf_dir, "documents"), rewrite=periodic.planted)
    found = found.withColumn("best", periodic.strongest("runs"))
    best = [F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")]
    milli = F.expr("1000 * best.length div best.period").alias("exponent_milli")
    digests = [F.sha2(periodic.as_lines("runs"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")]
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *best, milli, *digests)


QUERIES = {
    "op1_language": op1_language,
    "op2_exact_duplicates": op2_exact_duplicates,
    "op3_token_counts": op3_token_counts,
    "op4_personal_data": op4_personal_data,
    "op5_bpe": op5_bpe,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_source_divergence": op11_source_divergence,
    "op12_bottom_k": op12_bottom_k,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op2_exact_duplicates": r"""
        WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        ), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
    """,
    "op6_line_dedup": f"""
        WITH parts AS (
            SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw,
                   unnest(range(len(string_split(text, chr(10))))) AS pos
            FROM documents
        ), l AS (SELECT *, trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line FROM parts),
        known AS (
            SELECT line, min(doc_id) AS keep_id FROM l WHERE line <> ''
            GROUP BY line HAVING count(DISTINCT source) >= {lines.LEAST_SITES}
        ), marked AS (
            SELECT l.*, known.line IS NOT NULL AND l.doc_id <> keep_id AS gone FROM l LEFT JOIN known USING (line)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
               sha256(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op11_source_divergence": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
            FROM documents
        ), t AS (
            SELECT row, lang, source, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
            FROM (SELECT row, lang, source, unnest(words) AS word FROM d)
        ), c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
        kept AS (
            SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term
            HAVING count(DISTINCT row) >= {divergence.LEAST}
        ),
        groups AS (SELECT DISTINCT lang, source FROM d),
        langs AS (SELECT lang, count(*) AS v, sum(total) AS whole FROM kept GROUP BY lang),
        dense AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.total
            FROM groups g JOIN kept k ON k.lang = g.lang
            LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        ), sums AS (SELECT lang, source, sum(n) AS held FROM dense GROUP BY lang, source),
        shares AS (
            SELECT s.lang, s.source, term, n, 1 + 1000000000::HUGEINT * (n + 2) // (held + 2 * v) AS p,
                   1 + 1000000000::HUGEINT * (total + 2) // (whole + 2 * v) AS q
            FROM dense s JOIN sums ON sums.lang = s.lang AND sums.source = s.source JOIN langs ON langs.lang = s.lang
        ), apart AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY a.lang, a.source, b.source
        ), found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
        )
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
        FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP}
    """,
}
