"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing column names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from haulmark.llm import bpe, decontaminate, exact, jaccard, language, lines, pii, queries, substrings, token_counts, toxicity

VOCABULARY = public_tokenizers.path(queries.VOCABULARY)
CLASHES = "id row name keys n of key found t pair rep body doc own kept parts prefix bunch terms hit a b text_sha256 score ids value u v".split()
LONG = " ".join(f"word{n % 977} x{n % 13}" for n in range(60_000))
ROWS = [
    (1, "Good morning to all of them, said the other", "en", "s1", 5),
    (1, "Good morning to all of them, said the other", "en", "s1", 5),
    (2, None, "en", None, None),
    (3, "", None, "s2", 0),
    (4, "  \n\t ", "fr", "s2", 4),
    (None, "Good  morning to all of them, said\nthe other", "en", "s1", 5),
    (None, None, None, None, None),
    (5, LONG, "de", "s3", 9),
    (6, LONG, "de", "s4", 9),
    (7, "123 456 %%% 1.2.3.4", None, "s5", 1),
    (-8, "Good morning to all of them, said the other day\x00\x1c", "en", "s1", 5),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    return frame.withColumns({c: F.lit("x") for c in CLASHES})


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "all of them said the other day and more words"), (2, None), (3, " ")], "item_id long, text string")


LABELS = [(1, 0, 1), (1, 0, 0), (None, 1, 1), (2, None, None), (5, 1, 0)]


def results(spark, docs, benchmark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    return {
        "language": language.identify_held_out(docs),
        "exact": exact.exact_duplicates(docs),
        "tokens": token_counts.token_counts(docs, VOCABULARY),
        "pii": pii.extract(docs),
        "bpe": bpe.encode_corpus(docs, VOCABULARY, 100, with_text=True),
        "lines": lines.remove_boilerplate(docs, 2),
        "classes": jaccard.near_duplicates(docs),
        "repeats": substrings.remove_repeats(docs),
        "toxicity": toxicity.score_toxicity(docs, toxicity.learn_from_folds(docs, labels)),
        "leaks": decontaminate.contaminated(docs, benchmark),
    }


def test_awkward_rows_have_the_results_the_docstrings_say(spark, docs, benchmark):
    found = {name: [r.asDict() for r in frame.collect()] for name, frame in results(spark, docs, benchmark).items()}
    assert all(len(rows) == len(ROWS) for name, rows in found.items() if name != "leaks")
    of = lambda name, k: [r for r in found[name] if r["doc_id"] == k]
    assert [r["lang_pred"] for k in (2, 3, 4, 7) for r in of("language", k)] == ["und"] * 4
    assert [(r["group_size"], r["keep_id"]) for r in of("exact", 1)] == [(3, 1)] * 2
    assert sum(r["kept"] for r in of("exact", 1)) == 1 and not any(r["kept"] for r in of("exact", None) if r["group_size"] == 3)
    assert {r["keep_id"] for k in (2, 3) for r in of("exact", k)} == {2} and of("exact", 4)[0]["group_size"] == 1
    assert [r["n_tokens"] for k in (2, 3, 4) for r in of("tokens", k)] == [0, 0, 0] and of("tokens", 5)[0]["over_limit"]
    assert of("bpe", 5)[0]["n_tokens"] == of("tokens", 5)[0]["n_tokens"] and of("bpe", 2)[0]["decoded"] == ""
    assert [len(r["base"]) for k in (1, 2, 7) for r in of("pii", k)] == [0, 0, 0, 1]
    assert of("lines", 2)[0]["text"] is None and of("lines", 2)[0]["n_lines"] == 0 and of("lines", 6)[0]["n_removed"] == 1
    assert set(docs.columns) <= set(found["lines"][0]) and of("lines", 1)[0]["row"] == "x"
    assert {r["component_id"] for k in (1, -8) for r in of("classes", k)} == {1, -8} or {r["component_id"] for r in of("classes", 1)} == {-8}
    assert [(r["n_shingles"], r["component_id"]) for k in (2, 3, 4, 6) for r in of("classes", k)][:3] == [(0, 2), (0, 3), (0, 4)]
    assert of("classes", 6)[0]["component_id"] == 5 and {r["component_id"] for r in of("classes", None)} <= {None, 1, -8}
    assert [r["n_removed"] for k in (2, 3, 5, 6, 1) for r in of("repeats", k)] == [0, 0, 0, 120_000, 0, 0]
    assert all(0 <= r["score"] <= 1 for r in found["toxicity"])
    assert {r["item_id"] for r in found["leaks"]} <= {1}


def test_rows_without_id_take_no_links_from_others(spark):
    """The row without id stands first, in the one task, and shares its group with a row with an id."""
    text = "Good morning to all of them, said the other"
    rows = [(None, text), (1, text), (-8, f"{text} day")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()}
    assert got == {(None, 5, -8), (1, 5, -8), (-8, 6, -8)}


def test_stages_drop_rows_without_id_and_repeated_rows(spark, tmp_path):
    item = " ".join(f"item{n}" for n in range(30))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    text, other, lone = (" ".join(f"{w}{n}" for n in range(40)) for w in "abc")
    rows = [(None, text), (5, text), (5, text), (3, f"{text} more"), (3, other), (None, lone), (None, lone), (None, ""), (7, " "), (7, " "), (8, None)]
    docs = spark.createDataFrame([(k, t, "s") for k, t in rows], "doc_id long, text string, source string")
    left = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in left) == sorted((str(k), str(t)) for k, t in [(3, f"{text} more"), (3, other), (None, lone), *rows[-4:]])
    rows = [(None, f"ahead {item} behind"), (None, other), (1, item), (2, text), (2, item), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in left) == sorted((str(k), str(t)) for k, t in [(None, other), (2, text), (4, None)])


def test_empty_tables(spark, docs, benchmark):
    none = docs.limit(0)
    assert all(frame.count() == 0 for frame in results(spark, none, benchmark).values())
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_awkward_rows(spark, docs, benchmark, tmp_path, empty):
    spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = docs.limit(0) if empty else docs
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, rows, str(tmp_path))
        if name != "bpe":
            assert got.columns == docs.columns
        assert got.count() <= rows.count()


def test_pipeline_equals_its_stages_by_plain_rules(spark, tmp_path, sf_dir):
    """Kept rows: not toxic, one of each class of cleaned texts, no benchmark item; ids as the library gives."""
    import brute
    import numpy as np
    from tokenizers import Tokenizer

    done = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.drop_boilerplate(spark, corpus_pipeline.drop_toxic(spark, docs, sf_dir), sf_dir)
    texts = {r.doc_id: r.text for r in kept.select("doc_id", "text").collect()}
    assert 0.5 * docs.count() < len(done) <= len(texts)
    classes = brute.classes(texts)
    leaks = {r.doc_id for r in decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert set(done) <= {k for k, (_, c) in classes.items() if c == k}
    assert {k for k, (_, c) in classes.items() if c == k} - set(done) <= leaks
    library = Tokenizer.from_file(VOCABULARY)
    for k, row in done.items():
        assert np.frombuffer(row.ids, "<u4").tolist() == library.encode(texts[k], add_special_tokens=False).ids
