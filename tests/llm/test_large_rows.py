"""Long texts, hot rows and forced clashes: each within seconds, with the results of the plain rules."""

import random
import time
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from haulmark.llm import bpe, decontaminate, lines, queries
from haulmark.llm.lexicon import Lexicon, build, save
from haulmark.llm.scratch import Scratch
from haulmark.llm.wordbpe import parsed, read_vocabulary

VOCABULARY = public_tokenizers.path(queries.VOCABULARY)


def test_a_word_of_a_megabyte_is_merged_in_seconds():
    draw = random.Random(1)
    vocabulary, library = parsed(read_vocabulary(VOCABULARY)), Tokenizer.from_file(VOCABULARY)
    for word in ("".join(draw.choice("abcdefghijklmnop") for _ in range(1_000_000)), "a" * 100_000):
        start = time.perf_counter()
        ids = bpe.piece_ids(word, vocabulary)
        assert time.perf_counter() - start < 40
        assert ids == library.encode(word, add_special_tokens=False).ids


def test_an_encoder_of_many_unseen_pieces_stays_small(tmp_path, monkeypatch):
    """What a worker remembers is bounded, and all ids are right before and after it starts anew."""
    path = str(tmp_path / "lexicon")
    save(build([b"known"], [[7]]), path)
    encoder = bpe.Encoder(parsed(read_vocabulary(VOCABULARY)), Lexicon(path))
    monkeypatch.setattr(bpe, "piece_ids", lambda piece, vocabulary: [int(piece), 1, 2, int(piece)])
    tracemalloc.start()
    try:
        for begin in range(0, 950_000, 25_000):
            names = range(begin, begin + 25_000)
            first, last = encoder.encode(["known " + " ".join(map(str, names)), f"{begin} known"])
            assert first[0] == 7 and np.array_equal(first[1:].reshape(-1, 4)[:, 0], names) and np.array_equal(first[1:].reshape(-1, 4)[:, 3], names)
            assert last.tolist() == [begin, 1, 2, begin, 7]
            first = last = None
            assert tracemalloc.get_traced_memory()[0] < 110 << 20
    finally:
        tracemalloc.stop()


def site_rows(sites, of, line="This page is under the licence of all"):
    return [(n, f"own {n}\n{line if n < sites else f'none {n}'}\nend {n}", f"s{n % of}") for n in range(of)]


@pytest.mark.parametrize("sites, of, leaves", [(4, 20, False), (5, 20, True), (11, 20, True), (4, 4, False), (5, 5, True)])
def test_a_line_leaves_from_five_sites_on(spark, sites, of, leaves):
    rows = lines.remove_boilerplate(spark.createDataFrame(site_rows(sites, of), "doc_id long, text string, source string")).collect()
    assert sorted(r.doc_id for r in rows if r.n_removed) == (list(range(1, sites)) if leaves else [])


def test_thousands_of_lines_leave_one_text(spark):
    """20,000 lines on six sites, all of them in two long texts."""
    many = [f"shared line {n}" for n in range(20_000)]
    parts = [(k, "\n".join(many[k::6]), f"s{k}") for k in range(6)]
    spread = [(10 + s, "\n".join(many), f"s{s}") for s in range(6)]
    docs = spark.createDataFrame([*parts, *spread, (99, "\n".join(["own", *many, "own too"]), "s9")], "doc_id long, text string, source string")
    start = time.perf_counter()
    got = {r.doc_id: r for r in lines.remove_boilerplate(docs).collect()}
    assert time.perf_counter() - start < 60
    assert got[99].text == "own\nown too" and got[99].n_removed == 20_000 and got[3].n_removed == 0 and got[10].n_lines == 20_000


def test_few_common_words_are_no_finding(spark):
    """A text with 4 of an item's 30 words, among fillers that a quarter of all texts hold."""
    fillers = [f"filler{n}" for n in range(12)]
    draw = random.Random(2)
    own = [f"own{n}" for n in range(18)]
    item = " ".join(w for pair in zip(own, [*fillers, *own[:6]]) for w in pair)[:]
    words = item.split()[:30]
    item = " ".join(words)
    noise = lambda n: [f"noise{draw.randrange(3000)}" for _ in range(n)]
    rows = {n: " ".join([*noise(20), *fillers]) for n in range(300)}
    rows[1000] = " ".join([words[0], *noise(6), words[2], *noise(6), words[4], *noise(6), words[6]])
    rows[1001] = " ".join([*noise(9), *words, *noise(9)])
    rows[1002] = " ".join([*noise(9), *(w if n % 8 else "other" for n, w in enumerate(words)), *noise(9)])
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert set(found) == {1001, 1002} and found[1001].lcs == 1.0 and 0.8 < found[1002].lcs < 1
    kept = decontaminate.without_items(docs.withColumn("id", F.lit("x")), benchmark)
    assert kept.columns == ["doc_id", "text", "id"] and {r.doc_id for r in kept.collect()} == set(rows) - {1001, 1002}


def test_the_decomposition_has_the_singular_values():
    draw = np.random.default_rng(3)
    a = draw.standard_normal((400, 6)) @ np.diag([9, 7, 5, 3, 2, 1]) @ draw.standard_normal((6, 120))
    start = draw.standard_normal((120, 16))
    vectors, values = decontaminate._decomposed(a.T @ (a @ start), start)
    expected = np.linalg.svd(a)
    assert np.allclose(values[:6], expected[1][:6], rtol=1e-4)
    assert np.allclose(np.abs(np.sum(vectors[:, :6].T * expected[2][:6], axis=1)), 1, atol=1e-4)


def test_rows_are_told_apart_when_names_clash(spark, tmp_path, monkeypatch):
    texts = [" ".join(f"{c}{n}" for n in range(30)) for c in "abcdefgh"]
    rows = [(n, t, "s") for n, t in enumerate(texts)] + [(n + 100, t + " more", "s") for n, t in enumerate(texts)] + [(3, texts[3], "r"), (None, "", "s"), (None, "lone words here", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    expected = sorted([(n, t, "s") for n, t in enumerate(texts) if n != 3] + [(3, texts[3], "r"), *rows[-2:]], key=str)
    for forced in (False, True):
        if forced:
            monkeypatch.setattr(corpus_pipeline, "row_name", lambda *columns: F.pmod(F.xxhash64(*columns), F.lit(3)))
        got = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
        assert sorted(map(tuple, got.collect()), key=str) == expected
        keys = corpus_pipeline.named(docs, Scratch(spark, "test")).groupBy(corpus_pipeline.KEY).count()
        assert sorted(r["count"] for r in keys.collect()) == [1] * (len(rows) - 2) + [2]


def test_a_third_of_the_rows_without_id_and_text(spark, tmp_path):
    text = " ".join(f"w{n}" for n in range(40))
    rows = [(None, None)] * 300 + [(7, text)] * 300 + [(n, f"{text} {n} " * 2) for n in range(1000, 1003)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)).groupBy("doc_id").count().collect()
    counts = {r.doc_id: r["count"] for r in got}
    assert counts[None] == 300 and counts[7] == 1
