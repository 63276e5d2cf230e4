"""How the search for benchmark items looks at stretches of text that may hold one."""

import random

import numpy as np
import pyarrow as pa

from haulmark.llm import decontaminate


def search(items, size):
    idf = np.ones(size + 1)
    idf[size] = 0
    terms = [np.array(t) for t in items]
    return decontaminate._Search(decontaminate.Items(list(range(len(items))), terms, [t[-3:] for t in terms], np.arange(size)), idf, np.eye(size + 1, 16, dtype=np.float32))


def column(rows):
    return pa.array([np.array(r, np.uint32).tobytes() for r in rows], pa.binary())


def test_items_are_looked_up_once_for_many_stretches(monkeypatch):
    """Rows of an item's terms in another order come close by their words, and are told apart together."""
    draw = random.Random(5)
    item = list(range(16)) * 2
    rows = [draw.sample(item, 32) for _ in range(300)]
    rows[17] = [90] * 7 + item + [90] * 9
    looked = []
    member = decontaminate._Search.member
    monkeypatch.setattr(decontaminate._Search, "member", lambda self, one: (looked.append(one), member(self, one))[1])
    found = list(search([item, list(range(40, 60))], 90).find(column(rows)))
    assert {(row, one) for row, one, *_ in found if _[1] == 1.0} == {(17, 0)}
    assert 0 < len(looked) <= 4


def test_stretches_in_pieces_are_the_same(monkeypatch):
    draw = random.Random(6)
    items = [[draw.randrange(80) for _ in range(draw.randrange(8, 60))] for _ in range(12)]
    rows = [[], [90] * 50]
    for _ in range(120):
        own = list(draw.choice(items))
        for _ in range(draw.randrange(6)):
            own[draw.randrange(len(own))] = draw.randrange(91)
        rows.append([draw.randrange(91) for _ in range(draw.randrange(150))] + own + [draw.randrange(91) for _ in range(draw.randrange(150))])
    one = search(items, 90)
    whole = sorted(one.find(column(rows)))
    monkeypatch.setattr(decontaminate, "_WORDS_AT_ONCE", 50)
    assert sorted(one.find(column(rows))) == whole
    # As by looking at each stretch of each item alone.
    monkeypatch.setattr(decontaminate._Search, "_likely", lambda self, words, begin, end, item: (k for k, (x, y, i) in enumerate(zip(begin, end, item)) if decontaminate.common_subsequence(self.terms[i], words[x:y]) >= self.least[i]))
    assert sorted(one.find(column(rows))) == whole and len({i for _, i, *_ in whole}) > 8


def test_terms_of_any_number_keep_their_order():
    draw = np.random.default_rng(8)
    for size in (1, 300, 1 << 16, (1 << 16) + 1, 200_000):
        terms = np.append(draw.integers(0, size, 5000), size - 1)
        assert np.array_equal(decontaminate._by_term(terms, size), np.argsort(terms, kind="stable"))
