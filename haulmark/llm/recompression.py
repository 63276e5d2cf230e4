"""Locally consistent parsing of word sequences by recompression.

Each round first names runs of equal symbols, then pairs: a hash of its name puts every
symbol on the left or the right side, and a left symbol followed by a right one becomes one
symbol. Names are mixes of the names below, so all tasks give equal strings equal names.

What happens to a symbol depends on a few neighbours only. ``low`` and ``high`` hold the
range of words that decided its existence; two equal stretches of words share every symbol
whose range lies within them, whatever stands around.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from haulmark.llm.words import mix, sequence_names

_RUN = np.uint64(0xD6E8FEB86659FD93)
_PAIR = np.uint64(0xA0761D6478BD642F)
_SIDE = np.uint64(0xE7037ED1A0B428DB)


@dataclass
class Level:
    """Symbols in order: name, first word and end, deciding range of words, and row."""

    name: np.ndarray
    first: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray
    row: np.ndarray


def words_level(name: np.ndarray, row: np.ndarray) -> Level:
    at = np.arange(len(name))
    return Level(name, at, at + 1, at, at + 1, row)


def _with_neighbours(x: Level, head: np.ndarray, tail: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Deciding ranges from head to tail, widened by the neighbours where these took part.

    The edge of a text counts as a neighbour that lies outside every window.
    """
    n = len(x.name)
    low, high = x.low[head], x.high[tail]
    other = np.maximum(head - 1, 0)
    inner = (head > 0) & (x.row[other] == x.row[head])
    low = np.where(before, np.minimum(low, np.where(inner, x.low[other], x.first[head] - 1)), low)
    other = np.minimum(tail + 1, n - 1)
    inner = (tail < n - 1) & (x.row[other] == x.row[tail])
    high = np.where(after, np.maximum(high, np.where(inner, x.high[other], x.end[tail] + 1)), high)
    return low, high


def _runs(x: Level) -> Level:
    n = len(x.name)
    same = np.zeros(n, bool)
    same[1:] = (x.name[1:] == x.name[:-1]) & (x.row[1:] == x.row[:-1])
    head = np.flatnonzero(~same)
    size = np.diff(np.append(head, n))
    tail = head + size - 1
    run = size > 1
    name = np.where(run, mix(x.name[head] * _RUN + size.astype(np.uint64)), x.name[head])
    # A run ends, and a single symbol is one, because the neighbours differ: they take part.
    everywhere = np.ones(len(head), bool)
    low, high = _with_neighbours(x, head, tail, everywhere, everywhere)
    return Level(name, x.first[head], x.end[tail], low, high, x.row[head])


def _pairs(x: Level, salt: int) -> Level:
    n = len(x.name)
    left = (mix(x.name * _SIDE + np.uint64(salt)) & np.uint64(1)) == 0
    joined = np.zeros(n, bool)  # with the next symbol
    near = x.row[1:] == x.row[:-1]
    joined[:-1] = left[:-1] & ~left[1:] & near
    taken = np.zeros(n, bool)
    taken[1:] = joined[:-1]
    head = np.flatnonzero(~taken)
    pair = joined[head]
    tail = head + pair
    name = np.where(pair, mix(x.name[head] * _PAIR + mix(x.name[tail])), x.name[head])
    # A single left symbol is one because of the next symbol, a single right one because of the last.
    low, high = _with_neighbours(x, head, tail, ~pair & ~left[head], ~pair & left[head])
    return Level(name, x.first[head], x.end[tail], low, high, x.row[head])


def parse(name: np.ndarray, row: np.ndarray, rounds: int) -> list[Level]:
    """The words and the symbols after each round."""
    levels = [words_level(name, row)]
    for salt in range(rounds):
        levels.append(_pairs(_runs(levels[-1]), salt))
    return levels


#: Stretches of symbols that get one more name, by level: about six words each.
STRETCHES = ((1, 4), (0, 6))


def anchors(levels: list[Level], begin: np.ndarray, size: int, stretches: tuple[tuple[int, int], ...] = STRETCHES) -> np.ndarray:
    """A name for each window of ``size`` words that begins at ``begin``.

    It is the least name of the stretches of consecutive symbols whose deciding ranges lie in
    the window, so equal windows have equal anchors. A window in which no stretch of a level
    is decided takes one of the next; stretches of words are always decided by themselves.
    """
    out = np.zeros(len(begin), np.uint64)
    open_ = np.arange(len(begin))
    most = np.uint64(2**64 - 1)
    for number, m in stretches:
        level = levels[number]
        n = len(level.name) - m + 1
        if n <= 0 or not len(open_):
            continue
        names = mix(sequence_names(level.name, m) + np.uint64(number)) >> np.uint64(1)
        whole = level.row[:n] == level.row[m - 1 :]
        high = level.high[m - 1 :]
        at = begin[open_]
        # low never falls along a level, so the first stretch with low >= at is found by search.
        first = np.searchsorted(level.low[:n], at)
        best = np.full(len(open_), most)
        for k in range(size):
            spot = np.minimum(first + k, n - 1)
            inside = (first + k < n) & (high[spot] <= at + size)
            if not inside.any():
                break
            inside &= whole[spot]
            best = np.where(inside, np.minimum(best, names[spot]), best)
        found = best != most
        out[open_[found]] = best[found]
        open_ = open_[~found]
    return out
