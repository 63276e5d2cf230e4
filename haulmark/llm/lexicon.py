"""A minimal acyclic transducer over words, run on many words at once.

Words are added in sorted order and equal suffix automata are shared while building. Every
transition carries the number of words that come before those behind it, so the numbers
along a path add up to the word's place in the sorted list; that place points to its ids.
The tables are plain arrays in one file, which tasks map into memory.
"""

from __future__ import annotations

import os
from itertools import pairwise

import numpy as np


def build(words: list[bytes], ids: list[list[int]]) -> dict[str, np.ndarray]:
    """Tables of the automaton for distinct non-empty words, and of their ids."""
    order = sorted(range(len(words)), key=words.__getitem__)
    words, ids = [words[k] for k in order], [ids[k] for k in order]
    states, final, path = _minimal(words)
    letters = sorted({c for edges in states for c in edges})
    class_of = np.zeros(256, np.uint8)
    class_of[letters] = np.arange(1, len(letters) + 1)
    # State 0 takes every word that leaves the automaton; class 0 every unknown byte.
    go = np.zeros((len(states) + 1, len(letters) + 1), np.int32)
    skip = np.zeros_like(go)
    behind = [0] * len(states)
    for state in path:  # targets come before their sources
        count = int(final[state])
        for c in sorted(states[state]):
            target = states[state][c]
            go[state + 1, class_of[c]] = target + 1
            skip[state + 1, class_of[c]] = count
            count += behind[target]
        behind[state] = count
    return {
        "go": go,
        "skip": skip,
        "final": np.array([False, *final]),
        "class_of": class_of,
        "start": np.array([path[-1] + 1 if path else 0], np.int32),
        "longest": np.array([max(map(len, words), default=0)], np.int32),
        "first": np.cumsum([0, *map(len, ids)]).astype(np.int64),
        "ids": np.array([k for row in ids for k in row], np.uint32),
    }


def _minimal(words: list[bytes]) -> tuple[list[dict[int, int]], list[bool], list[int]]:
    """Edges and finality of each state, and the states with targets before sources."""
    known: dict[tuple, int] = {}
    states: list[dict[int, int]] = []
    final: list[bool] = []
    open_edges: list[dict[int, int]] = [{}]
    open_final = [False]

    def close() -> int:
        edges, ends = open_edges.pop(), open_final.pop()
        key = (ends, *edges.items())
        if key not in known:
            known[key] = len(states)
            states.append(edges)
            final.append(ends)
        return known[key]

    for before, word in pairwise([b"", *words]):
        shared = len(os.path.commonprefix([before, word]))
        for depth in range(len(before), shared, -1):
            target = close()
            open_edges[-1][before[depth - 1]] = target
        for _ in word[shared:]:
            open_edges.append({})
            open_final.append(False)
        open_final[-1] = True
    last = words[-1] if words else b""
    for depth in range(len(last), 0, -1):
        target = close()
        open_edges[-1][last[depth - 1]] = target
    close()
    return states, final, list(range(len(states)))


def save(tables: dict[str, np.ndarray], path: str) -> None:
    """All tables in one file: a line of names, kinds, shapes and places, then the arrays."""
    head, body, at = [], [], 0
    for name, table in tables.items():
        data = np.ascontiguousarray(table).tobytes()
        head.append(f"{name}:{table.dtype.str}:{','.join(map(str, table.shape))}:{at}")
        body.append(data + bytes(-len(data) % 16))
        at += len(body[-1])
    line = " ".join(head).encode()
    with open(path, "wb") as file:
        file.write(line + b" " * (-(len(line) + 1) % 16) + b"\n")
        file.writelines(body)


class Lexicon:
    def __init__(self, path: str):
        mapped = np.memmap(path, np.uint8, "r")
        with open(path, "rb") as file:
            line = file.readline()
        self.table = {}
        for entry in line.decode().split():
            name, kind, shape, at = entry.split(":")
            shape = tuple(int(n) for n in shape.split(","))
            size = int(np.prod(shape)) * np.dtype(kind).itemsize
            at = len(line) + int(at)
            self.table[name] = mapped[at : at + size].view(kind).reshape(shape)
        self.go, self.skip = self.table["go"].ravel(), self.table["skip"].ravel()
        self.width = self.table["go"].shape[1]

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places of the words ``data[start:end]`` in the sorted list, or -1."""
        size = end - start
        place = np.full(len(size), -1, np.int64)
        order = np.argsort(-size, kind="stable")
        order = order[np.searchsorted(-size[order], -int(self.table["longest"][0])) :]
        if not len(order):
            return place
        begin, length = start[order], size[order]
        state = np.full(len(order), self.table["start"][0], np.int64)
        number = np.zeros(len(order), np.int64)
        letters = self.table["class_of"][data]
        for k in range(int(length[0])):
            n = np.searchsorted(-length, -k, "left")  # words of more than k bytes come first
            edge = state[:n] * self.width + letters[begin[:n] + k]
            number[:n] += self.skip[edge]
            state[:n] = self.go[edge]
        place[order] = np.where(self.table["final"][state], number, -1)
        return place
