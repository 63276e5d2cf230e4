"""Plain versions of the operators, for small tables."""

import re
from collections import defaultdict

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, size=5):
    w = words((text or "").translate(A_TO_Z))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def classes(docs, percent=75):
    """Smallest id that links lead to, for ``{id: text}``."""
    sets = {k: shingles(t) for k, t in docs.items()}
    holders = defaultdict(set)
    for k, s in sets.items():
        for x in s:
            holders[x].add(k)
    root = {k: k for k in docs}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k in docs:
        for o in set().union(*(holders[x] for x in sets[k])) if sets[k] else ():
            both = len(sets[k] & sets[o])
            if o != k and 100 * both >= percent * (len(sets[k]) + len(sets[o]) - both):
                a, b = sorted((find(k), find(o)))
                root[b] = a
    return {k: (len(sets[k]), find(k)) for k in docs}


def without_repeats(docs, size=13):
    """Words, removed words and the rest of each text of ``{id: text}``."""
    first = {}
    for k in sorted(docs):
        w = words(docs[k])
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), k)
    out = {}
    for k in docs:
        w = words(docs[k])
        gone = {j for i in range(len(w) - size + 1) if first[tuple(w[i : i + size])] < k for j in range(i, i + size)}
        out[k] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = int(digit) * (2 if place % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)
