"""A word-level BPE vocabulary file: text to words, words to symbols.

The file is read once on the driver and sent to the tasks as bytes (under 2 MB), so
executors need no path. Text is normalised and cut as the file's library does: NFC, lower
case letter by letter, words by one pattern; special strings are found in the raw text.
No word crosses white space, so a piece between white space can be looked up on its own.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import regex

# What the tokenizer's library calls white space, and its word pattern.
SPACE = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")

# str.split() would also cut at these, which belong to words here.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_SPACES = re.compile(f"[{SPACE}]+")
END_OF_WORD = "</w>"


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=4)
def parsed(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def normalised(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def pieces(text: str) -> list[str]:
    """Normalised text cut at white space."""
    if _NOT_SPACE.search(text):
        return [p for p in _SPACES.split(text) if p]
    return text.split()


def words(piece: str) -> list[str]:
    """A piece cut by the word pattern.

    The pattern module may know newer letters than the tokenizer's library; code points
    that ``unicodedata`` doesn't assign count as neither letters nor numbers.
    """
    if piece.isascii() or max(piece) < "\u0250":
        return WORD.findall(piece)
    known = "".join(c if unicodedata.category(c) != "Cn" else "\ue000" for c in piece)
    return [piece[slice(*m.span())] for m in WORD.finditer(known)]


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte, as byte-level vocabularies number them."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    others = (b for b in range(256) if b not in letters)
    letters.update({b: chr(256 + n) for n, b in enumerate(others)})
    return [letters[b] for b in range(256)]


class Vocabulary:
    def __init__(self, content: bytes):
        data = json.loads(content)
        model = data["model"]
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = [""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, k in [*ids.items(), *self.special.items()]:
            self.tokens[k] = token
        self._special = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        #: (left id << 32 | right id) -> (rank, merged id)
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[left] << 32 | ids[right]] = (rank, ids[left + right])
        letters = _byte_letters()
        self._inner = [ids[x] for x in letters]
        self._last = [ids[x + END_OF_WORD] for x in letters]

    def parts(self, text: str) -> list[tuple[str, int | None]]:
        """Raw text as normalised ordinary text (None) and special strings (their id), in order."""
        out, at = [], 0
        for found in self._special.finditer(text):
            out.append((normalised(text[at : found.start()]), None))
            out.append(("", self.special[found.group()]))
            at = found.end()
        out.append((normalised(text[at:]), None))
        return out

    def has_special(self, text: str) -> bool:
        return self._special.search(text) is not None

    def symbols(self, word: str) -> list[int]:
        """The ids a word starts with: one per byte, the last marked as word end."""
        data = word.encode()
        out = [self._inner[b] for b in data]
        out[-1] = self._last[data[-1]]
        return out
