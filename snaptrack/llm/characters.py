"""What the tokenizer library takes for letters, numbers and white space, and how it folds case.

Its tables and Python's are of different versions of Unicode, so the library itself is asked, once per
process and for every code point that any version may assign: planes 0 to 3 and the start of plane
14 (all others are empty or for private use, and no class has members there).
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np

OTHER, LETTER, NUMBER, SPACE = range(4)

# The code points Unicode calls white space.
WHITE = (*range(9, 14), 32, 133, 160, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def assignable() -> np.ndarray:
    """The code points asked for, without surrogates."""
    return np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x40000), np.arange(0xE0000, 0xE1000)])


def text_of(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le")


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point."""
    from tokenizers import Regex, pre_tokenizers

    points = assignable()
    text, table = text_of(points), np.zeros(0x110000, np.uint8)
    for name, kind in (("L", LETTER), ("N", NUMBER)):
        found = pre_tokenizers.Split(Regex(rf"\p{{{name}}}+"), "removed", invert=True).pre_tokenize_str(text)
        for _, (a, b) in found:
            table[points[a:b]] = kind
    table[list(WHITE)] = SPACE
    return table


@lru_cache(maxsize=1)
def _library():
    from tokenizers import normalizers

    return normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])


def _own(text: str) -> str:
    # A capital sigma at a word's end is like any other to the library.
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


@lru_cache(maxsize=1)
def differing() -> re.Pattern[str]:
    """Matches a character that Python and the library compose, order or fold in different ways.

    Asked for every code point: alone, after a mark that all others come before, before a mark that comes
    before all others, and the pairs that Python composes."""
    chars = [c for c in text_of(assignable()) if c != "\n"]
    found = set()
    for around in ("{}", "aͅ{}", "a{}̴"):
        whole = "\n".join(map(around.format, chars))
        pairs = zip(chars, _library().normalize_str(whole).split("\n"), _own(whole).split("\n"), strict=True)
        found.update(c for c, theirs, ours in pairs if theirs != ours)
    for c in chars:
        parts = unicodedata.decomposition(c)
        if parts and not parts.startswith("<"):
            pair = "".join(chr(int(x, 16)) for x in parts.split())
            if _library().normalize_str(pair) != _own(pair):
                found.update((c, *pair))
    return re.compile(f"[{re.escape(''.join(sorted(found)))}]" if found else r"(?!)")


def fold(text: str) -> str:
    """Composed and in small letters, as the library has it."""
    if not text.isascii() and differing().search(text):
        return _library().normalize_str(text)
    return _own(text)
