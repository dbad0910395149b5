"""Pre-tokens of many texts at once, in numpy, each distinct one encoded once.

Both public pre-token patterns decide from the classes of neighbouring characters where a pre-token
begins, so the borders of a whole batch come from a few array comparisons. The pre-tokens are then
numbered (Arrow's dictionary encoding), only distinct ones are looked up or encoded, and the ids of
all texts are gathered by number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

from snaptrack.llm.characters import NUMBER, OTHER, SPACE, WHITE, classes

#: Code points in one go; a longer text goes alone.
GROUP = 1 << 21

BLANKS = "".join(map(chr, WHITE))
# The endings split off after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _endings(cp: np.ndarray, k: np.ndarray, first: np.ndarray, after_blank: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of apostrophes that begin an ending, and the lengths of what they begin (2 or 3).

    An apostrophe begins a match unless other signs come right before it, or a blank that takes it
    (where blanks join what follows)."""
    at = np.flatnonzero(cp == ord("'"))
    before = at - 1
    open_ = first[at] | ((k[before] != OTHER) & ~(after_blank & (cp[before] == 32)))
    at = at[open_]
    n = len(cp)
    one, two = np.minimum(at + 1, n - 1), np.minimum(at + 2, n - 1)
    has_one = (at + 1 < n) & ~first[one]
    has_two = has_one & (at + 2 < n) & ~first[two]
    length = np.zeros(len(at), np.int64)
    for e in ENDINGS:
        if len(e) == 1:
            length[has_one & (cp[one] == ord(e))] = 2
    for e in ENDINGS:
        if len(e) == 2:
            length[has_two & (length == 0) & (cp[one] == ord(e[0])) & (cp[two] == ord(e[1]))] = 3
    return at[length > 0], length[length > 0]


def borders(cp: np.ndarray, first: np.ndarray, words: bool) -> np.ndarray:
    """Whether a pre-token begins at each code point; `first` marks where texts begin.

    `words`: blanks stand alone and every number is one pre-token; else a blank joins what follows
    it and a run of white space leaves its last character to what follows."""
    k = classes()[cp]
    if not len(cp):
        return np.zeros(0, bool)
    begins = np.ones(len(cp), bool)
    p, c = k[:-1], k[1:]
    if words:
        begins[1:] = (p != c) | (c == NUMBER)
    else:
        followed = np.zeros(len(cp), bool)  # the next character is of the same text and no white space
        followed[:-1] = (k[1:] != SPACE) & ~first[1:]
        begins[1:] = np.where(
            c == SPACE, (p != SPACE) | followed[1:], np.where(p == SPACE, cp[:-1] != 32, p != c)
        )
    at, length = _endings(cp, k, first, not words)
    for extra in (1, 2):
        inside = at[length > extra] + extra
        begins[inside] = False
    ends = at + length
    begins[ends[ends < len(cp)]] = True
    begins |= first
    return begins


class Ids:
    """Looks up or makes the ids of pre-tokens. Of two generations the older is forgotten when the
    younger holds half of `most`; what is still used moves over."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], words: bool, most: int):
        self.encode, self.words, self.most = encode, words, most
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def of(self, pieces: list[str]) -> list[bytes]:
        if len(self.known) > self.most // 2:
            self.known, self.older = {}, self.known
        found = list(map(self.known.get, pieces))
        missing = [i for i, x in enumerate(found) if x is None]
        unknown = []
        for i in missing:
            ids = self.older.get(pieces[i])
            if ids is None:
                unknown.append(i)
            else:
                self.known[pieces[i]] = found[i] = ids
        if unknown:
            for i, ids in zip(unknown, self.encode([pieces[i] for i in unknown]), strict=True):
                self.known[pieces[i]] = found[i] = ids
        return found


def groups(texts: list[str]) -> Iterator[list[str]]:
    own, size = [], 0
    for t in texts:
        if own and size + len(t) > GROUP:
            yield own
            own, size = [], 0
        own.append(t)
        size += len(t)
    if own:
        yield own


class Pieces:
    """The pre-tokens of a group of texts: `lengths` in code points, `numbers` into `distinct`, and the
    place of each text's first pre-token (`firsts`, one more at the end). White space is left out
    where blanks stand alone."""

    def __init__(self, texts: list[str], words: bool):
        text = "".join(texts)
        cp = points(text)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.cumsum(sizes) - sizes
        first = np.zeros(len(cp), bool)
        first[starts[sizes > 0]] = True
        at = np.flatnonzero(borders(cp, first, words))
        bytes_before = np.zeros(len(cp) + 1, np.int32)
        np.cumsum(1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF), out=bytes_before[1:])
        offsets = bytes_before[np.append(at, len(cp))]
        data = text.encode("utf-8", "surrogatepass")
        coded = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
        self.lengths = np.diff(np.append(at, len(cp)))
        self.numbers = coded.indices.to_numpy(zero_copy_only=False)
        self.firsts = np.searchsorted(at, np.append(starts, len(cp)))
        if words:
            kept = classes()[cp[at]] != SPACE
            self.firsts = np.append(0, np.cumsum(kept))[self.firsts]
            self.lengths, self.numbers = self.lengths[kept], self.numbers[kept]
        self.dictionary = coded.dictionary

    @cached_property
    def distinct(self) -> list[str]:
        return self.dictionary.to_pylist()


def encode_group(texts: list[str], ids: Ids) -> list[np.ndarray]:
    """The ids of whole texts."""
    pieces = Pieces(texts, ids.words)
    own = ids.of(pieces.distinct)
    sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
    blob = np.frombuffer(b"".join(own), "<u4")
    counts = sizes[pieces.numbers]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    starts = (np.cumsum(sizes) - sizes)[pieces.numbers]
    found = blob[np.arange(total) + np.repeat(starts - (ends - counts), counts)]
    cuts = np.append(0, ends)[pieces.firsts]
    return [found[a:b] for a, b in zip(cuts, cuts[1:])]


def encode_texts(texts: list[str], ids: Ids) -> list[np.ndarray]:
    return [x for group in groups(texts) for x in encode_group(group, ids)]
