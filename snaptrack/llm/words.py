"""Words of many texts at once, on their UTF-8 bytes.

A word is a run of digits, letters a-z (A-Z are lowered) and characters beyond ASCII. All bytes of
the latter are 0x80 or more, so bytes decide, and a batch takes a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The same in SQL: a pattern for text whose A-Z are lowered.
PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of texts in one go; a longer text goes alone. And of words while they are hashed.
GROUP, HASHED = 1 << 22, 1 << 20
MULTIPLIER, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93

LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[ord("A") : ord("Z") + 1] += 32
IN_WORD = np.zeros(256, bool)
for _low, _high in ("09", "AZ", "az", "\x80\xff"):
    IN_WORD[ord(_low) : ord(_high) + 1] = True


class Words:
    """The words of a group of texts: `data` holds their bytes end to end, word k those from
    `offsets[k]` to `offsets[k + 1]`; `firsts[t]` is the first word of text t (one more at the end)."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string()).fill_null("")
        _, ends, data = texts.buffers()
        ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        raw = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        inside = IN_WORD[raw]
        begins, closes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        some = np.diff(ends) > 0  # words do not reach over the border of two texts
        at = ends[:-1][some]
        begins[at] = inside[at]
        at = ends[1:][some] - 1
        closes[at] = inside[at]
        starts = np.flatnonzero(begins)
        self.data = LOWERED[raw[inside]]
        self.offsets = np.append(0, np.cumsum(np.flatnonzero(closes) + 1 - starts))
        self.firsts = np.searchsorted(starts, ends)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.firsts)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number of each word among the distinct ones, and the distinct ones' data and offsets."""
        return distinct(self.data, self.offsets)

    def spaced(self) -> tuple[np.ndarray, np.ndarray]:
        """All words with a blank after each, and where each word starts (and the last one ends)."""
        n = len(self)
        found = np.full(len(self.data) + n, 32, np.uint8)
        found[np.arange(len(self.data)) + np.repeat(np.arange(n), np.diff(self.offsets))] = self.data
        return found, self.offsets + np.arange(n + 1)

    def runs(self, size: int) -> np.ndarray:
        """The first words of all runs of `size` words that lie in one text."""
        last = np.repeat(self.firsts[1:], self.counts) - size
        return np.flatnonzero(np.arange(len(self)) <= last)

    def hashes(self) -> np.ndarray:
        """A 64-bit number of each word: equal for equal words, seldom for others."""
        return string_hashes(self.data, self.offsets)

    def run_hashes(self, hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        """A 64-bit number of each run of `size` words, from the words' own."""
        found = np.full(len(starts), size, np.uint64)
        for k in range(size):
            found = found * np.uint64(MULTIPLIER) + hashes[starts + k]
        return mixed(found)


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers 0 to n - 1 at least of the multiplier and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((MULTIPLIER, pow(MULTIPLIER, -1, 1 << 64))):
            each = np.full(max(n, HASHED), base, np.uint64)
            each[0] = 1
            _POWERS[k] = np.cumprod(each, dtype=np.uint64)
    return [p[:n] for p in _POWERS]


def string_hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit number of each of many strings that lie end to end."""
    found = np.empty(len(offsets) - 1, np.uint64)
    low = 0
    while low < len(found):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + HASHED, "right")) - 1)
        own = offsets[low : high + 1] - offsets[low]
        powers, inverse = _powers(int(own[-1]) + 1)
        terms = (data[offsets[low] : offsets[high]].astype(np.uint64) + np.uint64(1)) * powers[:-1]
        sums = np.append(np.uint64(0), np.cumsum(terms, dtype=np.uint64))
        found[low:high] = mixed((sums[own[1:]] - sums[own[:-1]]) * inverse[own[:-1]])
        low = high
    return found


def mixed(numbers: np.ndarray) -> np.ndarray:
    numbers = (numbers ^ (numbers >> np.uint64(32))) * np.uint64(MIX)
    return numbers ^ (numbers >> np.uint64(29))


def distinct(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of strings end to end: the number of each among the distinct ones, and their data and offsets."""
    strings = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    ).dictionary_encode()
    _, ends, own = strings.dictionary.buffers()
    n = len(strings.dictionary)
    ends = np.frombuffer(ends, np.int64)[: n + 1] if n else np.zeros(1, np.int64)
    return strings.indices.to_numpy(zero_copy_only=False), np.frombuffer(own or b"", np.uint8), ends


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of `data`, which may overlap, end to end with their offsets."""
    sizes = ends - starts
    offsets = np.append(0, np.cumsum(sizes))
    return data[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)], offsets


def groups(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Slices of `texts` of bounded size, each with the place of its first text."""
    sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(texts):
        before = sizes[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, before + GROUP, "right")))
        yield low, texts.slice(low, high - low)
        low = high

