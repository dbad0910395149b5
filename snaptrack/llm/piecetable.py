"""Ids of pre-tokens in arrays: a hash table over bytes, looked up for a whole group at once.

A pre-token and its ids take about 50 bytes, and no Python object is made of one that is known. A
64-bit hash finds the place, the bytes decide.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from snaptrack.llm.pretokens import Pieces, groups
from snaptrack.llm.words import gathered, string_hashes


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind: str):
        self.held, self.size = np.empty(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.held):
            larger = np.empty(max(need, len(self.held) * 3 // 2), self.held.dtype)
            larger[: self.size] = self.held[: self.size]
            self.held = larger
        self.held[self.size : need] = values
        self.size = need


class PieceTable:
    """Looks up or makes the ids of pre-tokens; when it holds `most` it begins anew, which costs time only."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.slots = np.full(1 << max(10, (2 * self.most - 1).bit_length()), -1, np.int32)
        self.hashes, self.letters, self.ids = Grown("u8"), Grown("u1"), Grown("<u4")
        self.letter_ends, self.id_ends = Grown("i8"), Grown("i8")
        for ends in (self.letter_ends, self.id_ends):
            ends.add(np.zeros(1, np.int64))

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The number under which each hash is known, or -1."""
        mask = len(self.slots) - 1
        at = (hashes & np.uint64(mask)).astype(np.int64)
        found = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        while len(open_):
            number = self.slots[at[open_]]
            there = number >= 0
            open_, number = open_[there], number[there]
            same = self.hashes.held[number] == hashes[open_]
            found[open_[same]] = number[same]
            open_ = open_[~same]
            at[open_] = (at[open_] + 1) & mask
        return found

    def _enter(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        mask = len(self.slots) - 1
        at = (hashes & np.uint64(mask)).astype(np.int64)
        open_ = np.arange(len(hashes))
        while len(open_):
            free = open_[self.slots[at[open_]] < 0]
            self.slots[at[free]] = numbers[free]
            open_ = open_[self.slots[at[open_]] != numbers[open_]]
            at[open_] = (at[open_] + 1) & mask

    def _same(self, data: np.ndarray, offsets: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Whether strings are those known under the numbers."""
        sizes, ends = np.diff(offsets), self.letter_ends.held
        starts = ends[numbers]
        same = ends[numbers + 1] - starts == sizes
        own, own_ends = gathered(data, offsets[:-1][same], offsets[1:][same])
        known, _ = gathered(self.letters.held, starts[same], starts[same] + sizes[same])
        wrong = np.flatnonzero(own != known)
        same[np.flatnonzero(same)[np.searchsorted(own_ends, wrong, "right") - 1]] = False
        return same

    def numbers(self, pieces: pa.StringArray) -> np.ndarray:
        """The numbers of distinct pre-tokens."""
        if self.hashes.size + len(pieces) > self.most and self.hashes.size:
            self._clear()
        if 2 * len(pieces) > len(self.slots):
            self.most = 2 * len(pieces)
            self._clear()
        _, ends, letters = pieces.buffers()
        offsets = np.frombuffer(ends, np.int32)[: len(pieces) + 1].astype(np.int64) if len(pieces) else np.zeros(1, np.int64)
        data = np.frombuffer(letters or b"", np.uint8)
        hashes = string_hashes(data, offsets)
        found = self._find(hashes)
        known = np.flatnonzero(found >= 0)
        letters, parts = gathered(data, offsets[known], offsets[known + 1])
        found[known[~self._same(letters, parts, found[known])]] = -1
        new = np.flatnonzero(found < 0)
        if len(new):
            first = self.hashes.size
            made = self.encode(pieces.take(pa.array(new)).to_pylist())
            sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
            letters, parts = gathered(data, offsets[new], offsets[new + 1])
            self.letter_ends.add(self.letters.size + parts[1:])
            self.letters.add(letters)
            self.id_ends.add(self.ids.size + np.cumsum(sizes))
            self.ids.add(np.frombuffer(b"".join(made), "<u4"))
            self.hashes.add(hashes[new])
            found[new] = np.arange(first, first + len(new))
            self._enter(hashes[new], found[new].astype(np.int32))
        return found

    def encode_texts(self, texts: list[str], words: bool) -> list[np.ndarray]:
        """The ids of whole texts."""
        found = []
        for group in groups(texts):
            pieces = Pieces(group, words)
            own = self.numbers(pieces.dictionary)[pieces.numbers]
            ends = self.id_ends.held
            ids, offsets = gathered(self.ids.held, ends[own], ends[own + 1])
            cuts = offsets[pieces.firsts]
            found += [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        return found
