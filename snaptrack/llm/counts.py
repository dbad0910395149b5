"""Edit-aware token counts: a segment tree of pre-tokens per document.

A document's leaves are its pre-tokens, `PIECES` to a leaf; a leaf knows its
characters and tokens, an inner node the sums below it. An edit walks down to the leaves it
touches, takes one more leaf on each side as context, encodes only that stretch anew, and updates
the sums on the way up. Where pieces begin depends on three characters in a row, so nothing outside
the stretch can change. The stretch's pieces are dealt to its leaves; where they are too many for
these, new leaves are put in and the sums, nothing else, are worked out anew. So leaves stay short
whatever is inserted; counts are those of encoding the whole edited text.

Defined results: a null or empty text has no tokens and can be edited all the same; strings of
special tokens are ordinary text; edits apply one after the other, each in positions (code points)
of the text as it is by then, cut to the text's ends; null edits, or null fields of an edit (start
and end: 0; replacement: empty), change nothing more; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrack.llm.bpe import BYTE_VOCABULARY, Encoder, encoder, vocabulary_path
from snaptrack.llm.characters import LETTER, NUMBER, assignable, classes, text_of
from snaptrack.llm.common import batch_rows, col, fresh
from snaptrack.llm.pretokens import BLANKS, Pieces, groups

# Fixed value: the pre-token pattern of the byte-level vocabulary.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Leaves are this many pieces when a tree is built.
PIECES = 8
#: Pieces a leaf may grow to under edits.
MOST = 4 * PIECES


@lru_cache(maxsize=1)
def _pattern():
    import regex

    space = f"[{BLANKS}]"
    return regex.compile(BYTE_PATTERN.replace(r"[^\s", f"[^{BLANKS}").replace(r"\S", f"[^{BLANKS}]").replace(r"\s", space))


@lru_cache(maxsize=1)
def _unlike():
    """Matches a character that the pattern's engine and the library put into different classes."""
    import regex

    points = assignable()
    text, kinds = text_of(points), classes()[points]
    differ = np.zeros(len(text), bool)
    for name, kind in (("L", LETTER), ("N", NUMBER)):
        theirs = np.zeros(len(text), bool)
        for m in regex.finditer(rf"\p{{{name}}}+", text):
            theirs[m.start() : m.end()] = True
        differ |= theirs != (kinds == kind)
    unlike = points[differ]
    if not len(unlike):
        return regex.compile(r"(?!)")
    stretches = np.split(unlike, np.flatnonzero(np.diff(unlike) > 1) + 1)
    return regex.compile("[" + "".join(f"{chr(x[0])}-{chr(x[-1])}" for x in stretches) + "]")


def short_pieces(text: str) -> list[str]:
    """The pre-tokens of one short text, for which setting up arrays costs more than it saves."""
    if text.isascii() or not _unlike().search(text):
        return _pattern().findall(text)
    pieces = Pieces([text], False)
    return [pieces.distinct[k] for k in pieces.numbers]


def counted_pieces(texts: list[str], e: Encoder) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Each text with its pieces' characters and tokens."""
    if e.suffix:
        raise ValueError("edits need a vocabulary whose pieces keep white space")
    for group in groups(texts):
        pieces = Pieces(group, False)
        sizes = np.fromiter(map(len, e.ids.of(pieces.distinct)), np.int64, len(pieces.distinct)) // 4
        tokens = sizes[pieces.numbers]
        for text, a, b in zip(group, pieces.firsts, pieces.firsts[1:]):
            yield text, pieces.lengths[a:b], tokens[a:b]


class TokenTree:
    """Counts of one text under edits. Nodes lie in arrays as in a heap: node k has 2k and 2k + 1."""

    def __init__(self, text: str, lengths: np.ndarray, tokens: np.ndarray, e: Encoder):
        self.encoder = e
        self.encoded = 0  # characters encoded for edits
        firsts = np.arange(0, len(lengths), PIECES)
        cuts = np.concatenate([[0], np.cumsum(lengths)[firsts[1:] - 1], [len(text)]]).tolist()
        sums = np.add.reduceat(tokens, firsts) if len(tokens) else np.zeros(1, np.int64)
        self._plant([text[a:b] for a, b in zip(cuts, cuts[1:])], np.diff(cuts), sums)

    def _plant(self, texts: list[str], chars: np.ndarray, tokens: np.ndarray) -> None:
        """Leaves and the sums above them."""
        self.texts = texts
        self.size = 1 << max(len(texts) - 1, 0).bit_length()
        sums = []
        for values in (chars, tokens):
            levels = [np.zeros(self.size, np.int64)]
            levels[0][: len(values)] = values
            while len(levels[0]) > 1:
                levels.insert(0, levels[0].reshape(-1, 2).sum(1))
            sums.append(np.concatenate([[0], *levels]).tolist())
        self.chars, self.tokens = sums

    @classmethod
    def of(cls, text: str, e: Encoder) -> TokenTree:
        return cls(*next(counted_pieces([text], e)), e)

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(self.texts)

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds character `place` and the place of the leaf's first character."""
        node, first = 1, 0
        while node < self.size:
            node *= 2
            if place >= first + self.chars[node]:
                first += self.chars[node]
                node += 1
        return node - self.size, first

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.texts[leaf] = text
        node = leaf + self.size
        more_chars, more_tokens = len(text) - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2

    def _pieces(self, stretch: str, following: str) -> tuple[list[str], list[int]]:
        """The pieces of a stretch and the tokens of each."""
        own = short_pieces(stretch + following)
        if following:
            own[-1] = own[-1][:-1]
        own = [p for p in own if p]
        return own, [len(x) // 4 for x in self.encoder.ids.of(own)]

    def _deal(self, low: int, high: int, pieces: list[str], tokens: list[int]) -> None:
        """Put a stretch's pieces into the leaves low to high, or, where these would grow beyond `MOST`,
        into as many new ones as they need."""
        slots = high - low + 1
        each = -(-len(pieces) // slots)
        if each > MOST:
            each = PIECES
        cuts = range(0, max(len(pieces), 1), max(each, 1))
        texts = ["".join(pieces[k : k + each]) for k in cuts]
        sums = [sum(tokens[k : k + each]) for k in cuts]
        if len(texts) <= slots:
            for k in range(slots):
                self._set(low + k, *((texts[k], sums[k]) if k < len(texts) else ("", 0)))
            return
        leaves = np.array(self.chars[self.size : self.size + len(self.texts)])
        known = np.array(self.tokens[self.size : self.size + len(self.texts)])
        self._plant(
            [*self.texts[:low], *texts, *self.texts[high + 1 :]],
            np.concatenate([leaves[:low], list(map(len, texts)), leaves[high + 1 :]]),
            np.concatenate([known[:low], sums, known[high + 1 :]]),
        )

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Put `replacement` where characters start to end are."""
        n = self.n_chars
        start = min(max(start, 0), n)
        end = min(max(end, start), n)
        if start == end and not replacement:
            return
        # One leaf more on each side; an empty leaf is no context.
        low, first = self.leaf_at(max(start - 1, 0)) if n else (0, 0)
        if first:
            low, first = self.leaf_at(first - 1)
        high, at = self.leaf_at(max(min(end, n - 1), 0)) if n else (0, 0)
        after = at + self.chars[high + self.size]
        if after < n:
            high, at = self.leaf_at(after)
            after = at + self.chars[high + self.size]
        high = min(high, len(self.texts) - 1)
        old = "".join(self.texts[low : high + 1])
        new = old[: start - first] + replacement + old[end - first :]
        # The character after shows how the stretch ends; its own piece's tokens are counted elsewhere.
        following = self.texts[self.leaf_at(after)[0]][0] if after < n else ""
        self.encoded += len(new)
        self._deal(low, high, *self._pieces(new, following))


def count_tokens(
    docs: DataFrame, edits: Column, text_col: str = "text", into: str = "counts", path: str | None = None
) -> DataFrame:
    """`docs` with a struct `into` (renamed if taken): n_tokens, and after the edits (an
    array<struct<start int, end int, replacement string>>) edited_tokens, edited_chars,
    encoded_chars (characters encoded again for the edits) and edited_text."""

    @F.arrow_udf(
        "n_tokens long, edited_tokens long, edited_chars long, encoded_chars long, edited_text string"
    )
    def counted(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        e = encoder(path or vocabulary_path(BYTE_VOCABULARY))
        for texts, changes in batches:
            found = []
            counted = counted_pieces([t or "" for t in texts.to_pylist()], e)
            for own, (text, lengths, tokens) in zip(changes.to_pylist(), counted, strict=True):
                tree = TokenTree(text, lengths, tokens, e)
                before = tree.n_tokens
                for change in own or ():
                    if change is not None:
                        tree.edit(change["start"] or 0, change["end"] or 0, change["replacement"] or "")
                found.append((before, tree.n_tokens, tree.n_chars, tree.encoded, tree.text()))
            kinds = [pa.int64()] * 4 + [pa.string()]
            columns = [pa.array([x[k] for x in found], kind) for k, kind in enumerate(kinds)]
            yield pa.StructArray.from_arrays(
                columns, ["n_tokens", "edited_tokens", "edited_chars", "encoded_chars", "edited_text"]
            )

    batch_rows(docs.sparkSession)
    return docs.withColumn(fresh(docs, into), counted(col(text_col), edits))


def sample_edits(text: Column) -> Column:
    """Three edits of any text: its first 20 characters put in its middle, its third quarter's first
    twelve characters taken out, and " (end)" put after it."""
    n = F.coalesce(F.length(text), F.lit(0))

    def edit(start: Column, end: Column, replacement: Column) -> Column:
        return F.struct(
            start.cast("int").alias("start"), end.cast("int").alias("end"), replacement.alias("replacement")
        )

    middle, third = F.floor(n / 2), F.floor(n * 3 / 4)
    large = F.lit((1 << 31) - 1)
    return F.array(
        edit(middle, middle, F.substring(text, 1, 20)),
        edit(third, third + 12, F.lit("")),
        edit(large, large, F.lit(" (end)")),
    )


def op10(docs: DataFrame) -> DataFrame:
    """Tokens of every document before and after three edits."""
    counted = count_tokens(docs.select("doc_id", "text"), sample_edits(F.col("text")))
    return counted.select(
        "doc_id", "counts.n_tokens", "counts.edited_tokens", "counts.edited_chars", "counts.encoded_chars",
        F.sha2("counts.edited_text", 256).alias("edited_sha256"),
    )
