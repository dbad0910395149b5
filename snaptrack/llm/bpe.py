"""Exact byte-pair encoding with a backtracking encoder, and decoding from an offset table.

An Aho-Corasick automaton over the vocabulary finds, for every position of a pre-token, the tokens
that start there. The encoder takes the longest one that is compatible with its left neighbour and
goes back where none is; a position given up once is never entered again, because a prefix has one
encoding only, so the work is linear in the pre-token. Two neighbours are compatible if merging
their joined text by rank would not have crossed the border between them; answers are kept in a
table. The result is what applying the merges one by one gives.

Decoding reads every token's text out of one byte string by an offset table, in numpy.

Defined results: a null or empty text has no ids and decodes to the empty text; strings of special
tokens in a text become their ids, as the public library does by default; repeated rows are encoded
alike; an empty table gives an empty result; extra columns are carried along.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrack.llm import characters
from snaptrack.llm.common import batch_rows, col, fresh
from snaptrack.llm.pretokens import BLANKS, Ids, encode_texts

WORD_VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"
#: Pre-tokens and neighbours a worker remembers, about 100 MB together; forgetting costs time only.
REMEMBERED, NEIGHBOURS = 250_000, 100_000
#: More than any id.
ID = 1 << 20

#: Stands for the end-of-word suffix; no byte is written with this character.
END = "\n"
NEVER = 1 << 40


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next unused from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = iter(range(256, 512))
    return [chr(b if b in plain else next(moved)) for b in range(256)]


class Merges:
    """A vocabulary with its merges, and whether two tokens may stand side by side."""

    def __init__(self, ids: dict[str, int], merges: list[tuple[str, str]]):
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # id -> rank, left, right
        for rank, (left, right) in enumerate(merges):
            pair, whole = (ids[left], ids[right]), ids[left + right]
            self.rank[pair] = rank
            self.parts[whole] = (rank, *pair)
        self.compatible: dict[int, bool] = {}  # left * ID + right

        self.edges: dict[int, tuple[list, list]] = {}

    def edge(self, token: int) -> tuple[list, list]:
        """For the left and the right side: the token and what it was merged from there, each with the rank that ended it."""
        known = self.edges.get(token)
        if known is None:
            known = ([], [])
            for side, nodes in enumerate(known, 1):
                node, ended = token, NEVER
                while node in self.parts:
                    nodes.append((node, ended))
                    ended, node = self.parts[node][0], self.parts[node][side]
                nodes.append((node, ended))
            self.edges[token] = known
        return known

    def fits(self, left: int, right: int) -> bool:
        key = left * ID + right
        known = self.compatible.get(key)
        if known is None:
            if len(self.compatible) >= NEIGHBOURS:
                self.compatible.clear()
            known = self.compatible[key] = not self._crossed(self.edge(left)[1], self.edge(right)[0])
        return known

    def _crossed(self, left: list[tuple[int, int]], right: list[tuple[int, int]]) -> bool:
        """Whether a merge joins the two sides. Of equal merges the leftmost comes first: hence < and <=."""
        for a, until_a in left:
            for b, until_b in right:
                rank = self.rank.get((a, b))
                if rank is not None and rank < until_a and rank <= until_b:
                    return True
        return False


class Encoder:
    """A vocabulary file, ready to encode; what it encoded is remembered."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        inner = {self._inner(t): i for t, i in model["vocab"].items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = Merges(inner, [(self._inner(a), self._inner(b)) for a, b in pairs])
        self.automaton = ahocorasick.Automaton()
        for token, i in inner.items():
            self.automaton.add_word(token, i)
        self.automaton.make_automaton()
        self.inner_ids, self.inner_tokens = inner, {i: t for t, i in inner.items()}
        self.next_shorter: dict[int, int | None] = {}
        self.letters = byte_letters()
        self.split_special = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")"
        ) if self.special else None
        self.ids = Ids(self.encode_pieces, bool(self.suffix), REMEMBERED)
        size = max([*model["vocab"].values(), *self.special.values()], default=-1) + 1
        self.tokens = [""] * size
        for token, i in [*model["vocab"].items(), *self.special.items()]:
            self.tokens[i] = token

    def _inner(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix):
            return token[: -len(self.suffix)] + END
        return token

    def shorter(self, token: int) -> int | None:
        """The longest token that begins `token` and is shorter."""
        if token not in self.next_shorter:
            text = self.inner_tokens[token]
            self.next_shorter[token] = next(
                (self.inner_ids[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.inner_ids), None
            )
        return self.next_shorter[token]

    def piece(self, text: str) -> list[int]:
        """The ids of one pre-token (in the letters that stand for bytes, with END if words end)."""
        tokens, known, fits, matches = self.inner_tokens, self.merges.compatible, self.merges.fits, self.automaton.iter_long
        ids: list[int] = []
        given_up: set[int] = set()
        at, size = 0, len(text)
        longest = [(last + 1 - len(tokens[i]), i) for last, i in matches(text)]
        longest.reverse()  # longest matches one after the other, the next one last
        while True:
            while longest and longest[-1][0] < at:
                longest.pop()
            if not longest or longest[-1][0] != at:
                # Off the first run's path: match anew from here.
                longest = [(last + 1 - len(tokens[i]), i) for last, i in matches(text, at)]
                longest.reverse()
            token = longest[-1][1] if longest and longest[-1][0] == at else None
            while True:
                while token is not None:
                    end = at + len(tokens[token])
                    if end not in given_up and (not ids or (fit := known.get(ids[-1] * ID + token)) or fit is None and fits(ids[-1], token)):
                        break
                    token = self.shorter(token)
                if token is not None:
                    break
                if not ids:
                    raise ValueError(f"no encoding for {text!r}")
                given_up.add(at)
                token = ids.pop()
                at -= len(tokens[token])
            ids.append(token)
            at = end
            if at == size:
                return ids

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Pre-tokens' ids as little-endian uint32 bytes."""
        end = END if self.suffix else ""
        found = []
        for piece in pieces:
            ids = self.piece("".join(map(self.letters.__getitem__, piece.encode("utf-8", "surrogatepass"))) + end) if not self.suffix or piece.strip(BLANKS) else []
            found.append(pack(f"<{len(ids)}I", *ids))
        return found

    def fold(self, text: str) -> str:
        """What the vocabulary's normalizer makes of a text, but for white space, which is dropped later."""
        return characters.fold(text) if self.suffix else text

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of whole texts, strings of special tokens taken as these."""
        parts: list[str] = []
        layout: list[list[int | np.ndarray]] = []  # of each text: places in parts, or ids
        for text in texts:
            own = [text or ""]
            if text and "<" in text and self.split_special:
                own = self.split_special.split(text)
            layout.append([])
            for k, x in enumerate(own):
                if k % 2:
                    layout[-1].append(np.array([self.special[x]], "<u4"))
                else:
                    layout[-1].append(len(parts))
                    parts.append(self.fold(x))
        found = encode_texts(parts, self.ids)
        return [
            found[own[0]] if len(own) == 1 else np.concatenate([found[x] if isinstance(x, int) else x for x in own])
            for own in layout
        ]


class Decoder:
    """Texts of ids, read from one byte string by offsets.

    A vocabulary without decoding rules (one with word ends) joins its tokens by a blank; a
    byte-level one joins the bytes and replaces what is no UTF-8.
    """

    def __init__(self, tokens: list[str], special: set[int], joined_by_blank: bool):
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.blank = joined_by_blank
        parts = [
            (t + " ").encode() if joined_by_blank
            else t.encode() if i in special else bytes(byte_of[c] for c in t)
            for i, t in enumerate(tokens)
        ]
        self.table = np.frombuffer(b"".join(parts), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])

    def decode(self, ids: np.ndarray) -> bytes:
        starts = self.offsets[ids]
        lengths = self.offsets[ids.astype(np.int64) + 1] - starts
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
        found = self.table[places].tobytes()
        if self.blank:
            return found[:-1]
        return found.decode("utf-8", "replace").encode()


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=4)
def decoder(path: str) -> Decoder:
    e = encoder(path)
    return Decoder(e.tokens, set(e.special.values()), bool(e.suffix))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate([*arrays, np.empty(0, "<u4")]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _id_arrays(ids: pa.Array) -> list[np.ndarray]:
    ids = ids.fill_null([]) if ids.null_count else ids
    values, ends = ids.flatten().to_numpy(zero_copy_only=False), np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(values, ends[:-1]) if len(ids) else []


def encode(docs: DataFrame, text_col: str = "text", into: str = "ids", path: str | None = None) -> DataFrame:
    """`docs` with the ids of a text in `into` (array<int>, renamed if the name is taken)."""

    @F.arrow_udf("array<int>")
    def ids_of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        e = encoder(path or vocabulary_path(WORD_VOCABULARY))
        for batch in texts:
            yield _lists(e.encode(batch.to_pylist()))

    batch_rows(docs.sparkSession)
    return docs.withColumn(fresh(docs, into), ids_of(col(text_col)))


def decode(tokens: DataFrame, ids_col: str = "ids", into: str = "text", path: str | None = None) -> DataFrame:
    """`tokens` with the text of their ids (special tokens kept) in `into`."""

    @F.arrow_udf("string")
    def text_of(ids: Iterator[pa.Array]) -> Iterator[pa.Array]:
        d = decoder(path or vocabulary_path(WORD_VOCABULARY))
        for batch in ids:
            yield pa.array([d.decode(x) for x in _id_arrays(batch)], pa.binary()).cast(pa.string())

    batch_rows(tokens.sparkSession)
    return tokens.withColumn(fresh(tokens, into), text_of(col(ids_col)))


def round_trip(docs: DataFrame, text_col: str = "text", into: str = "bpe", path: str | None = None) -> DataFrame:
    """`encode` and `decode` in one pass: a struct `into` of ids and the text decoded from them."""

    @F.arrow_udf("ids array<int>, decoded string")
    def both(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at = path or vocabulary_path(WORD_VOCABULARY)
        e, d = encoder(at), decoder(at)
        for batch in texts:
            ids = e.encode(batch.to_pylist())
            decoded = pa.array([d.decode(x) for x in ids], pa.binary()).cast(pa.string())
            yield pa.StructArray.from_arrays([_lists(ids), decoded], ["ids", "decoded"])

    batch_rows(docs.sparkSession)
    return docs.withColumn(fresh(docs, into), both(col(text_col)))


def op4(docs: DataFrame) -> DataFrame:
    coded = round_trip(docs.select("doc_id", "text")).select("doc_id", "bpe.ids", "bpe.decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
