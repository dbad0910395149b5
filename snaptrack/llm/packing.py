"""Token ids in binary files: fixed-width bit packing with block offsets.

A file holds blocks of `BLOCK_IDS` ids, each id in the fewest bits that hold the vocabulary, low
bits first, then an index and a trailer:

    block 0 \\n block 1 \\n ... index \\n trailer \\n

index:    block offsets in bytes (u64 each), document ids (i64), documents' ends in ids (u64)
trailer:  magic, part, file of the part, bits, ids, blocks, documents, offset of the index (u64 each)

Everything is little-endian. Id k lies in block k // BLOCK_IDS from bit (k % BLOCK_IDS) * bits on,
so numpy unpacks a block, or one document, without reading the rest (`TokenFile`).

Documents are put in order by a range partitioning on their id; every partition writes files of at
most `FILE_IDS` ids or so one after another, through Spark's own file commit, so a lost executor
leaves no half file. A file is one row, since Spark sorts rows by file before it writes them and
keeps no order inside; it is written as raw bytes and followed by a line feed. A partition is a
stream of batches; no task holds more than a file's ids.

Defined results: a null or empty text is the end id alone; a null id sorts first and reads back as
null; repeated ids are documents of their own, in the order of their texts; an empty table gives no
files and an empty result; extra columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snaptrack.llm.bpe import BYTE_VOCABULARY, vocabulary_path
from snaptrack.llm.common import batch_rows, col, scratch, written
from snaptrack.llm.piecetable import PieceTable
from snaptrack.llm.pretokens import BLANKS

BLOCK_IDS, FILE_IDS = 1 << 16, 1 << 23
#: Pre-tokens a worker remembers, about 150 MB; forgetting costs time only.
REMEMBERED = 2_000_000
MAGIC = int.from_bytes(b"PACKIDS1", "little")
TRAILER = 8
NO_ID = -(1 << 63)


def bits_for(vocabulary_size: int) -> int:
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):  # the same bytes
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(each[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(data: bytes | memoryview, bits: int, first: int, count: int) -> np.ndarray:
    """Ids `first` to `first + count` of a block."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count, first * bits // 8).astype("<u4")
    at = (first + np.arange(count, dtype=np.int64)) * bits
    low, high = first * bits // 8, ((first + count) * bits + 7) // 8
    padded = np.concatenate([np.frombuffer(data, np.uint8)[low:high], np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded.view("<u1"), (max(len(padded) - 7, 0), 8), (1, 1))
    values = words[(at >> 3) - low].copy().view("<u8").ravel()
    return ((values >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype("<u4")


class TokenFile:
    """Random access to one file's bytes (or a memory map of them)."""

    def __init__(self, data: bytes | memoryview):
        self.data = data
        head = np.frombuffer(data[len(data) - 1 - 8 * TRAILER : len(data) - 1], "<u8")
        if int(head[0]) != MAGIC:
            raise ValueError("not a file of packed ids")
        self.part, self.file, self.bits, self.ids, blocks, docs, index = map(int, head[1:])
        parts = np.frombuffer(data[index : index + 8 * (blocks + 2 * docs)], "<u8")
        self.offsets, self.ends = parts[:blocks].astype(np.int64), parts[blocks + docs :].astype(np.int64)
        self.doc_ids = parts[blocks : blocks + docs].view("<i8")

    def slice(self, start: int, end: int) -> np.ndarray:
        """The ids at places start to end of the file."""
        found = [np.empty(0, "<u4")]
        while start < end:
            block, first = divmod(start, BLOCK_IDS)
            count = min(end - start, BLOCK_IDS - first)
            size = (min(BLOCK_IDS, self.ids - block * BLOCK_IDS) * self.bits + 7) // 8
            at = int(self.offsets[block])
            found.append(unpack(self.data[at : at + size], self.bits, first, count))
            start += count
        return np.concatenate(found)

    def document(self, k: int) -> np.ndarray:
        return self.slice(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


class FileBuilder:
    """Rows of one partition's files, in order."""

    def __init__(self, part: int, bits: int):
        self.part, self.bits, self.file = part, bits, 0
        self._reset()

    def _reset(self) -> None:
        self.offsets, self.doc_ids, self.ends = [], [], []
        self.at, self.ids, self.open, self.waiting = 0, 0, [], 0

    def _row(self, data: bytes) -> tuple[str, bytes]:
        self.at += len(data) + 1
        return f"{self.part:08d}-{self.file:06d}", data

    def _blocks(self, least: int) -> Iterator[tuple[str, bytes]]:
        ids = np.concatenate(self.open) if self.open else np.empty(0, "<u4")
        while len(ids) >= least and len(ids):
            self.offsets.append(self.at)
            yield self._row(pack(ids[:BLOCK_IDS], self.bits))
            ids = ids[BLOCK_IDS:]
        self.open, self.waiting = [ids], len(ids)

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple[str, bytes]]:
        self.open.append(ids)
        self.waiting += len(ids)
        self.ids += len(ids)
        self.doc_ids.append(NO_ID if doc_id is None else doc_id)
        self.ends.append(self.ids)
        if self.waiting >= BLOCK_IDS:
            yield from self._blocks(BLOCK_IDS)
        if self.ids >= FILE_IDS:
            yield from self.close()

    def close(self) -> Iterator[tuple[str, bytes]]:
        if not self.doc_ids:
            return
        yield from self._blocks(1)
        index = self.at
        yield self._row(
            np.array(self.offsets, "<u8").tobytes() + np.array(self.doc_ids, "<i8").tobytes() + np.array(self.ends, "<u8").tobytes()
        )
        head = [MAGIC, self.part, self.file, self.bits, self.ids, len(self.offsets), len(self.doc_ids), index]
        yield self._row(np.array(head, "<u8").tobytes())
        self.file += 1
        self._reset()


class LibraryEncoder:
    """The public library's ids; a pre-token is given to it once, and later remembered."""

    #: Separates pre-tokens in one text for the library; it is a pre-token of its own there.
    LINE = "\n"
    #: Pre-tokens in one text for the library.
    TOGETHER = 256

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        (self.line,) = self._whole([self.LINE])[0]
        self.table = PieceTable(self._pieces, REMEMBERED)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        blank = [i for i, p in enumerate(pieces) if not p.strip(BLANKS)]
        known = dict(zip(blank, self._whole([pieces[i] for i in blank]), strict=True))
        rest = [p for i, p in enumerate(pieces) if i not in known] if known else pieces
        joined = [self.LINE.join(rest[k : k + self.TOGETHER]) for k in range(0, len(rest), self.TOGETHER)]
        others = (x for ids in self._whole(joined) for x in self._between_lines(ids))
        if not known:
            return list(others)
        return [known[i].tobytes() if i in known else next(others) for i in range(len(pieces))]

    def _between_lines(self, ids: np.ndarray) -> list[bytes]:
        data, at = ids.tobytes(), (4 * np.flatnonzero(ids == self.line)).tolist()
        return [data[a:b] for a, b in zip([0, *(x + 4 for x in at)], [*at, len(data)], strict=True)]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of whole texts."""
        texts = [t or "" for t in texts]
        whole = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        found = self.table.encode_texts(["" if i in set(whole) else t for i, t in enumerate(texts)], False)
        for i, ids in zip(whole, self._whole([texts[i] for i in whole]), strict=True):
            found[i] = ids
        return found


@lru_cache(maxsize=2)
def library(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def write_ids(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = 0
) -> None:
    """Encode whole texts, end each with `end_id` and write all in ascending order of `id_col`."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library(path or vocabulary_path(BYTE_VOCABULARY))
        builder = FileBuilder(TaskContext.get().partitionId(), bits_for(max(encoder.size, end_id + 1)))
        end = np.array([end_id], "<u4")

        def built() -> Iterator[tuple[str, bytes]]:
            for b in batches:
                for doc_id, ids in zip(b.column(0).to_pylist(), encoder.encode(b.column(1).to_pylist()), strict=True):
                    yield from builder.add(doc_id, np.append(ids, end))
            yield from builder.close()

        for name, found in groupby(built(), itemgetter(0)):
            whole = b"\n".join(data for _, data in found)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([whole], pa.binary())], ["file", "value"])

    batch_rows(docs.sparkSession)
    narrow = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"))
    ordered = narrow.repartitionByRange("id").sortWithinPartitions("id", F.coalesce("text", F.lit("")))
    packed = ordered.mapInArrow(rows, "file string, value binary")
    # A text row is written as its bytes, whatever they are, and one line feed.
    lines = packed.select("file", F.col("value").cast("string").alias("value"))
    lines.write.partitionBy("file").mode("errorifexists").text(folder)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files: part, file, doc_id, place (in its file), first (its first
    id's place in the file), and ids as little-endian uint32 bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                f = TokenFile(data.as_buffer())
                n = len(f.doc_ids)
                firsts = np.concatenate([[0], f.ends[:-1]]).astype(np.int64)
                for low in range(0, n, 256):
                    high = min(low + 256, n)
                    ids = f.slice(int(firsts[low]), int(f.ends[high - 1]))
                    parts = np.split(ids, (f.ends[low : high - 1] - firsts[low]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(high - low, f.part)), pa.array(np.full(high - low, f.file)),
                            pa.array(f.doc_ids[low:high], mask=f.doc_ids[low:high] == NO_ID),
                            pa.array(np.arange(low, high)), pa.array(firsts[low:high]),
                            pa.array([x.tobytes() for x in parts], pa.binary()),
                        ],
                        ["part", "file", "doc_id", "place", "first", "ids"],
                    )

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    # Spark reads a file whole; FILE_IDS bounds its size, maxPartitionBytes what a task is given.
    return files.select("content").mapInArrow(
        rows, "part long, file long, doc_id long, place long, first long, ids binary"
    )


def op5(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    folder = scratch(spark, "packed-ids")
    write_ids(docs, folder)
    found = written(
        read_ids(spark, folder).select(
            "part", "file", "doc_id", "place", "first",
            (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
        ),
        "packed-read",
    )
    # One row a file: the ids of all files before.
    files = found.groupBy("part", "file").agg(F.sum("n_tokens").alias("ids"))
    before = F.sum("ids").over(Window.orderBy("part", "file")) - F.col("ids")
    files = files.select("part", "file", before.alias("before"))
    return found.join(files, ["part", "file"]).select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )
