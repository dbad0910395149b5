"""Document fingerprints from content-defined chunks.

A gear hash rolls over a text's UTF-8 bytes: the hash at a byte depends on the `REACH` bytes up to
it, so boundaries move along with the content. Chunk lengths are normalised: up to `NORMAL` bytes a
boundary needs more zero bits of the hash, from there on fewer, and `MOST` bytes end any chunk. A
fingerprint is the set of the chunks' digests, each weighted by the chunk's length; the likeness of
two is the weight they share over the smaller one's weight (containment).

`with_next` gives every document its neighbour in descending order of ids with a single shuffle of
the texts: buckets of an id range each are sorted, and the first document of a bucket also goes to
the bucket before. A task reads its bucket as a stream and remembers one document.

Defined results: a null or empty text has the empty fingerprint; two empty fingerprints are alike
(1), an empty and another are not (0); null ids come last; documents of one id follow each other by
text; a document alone is its own neighbour; an empty table gives an empty result; extra columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrack.llm.common import batch_rows, col

LEAST, NORMAL, MOST, REACH = 8, 32, 128, 32
#: Zero bits a boundary needs before and after NORMAL bytes: the top bits, which all of REACH reach.
STRICT, LOOSE = np.uint32(0xFE000000), np.uint32(0xE0000000)
GEAR = np.random.default_rng(2016).integers(0, 1 << 32, 256, dtype=np.uint32)
DIGEST_BITS = 48


def gear_hashes(data: bytes) -> np.ndarray:
    """At every byte the sum of the last REACH bytes' gear values, each shifted by its distance."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    reach = 1
    while reach < REACH:
        h[reach:] += h[:-reach] << np.uint32(reach)
        reach *= 2
    return h


def boundaries(data: bytes) -> list[int]:
    """Where chunks begin and end."""
    n = len(data)
    if n <= LEAST:
        return [0, n] if n else [0]
    h = gear_hashes(data)
    places = np.arange(n, dtype=np.int32)
    end = np.int32(n + MOST)

    def following(mask: np.uint32) -> np.ndarray:
        """The first place from each on whose hash has no bit of the mask, or `end`."""
        at = np.where(h & mask == 0, places, end)
        return np.append(np.minimum.accumulate(at[::-1])[::-1], np.full(MOST, end, np.int32))

    strict = following(STRICT)[LEAST - 1 : LEAST - 1 + n]
    loose = following(LOOSE)[NORMAL - 1 : NORMAL - 1 + n]
    cut = np.where(loose < places + (MOST - 1), loose + 1, places + MOST)
    cut = np.minimum(np.where(strict < places + (NORMAL - 1), strict + 1, cut), n).tolist()
    ends = [0]
    at = 0
    while at < n:
        at = cut[at]
        ends.append(at)
    return ends


def fingerprint(text: str) -> np.ndarray:
    """Sorted distinct chunks: the upper 48 bits are the digest, the lower 16 the length in bytes."""
    from xxhash import xxh64_intdigest

    data = text.encode("utf-8", "surrogatepass")
    ends = boundaries(data)
    chunks = {data[a:b] for a, b in zip(ends, ends[1:])}
    digests = np.fromiter(map(xxh64_intdigest, chunks), np.uint64, len(chunks))
    lengths = np.fromiter(map(len, chunks), np.uint64, len(chunks))
    return np.unique((digests >> np.uint64(64 - DIGEST_BITS) << np.uint64(64 - DIGEST_BITS)) | lengths)


def weight(chunks: np.ndarray) -> int:
    return int((chunks & np.uint64(0xFFFF)).sum())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return weight(a[b[place] == a]) / min(weight(a), weight(b))


def as_text(chunks: np.ndarray) -> str:
    """16 hexadecimal digits a chunk."""
    return chunks.astype(">u8").tobytes().hex()


def as_chunks(fingerprint_text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint_text), ">u8").astype(np.uint64)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns bucket, visitor, id, text: buckets of whole id ranges, each sorted in descending order
    of id, and after a bucket's rows (visitor 0) the document that follows them (visitor 1)."""
    spark = docs.sparkSession
    own = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [k / n for k in range(1, n)] or [0.5]
    found = own.agg(F.percentile_approx("id", shares, 10 * n)).first()[0] or []
    # Bucket k holds ids from bounds[k - 1] down to above bounds[k]; nulls are in the last.
    bounds = np.array(sorted(set(found), reverse=True), np.int64)

    @F.arrow_udf("int")
    def bucket_of(ids: pa.Array) -> pa.Array:
        known = ids.fill_null(0).to_numpy(zero_copy_only=False)
        bucket = np.searchsorted(-bounds, -known, side="left")
        return pa.array(np.where(ids.is_null().to_numpy(zero_copy_only=False), len(bounds), bucket).astype(np.int32))

    dealt = own.withColumn("bucket", bucket_of("id"))
    # One row a bucket; there are as many as shuffle partitions at most.
    firsts = dealt.groupBy("bucket").agg(F.max("id").alias("first")).orderBy("bucket").collect()
    if not firsts:
        return dealt.select("bucket", F.lit(0).alias("visitor"), "id", "text")
    # The first bucket's head follows the last bucket.
    before = {r["first"]: firsts[k - 1]["bucket"] for k, r in enumerate(firsts)}
    lone = before.pop(None, None)
    visited = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))[F.col("id")] if before else F.lit(None).cast("int")
    if lone is not None:
        visited = F.when(F.col("id").isNull(), F.lit(lone)).otherwise(visited)
    sent = F.array(
        F.struct(F.col("bucket"), F.lit(0).alias("visitor")), F.struct(visited.alias("bucket"), F.lit(1).alias("visitor"))
    )
    rows = dealt.select(F.explode(F.filter(sent, lambda s: s["bucket"].isNotNull())).alias("to"), "id", "text")
    rows = rows.select("to.bucket", "to.visitor", "id", "text").repartitionById(n, F.col("to.bucket"))
    return rows.sortWithinPartitions("bucket", "visitor", F.desc_nulls_last("id"), F.coalesce("text", F.lit("")))


COLUMNS = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
}


def edited_text(text: str, following: str) -> str:
    """The last third replaced by as many first characters of the next document, or all it has."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint, its edited text's, and how alike they and the next document's are."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # bucket, id, text, fingerprint
        for b in batches:
            found: dict[str, list] = {k: [] for k in COLUMNS}
            for bucket, visitor, doc_id, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if visitor and last is None:
                    continue  # a further document with the id of the one that follows
                text = text or ""
                chunks = fingerprint(text)
                if last is not None:
                    _, own_id, own, own_chunks = last
                    edited = edited_text(own, text)
                    edited_chunks = fingerprint(edited)
                    values = (
                        own_id, len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        as_text(own_chunks), as_text(edited_chunks), likeness(own_chunks, edited_chunks),
                        likeness(own_chunks, chunks),
                    )
                    for k, v in zip(COLUMNS, values, strict=True):
                        found[k].append(v)
                last = None if visitor else (bucket, doc_id, text, chunks)
            if found["doc_id"]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[k], kind) for k, kind in COLUMNS.items()], list(COLUMNS)
                )

    batch_rows(docs.sparkSession)
    return with_next(docs, id_col, text_col).mapInArrow(
        rows,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )


def op1(docs: DataFrame) -> DataFrame:
    return neighbour_fingerprints(docs.select("doc_id", "text"))
