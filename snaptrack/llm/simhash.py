"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints at `RADIUS` = 3 bits or fewer have a variant in common that is one bit away from
the one and at most two bits from the other. So every fingerprint emits itself and its 64 variants
at one bit, which meet for pairs up to two bits apart; at three bits one of the two has an odd
number of ones, and only those emit variants at two bits. Of three differing bits two lie in the
same half of the word, so two-bit variants inside a half are enough. Links come from equal variants,
are deduplicated and verified by their bit distance.

Variants are shuffled by cell, the value of some of their bits. Fingerprints travel instead of
variants: once to every cell that any of their variants lies in, and the cell's task writes out the
variants that belong there. A task's work is linear in its fingerprints: fingerprints that meet in
a variant are linked to the first of them, never pairwise, and a cell returns a spanning forest.
Cell bits are those that divide the fingerprints most evenly, as many as keep cells small.

Equal fingerprints are one node from the start, whatever the number of documents.

Defined results: a null or blank text has fingerprint 0 and is linked like any other; texts with
fewer than `k` words are one shingle; repeated rows are linked; a null id counts for nothing when
the smallest id is chosen; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaptrack.llm.common import batch_rows, col, fresh, written
from snaptrack.llm.components import components, local_roots

BITS, RADIUS, SHINGLE, HASH_SEED = 64, 3, 3, 42
#: Fingerprints that a cell is at home to on average, and at most before more bits are used.
CELL, CELL_MOST = 1 << 10, 1 << 14
MOST_CELL_BITS = 24
#: Variants tried at a time in a task.
STEP = 1 << 18


def simhash(text: str | None, k: int = SHINGLE) -> int:
    """The fingerprint, unsigned: bit b is 1 if set in over half of the shingles' hashes."""
    from xxhash import xxh64_intdigest

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not found:
        return 0
    n = max(len(found) - k + 1, 1)
    shingles = map(b" ".join, zip(*(found[i:] for i in range(k)))) if len(found) >= k else [b" ".join(found)]
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(HASH_SEED)), np.uint64, n)
    ones = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(0)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, k: int = SHINGLE) -> Column:
    """The fingerprint of a text as a long with the same 64 bits."""

    @F.arrow_udf("long")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = np.fromiter((simhash(t, k) for t in batch.to_pylist()), np.uint64, len(batch))
            yield pa.array(found.view(np.int64))

    return of(text)


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _bit(i: int) -> int:
    """Bit i of a word as a signed long."""
    return 1 << i if i < 63 else -(1 << 63)


def cell_bits(fps: DataFrame, n: int) -> list[int]:
    """Bits of the word that name a cell: the most even ones of both halves."""
    ones = fps.agg(*(F.sum(F.shiftrightunsigned("fp", i).bitwiseAND(F.lit(1).cast("long"))).alias(str(i)) for i in range(BITS))).first()
    even = [sorted(half, key=lambda i: abs((ones[i] or 0) - n / 2)) for half in (range(32), range(32, 64))]
    by_turns = [i for pair in zip(*even, strict=True) for i in pair]
    m = max(4, ceil(log2(max(n, 1) / CELL))) if n > CELL else 2
    while m < MOST_CELL_BITS:
        largest = fps.groupBy(_home(by_turns[:m])).count().agg(F.max("count")).first()[0] or 0
        if largest <= CELL_MOST:
            break
        m += 2
    return by_turns[: min(m, MOST_CELL_BITS)]


def _home(bits: list[int]) -> Column:
    parts = [
        F.shiftleft(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1).cast("long")), i) for i, b in enumerate(bits)
    ]
    home = parts[0]
    for p in parts[1:]:
        home = home.bitwiseOR(p)
    return home.cast("int")


def _same_half(a: int, b: int) -> bool:
    return a // 32 == b // 32


def cell_links(fps: np.ndarray, cell: int, bits: list[int]) -> np.ndarray:
    """Links (rows a, b: places in `fps`, distinct unsigned words) that meet in variants of the cell."""
    n, masks = len(fps), np.array([1 << b for b in range(BITS)], np.uint64)
    home = np.zeros(n, np.int64)
    for i, b in enumerate(bits):
        home |= ((fps >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << i
    away = home ^ cell
    # What must be flipped to come into the cell: a word, and how many bits that takes.
    toward = np.zeros(n, np.uint64)
    for i, b in enumerate(bits):
        toward |= ((away >> i) & 1).astype(np.uint64) << np.uint64(b)
    steps = np.bitwise_count(away)
    free = [b for b in range(BITS) if b not in set(bits)]
    at_home, one_off = np.flatnonzero(steps == 0), np.flatnonzero(steps == 1)
    variants = np.concatenate([
        fps[at_home],
        (fps[at_home][:, None] ^ masks[free][None, :]).ravel(),
        fps[one_off] ^ toward[one_off],
    ])
    owners = np.concatenate([at_home, np.repeat(at_home, len(free)), one_off])
    if not len(variants):
        return np.empty((0, 2), np.int64)
    order = np.argsort(variants, kind="stable")
    variants, owners = variants[order], owners[order]
    new = np.concatenate([[True], variants[1:] != variants[:-1]])
    values, first = variants[new], owners[new]
    leader = first[np.cumsum(new) - 1]
    links = [np.stack([leader[~new], owners[~new]], 1)]

    odd = np.bitwise_count(fps) % 2 == 1
    size = 1 << max(16, (4 * len(values)).bit_length())
    shift = np.uint64(64 - (size.bit_length() - 1))

    def slot(v: np.ndarray) -> np.ndarray:
        return (v * np.uint64(0x9E3779B97F4A7C15)) >> shift

    seen = np.zeros(size, bool)
    seen[slot(values)] = True

    def meet(own: np.ndarray, flips: np.ndarray) -> None:
        """Link `own` fingerprints with the leaders of their two-bit variants (one or a row of flips each)."""
        if not len(own) or not flips.size:
            return
        per = max(1, STEP // flips.shape[-1])
        for low in range(0, len(own), per):
            part = own[low : low + per]
            tried = fps[part][:, None] ^ (flips if len(flips) == 1 else flips[low : low + per])
            hit = np.flatnonzero(seen[slot(tried.ravel())])
            found = tried.ravel()[hit]
            place = np.minimum(np.searchsorted(values, found), len(values) - 1)
            real = values[place] == found
            links.append(np.stack([first[place[real]], part[hit[real] // tried.shape[1]]], 1))

    pairs = [masks[a] | masks[b] for a, b in combinations(free, 2) if _same_half(a, b)]
    meet(np.flatnonzero(odd & (steps == 0)), np.array([pairs], np.uint64))
    for b in bits:
        own = np.flatnonzero(odd & (steps == 1) & (toward == masks[b]))
        meet(own, np.array([[masks[b] | masks[f] for f in free if _same_half(b, f)]], np.uint64))
    two = np.flatnonzero(odd & (steps == 2))
    meet(two, toward[two][:, None])
    found = np.concatenate(links)
    found = np.unique(np.sort(found, 1), axis=0) if len(found) else found
    close = np.bitwise_count(fps[found[:, 0]] ^ fps[found[:, 1]]) <= RADIUS
    return found[close & (found[:, 0] != found[:, 1])]


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints (column fp) as all pairs within `RADIUS` bits do."""
    n = fps.count()
    bits = cell_bits(fps, n)
    singles = [0, *(1 << i for i in range(len(bits)))]
    doubles = [1 << i | 1 << j for i, j in combinations(range(len(bits)), 2) if _same_half(bits[i], bits[j])]
    odd = F.bit_count("fp") % 2 == 1
    to = F.when(odd, F.lit(singles + doubles)).otherwise(F.lit(singles))
    cells = fps.select("fp", F.explode(F.transform(to, lambda x: x.bitwiseXOR(_home(bits)))).alias("cell"))

    def forest(group: pa.Table) -> pa.Table:
        words = np.unique(group.column("fp").to_numpy()).view(np.uint64)
        pairs = cell_links(words, group.column("cell")[0].as_py(), bits)
        used, ends = np.unique(pairs, return_inverse=True)
        ends = ends.reshape(-1, 2)
        root = local_roots(len(used), ends[:, 0], ends[:, 1])
        own = np.flatnonzero(root != np.arange(len(root)))
        a, b = words[used[own].astype(np.int64)], words[used[root[own]].astype(np.int64)]
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return cells.groupBy("cell").applyInArrow(forest, "a long, b long")


def _labels(marked: DataFrame) -> DataFrame:
    """From written rows (id, fp): own (each fingerprint), component (one of its group's fingerprints), least (id)."""
    firsts = written(marked.groupBy("fp").agg(F.min("id").alias("first")), "simhash-fps")
    linked = components(links(firsts.select("fp")))
    joined = firsts.join(linked, firsts["fp"] == linked["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    joined = written(joined, "simhash-components")
    least = joined.groupBy("component").agg(F.min("first").alias("least"))
    return joined.join(least, "component").select(F.col("fp").alias("own"), "component", "least")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """One row per document: id, fp (long) and component, the smallest id its links reach."""
    batch_rows(docs.sparkSession)
    marked = written(docs.select(col(id_col).alias("id"), fingerprint(col(text_col), k).alias("fp")), "simhash")
    labels = _labels(marked)
    return marked.join(labels, marked["fp"] == labels["own"]).select("id", "fp", F.col("least").alias("component"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """One row of `docs` for each group: the one with the smallest id (a null id only if all are), and
    of rows with that id the first by a hash of the text and then by one of the whole row; of equal rows
    one. Texts are shuffled once, to the rows kept."""
    batch_rows(docs.sparkSession)
    plain = [col(f.name) for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    tie = F.struct(F.xxhash64(col(text_col)).alias("text"), F.xxhash64(*plain).alias("row"))
    marked = written(
        docs.select(col(id_col).alias("id"), tie.alias("tie"), fingerprint(col(text_col), k).alias("fp")), "simhash"
    )
    labels = _labels(marked.select("id", "fp"))
    one = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tie")).alias("one")
    kept = marked.join(labels, marked["fp"] == labels["own"]).groupBy("component").agg(one)
    kept = kept.select(F.col("one.id").alias("kept_id"), F.col("one.tie").alias("kept_tie"))
    own_id, own_tie = fresh(docs, "own_id"), fresh(docs, "own_tie")
    keyed = docs.withColumn(own_id, col(id_col)).withColumn(own_tie, tie)
    same = keyed[own_id].eqNullSafe(kept["kept_id"]) & (keyed[own_tie] == kept["kept_tie"])
    # Repeated rows share id and text; the join has brought them together.
    return keyed.join(kept, same, "left_semi").dropDuplicates([own_id, own_tie]).drop(own_id, own_tie)


def op6(docs: DataFrame) -> DataFrame:
    found = groups(docs.select("doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), hex_digits(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id")
    )
