"""Target-distribution importance resampling over hashed features.

A document's features are its runs of consecutive words; each falls into a bucket by the CRC-32 of
its bytes. The checksums of a batch come from matrices: distinct features of equal length are the
rows of a two-dimensional byte array, all checksums advance one column at a time, and the buckets
are scattered back to where the features stand. Features over `BLOCK` bytes are cut into rows of
that size, whose checksums are put together afterwards, so no column is ever visited for one row.

Bucket counts of the corpus and of the target texts give every bucket a gain (its log ratio, in
thousandths); a document's weight is the floored mean of its features' gains. Adding Gumbel noise that depends on
the id alone and keeping the highest scores draws without replacement in proportion to the weights.

Texts are read once: a table holds the buckets of every document; counts, weights and ranks come
from it. What the driver sees are the counts of the `buckets` buckets, and one row per partition of
the ranking. The ranking is a range partitioning by score, so no task holds all documents.

Defined results: a null or empty text has no features, weight 0 and is never drawn; a null id hashes
as the empty string and comes before others of its score; rows that repeat an id are documents of
their own with the same noise (ties by the number of features); an empty target leaves gains that
only smooth; an empty table gives an empty result; extra columns are carried along.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaptrack.llm.common import batch_rows, col, fresh, written
from snaptrack.llm.words import PATTERN, UPPER, Words, distinct, gathered, groups

LONGEST, BUCKETS, SEED, PERCENT, LEAST_WORDS = 1, 10_000, 2024, 10, 20
#: The reflected polynomial of CRC-32.
POLYNOMIAL, ONES = 0xEDB88320, 0xFFFFFFFF
#: Columns of a matrix, and bytes in one go.
BLOCK, AT_ONCE = 64, 1 << 20


@lru_cache(maxsize=1)
def byte_table() -> np.ndarray:
    """What each byte does to an empty register."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return table


@lru_cache(maxsize=1)
def block_tables() -> list[list[int]]:
    """What `BLOCK` zero bytes make of a register, by each of its four bytes."""
    registers = (np.arange(256, dtype=np.uint32)[None] << (np.uint32(8) * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    table = byte_table()
    for _ in range(BLOCK):
        registers = table[registers & np.uint32(255)] ^ (registers >> np.uint32(8))
    return registers.reshape(4, 256).tolist()


def _registers(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: int) -> np.ndarray:
    """Registers after the bytes of each string, from `first` on: a matrix for each length."""
    table, found = byte_table(), np.full(len(starts), first, np.uint32)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for equal in np.split(order, cuts):
        length = int(lengths[equal[0]]) if len(equal) else 0
        if not length:
            continue
        for low in range(0, len(equal), max(1, AT_ONCE // length)):
            own = equal[low : low + max(1, AT_ONCE // length)]
            columns = data[starts[own] + np.arange(length)[:, None]]  # a row of it is a column of the strings
            registers = found[own]
            for column in columns:
                registers = table[(registers ^ column) & np.uint32(255)] ^ (registers >> np.uint32(8))
            found[own] = registers
    return found


def crc32s(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The CRC-32 of strings that lie end to end."""
    starts, lengths = offsets[:-1], np.diff(offsets)
    blocks = np.where(lengths > BLOCK, lengths // BLOCK, 0)
    head = lengths - blocks * BLOCK
    found = _registers(data, starts, head, ONES)
    long = np.flatnonzero(blocks)
    if len(long):
        ends = np.cumsum(blocks[long])
        place = np.arange(ends[-1]) - np.repeat(ends - blocks[long], blocks[long])
        at = np.repeat(starts[long] + head[long], blocks[long]) + BLOCK * place
        each = _registers(data, at, np.full(len(at), BLOCK), 0).tolist()
        a, b, c, d = block_tables()
        for k, low, high in zip(long.tolist(), (ends - blocks[long]).tolist(), ends.tolist(), strict=True):
            r = int(found[k])
            for own in each[low:high]:
                r = a[r & 255] ^ b[r >> 8 & 255] ^ c[r >> 16 & 255] ^ d[r >> 24] ^ own
            found[k] = r
    return found ^ np.uint32(ONES)


def feature_buckets(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets of all features of the texts, how many each text has, and its words."""
    words = Words(texts)
    spaced, starts = words.spaced() if longest > 1 else (words.data, words.offsets)
    found, owner = [], []
    texts_of = np.repeat(np.arange(len(texts)), words.counts)
    for size in range(1, longest + 1):
        if longest == 1:
            numbers, data, offsets = words.distinct()
            owner.append(texts_of)
        else:
            first = words.runs(size)
            numbers, data, offsets = distinct(*gathered(spaced, starts[first], starts[first + size] - 1))
            owner.append(texts_of[first])
        found.append((crc32s(data, offsets) % np.uint32(buckets)).astype(np.int32)[numbers])
    if longest > 1:
        order = np.argsort(np.concatenate(owner), kind="stable")
        found, owner = [np.concatenate(found)[order]], [np.concatenate(owner)[order]]
    return found[0], np.bincount(owner[0], minlength=len(texts)), words.counts


def hashed(docs: DataFrame, text_col: str, longest: int, buckets: int, into: str) -> DataFrame:
    """`docs` with a struct `into` of n_words and the buckets of a text's features."""

    @F.arrow_udf("n_words long, buckets array<int>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            own = [feature_buckets(texts, longest, buckets) for _, texts in groups(batch)]
            values = np.concatenate([np.empty(0, np.int32), *(o[0] for o in own)])
            sizes = np.concatenate([np.empty(0, np.int64), *(o[1] for o in own)])
            n_words = np.concatenate([np.empty(0, np.int64), *(o[2] for o in own)])
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values))
            yield pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), lists], ["n_words", "buckets"])

    batch_rows(docs.sparkSession)
    return docs.withColumn(into, features(col(text_col)))


def bucket_counts(features: DataFrame, buckets: int) -> list[int]:
    """How many features each bucket holds: partial sums per task, at most `buckets` rows here."""
    found = [0] * buckets
    for r in features.select(F.explode("buckets").alias("bucket")).groupBy("bucket").count().collect():
        found[r["bucket"]] = r["count"]
    return found


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """The log ratio of every bucket's share of the target and of the corpus, in floored thousandths."""
    s_all, t_all, n = sum(corpus), sum(target), len(corpus)
    return [
        math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n)))) for s, t in zip(corpus, target, strict=True)
    ]


def ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """(place, rank) of the drawn: the share of highest scores among rows with enough words.

    Rows are range-partitioned and sorted; a row's rank is its place in its partition after the
    rows of all partitions before.
    """
    own = scored.filter(F.col("n_words") >= least_words).select(
        "place", "score", "id", "n_features"
    )
    order = [F.desc("score"), F.asc_nulls_first("id"), F.desc("n_features"), F.asc("place")]
    rows = written(
        own.repartitionByRange(*order).sortWithinPartitions(*order).select("place", F.monotonically_increasing_id().alias("at")),
        "ranked",
    )
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    # One row a partition.
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("part")) - F.col("rows")
    shift = sizes.select("part", before.alias("before"), F.sum("rows").over(Window.partitionBy()).alias("all_rows"))
    rank = F.col("before") + inside + 1
    return rows.withColumn("part", part).join(F.broadcast(shift), "part").filter(
        rank * 100 <= F.col("all_rows") * percent
    ).select(F.col("place").alias("drawn"), rank.cast("long").alias("rank"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Sequence[str] | None = None,
    into: str = "resampled",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """`docs` (columns `keep`, by default all) with a struct `into`: n_features, weight, score and, for
    the `percent` of the documents of at least `least_words` words that are drawn, the rank."""
    keep = docs.columns if keep is None else list(keep)
    features = fresh(docs, "features")
    noise = F.conv(
        F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(col(id_col).cast("string"), F.lit(""))), 256), 1, 8), 16, 10
    ).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((noise + 0.5) / 4294967296.0)))
    table = written(
        hashed(docs, text_col, longest, buckets, features).select(
            F.struct(*(col(c) for c in keep)).alias("row"), col(id_col).alias("id"),
            gumbel.cast("long").alias("noise"), F.monotonically_increasing_id().alias("place"), f"{features}.*",
        ),
        "features",
    )
    wanted = hashed(target, text_col, longest, buckets, (own := fresh(target, "features"))).select(f"{own}.*")
    gain = np.array(gains(bucket_counts(table, buckets), bucket_counts(wanted, buckets)), np.int64)

    @F.arrow_udf("long")
    def weights(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.append(0, np.cumsum(gain[lists.flatten().to_numpy(zero_copy_only=False)]))
            ends = np.cumsum(sizes)
            yield pa.array((sums[ends] - sums[ends - sizes]) // np.maximum(sizes, 1))

    scored = table.select(
        "row", "id", "place", "n_words", F.size("buckets").cast("long").alias("n_features"), "noise",
        weights("buckets").alias("weight"),
    ).withColumn("score", F.col("weight") + F.col("noise"))
    scored = written(scored.drop("noise"), "scored")
    drawn = ranked(scored, percent, least_words)
    outcome = F.struct("n_features", "weight", "score", "rank").alias(fresh(docs.select(*(col(c) for c in keep)), into))
    return scored.join(drawn, F.col("place") == F.col("drawn"), "left").select("row.*", outcome)


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents, with all their columns."""
    found = resample(docs, target, **options)
    return found.filter(F.col(found.columns[-1])["rank"].isNotNull()).drop(found.columns[-1])


def op12(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = resample(docs.select("doc_id", "text"), benchmark.select("text"), keep=["doc_id"])
    return found.select("doc_id", *(f"resampled.{c}" for c in ("n_features", "weight", "score", "rank")))


def _words_sql(text: str) -> str:
    return f"coalesce(regexp_extract_all(translate({text}, '{UPPER}', '{UPPER.lower()}'), '{PATTERN}'), [])"


ORACLE = rf"""
  WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_words_sql("text")} AS w FROM documents),
    o AS MATERIALIZED (SELECT unnest({_words_sql("text")}) AS word FROM benchmark),
    f AS MATERIALIZED (SELECT rid, unnest(w) AS word FROM d),
    steps AS (
      SELECT b, b::BIGINT AS c, 0 AS k FROM (SELECT unnest(range(256)) AS b)
      UNION ALL SELECT b, xor(c >> 1, CASE WHEN c % 2 = 1 THEN {POLYNOMIAL} ELSE 0 END), k + 1 FROM steps WHERE k < 8),
    crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
    letters AS MATERIALIZED (
      SELECT word, list_transform(range(1, len(h) + 1, 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT) AS bytes
      FROM (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM f UNION SELECT word FROM o))),
    coded AS MATERIALIZED (
      SELECT word, xor(list_reduce(list_prepend({ONES}::BIGINT, bytes), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), {ONES}) % 10000 AS bucket
      FROM letters, crc),
    s AS (SELECT bucket, count(*) AS s FROM f JOIN coded USING (word) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS t FROM o JOIN coded USING (word) GROUP BY bucket),
    totals AS (SELECT (SELECT count(*) FROM f) AS s_all, (SELECT count(*) FROM o) AS t_all),
    gain AS MATERIALIZED (
      SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))::DOUBLE))::BIGINT AS gain
      FROM s LEFT JOIN t USING (bucket), totals),
    weights AS (SELECT rid, floor(sum(gain) / count(*)::DOUBLE)::BIGINT AS weight FROM f JOIN coded USING (word) JOIN gain USING (bucket) GROUP BY rid),
    scored AS (
      SELECT rid, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
      FROM d LEFT JOIN weights USING (rid)),
    placed AS (
      SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n_features DESC) AS rank, count(*) OVER () AS n
      FROM scored WHERE n_features >= {LEAST_WORDS})
  SELECT doc_id, n_features, weight, score, CASE WHEN rank * 100 <= n * {PERCENT} THEN rank END AS rank
  FROM scored LEFT JOIN placed USING (rid)"""
