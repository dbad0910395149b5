"""Benchmark decontamination: a prefix-filtered set join of documents with windows of benchmark items.

An item's windows are its runs of `WINDOW` words (an item of fewer words is one window); a window is
the set of its shingles, runs of `SHINGLE` words. A document holds a window only if it holds all
shingles, so the necessary prefix of a window, its shingles ordered from rare to frequent, is the
first one. Documents are read twice: once to count the benchmark's shingles in the corpus, once to
find the prefixes. Windows whose rarest shingle no document holds are gone after the first time.

A place where a document has a prefix is joined with the windows of that prefix. The place must
leave room for the words before the shingle (positional bound) and for the rest of the window
(length bound), and the words there must be the window's, compared as text. Both passes look shingles
up in a bit filter of at most `MOST_BITS` bits, which only saves rows; the join decides.

The join is a plain one: Spark broadcasts the windows only if it measures them below its threshold
and otherwise shuffles, splitting hot shingles; verified places are written before they are
grouped by document. A row sent for a place holds at most 2 * `WINDOW` + `SHINGLE` words.

Defined results: a null or empty text, or one without a word, has no words and is never hit; items
without a word have no window; rows that repeat an item_id are one item with several texts, a null
item_id is the item ''; rows that repeat a doc_id, also null ones, are documents of their own; empty
tables give an empty result, or no hits; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaptrack.llm.common import batch_rows, col, written
from snaptrack.llm.words import PATTERN, UPPER, Words, groups

WINDOW, SHINGLE = 10, 3
#: Bits of the filter: so many for a shingle, and in all.
BITS_EACH, MOST_BITS = 32, 1 << 26
#: Rows in one Arrow batch of places.
ROWS = 4096


class Filter:
    """Bits of hashed shingles: none is missed, few others pass."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes & np.uint64(len(self.bits) * 8 - 1)).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def bit_filter(shingles: DataFrame) -> Filter:
    """The filter of a table of distinct shingles (column `shingle`); its size is bounded, and so is
    what reaches the driver: one bitmap for each 32,768 bits."""
    n = shingles.count()
    bits = min(MOST_BITS, max(1 << 15, 1 << ceil(log2(max(n, 1) * BITS_EACH))))
    place = F.col("shingle").bitwiseAND(bits - 1) + 1
    maps = shingles.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    found = np.zeros(bits // 8, np.uint8)
    for r in maps.collect():
        own = np.frombuffer(bytes(r["bits"]), np.uint8)
        found[(r["bucket"] - 1) * len(own) : r["bucket"] * len(own)] = own
    return Filter(found)


def _shingles(words: Words, hashes: np.ndarray, sizes: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The first words of all runs of each size, and their hashes."""
    for size in sizes:
        starts = words.runs(size)
        yield starts, words.run_hashes(hashes, starts, size), size


def windows(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """One row per item and window: item, text (words joined by a blank), size, shingles in order."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch.column(1)):
                words = Words(texts)
                hashes, counts = words.hashes(), words.counts
                spaced, at = words.spaced()
                for k in np.flatnonzero(counts).tolist():
                    size = min(window, int(counts[k]))
                    run = min(shingle, size)
                    starts = np.arange(words.firsts[k], words.firsts[k + 1] - size + 1)
                    own = words.run_hashes(hashes, np.arange(words.firsts[k], words.firsts[k + 1] - run + 1), run).view(np.int64)
                    for low in range(0, len(starts), ROWS):
                        part = starts[low : low + ROWS]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([batch.column(0)[first + k].as_py() or ""] * len(part), pa.string()),
                                pa.array([spaced[at[s] : at[s + size] - 1].tobytes().decode() for s in part.tolist()]),
                                pa.array(np.full(len(part), size), pa.int64()),
                                pa.array(list(np.lib.stride_tricks.sliding_window_view(own, size - run + 1)[low : low + ROWS]), pa.list_(pa.int64())),
                            ],
                            ["item", "text", "size", "shingles"],
                        )

    narrow = items.select(col(id_col).cast("string").alias("item"), col(text_col).alias("text"))
    return narrow.mapInArrow(rows, "item string, text string, size long, shingles array<long>")


def shingle_counts(docs: DataFrame, text_col: str, wanted: Filter, sizes: Sequence[int]) -> DataFrame:
    """(shingle, n): how often the corpus has the shingles that pass the filter; summed up in a batch first."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty(0, np.uint64)]
            for _, texts in groups(batch.column(0)):
                words = Words(texts)
                for _, own, _ in _shingles(words, words.hashes(), sizes):
                    found.append(own[wanted.holds(own)])
            shingles, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(shingles.view(np.int64)), pa.array(n, pa.int64())], ["shingle", "n"])

    counted = docs.select(col(text_col).alias("text")).mapInArrow(rows, "shingle long, n long")
    return counted.groupBy("shingle").agg(F.sum("n").alias("n"))


def places(docs: DataFrame, id_col: str, text_col: str, prefixes: Filter, sizes: Sequence[int], window: int) -> DataFrame:
    """Rows of two kinds: (place, id, n_words) for every document, and (place, at, shingle, before,
    words) wherever it has a shingle that passes the filter: its first word's number, and the words
    around it, `before` of them to its left."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["place", "id", "n_words", "at", "shingle", "before", "words"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids = batch.column(0)
            for low, texts in groups(batch.column(1)):
                words = Words(texts)
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place + np.arange(n)), ids.slice(low, n), pa.array(words.counts, pa.int64())]
                    + [pa.nulls(n, pa.int64())] * 3 + [pa.nulls(n, pa.string())], names,
                )
                owner, hashes = np.repeat(np.arange(n), words.counts), words.hashes()
                spaced, at = words.spaced()
                for starts, own, size in _shingles(words, hashes, sizes):
                    hit = wanted = np.flatnonzero(prefixes.holds(own))
                    for part in range(0, len(hit), ROWS):
                        wanted = hit[part : part + ROWS]
                        first = starts[wanted]
                        text = owner[first]
                        left = np.maximum(words.firsts[text], first - window + size)
                        right = np.minimum(words.firsts[text + 1], first + window)
                        m = len(wanted)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(place + text), pa.nulls(m, ids.type), pa.nulls(m, pa.int64()),
                                pa.array(first - words.firsts[text]), pa.array(own[wanted].view(np.int64)), pa.array(first - left),
                                pa.array([spaced[a:b].tobytes().decode() for a, b in zip(at[left].tolist(), (at[right] - 1).tolist(), strict=True)], pa.string()),
                            ],
                            names,
                        )
                place += n

    batch_rows(docs.sparkSession)
    return docs.select(col(id_col).alias("id"), col(text_col).alias("text")).mapInArrow(
        rows, f"place long, id {id_type}, n_words long, at long, shingle long, before long, words string"
    )


def find(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: documents (place, id, n_words), where they hold windows (place, start, size,
    window), and the windows' items (window, item)."""
    spark = docs.sparkSession
    of_items = written(windows(items, item_col, item_text_col, window, shingle), "item-windows")
    known = written(
        of_items.groupBy("text").agg(F.any_value("size").alias("size"), F.any_value("shingles").alias("shingles"))
        .withColumn("window", F.monotonically_increasing_id()), "windows",
    )
    # At most `shingle` lengths: shorter items are shingles as a whole.
    sizes = sorted(r[0] for r in known.select(F.least("size", F.lit(shingle)).cast("int")).distinct().collect())
    batch_rows(spark)
    shingles = known.select("window", F.posexplode("shingles").alias("offset", "shingle"))
    counts = written(shingle_counts(docs, text_col, bit_filter(shingles.select("shingle").distinct()), sizes), "shingle-counts")
    # The rarest shingle of each window; windows with a shingle that no document has go.
    rarity = shingles.join(counts, "shingle", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("shingle"), F.col("offset"))).alias("rarest")
    )
    prefixes = written(
        known.select("window", "text", "size").join(rarity.filter("rarest.n > 0"), "window")
        .select("window", F.col("text").alias("wanted"), "size", F.col("rarest.shingle").alias("prefix"), F.col("rarest.offset").cast("long").alias("offset")),
        "prefixes",
    )
    rare = bit_filter(prefixes.select(F.col("prefix").alias("shingle")).distinct())
    seen = written(places(docs, id_col, text_col, rare, sizes, window), "places")
    words = F.split("words", " ")
    start = F.col("before") - F.col("offset")
    room = (start >= 0) & (start + F.col("size") <= F.size(words))
    same = F.array_join(F.slice(words, (start + 1).cast("int"), F.col("size").cast("int")), " ") == F.col("wanted")
    hits = written(
        seen.filter("shingle IS NOT NULL").join(prefixes, F.col("shingle") == F.col("prefix"))
        .filter(F.when(room, same).otherwise(False))
        .select("place", (F.col("at") - F.col("offset")).alias("start"), "size", "window"),
        "hits",
    )
    return seen.filter("n_words IS NOT NULL").select("place", "id", "n_words"), hits, of_items.join(known.select("text", "window"), "text").select("window", "item").distinct()


def covered(hits: DataFrame) -> DataFrame:
    """(place, n_hit): how many words of a document lie inside any of its windows."""
    spans = hits.groupBy("place", "start").agg(F.max(F.col("start") + F.col("size")).alias("end"))
    before = F.max("end").over(Window.partitionBy("place").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    new = F.col("end") - F.greatest("start", F.coalesce(before, F.col("start")))
    return spans.withColumn("new", F.greatest(new, F.lit(0))).groupBy("place").agg(F.sum("new").alias("n_hit"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without a hit, with all their columns (an id counts as hit if any of its rows is)."""
    found, hits, _ = find(docs, items, id_col, text_col, **options)
    bad = found.join(hits.select("place").distinct(), "place", "left_semi").select(F.col("id").alias("hit_id")).distinct()
    return docs.join(bad, col(id_col).eqNullSafe(F.col("hit_id")), "left_anti")


def op11(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found, hits, items = find(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
    named = hits.select("place", "window").distinct().join(items, "window").groupBy("place").agg(
        F.array_sort(F.collect_set("item")).alias("items")
    )
    per_doc = covered(hits).join(named, "place").withColumnRenamed("place", "hit_place")
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return found.join(per_doc, F.col("place") == F.col("hit_place"), "left").select(
        F.col("id").alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def _words_sql(text: str) -> str:
    return f"coalesce(regexp_extract_all(translate({text}, '{UPPER}', '{UPPER.lower()}'), '{PATTERN}'), [])"


ORACLE = rf"""
  WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_words_sql("text")} AS w FROM documents),
    i AS MATERIALIZED (
      SELECT coalesce(item_id::VARCHAR, '') AS item, w, least(len(w), {WINDOW}) AS size
      FROM (SELECT item_id, {_words_sql("text")} AS w FROM benchmark) WHERE len(w) > 0),
    v AS MATERIALIZED (
      SELECT DISTINCT item, size, array_to_string(list_slice(w, k, k + size - 1), ' ') AS words
      FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k FROM i)),
    p AS (SELECT rid, size, k, array_to_string(list_slice(w, k, k + size - 1), ' ') AS words
      FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, (SELECT DISTINCT size FROM v) WHERE len(w) >= size)),
    hits AS MATERIALIZED (SELECT rid, k, size, item FROM p JOIN v USING (size, words)),
    covered AS (SELECT rid, count(DISTINCT word) AS n_hit FROM (SELECT rid, unnest(range(k, k + size)) AS word FROM (SELECT DISTINCT rid, k, size FROM hits)) GROUP BY rid),
    named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
  FROM d LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)"""
