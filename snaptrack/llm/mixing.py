"""Mixing sources to target weights by Sainte-Laguë apportionment.

The words of a source are dealt to shards of about `SHARD_WORDS` words. Inside a shard the
documents lie end to end in a seeded order and are cut into blocks of `BLOCK_WORDS` words (the last
may be shorter). Seats are blocks: first the sources get seats by the highest quotients
target / (2k + 1), then each source's seats go to its shards by the quotients blocks / (2k + 1).
A shard with q seats and n blocks takes each block q div n times and q mod n blocks once more,
evenly spaced from a seeded start. So a document's share is plain arithmetic on its place in the
shard and no block is ever a row.

Only shards' tables are joined, and documents are only sorted inside shards, so a source that holds
a third of the rows is spread over its shards. The table of one row per source is ranked and dealt
seats in one task, which bounds the method: at most `SMALL_ROWS` sources are meant.

Defined results: a null or empty text has size 0 and takes 0 words; documents without any word
are kept with taken 0; a null source is a source of its own, the last in order; repeated rows are
documents of their own; an empty table gives an empty result; extra columns are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaptrack.llm.common import WORD, batch_rows, col, fresh, written

WORD_PATTERN = re.compile(WORD)

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: The mix's words as a share of all words, and how often a source's words may be used.
SHARE, REPEATS = 1.5, 2
BLOCK_WORDS, SHARD_WORDS, SEED = 32, 1 << 20, "mix"
#: Per-source tables of at most so many rows (below 10 MB) are broadcast, larger ones joined by shuffle.
SMALL_ROWS = 100_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source (columns source, size): its words, place, weight and target.

    With everything below its cap, targets are `level * weight`. The sources that reach the cap are
    those with the smallest cap / weight, so the level follows from running sums in that order.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = total.withColumn("place", F.row_number().over(order))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") - 1) % len(WEIGHTS) + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("cap", REPEATS * F.col("source_size"))
    ratio = F.col("cap") / F.col("weight")
    by_ratio = Window.orderBy(ratio, "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    levels = ranked.select(
        "*",
        (
            (SHARE * F.sum("source_size").over(everything)
             - F.coalesce(F.sum("cap").over(before), F.lit(0)))
            / F.sum("weight").over(rest)
        ).alias("level_here"),
    )
    # The first source in that order that stays below its cap sets the level.
    level = F.min(
        F.when(F.col("level_here") <= ratio, F.struct(ratio.alias("r"), "place", "level_here"))
    ).over(everything)["level_here"]
    target = F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("weight"), F.col("cap")))
    return levels.select("source", "source_size", "place", target.alias("target"))


def highest_quotients(
    cells: DataFrame, keys: list[str], votes: str, seats: str, order: str
) -> DataFrame:
    """Sainte-Laguë: `cells` with a column `quota` that deals `seats` inside each group of `keys`.

    With n cells, divisors that aim at n/2 seats less and more give each cell a lower and an
    upper bound that enclose the result and differ by 2n or so in all; only the quotients between
    are ranked. Ties go to the lower `order`.
    """
    group = Window.partitionBy(*keys)
    n, all_votes = F.count(F.lit(1)).over(group), F.sum(votes).over(group)

    def bound(aim: Column) -> Column:
        raw = F.floor(F.col(votes) * F.greatest(aim, F.lit(0.0)) / F.col("all_votes") + 0.5)
        return F.when(F.col("all_votes") > 0, raw).otherwise(0).cast("long")

    bounded = (
        cells.withColumn("n", n)
        .withColumn("all_votes", all_votes)
        .withColumn("low", F.when(F.col(seats) > F.col("n") / 2, bound(F.col(seats) - F.col("n") / 2)).otherwise(F.lit(0).cast("long")))
        .withColumn("high", bound(F.col(seats) + F.col("n") / 2) + F.when(F.col(votes) > 0, 1).otherwise(0))
    )
    open_seats = bounded.withColumn("open", F.col(seats) - F.sum("low").over(group))
    quotients = open_seats.filter("high > low").select(
        *keys, order, votes, "open", F.explode(F.sequence("low", F.col("high") - 1)).alias("k")
    )
    rank = F.row_number().over(
        Window.partitionBy(*keys).orderBy((F.col(votes) / (2 * F.col("k") + 1)).desc(), order, "k")
    )
    won = (
        quotients.withColumn("rank", rank)
        .filter(F.col("rank") <= F.col("open"))
        .groupBy(*keys, order)
        .agg(F.count(F.lit(1)).alias("won"))
    )
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*keys, order)]
    joined = open_seats.alias("a").join(won.alias("b"), on, "left")
    return joined.select(
        *(F.col(f"a.{c}") for c in cells.columns),
        (F.col("low") + F.coalesce("won", F.lit(0))).alias("quota"),
    )


def _hash(key: Column, what: str) -> Column:
    text = F.concat(F.lit(f"{SEED}:{what}:"), F.coalesce(key.cast("string"), F.lit("-")))
    return F.md5(text)


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    size: Column | None = None,
    into: str = "mix",
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """`docs` with a struct column `into` (renamed if the name is taken): what the mix takes.

    Fields: size, source_size, target, taken (words, repeats counted), start (the place of the
    document's first word in its shard) and the shard's rule: blocks, full, rest, offset.
    `size` is the expression for a document's words, by default the words of column `text`.
    """
    into, shard, sized = fresh(docs, into), fresh(docs, "mix_shard"), fresh(docs, "mix_size")
    size = words(col("text")) if size is None else size
    digest = _hash(col(id_col), "doc")
    narrow = written(
        docs.select(col(source_col).alias("source"), _number(digest).alias("h"), size.alias("size")),
        "mix-sizes",
    )
    sources = written(
        source_targets(narrow)
        .withColumn("shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))),
        "mix-sources",
    )
    small = _small(sources.select("source", "place", "shards"))
    blocks = F.ceil(F.sum("size") / block_words).alias("blocks")
    shards = (
        narrow.join(small, narrow["source"].eqNullSafe(small["source"]))
        .groupBy("place", (F.col("h") % F.col("shards")).alias("shard"))
        .agg(blocks)
    )
    seats = F.round(F.sum("target").over(Window.partitionBy(F.lit(0))) / block_words).cast("long")
    by_source = highest_quotients(
        sources.withColumn("seats", seats).withColumn("all", F.lit(0)), ["all"], "target", "seats", "place"
    )
    held = shards.groupBy("place").agg(F.sum("blocks").alias("held"))
    dealt = by_source.join(held, "place").select(
        F.col("place"), "source_size", "target",
        F.least("quota", REPEATS * F.col("held")).alias("seats"),
    )
    quotas = highest_quotients(shards.join(dealt, "place"), ["place"], "blocks", "seats", "shard")
    start_at = _number(_hash(F.concat_ws(":", "place", "shard"), "start")) % F.greatest("blocks", F.lit(1)) + 1
    rules = written(
        quotas.select(
            F.col("place").alias("p"), F.col("shard").alias("s"), "source_size", "target", "blocks",
            F.least("quota", REPEATS * F.col("blocks")).alias("q"), start_at.alias("offset"),
        ).select(
            "p", "s", "source_size", "target", "blocks", "offset",
            F.when(F.col("blocks") > 0, F.floor(F.col("q") / F.col("blocks"))).otherwise(0).cast("long").alias("full"),
            F.when(F.col("blocks") > 0, F.col("q") % F.col("blocks")).otherwise(0).cast("long").alias("rest"),
        ),
        "mix-rules",
    )
    named = small.select(F.col("source").alias("mix_s"), F.col("place").alias("mix_p"), F.col("shards").alias("mix_n"))
    placed = docs.withColumn(sized, size).alias("d").join(
        named.alias("n"), col(source_col).eqNullSafe(F.col("n.mix_s"))
    ).select(
        "d.*", F.struct(F.col("n.mix_p").alias("place"), (_number(digest) % F.col("n.mix_n")).alias("shard")).alias(shard)
    )
    in_shard = Window.partitionBy(F.col(shard)).orderBy(digest, col(id_col), F.col(sized))
    up_to = in_shard.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.sum(sized).over(up_to) - F.col(sized)
    placed = placed.withColumn(into, start)
    rules = rules.alias("r")
    joined = placed.alias("d").join(
        rules, (F.col(f"d.{shard}.place") == F.col("r.p")) & (F.col(f"d.{shard}.shard") == F.col("r.s"))
    )
    n, rest, offset = F.col("r.blocks"), F.col("r.rest"), F.col("r.offset")
    first = F.col(f"d.{into}")

    def spaced(i: Column) -> Column:
        return F.when(n > 0, F.floor(i * rest / n)).otherwise(0).cast("long")

    def chosen_before(word: Column) -> Column:
        """Words of the blocks taken once more among the shard's first `word` words."""
        block = F.floor(word / block_words)
        count = spaced(block + offset - 1) - spaced(offset - 1)
        here = spaced(block + offset) - spaced(block + offset - 1)
        return block_words * count + here * (word - block * block_words)

    taken = F.col("r.full") * F.col(f"d.{sized}") + chosen_before(first + F.col(f"d.{sized}")) - chosen_before(first)
    plan = F.struct(
        F.col(f"d.{sized}").alias("size"), F.col("r.source_size").alias("source_size"),
        F.col("r.target").alias("target"), taken.cast("long").alias("taken"), first.alias("start"),
        n.alias("blocks"), F.col("r.full").alias("full"), rest.alias("rest"), offset.alias("offset"),
    )
    kept = [F.col("d.`" + c.replace("`", "``") + "`") for c in docs.columns]
    return joined.select(*kept, plan.alias(into))


def taken_texts(text: str, plan: dict, block_words: int = BLOCK_WORDS) -> list[str]:
    """What the mix takes of a text: the whole text once for every full round, then the words of the
    blocks taken once more, runs of them (as they stand in the text) on lines of their own."""
    texts = [text] * plan["full"] if plan["size"] else []
    if not plan["rest"] or not plan["size"]:
        return texts
    n, rest, offset = plan["blocks"], plan["rest"], plan["offset"]
    spans = [m.span() for m in WORD_PATTERN.finditer(text)]
    runs, at, first = [], 0, plan["start"]
    while at < len(spans):
        block = (first + at) // block_words
        end = min(len(spans), (block + 1) * block_words - first)
        if (block + offset) * rest // n > (block + offset - 1) * rest // n:
            if runs and runs[-1][1] == at:
                runs[-1][1] = end
            else:
                runs.append([at, end])
        at = end
    if runs:
        texts.append("\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in runs))
    return texts


def apply(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """`docs` as the mix has them: a row for every time a document is taken, with the words taken.
    A column n_chars follows the text."""
    into, piece = fresh(docs, "mix"), fresh(docs, "mix_text")
    mixed = mix(docs, id_col, source_col, words(col(text_col)), into)

    @F.arrow_udf("array<string>")
    def texts_of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, plans in batches:
            found = [taken_texts(t or "", p) for t, p in zip(texts.to_pylist(), plans.to_pylist(), strict=True)]
            yield pa.array(found, pa.list_(pa.string()))

    batch_rows(docs.sparkSession)
    rows = mixed.withColumn(piece, F.explode(texts_of(col(text_col), F.col(into))))
    new = {text_col: F.col(piece)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(piece).cast(docs.schema["n_chars"].dataType)
    return rows.select(*(new[c].alias(c) if c in new else col(c) for c in docs.columns))


def op9(docs: DataFrame) -> DataFrame:
    mixed = mix(docs.select("doc_id", "source", "text"))
    return mixed.select(
        "doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken"
    )


def _quotient_sql(name: str, cells: str, keys: str, votes: str, seats: str, order: str) -> str:
    """The CTEs of `highest_quotients`; the result is CTE `{name}` with column quota."""
    return f"""
    {name}_b AS (
      SELECT *, CASE WHEN v > 0 AND st > n / 2 THEN floor(votes * greatest(st - n / 2, 0.0) / v + 0.5) ELSE 0 END::BIGINT AS low,
        CASE WHEN v > 0 THEN floor(votes * greatest(st + n / 2, 0.0) / v + 0.5) ELSE 0 END::BIGINT
          + CASE WHEN votes > 0 THEN 1 ELSE 0 END AS high
      FROM (SELECT *, {votes} AS votes, {seats} AS st, count(*) OVER (PARTITION BY {keys}) AS n,
              sum({votes}) OVER (PARTITION BY {keys}) AS v FROM {cells})),
    {name}_o AS (SELECT *, st - sum(low) OVER (PARTITION BY {keys}) AS open FROM {name}_b),
    {name}_q AS (SELECT {keys}, {order}, votes, open, unnest(range(low, high)) AS k FROM {name}_o WHERE high > low),
    {name}_w AS (
      SELECT {keys}, {order}, count(*) AS won FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY votes / (2 * k + 1) DESC, {order}, k) AS r FROM {name}_q)
      WHERE r <= open GROUP BY {keys}, {order}),
    {name} AS (SELECT o.*, (low + coalesce(won, 0))::BIGINT AS quota FROM {name}_o o LEFT JOIN {name}_w USING ({keys}, {order}))"""


def _number_sql(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


ORACLE_CTES = rf"""
    d AS (
      SELECT doc_id, source, text, lang, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        md5('{SEED}:doc:' || coalesce(doc_id::VARCHAR, '-')) AS dg,
        {_number_sql(f"'{SEED}:doc:' || coalesce(doc_id::VARCHAR, '-')")} AS h
      FROM documents),
    ranked AS (
      SELECT source, source_size, place, [5, 2, 1][((place - 1) % 3 + 1)::INTEGER] AS weight, 2 * source_size AS cap FROM (
        SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
        FROM d GROUP BY source)),
    levels AS (
      SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (
            ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
          / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level_here
      FROM ranked),
    sources AS (
      SELECT source, source_size, place, least(cap::DOUBLE, coalesce(weight * (
          SELECT level_here FROM levels WHERE level_here <= cap / weight ORDER BY cap / weight, place LIMIT 1), cap)) AS target,
        greatest(ceil(source_size / {SHARD_WORDS}), 1)::BIGINT AS shards
      FROM levels),
    shards AS (
      SELECT place, (h % shards)::BIGINT AS shard, ceil(sum(size) / {BLOCK_WORDS})::BIGINT AS blocks
      FROM d JOIN sources ON d.source IS NOT DISTINCT FROM sources.source GROUP BY ALL),
    seated AS (SELECT *, 0 AS one, round(sum(target) OVER () / {BLOCK_WORDS})::BIGINT AS seats FROM sources),
    {_quotient_sql("bysource", "seated", "one", "target", "seats", "place").strip()},
    dealt AS (
      SELECT place, source_size, target, least(quota, {REPEATS} * held) AS seats
      FROM bysource JOIN (SELECT place, sum(blocks)::BIGINT AS held FROM shards GROUP BY place) USING (place)),
    cells AS (SELECT * FROM shards JOIN dealt USING (place)),
    {_quotient_sql("byshard", "cells", "place", "blocks", "seats", "shard").strip()},
    rules AS (
      SELECT place, shard, source_size, target, blocks, start_at,
        CASE WHEN blocks > 0 THEN q // blocks ELSE 0 END AS full_times, CASE WHEN blocks > 0 THEN q % blocks ELSE 0 END AS rest
      FROM (SELECT *, least(quota, {REPEATS} * blocks) AS q,
          {_number_sql(f"'{SEED}:start:' || place || ':' || shard")} % greatest(blocks, 1) + 1 AS start_at FROM byshard)),
    placed AS (
      SELECT doc_id, d.source, text, lang, size, place, (h % shards)::BIGINT AS shard,
        (sum(size) OVER (PARTITION BY place, h % shards ORDER BY dg, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS first
      FROM d JOIN sources ON d.source IS NOT DISTINCT FROM sources.source),
    chosen AS (
      SELECT p.*, source_size, target, full_times, blocks, rest, start_at,
        CASE WHEN blocks > 0 THEN
          {BLOCK_WORDS} * ((((first + size) // {BLOCK_WORDS} + start_at - 1) * rest) // blocks)
          + (((((first + size) // {BLOCK_WORDS} + start_at) * rest) // blocks) - ((((first + size) // {BLOCK_WORDS} + start_at - 1) * rest) // blocks))
            * ((first + size) % {BLOCK_WORDS})
          - {BLOCK_WORDS} * (((first // {BLOCK_WORDS} + start_at - 1) * rest) // blocks)
          - ((((first // {BLOCK_WORDS} + start_at) * rest) // blocks) - (((first // {BLOCK_WORDS} + start_at - 1) * rest) // blocks))
            * (first % {BLOCK_WORDS})
        ELSE 0 END AS extra
      FROM placed p JOIN rules USING (place, shard))"""

ORACLE = f"""
  WITH {ORACLE_CTES}
  SELECT doc_id, size, source_size, target, (full_times * size + extra)::BIGINT AS taken FROM chosen"""
