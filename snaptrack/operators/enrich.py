"""Fill entities from a keyed record cache and from a gazetteer.

Lookups are made once per distinct key and joined back, so their cost follows the number of
keys, not the number of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrack import constants as K
from snaptrack.functions.geo import format_coordinate
from snaptrack.functions.text import (
    first_token, is_blank, normalise, or_empty, strip,
)
from snaptrack.operators.joins import lookup_join
from snaptrack.schemas import RECORD_COLUMNS

_TRIPLE = ("g_municipality", "g_province", "g_region")
# Fields of a record that tell a place.
_PLACE = ("municipalities", "province")


def wanted_keys(rows: DataFrame, tag: str | None = "tag") -> DataFrame:
    """Distinct usable project keys of rows the user has not denied."""
    if tag is not None:
        rows = rows.where(or_empty(F.col(tag)) != K.TAG_DENIED)
    key = strip(F.col("project_key"))
    return rows.where(~is_blank(F.col("project_key"))).select(key.alias("project_key")).distinct()


def worklist(rows: DataFrame, force: bool = False, keys: DataFrame | None = None) -> DataFrame:
    """Per row: is its project requested, and does it then need the record, a coordinate, nothing?

    `keys` (project_key, distinct) are the requested projects; all are without. Whatever a row's own
    tag, it is its project that counts. Rows of other projects stay, with every flag false.
    """
    if keys is None:
        rows = rows.withColumn("requested", F.lit(True))
    else:
        wanted = keys.select(F.col("project_key").alias("k_wanted"), F.lit(True).alias("_wanted"))
        keyed = rows.withColumn("k_wanted", strip(F.col("project_key")))
        found = F.coalesce("_wanted", F.lit(False)).alias("requested")
        rows = lookup_join(keyed, wanted, ["k_wanted"]).select(*rows.columns, found)
    always, requested = F.lit(force), F.col("requested")
    record = always | is_blank(F.col("official_name"))
    coordinate = always | is_blank(F.col("coordinate"), K.BLANK_COORDINATE)
    return rows.withColumns(
        {
            "needs_record": requested & record,
            "needs_coordinate": requested & coordinate,
            "complete": requested & ~record & ~coordinate,
        }
    )


def empty_record(columns: tuple[str, ...] = RECORD_COLUMNS) -> Column:
    """Does a fetched record hold nothing at all?"""
    blank = [is_blank(F.col(c)) for c in columns]
    return reduce(Column.__and__, blank)


def worklist_counters(flagged: DataFrame) -> DataFrame:
    """Rows of requested projects, rows and distinct keys that need a record, rows without a coordinate.

    Grouping by key first keeps the distinct count a plain sum over keys.
    """
    per_key = flagged.where("requested").groupBy(strip(F.col("project_key")).alias("k")).agg(
        F.count("*").alias("rows"),
        F.count_if("needs_record").alias("record"),
        F.count_if("needs_coordinate").alias("coordinate"),
        F.count_if("complete").alias("complete"),
    )

    def total(c: str | Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    return per_key.agg(
        total("rows").alias("rows_touched"),
        total("record").alias("rows_need_record"),
        total((F.col("record") > 0).cast("long")).alias("keys_need_record"),
        total("coordinate").alias("rows_need_coordinate"),
        total("complete").alias("rows_complete"),
    )


def missing_keys(keys: DataFrame, cache: DataFrame, on: str = "project_key") -> DataFrame:
    """Distinct keys the cache does not hold."""
    return keys.select(on).distinct().join(cache.select(on), on, "left_anti")


def upsert_cache(
    cache: DataFrame, fetched: DataFrame, is_empty: Column, on: str = "project_key"
) -> DataFrame:
    """Cache with fetched records in place of older ones; empty results are not stored.

    A key whose new result is empty keeps its older record. Both inputs hold one row per key.
    """
    found = fetched.where(~is_empty)
    return cache.join(found.select(on), on, "left_anti").unionByName(found)


def safe_write(
    flagged: DataFrame, cache: DataFrame, columns: tuple[str, ...] = RECORD_COLUMNS, place: bool = False
) -> DataFrame:
    """Write non-blank cached fields into rows that need the record; adds `fields_written`.

    The cache holds one row per project key. With `place`, the fields of the cache that tell a place stay beside
    the row for `with_lookup_place`, which then need not join the cache again.
    """
    record = cache.select(
        F.col("project_key").alias("k_record"), *[F.col(c).alias(f"c_{c}") for c in columns]
    )
    keyed = flagged.withColumn("k_record", strip(F.col("project_key")))
    joined = lookup_join(keyed, record, ["k_record"])

    def writes(c: str) -> Column:
        return F.col("needs_record") & ~is_blank(F.col(f"c_{c}"))

    written = sum([writes(c).cast("long") for c in columns], F.lit(0).cast("long"))
    others = [c for c in flagged.columns if c not in columns]
    return joined.select(
        *others,
        *[F.when(writes(c), F.col(f"c_{c}")).otherwise(F.col(c)).alias(c) for c in columns],
        written.alias("fields_written"),
        *[F.col(f"c_{c}") for c in _PLACE if place],
    )


def with_lookup_place(rows: DataFrame, cache: DataFrame | None = None) -> DataFrame:
    """Add the place to look up: first municipality, province, region; the cache comes first, with its fields as
    `safe_write` left them in the rows or else by a join."""
    beside = [f"c_{c}" for c in _PLACE]
    if cache is not None:
        if set(beside) <= set(rows.columns):
            joined = rows
        else:
            place = cache.select(F.col("project_key").alias("k_place"), *[F.col(c).alias(f"c_{c}") for c in _PLACE])
            keyed = rows.withColumn("k_place", strip(F.col("project_key")))
            joined = lookup_join(keyed, place, ["k_place"])

        def source(c: str) -> Column:
            return F.when(F.col(f"c_{c}") != "", F.col(f"c_{c}")).otherwise(F.col(c))
    else:
        joined = rows

        def source(c: str) -> Column:
            return F.col(c)

    return joined.select(
        *[c for c in rows.columns if c not in beside],
        F.lower(first_token(source("municipalities"))).alias("g_municipality"),
        normalise(source("province")).alias("g_province"),
        normalise(F.col("region")).alias("g_region"),
    )


def _level(n: int, first: Column, second: Column) -> Column:
    return F.struct(F.lit(n).alias("level"), first.alias("k1"), second.alias("k2"))


def gazetteer_index(gazetteer: DataFrame) -> DataFrame:
    """First gazetteer hit (by `rank`) of every key at every level of detail.

    Levels: 1 municipality + province, 2 municipality + region, 3 municipality, 4 province.
    """
    municipality = normalise(F.col("municipality"))
    province, region = normalise(F.col("province")), normalise(F.col("region"))
    nothing = F.lit("")
    levels = F.array(
        _level(1, municipality, province),
        _level(2, municipality, region),
        _level(3, municipality, nothing),
        _level(4, province, nothing),
    )
    hit = F.min(F.struct("rank", "lat", "lng"))
    return (
        gazetteer.select(F.explode(levels).alias("l"), "rank", "lat", "lng")
        .select("l.*", "rank", "lat", "lng")
        .where(F.col("k1") != "")
        .groupBy("level", "k1", "k2")
        .agg(hit.alias("hit"))
        .select("level", "k1", "k2", format_coordinate(F.col("hit.lat"), F.col("hit.lng")).alias("found"))
        .where(F.col("found") != "")
    )


def look_up_places(places: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Coordinate of every distinct place, from the most detailed level that has one."""
    municipality, province, region = (F.col(c) for c in _TRIPLE)
    nothing = F.lit("")
    levels = F.array_compact(
        F.array(
            F.when((municipality != "") & (province != ""), _level(1, municipality, province)),
            F.when((municipality != "") & (region != ""), _level(2, municipality, region)),
            F.when(municipality != "", _level(3, municipality, nothing)),
            F.when((municipality == "") & (province != ""), _level(4, province, nothing)),
        )
    )
    tried = places.select(*_TRIPLE).distinct().select(*_TRIPLE, F.explode(levels).alias("l"))
    hits = lookup_join(
        tried.select(*_TRIPLE, "l.*"), gazetteer_index(gazetteer), ["level", "k1", "k2"], "inner"
    )
    return hits.groupBy(*_TRIPLE).agg(F.min_by("found", "level").alias("found"))


def fill_coordinates(flagged: DataFrame, gazetteer: DataFrame, cache: DataFrame | None = None) -> DataFrame:
    """Fill the coordinate of rows that need one; adds `coordinate_found`."""
    placed = with_lookup_place(flagged, cache)
    found = look_up_places(placed.where(F.col("needs_coordinate")), gazetteer)
    joined = lookup_join(placed, found, _TRIPLE)
    hit = F.col("needs_coordinate") & F.col("found").isNotNull()
    others = [c for c in placed.columns if c not in ("coordinate", *_TRIPLE)]
    return joined.select(
        *others,
        F.when(hit, F.col("found")).otherwise(F.col("coordinate")).alias("coordinate"),
        hit.alias("coordinate_found"),
    )
