"""Raw landed files: works (with or without fields nobody knows yet), roads and markers per region, and
registry pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaptrack import constants as K
from snaptrack.functions.numbers import to_double
from snaptrack.functions.text import strip
from snaptrack.schemas import CORRUPT, RAW_MARKER, RAW_ROAD, RAW_WORK, UNKNOWN


_WORK_OR_TEXT = T.StructType([*RAW_WORK.fields, T.StructField(CORRUPT, T.StringType())])


def _json(spark: SparkSession, path: str, schema, multiline: bool) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def scan_works(
    spark: SparkSession, path: str, multiline: bool = False, regions: Sequence[str] = K.REGIONS
) -> DataFrame:
    """Works with their nested segments and, as `updated_at`, how fresh their file is.

    A missing region is taken from the file name '<REGION>.json' (or '.json.gz'), whose upper-case code stands for
    the name in `regions`. Lines that are no JSON keep their text in `_corrupt` and nothing else.
    `multiline` reads the landed form, one JSON array per file and so one task per file; JSON
    lines split freely and are the form to land at scale.
    """
    reader = spark.read.schema(_WORK_OR_TEXT).option("multiLine", multiline)
    return _with_region(reader.option("columnNameOfCorruptRecord", CORRUPT).json(path), regions)


def _with_region(works: DataFrame, regions: Sequence[str]) -> DataFrame:
    names = F.create_map(*[F.lit(x) for r in regions for x in (r.upper(), r)])
    named = F.regexp_extract(F.col("_metadata.file_name"), r"^([^/]*)\.json(?:\.gz)?$", 1)
    return works.select(
        *[c for c in works.columns if c not in ("_regione", "_metadata")],
        F.coalesce(F.col("_regione"), names[F.upper(named)], named).alias("_regione"),
        F.col("_metadata.file_modification_time").alias("updated_at"),
    )


def scan_works_open(
    spark: SparkSession, path: str, multiline: bool = False, regions: Sequence[str] = K.REGIONS
) -> DataFrame:
    """`scan_works` with, as the variant `_unknown`, an object of all fields that no column takes; null
    where there are none.

    The columns are those of `scan_works`, from the same text, which is read once and parsed twice. A
    record that names a field twice shows no unknown fields. Elements of an array are records
    of their own, also where one of them is broken.
    """
    lines = spark.read.text(path, wholetext=multiline).where(strip(F.col("value")) != "").select("value", "_metadata")
    if multiline:
        records = F.coalesce(F.from_json("value", "array<string>"), F.array("value"))
        lines = lines.select(F.explode(records).alias("value"), "_metadata")
    work = F.from_json("value", _WORK_OR_TEXT, {"columnNameOfCorruptRecord": CORRUPT})
    fields = F.try_parse_json("value").try_cast("map<string,variant>")
    others = F.map_filter(fields, lambda name, _: ~name.isin(*RAW_WORK.names))
    parsed = lines.select(work.alias("_work"), others.alias("_others"), "_metadata")
    unknown = F.when(F.size("_others") > 0, F.to_variant_object("_others")).alias(UNKNOWN)
    return _with_region(parsed.select("_work.*", unknown, "_metadata"), regions)


def drift(works: DataFrame, by: Sequence[str] = ("_regione",)) -> DataFrame:
    """Unknown fields of open works: per group and field its kind over all rows (VARIANT where kinds do not
    go together) and the number of rows with it."""
    fields = F.explode(F.col(UNKNOWN).try_cast("map<string,variant>")).alias("field", "value")
    return works.select(*by, fields).groupBy(*by, "field").agg(
        F.schema_of_variant_agg("value").alias("kind"), F.count("*").alias("rows")
    )


def unknown_fields() -> Column:
    """Names and kinds of all unknown fields of open works, as an aggregate; null if there are none."""
    kinds = F.schema_of_variant_agg(UNKNOWN)
    return F.when(F.count(UNKNOWN) > 0, kinds).alias("unknown_fields")


def scan_roads(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return _json(spark, path, RAW_ROAD, multiline).select(
        F.col("codice").alias("road_code"), F.col("strada").alias("road_name")
    )


def scan_markers(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    markers = _json(spark, path, RAW_MARKER, multiline)
    return markers.select("id", *[to_double(strip(F.col(c))).alias(c) for c in ("lat", "lng")])


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """One landed page per file, keyed by the file name without its ending."""
    pages = spark.read.text(path, wholetext=True)
    key = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    return pages.select(key.alias("project_key"), F.col("value").alias("html"))
