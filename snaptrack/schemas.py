"""Explicit schemas of everything the package reads and stores."""

from __future__ import annotations

from pyspark.sql import types as T

from snaptrack.constants import CACHE_FIELDS


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


KEY = "work_id"
TAG = "tag"
PROGRESS = "progress"

RECORD_COLUMNS = tuple(CACHE_FIELDS.values())

# One snapshot file; `sources.snapshots.scan_csv` finds the columns by name.
SNAPSHOT_COLUMNS = (
    "work_id", "region", "road_code", "road_name", "project_key", "description", "work_type",
    "contractor", "amount_main", "amount_total", "delivered_on", "progress", "due_on",
    "km_from", "km_to", "segments", "coordinate", *RECORD_COLUMNS,
)
ENTITY_COLUMNS = (*[c for c in SNAPSHOT_COLUMNS if c != PROGRESS], TAG)
# What a newer snapshot may update: not the row key, not what the user owns.
MERGE_COLUMNS = tuple(c for c in ENTITY_COLUMNS if c not in (KEY, TAG))

SNAPSHOT = strings(*SNAPSHOT_COLUMNS)
SIGNATURE_COLUMNS = ("sig_project", "sig_region", "sig_id")

# Tables of the state.
ENTITIES = strings(*SIGNATURE_COLUMNS, *ENTITY_COLUMNS)
SNAPSHOT_ROWS = T.StructType(
    [*strings(*SIGNATURE_COLUMNS, *ENTITY_COLUMNS, PROGRESS).fields, T.StructField("run_ts", T.TimestampType())]
)
FACTS = T.StructType(
    [
        *strings(*SIGNATURE_COLUMNS).fields,
        T.StructField("present", T.BooleanType()),
        T.StructField("seen_before", T.BooleanType()),
        T.StructField("last_known", T.DoubleType()),
        T.StructField("pct_now", T.DoubleType()),
        T.StructField("now_known", T.BooleanType()),
        T.StructField("pct_before", T.DoubleType()),
    ]
)
# Per entity, of all runs behind the horizon: the newest run that counts with the entity and the newest
# in which its progress was known.
RECORDS = T.StructType(
    [
        *strings(*SIGNATURE_COLUMNS).fields,
        T.StructField("seen_at", T.TimestampType()),
        T.StructField("seen_pct", T.DoubleType()),
        T.StructField("known_at", T.TimestampType()),
        T.StructField("known_pct", T.DoubleType()),
    ]
)
# Snapshot rows of the runs behind the horizon, by stretches of runs in which nothing changed.
STRETCHES = T.StructType(
    [
        *strings(*SIGNATURE_COLUMNS, *ENTITY_COLUMNS, PROGRESS).fields,
        T.StructField("valid_from", T.TimestampType()),
        T.StructField("valid_to", T.TimestampType()),
        T.StructField("open", T.BooleanType()),
    ]
)
CACHE = strings("project_key", *RECORD_COLUMNS)


def with_sequence(schema: T.StructType) -> T.StructType:
    """A table read over all its numbered folders."""
    return T.StructType([*schema.fields, T.StructField("sequence", T.LongType())])

# Landed raw work, one JSON object per work with its road segments nested inside.
SEGMENT = strings("CODICE_STRADA", "DALKM", "ALKM")
RAW_WORK = T.StructType(
    [
        *strings(
            "id", "cup", "descrizione", "tipo_lavoro", "impresa", "importo_lav_principali",
            "importo_lav_totale", "data_consegna_impresa", "avanzamento_lavori", "ultimazione",
        ).fields,
        T.StructField("strade_list", T.ArrayType(SEGMENT)),
        # Numbers come quoted or not: read as text, converted by `project_snapshot`.
        *strings("lat", "lng", "_regione", "_strada_cod", "_strada_nome").fields,
    ]
)
CORRUPT = "_corrupt"
UNKNOWN = "_unknown"
# Fields of landed works that no column takes, per work of a run.
UNKNOWN_ROWS = T.StructType([*strings("work_id", "region").fields, T.StructField("fields", T.VariantType())])
RAW_ROAD = strings("codice", "strada")
RAW_MARKER = strings("id", "lat", "lng")

DENY_COLUMNS = ("project_key", "region", "contractor", "description", "added_on")
DENY_ENTRIES = strings(*DENY_COLUMNS)
DENY_DOCUMENT = T.StructType(
    [
        T.StructField(
            "entries", T.ArrayType(strings("cup", "regione", "impresa", "descrizione", "added_at"))
        ),
        T.StructField("cups", T.ArrayType(T.StringType())),
        T.StructField("ids", T.ArrayType(T.StringType())),
    ]
)

CACHE_RECORD = strings(*CACHE_FIELDS)
CACHE_DOCUMENT = T.MapType(T.StringType(), CACHE_RECORD)

COMMITS = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("run_ts", T.TimestampType()),
        T.StructField("run_date", T.DateType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("regions", T.StringType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("kept_rows", T.LongType()),
        T.StructField("corrupt_rows", T.LongType()),
        *[T.StructField(t, T.LongType()) for t in ("snapshots", "entities", "facts", "entries", "cache", "horizon", "stretches")],
        T.StructField("stretches_since", T.LongType()),
        T.StructField("horizon_ts", T.TimestampType()),
        T.StructField("quarantine", T.LongType()),
        T.StructField("quarantined_rows", T.LongType()),
        T.StructField("unknown", T.LongType()),
        T.StructField("unknown_fields", T.StringType()),
        T.StructField("sequence", T.LongType()),
    ]
)
