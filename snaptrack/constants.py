"""Fixed values that results depend on.

Everything here is part of the data contract (texts stored in tables, texts found in source
files, business thresholds). Functions take these as defaults and accept others.
"""

# Lifecycle labels.
LABEL_NEW = "Obra Nueva"
LABEL_DONE = "Obra Conclusa"
LABEL_PROBABLY_DONE = "Obra Conclusa (probable)"
LABEL_GONE = "Obra Desaparecida"
LABELS = (LABEL_NEW, LABEL_DONE, LABEL_PROBABLY_DONE, LABEL_GONE)

# Last known progress (percent) from which a vanished entity counts as finished.
DONE_AT = 100.0
PROBABLY_DONE_AT = 80.0

# User-owned tags and how they are shown.
TAG_OPEN = ""
TAG_TO_LOAD = "Da caricare"
TAG_LOADED = "In VTiger"
TAG_DENIED = "Non interessa"
TAGS = (TAG_OPEN, TAG_TO_LOAD, TAG_LOADED, TAG_DENIED)
TAG_DISPLAY = {
    TAG_OPEN: "Da valutare",
    TAG_TO_LOAD: "Da caricare",
    TAG_LOADED: "In VTiger",
    TAG_DENIED: "Non interessa",
}
TAG_ALL_DISPLAY = "Tutte"
# Spellings of "yes" in the legacy boolean flag that preceded the tags.
LEGACY_TRUE = ("si", "sì", "true", "1", "yes")

# Texts that mean "no value" in text columns.
BLANK_TEXTS = ("", "None", "nan")
BLANK_AMOUNT = "null"
# A raw amount written like this is no amount.
ZERO_AMOUNTS = ("0", "0.0")
BLANK_COORDINATE = "0.000000, 0.000000"

# Source scope and limits.
REGIONS = ("Sicilia", "Basilicata", "Puglia", "Calabria", "Molise", "Campania")
MIN_AMOUNT = 10_000_000.0
RETAINED_RUNS = 5
SHOWN_RUNS = 3
MIN_FILE_BYTES = 50
DESCRIPTION_LENGTH = 140

# Formats and patterns.
RUN_PREFIX = "Avanz_"
PROJECT_KEY_PATTERN = r"^[A-Z]\d{2}[A-Z]\d{11}$"
MAP_LINK = "https://www.google.com/maps?q="

# Landmarks on a registry page.
TITLE_MARKER = "Dettaglio Progetto"
TITLE_SKIP = "CUP:"
TITLE_SKIP_WORD = "version"
TITLE_WINDOW = 7
TITLE_MIN_LENGTH = 10
LINKED_PATTERN = r"(?i)(\d+)\s*(?:CUP\s+)?collegat"
# Record field -> label line on the page.
PAGE_LABELS = {
    "decision_year": "Anno decisione",
    "province": "Provincia",
    "municipalities": "Comune",
    "typology": "Tipologia",
    "sector": "Settore",
    "subsector": "Sottosettore",
}
CATEGORY_LABEL = "Categoria"

# Headers of landed snapshot files -> snapshot column.
SNAPSHOT_HEADERS = {
    "Id_ANAS": "work_id",
    "Regione": "region",
    "Codice_Strada": "road_code",
    "Nome_Strada": "road_name",
    "Cup": "project_key",
    "Descrizione": "description",
    "Tipo_Lavoro": "work_type",
    "Impresa": "contractor",
    "Importo_Principale": "amount_main",
    "Importo_Totale": "amount_total",
    "Data_Consegna_Impresa": "delivered_on",
    "Avanzamento_Lavori": "progress",
    "Data_Ultimazione_Prevista": "due_on",
    "Dal_Km": "km_from",
    "Al_Km": "km_to",
    "Strade_Segmentos": "segments",
    "Coordinate": "coordinate",
    "Nome_Ufficiale_Progetto": "official_name",
    "Anno_Decisione": "decision_year",
    "Provincia_CUP": "province",
    "Municipi_Coinvolti": "municipalities",
    "Tipologia": "typology",
    "Settore": "sector",
    "Sottosettore": "subsector",
    "Categoria_Settore": "sector_category",
    "Cup_Padre": "parent_key",
    "Progetti_Collegati_CUP": "linked_keys",
}

# Field names of the cached registry record -> entity column.
CACHE_FIELDS = {
    "Nome_Ufficiale_Progetto": "official_name",
    "Anno_Decisione": "decision_year",
    "Provincia": "province",
    "Municipi_Coinvolti": "municipalities",
    "Tipologia": "typology",
    "Settore": "sector",
    "Sottosettore": "subsector",
    "Categoria_Settore": "sector_category",
    "Cup_Padre": "parent_key",
    "Progetti_Collegati_CUP": "linked_keys",
}
