"""Free-text search through the trigram index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrack.operators.trigrams import TrigramIndex
from snaptrack.plans import tables as t
from snaptrack.plans.queries_works import RUN_1, RUN_2, SQL_ENTITY_VIEW
from snaptrack.plans.registry import query
from snaptrack.plans.state import State, index_search, ingest_run
from snaptrack.sources.shared import new_folder

#: Words, alternatives, a group with a class beside it, an optional letter, and two that are scanned.
SEARCHES = ("SCHKEIT", "est le|the and", "(a|the) and[a-z]+", "ouv?ement|schü", "xq", "[aeiou]{4}|src1$")


@query(
    "search_by_trigrams",
    " UNION ALL ".join(
        f"SELECT doc_id, lang, source, '{p}' AS pattern FROM documents"
        f" WHERE regexp_matches(text, '{p}', 'i') OR regexp_matches(source, '{p}', 'i')"
        for p in SEARCHES
    ),
)
def search_by_trigrams(spark, sf):
    """Several searches in documents that were indexed in two batches."""
    documents = t.table(spark, sf, "documents")
    index = TrigramIndex(spark, new_folder(spark, "trigrams"))
    first = F.col("lang").eqNullSafe("en")
    for part in (documents.where(first), documents.where(~first)):
        index.add(part, ["text", "source"])
    found = [index.search(p, ["text", "source", "absent"]).withColumn("pattern", F.lit(p)) for p in SEARCHES]
    return reduce(DataFrame.unionByName, found).select("doc_id", "lang", "source", "pattern")


@query(
    "search_state",
    SQL_ENTITY_VIEW
    + """ SELECT work_id, region, label, 'plain' AS search FROM viewed
          WHERE contains(lower(contractor), 'supplier 1') OR contains(lower(description), 'supplier 1')
          UNION ALL SELECT work_id, region, label, 'pattern' FROM viewed
          WHERE regexp_matches(description, 'urgent|high', 'i') OR regexp_matches(contractor, 'urgent|high', 'i')""",
)
def search_state(spark, sf):
    """Two runs in the state, their entities indexed and searched."""
    state = State(spark, new_folder(spark, "state"))
    for status, run_ts in ((t.OLD, RUN_1), (t.NEW, RUN_2)):
        ingest_run(state, t.works_snapshot(spark, sf, status), run_ts)
    index_search(state)
    shown = {"plain": state.search("supplier 1", regex=False), "pattern": state.search("urgent|high")}
    parts = [df.select("work_id", "region", "label", F.lit(name).alias("search")) for name, df in shown.items()]
    return parts[0].unionByName(parts[1])
