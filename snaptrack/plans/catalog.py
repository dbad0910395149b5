"""All registered queries."""

from snaptrack.plans import (  # noqa: F401 - importing registers
    queries_deny,
    queries_history,
    queries_intake,
    queries_lookups,
    queries_pages,
    queries_presence,
    queries_raw,
    queries_runs,
    queries_search,
    queries_stream,
    queries_views,
    queries_works,
)
from snaptrack.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
