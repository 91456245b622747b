"""Predicates: feed routing by key prefix (W1), terminal run state."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions._col import col, null_string

# Run states after which a load is over.
TERMINAL_STATES = ("SUCCEEDED", "FAILED", "STOPPED")


def route_prefix(key, routes: Mapping[str, str]) -> Column:
    """The name of the route whose prefix the key starts with; NULL if none.

    ``routes`` maps prefix to name; it is the feed configuration, a handful of
    entries, so it becomes one CASE expression (longest prefix first) with no
    join and no shuffle.
    """
    k = col(key)
    out = None
    for prefix in sorted(routes, key=len, reverse=True):
        cond = F.startswith(k, F.lit(prefix))
        out = F.when(cond, F.lit(routes[prefix])) if out is None else out.when(cond, F.lit(routes[prefix]))
    return null_string() if out is None else out.otherwise(null_string())


def is_terminal(status, states=TERMINAL_STATES) -> Column:
    """The state is one of ``states``."""
    return col(status).isin(list(states))
