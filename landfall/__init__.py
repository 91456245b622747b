"""landfall: delimited record feeds into tables, on Spark.

A feed is described by a ``FeedSpec``; ``load`` turns one landed file into a
lazy DataFrame of target rows, ``run_load`` writes it as a new snapshot,
reconciles counts and records the outcome, and ``start_intake`` does the same
for files as they arrive.
"""

from landfall.plans.feeds import ALL_FEEDS, APPOINTMENTS, DEMOGRAPHICS, PROVIDERS, RX_ORDERS, VISITS
from landfall.plans.load import FeedLoad, build_load, load
from landfall.plans.run import LoadOutcome, run_load
from landfall.plans.spec import FeedSpec
from landfall.sinks.lake import read_current, superseded_loads
from landfall.streaming.intake import start_intake, start_notified_intake

__all__ = [
    "ALL_FEEDS",
    "APPOINTMENTS",
    "DEMOGRAPHICS",
    "FeedLoad",
    "FeedSpec",
    "LoadOutcome",
    "PROVIDERS",
    "RX_ORDERS",
    "VISITS",
    "build_load",
    "load",
    "read_current",
    "run_load",
    "start_intake",
    "start_notified_intake",
    "superseded_loads",
]
