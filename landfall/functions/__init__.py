"""Column functions of the feed rules.

Every function takes a column (name or ``Column``) and returns a ``Column``
built from Spark's native expressions, so a load stays inside whole-stage
codegen with no Python worker.
"""

from landfall.functions.dates import (
    DATE_LAYOUTS,
    parse_date,
    reformat_date,
    reformat_time,
    timestamp_text,
    load_stamp_text,
)
from landfall.functions.nulls import NULL_TOKENS, empty_to_null, fill_missing, null_tokens
from landfall.functions.paths import (
    base_name,
    location_key,
    location_store,
    strip_leading_slash,
    url_unquote,
    url_unquote_plus,
)
from landfall.functions.predicates import TERMINAL_STATES, is_terminal, route_prefix
from landfall.functions.text import (
    as_text,
    digits_only,
    family_name,
    given_name,
    outcome_message,
    outcome_subject,
)

__all__ = [
    "DATE_LAYOUTS",
    "NULL_TOKENS",
    "TERMINAL_STATES",
    "as_text",
    "base_name",
    "digits_only",
    "empty_to_null",
    "family_name",
    "fill_missing",
    "given_name",
    "is_terminal",
    "load_stamp_text",
    "location_key",
    "location_store",
    "null_tokens",
    "outcome_message",
    "outcome_subject",
    "parse_date",
    "reformat_date",
    "reformat_time",
    "route_prefix",
    "strip_leading_slash",
    "timestamp_text",
    "url_unquote",
    "url_unquote_plus",
]
