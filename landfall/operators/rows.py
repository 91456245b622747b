"""Row checks: long rows."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions._col import col

# The body of a quoted field: quote, any run of non-quotes and doubled quotes, quote.
# Written as an unrolled loop so long fields do not recurse in the regex engine.
_QUOTED = r'"[^"]*(?:""[^"]*)*"'


def without_quoted(raw, sep: str = "|") -> Column:
    """A raw record without its quoted fields. A quote opens a field only at its start and closes it
    only at its end; one inside a field (an inch mark) is text."""
    s = r"\Q" + sep + r"\E"
    return F.regexp_replace(col(raw), rf"(\A|{s}){_QUOTED}(?={s}|\z)", "$1")


def field_count(raw, sep: str = "|") -> Column:
    """Fields in a raw record: separators outside quoted fields, plus one."""
    return F.size(F.split(without_quoted(raw, sep), r"\Q" + sep + r"\E"))


def has_open_quote(raw, sep: str = "|") -> Column:
    """A raw record whose last quoted field does not end in it: after the closed ones, a quote at a
    field's start is followed by doubled quotes only. (A closing quote with text behind it is text.)"""
    s = r"\Q" + sep + r"\E"
    return F.regexp_like(without_quoted(raw, sep), F.lit(rf'(?:\A|{s})"[^"]*(?:""[^"]*)*\z'))


def is_long_row(raw, sep: str, n_columns: int) -> Column:
    """The reader flagged the row and it holds more fields than the header.

    Short rows are flagged by the reader too but are kept, padded with NULL.
    Only flagged rows reach the regex, so clean rows cost one NULL test.
    """
    raw = col(raw)
    return raw.isNotNull() & (field_count(raw, sep) > F.lit(n_columns))
