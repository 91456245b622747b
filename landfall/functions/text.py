"""Text functions: digits only (F5), text cast (F10), name parts (F6, F7),
outcome message (F12)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions._col import col

# White space as Python's ``str.split()`` sees it: Unicode white space plus the
# four information separators U+001C..U+001F. ``(?U)`` makes ``\s`` Unicode-aware.
_WS = r"[\s\x{1C}-\x{1F}]"
_WORD = r"[^\s\x{1C}-\x{1F}]"


def as_text(c) -> Column:
    """any value as text."""
    return col(c).cast("string")


def digits_only(c) -> Column:
    """drop every character that is not a decimal digit (any script).

    ``\\P{Nd}`` is the complement of Unicode decimal digits, the class Python's
    ``\\D`` uses; Java's own ``\\D`` is ASCII-only.
    """
    return F.regexp_replace(col(c).cast("string"), r"\P{Nd}", "")


def _rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U){_WS}+$", "")


def family_name(c) -> Column:
    """the text before the last run of white space (``rsplit(None, 1)[0]``).

    A single word comes back without its leading white space; blank is NULL.
    """
    t = _rstrip(col(c))
    two_parts = t.rlike(rf"(?U){_WORD}{_WS}+{_WORD}+$")
    head = F.regexp_extract(t, rf"(?U)^([\s\S]*{_WORD}){_WS}+{_WORD}+$", 1)
    single = F.nullif(F.regexp_replace(t, rf"(?U)^{_WS}+", ""), F.lit(""))
    return F.when(two_parts, head).otherwise(single)


def given_name(c) -> Column:
    """the last word (``rsplit(None, 1)[1]``); NULL for one word or blank."""
    t = _rstrip(col(c))
    return F.nullif(F.regexp_extract(t, rf"(?U){_WORD}{_WS}+({_WORD}+)$", 1), F.lit(""))


# Fixed value: the text for an outcome without an error of its own.
NO_ERROR_TEXT = "No error message provided"


def outcome_subject(feed, status) -> Column:
    """F12, subject line of a load outcome."""
    return F.concat(F.lit("Load finished - "), col(feed), F.lit(" - Status: "), col(status))


def outcome_message(feed, status, file, error) -> Column:
    """F12, body of a load outcome; a run that did not succeed names its error,
    or the default text when it has none."""
    base = F.concat(F.lit("The load "), col(feed), F.lit(" has "), col(status),
                    F.lit(" for file "), col(file), F.lit("."))
    err = F.concat(F.lit(" Error: "), F.coalesce(col(error), F.lit(NO_ERROR_TEXT)))
    return F.when(col(status) == "SUCCEEDED", base).otherwise(F.concat(base, err))
