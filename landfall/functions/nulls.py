"""NULL handling: null tokens (N1), fill missing (N2), empty to NULL."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions._col import col, null_string, sql_name, sql_string

# The texts a delimited-file parse reads as missing. They are the
# default missing-value list of pandas before 2.0, which the original loads used;
# they must stay equal to it for loaded values to match. ``None`` is not in it.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "n/a",
    "nan",
    "null",
)


def null_tokens(c, tokens=NULL_TOKENS) -> Column:
    """A value equal to one of ``tokens`` becomes NULL; others pass.

    More than ten tokens turn into an ``InSet`` hash lookup in Catalyst. Given a
    column name, the test is built as one SQL expression (one call to the JVM
    instead of one per token).
    """
    if isinstance(c, str):
        ref = sql_name(c)
        listed = ", ".join(sql_string(t) for t in tokens)
        return F.expr(f"CASE WHEN {ref} IN ({listed}) THEN CAST(NULL AS STRING) ELSE {ref} END")
    c = col(c)
    return F.when(c.isin(list(tokens)), null_string()).otherwise(c)


def fill_missing(c, value: str = "") -> Column:
    """NULL becomes ``value``."""
    return F.coalesce(col(c), F.lit(value))


def empty_to_null(c) -> Column:
    """The empty text becomes NULL (what a staged CSV round trip did)."""
    return F.nullif(col(c), F.lit(""))
