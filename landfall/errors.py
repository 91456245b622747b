"""Errors of a load. ``LoadError`` marks a problem with the data or its source:
the load is audited as FAILED and the next file goes on. Anything else (sink,
cluster) propagates so the caller, or the stream, retries."""

# Marker carried by every check that fails inside Spark tasks (``raise_error``).
CHECK_MARK = "load check failed"


class LoadError(Exception):
    error_type = "LoadError"


class SourceMissing(LoadError):
    error_type = "SourceMissing"


class HeaderError(LoadError):
    error_type = "HeaderError"


class DataError(LoadError):
    error_type = "DataError"


class EncodingError(LoadError):
    error_type = "EncodingError"


class CountMismatch(LoadError):
    error_type = "CountMismatch"


def is_data_check_failure(exc: BaseException) -> bool:
    """A task failed on one of our row checks (strict date, time, long row)."""
    return CHECK_MARK in str(exc)


# Spark's text when a file of a landed folder has another header than the first.
HEADER_MISMATCH = "CSV header does not conform to the schema"


def is_header_mismatch(exc: BaseException) -> bool:
    return HEADER_MISMATCH in str(exc)
