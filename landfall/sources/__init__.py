from landfall.sources.delimited import (
    CORRUPT,
    check_header,
    count_invalid_utf8,
    read_delimited,
    read_head,
    read_header,
    read_table_text,
    record_report,
    utf8_report,
)
from landfall.sources.jdbc import read_jdbc

__all__ = [
    "CORRUPT",
    "check_header",
    "count_invalid_utf8",
    "read_delimited",
    "read_head",
    "read_header",
    "read_jdbc",
    "read_table_text",
    "record_report",
    "utf8_report",
]
