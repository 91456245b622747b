from landfall.operators.counts import LoadCounts, content_sum, head_rows, observe_counts, reconcile, reconcile_content
from landfall.operators.projection import (
    closed_projection,
    open_projection,
    qcol,
    rename_column,
    replace_column,
    with_file_name,
    with_load_stamp,
    with_source_file,
)
from landfall.operators.rows import field_count, has_open_quote, is_long_row, without_quoted

__all__ = [
    "LoadCounts",
    "closed_projection",
    "content_sum",
    "field_count",
    "has_open_quote",
    "head_rows",
    "is_long_row",
    "observe_counts",
    "open_projection",
    "qcol",
    "reconcile",
    "reconcile_content",
    "rename_column",
    "replace_column",
    "with_file_name",
    "with_load_stamp",
    "with_source_file",
    "without_quoted",
]
