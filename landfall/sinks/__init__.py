from landfall.sinks.audit import AUDIT_SCHEMA, append_audit, compact_audit, dead_letters, has_outcome, read_audit
from landfall.sinks.delimited import write_delimited
from landfall.sinks.jdbc import append_jdbc, recreate_jdbc, replace_jdbc
from landfall.sinks.lake import (
    current_load_id,
    read_current,
    read_snapshot,
    snapshot_path,
    superseded_loads,
    write_snapshot,
)

__all__ = [
    "AUDIT_SCHEMA",
    "append_audit",
    "append_jdbc",
    "compact_audit",
    "current_load_id",
    "dead_letters",
    "has_outcome",
    "read_audit",
    "read_current",
    "read_snapshot",
    "recreate_jdbc",
    "replace_jdbc",
    "snapshot_path",
    "superseded_loads",
    "write_delimited",
    "write_snapshot",
]
