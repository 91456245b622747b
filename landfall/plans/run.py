"""Run one load end to end: plan, write, count, reconcile, audit.

Order of a lake load (one scan of the landed object):
  header read (R2, S6) -> write of the snapshot folder with counts observed (A1)
  -> exact UTF-8 check only if replacement characters were seen (S5)
  -> check of the raw lines for cut records only if a feed that splits its files saw quotes (S2)
  -> quarantine pass only if long rows were seen (R1)
  -> target count from the written files' footers (A2) -> reconcile counts and, if the feed asks
     for it, the checksum of all values (A3)
  -> optional JDBC copy of the validated snapshot (K3) -> audit row (T3).
The audit row is the pointer: until it is written the old snapshot stays current.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from landfall.errors import (
    CHECK_MARK,
    CountMismatch,
    DataError,
    EncodingError,
    HeaderError,
    LoadError,
    is_data_check_failure,
    is_header_mismatch,
)
from landfall.operators.counts import content_sum, counts_of, reconcile, reconcile_content
from landfall.plans.load import build_load, file_name_of
from landfall.plans.spec import FeedSpec
from landfall.sinks.audit import append_audit, outcome_state, read_audit
from landfall.sinks.jdbc import replace_jdbc
from landfall.sources.jdbc import read_jdbc
from landfall.sinks.lake import is_newest, read_snapshot, snapshot_path, write_snapshot
from landfall.sources.delimited import count_invalid_utf8, record_report

#: Unexpected errors of one arrival after which it is given up.
MAX_ATTEMPTS = 3


@dataclass
class LoadOutcome:
    load_id: str
    feed: str
    target: str
    file: str
    status: str
    rows_read: int | None = None
    rows_quarantined: int | None = None
    rows_target: int | None = None
    error_type: str | None = None
    error: str | None = None
    load_ts: str | None = None
    path: str | None = None
    arrived: int | None = None              # microseconds
    attempt: int | None = None
    lost_values: dict | None = None         # column -> texts that a rule turned into nothing
    sum_written: int | None = None
    sum_target: int | None = None


def stable_load_id(feed: str, path: str, stamp) -> str:
    """Same arrival, same id: a replay overwrites its own folder."""
    return hashlib.sha256(f"{feed}\n{path}\n{stamp}".encode()).hexdigest()[:24]


def _error_class(exc: BaseException) -> str | None:
    """Spark's error class (``[NAME]`` at the start of its message), if any."""
    m = re.match(r"\s*\[([A-Z0-9_.]+)\]", str(exc))
    return m.group(1) if m else None


def _check_text(exc: BaseException, spec: FeedSpec) -> str:
    """Our own check message only; Spark's text may quote row values."""
    s = str(exc)
    for m in spec.check_messages():
        if m in s:
            return m
    return CHECK_MARK


def _check_records(spark: SparkSession, spec: FeedSpec, path: str, line_sep: str | None, glob: str | None) -> None:
    """Fails the load of a file that was read line by line though a record runs over a line end."""
    r = record_report(spark, path, spec.sep, line_sep, spec.encoding, glob).first()
    if r["open_quotes"]:
        raise DataError(f"{r['open_quotes']} lines hold a quoted field with a line break; load feed {spec.name} with multi_line=True")
    if r["stray_ends"]:
        raise DataError(f"line ends differ within the file ({r['stray_ends']} records)")


def run_load(spark: SparkSession, spec: FeedSpec, path: str, *, lake_root: str, audit_root: str,
             quarantine_root: str | None = None, load_id: str | None = None, load_ts: str | None = None,
             file_name: str | None = None, jdbc: dict | None = None, arrived: int | None = None,
             attempt: int | None = None, glob: str | None = None) -> LoadOutcome:
    """Load one landed object into the target of ``spec``; returns the audited outcome.

    ``jdbc`` (``url``, ``table`` and optionally ``user``, ``password``,
    ``driver``, ``num_partitions``, ``batch_size``) also replaces a database
    table with the validated snapshot and reconciles its row count, unless the
    target already has a file that arrived later. ``arrived`` (microseconds) is
    when the object landed; without it, the time its files were last changed.

    A problem with the data or the source is audited as FAILED and returned;
    any other error is noted as ERROR (not final) and raised after nothing was
    switched, so a retry is safe.
    """
    load_id = load_id or uuid.uuid4().hex[:24]
    target_root = f"{lake_root.rstrip('/')}/{spec.target}"
    q_root = f"{(quarantine_root or lake_root.rstrip('/') + '/_quarantine')}/{spec.target}"
    out = LoadOutcome(load_id, spec.name, spec.target, file_name or file_name_of(path), "RUNNING", path=path, arrived=arrived, attempt=attempt)
    try:
        fl = build_load(spark, spec, path, load_ts=load_ts, file_name=file_name, glob=glob)
        out.load_ts = fl.load_ts
        try:
            write_snapshot(fl.rows, target_root, load_id)
        except Exception as e:  # a row or header check failed inside the tasks
            if is_data_check_failure(e):
                raise DataError(_check_text(e, spec)) from None
            if is_header_mismatch(e):
                raise HeaderError("a file of the landed folder has another header") from None
            raise
        counts = counts_of(fl.observation, fl.results, fl.lost)
        out.arrived = arrived if arrived is not None else counts.arrived
        out.lost_values, out.sum_written = counts.lost or None, counts.content_sum
        # Second passes only when the first one saw a reason for them.
        if counts.rows_replaced_chars and count_invalid_utf8(spark, path, glob) > 0:
            raise EncodingError("source is not valid UTF-8")
        if counts.rows_with_quotes:
            _check_records(spark, spec, path, fl.line_sep, glob)
        quarantined = 0
        if fl.quarantine is not None and counts.rows_long:
            write_snapshot(fl.quarantine, q_root, load_id)
            quarantined = read_snapshot(spark, q_root, load_id, schema=fl.quarantine.schema).count()
            if quarantined != counts.rows_long:
                raise CountMismatch(f"quarantine holds {quarantined} rows, {counts.rows_long} were long")
        out.rows_read, out.rows_quarantined = counts.rows_read, quarantined
        snap = read_snapshot(spark, target_root, load_id, schema=fl.rows.schema)
        if counts.content_sum is None:
            out.rows_target = snap.count()
        else:
            found = snap.agg(F.count(F.lit(1)).alias("n"), content_sum(fl.columns).alias("s")).first()
            out.rows_target, out.sum_target = found["n"], int(found["s"])
        reconcile(counts.rows_read - quarantined, out.rows_target)
        if counts.content_sum is not None:
            reconcile_content(out.sum_written, out.sum_target)
        if jdbc is not None and is_newest(spark, audit_root, spec.target, out.arrived):
            # The database gets a copy of the validated snapshot, then is counted.
            replace_jdbc(snap, **jdbc)
            conn = {k: jdbc.get(k) for k in ("url", "table", "user", "password", "driver")}
            reconcile(out.rows_target, read_jdbc(spark, **conn).count())
        out.status = "SUCCEEDED"
    except LoadError as e:
        out.status, out.error_type, out.error = "FAILED", e.error_type, str(e)
    except Exception as e:
        # Not a data problem: note it (type and Spark error class only, as the
        # text may quote row values), then raise so the caller or the stream
        # retries. ERROR is not final, so a retry loads the file again.
        out.status, out.error_type, out.error = "ERROR", type(e).__name__, _error_class(e)
        try:
            append_audit(spark, audit_root, asdict(out))
        except Exception:  # noqa: BLE001 - the original error matters more
            pass
        raise
    append_audit(spark, audit_root, asdict(out))
    return out


def run_arrival(spark: SparkSession, spec: FeedSpec, path: str, stamp, *, max_attempts: int = MAX_ATTEMPTS, **kw) -> LoadOutcome | None:
    """Idempotent form for arrivals: the id comes from feed, path and arrival
    time; an arrival that already has an outcome is not loaded again.

    An unexpected error is raised, so the caller or the stream comes back; the
    attempt after the ``max_attempts``-th error is not made: the arrival is
    recorded as DEAD, with its last error, and counts as done.
    """
    load_id = stable_load_id(spec.name, path, stamp)
    final, errors = outcome_state(spark, kw["audit_root"], load_id, spec.target)
    if final:
        return None
    if errors >= max_attempts:
        return _give_up(spark, spec, path, load_id, errors, kw["audit_root"], kw.get("arrived"))
    return run_load(spark, spec, path, load_id=load_id, attempt=errors + 1, **kw)


def _give_up(spark: SparkSession, spec: FeedSpec, path: str, load_id: str, errors: int, audit_root: str, arrived) -> LoadOutcome:
    last = (read_audit(spark, audit_root).filter((F.col("target") == spec.target) & (F.col("load_id") == load_id) & (F.col("status") == "ERROR"))
            .agg(F.max_by(F.struct("error_type", "error"), "recorded_at").alias("e")).first()["e"])
    out = LoadOutcome(load_id, spec.name, spec.target, file_name_of(path), "DEAD", error_type=last["error_type"], error=last["error"],
                      path=path, arrived=arrived, attempt=errors)
    append_audit(spark, audit_root, asdict(out))
    return out


__all__ = ["LoadOutcome", "run_arrival", "run_load", "snapshot_path", "stable_load_id"]
