"""Snapshot replace in a lake folder (K3, lake form).

Each load writes its own folder ``<root>/load_id=<id>``; the audit table is the
pointer. Readers take the SUCCEEDED load of the target whose file arrived last, so
a failed or half-written load never hides the previous snapshot, an older file
that is loaded late never hides a newer one, and a replayed load overwrites only
its own folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.sinks.audit import read_audit


def snapshot_path(root: str, load_id: str) -> str:
    return f"{root.rstrip('/')}/load_id={load_id}"


def write_snapshot(df: DataFrame, root: str, load_id: str, fmt: str = "parquet") -> str:
    path = snapshot_path(root, load_id)
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def read_snapshot(spark: SparkSession, root: str, load_id: str, fmt: str = "parquet",
                  schema=None) -> DataFrame:
    """One load's folder; with ``schema`` no footer is read to infer it."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(snapshot_path(root, load_id))


def _arrival_order():
    """When a load's file arrived, then when the load was recorded (for rows without an arrival, and
    for several loads of one file)."""
    return F.struct(F.coalesce("arrived", "recorded_at").alias("arrived"), "recorded_at", "load_id")


def is_newest(spark: SparkSession, audit_root: str, target: str, arrived: int | None) -> bool:
    """No SUCCEEDED load of ``target`` is of a file that arrived after ``arrived`` (microseconds)."""
    if arrived is None:
        return True
    later = (read_audit(spark, audit_root).filter((F.col("target") == target) & (F.col("status") == "SUCCEEDED"))
             .filter(F.unix_micros(F.coalesce("arrived", "recorded_at")) > arrived))
    return later.isEmpty()


def current_load_id(spark: SparkSession, audit_root: str, target: str) -> str | None:
    """The SUCCEEDED load of ``target`` whose file arrived last: one aggregate row to the driver."""
    row = (read_audit(spark, audit_root)
           .filter((F.col("target") == target) & (F.col("status") == "SUCCEEDED"))
           .agg(F.max_by("load_id", _arrival_order()).alias("id"))
           .first())
    return None if row is None else row["id"]


def read_current(spark: SparkSession, root: str, audit_root: str, target: str,
                 fmt: str = "parquet") -> DataFrame:
    """The current snapshot of ``target``; only its own folder is listed."""
    load_id = current_load_id(spark, audit_root, target)
    if load_id is None:
        raise LookupError(f"no succeeded load of {target}")
    return read_snapshot(spark, root, load_id, fmt)


def superseded_loads(spark: SparkSession, root: str, audit_root: str, target: str, keep: int = 2) -> DataFrame:
    """Snapshot folders of ``target`` that retention may remove: every load
    except the SUCCEEDED ones of the ``keep`` latest arrivals (failed and errored loads included). Deleting
    them is left to the storage's own lifecycle tooling."""
    audit = read_audit(spark, audit_root).filter(F.col("target") == target)
    kept = (audit.filter(F.col("status") == "SUCCEEDED")
            .orderBy(_arrival_order().desc()).limit(keep).select("load_id"))
    return (audit.filter(F.col("status").isin("SUCCEEDED", "FAILED", "ERROR", "DEAD"))
            .select("load_id", "status", "recorded_at").distinct()
            .join(kept, "load_id", "left_anti")
            .select("load_id", "status", F.concat(F.lit(root.rstrip("/") + "/load_id="), "load_id").alias("path")))
