"""Audit table of load outcomes (T3, T4): one row per load, append only.

Every load adds a file to the log, ``<root>/target=<target>/``. ``compact_audit``
puts the log's rows into a few files of a new epoch, ``<root>/_epochs/<number>/``:
its rows, and the names of the log files that they cover. An epoch counts once its
``COMMIT`` file is there, which is made last and at once, so a reader sees either
the epoch before or this one: the newest epoch's rows, and the log files that are
not among its names (those are never opened). Log files are removed one epoch
after the one that took their rows, so a reader is not disturbed by the next
compaction.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from landfall.functions.text import outcome_message

AUDIT_SCHEMA = (
    "load_id string, feed string, target string, file string, status string, "
    "rows_read bigint, rows_quarantined bigint, rows_target bigint, "
    "error_type string, error string, load_ts string, path string, arrived timestamp, "
    "attempt int, lost_values map<string,bigint>, sum_written decimal(38,0), sum_target decimal(38,0)"
)
#: States after which an arrival is not loaded again.
FINAL = ("SUCCEEDED", "FAILED", "DEAD")
EPOCHS = "_epochs"


def audit_frame(spark: SparkSession, records: list[dict]) -> DataFrame:
    """Outcome rows with their message (F12) and the time they were recorded. ``arrived`` of a
    record is in microseconds."""
    value = lambda r, name: Decimal(r[name]) if name.startswith("sum_") and r.get(name) is not None else r.get(name)
    df = spark.createDataFrame([tuple(value(r, f.split()[0]) for f in AUDIT_SCHEMA.split(", "))
                                for r in records], AUDIT_SCHEMA.replace("arrived timestamp", "arrived bigint"))
    return df.withColumn("arrived", F.timestamp_micros("arrived")).select("*", outcome_message("feed", "status", "file", "error").alias("message"),
                     F.current_timestamp().alias("recorded_at"))


def append_audit(spark: SparkSession, audit_root: str, record: dict) -> None:
    """One load's outcome, written into its target's own folder: loads of
    different targets may record at the same time without sharing a commit
    folder."""
    (audit_frame(spark, [record]).drop("target").coalesce(1)
     .write.mode("append").parquet(f"{audit_root.rstrip('/')}/target={record['target']}"))


STORED_SCHEMA = AUDIT_SCHEMA + ", message string, recorded_at timestamp"


def append_audit_rows(df: DataFrame, audit_root: str) -> None:
    """Append outcome rows; the table is partitioned by target, so a lookup of
    one target's current load lists only that target's folder.

    The rows are few (one per arrival of a stream batch, which
    ``maxFilesPerTrigger`` bounds), so they go out as one file per target
    rather than one per shuffle partition.
    """
    df.coalesce(1).write.mode("append").partitionBy("target").parquet(audit_root)


STORED_SCHEMA = AUDIT_SCHEMA + ", message string, recorded_at timestamp"


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))


def _file_system(spark: SparkSession, root: str):
    """The root's own file system (any that Spark can write to)."""
    return _path(spark, root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def committed_epochs(spark: SparkSession, audit_root: str) -> list[int]:
    """Numbers of the epochs that count, oldest first: a listing of one small folder."""
    if getattr(spark, "_jvm", None) is None:  # a Spark Connect session has no file system at hand and makes no epochs
        return []
    fs = _file_system(spark, audit_root)
    folder = _path(spark, audit_root, EPOCHS)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit() and fs.exists(_path(spark, audit_root, EPOCHS, n, "COMMIT")))


def _covered(spark: SparkSession, audit_root: str, epochs: list[int]) -> list[str]:
    """Log files that the newest epoch covers and that may still be there: the files of two
    compactions at most."""
    if not epochs:
        return []
    return [r["_file"] for r in spark.read.schema("_file string").parquet(f"{audit_root.rstrip('/')}/{EPOCHS}/{epochs[-1]}/files").collect()]


def _log(spark: SparkSession, audit_root: str, without: list[str]) -> DataFrame | None:
    """The log's rows with the name of their file, but for the files in ``without``, which the scan
    leaves out of its listing. The schema is given, so the partition column ``target`` stays text
    whatever the target names look like."""
    try:
        log = spark.read.schema(STORED_SCHEMA).parquet(audit_root)
    except AnalysisException:
        return None
    log = log.filter(~F.col("_metadata.file_name").isin(without)) if without else log
    return log.select("*", F.col("_metadata.file_name").alias("_file"))


def _epoch_rows(spark: SparkSession, audit_root: str, number: int) -> DataFrame:
    return spark.read.schema(STORED_SCHEMA).parquet(f"{audit_root.rstrip('/')}/{EPOCHS}/{number}/rows")


def read_audit(spark: SparkSession, audit_root: str) -> DataFrame:
    """The audit table: the newest epoch's rows and the log that came after it."""
    epochs = committed_epochs(spark, audit_root)
    log = _log(spark, audit_root, _covered(spark, audit_root, epochs))
    parts = [_epoch_rows(spark, audit_root, epochs[-1])] if epochs else []
    if log is not None:
        parts.append(log.drop("_file"))
    names = [f.split()[0] for f in STORED_SCHEMA.split(", ")]
    return reduce(DataFrame.unionByName, [p.select(*names) for p in parts]) if parts else spark.createDataFrame([], STORED_SCHEMA)


def compact_audit(spark: SparkSession, audit_root: str) -> int | None:
    """Put all rows into a new epoch of one file a target; returns its number, or None if the log holds
    nothing new. Loads may append and readers read meanwhile; run one compaction at a time (a second
    one fails when it makes its ``COMMIT``)."""
    epochs = committed_epochs(spark, audit_root)
    covered = _covered(spark, audit_root, epochs)
    log = _log(spark, audit_root, covered)
    new = [r["_file"] for r in log.select("_file").distinct().collect()] if log is not None else []
    if not new:
        return None
    number = epochs[-1] + 1 if epochs else 1
    root = f"{audit_root.rstrip('/')}/{EPOCHS}/{number}"
    rows = log.filter(F.col("_file").isin(new)).drop("_file")  # no file that came since
    if epochs:
        rows = rows.unionByName(_epoch_rows(spark, audit_root, epochs[-1]).select(*rows.columns))
    rows.repartition("target").write.mode("overwrite").partitionBy("target").parquet(f"{root}/rows")
    fs = _file_system(spark, audit_root)
    log_files = [f.getPath() for d in fs.listStatus(_path(spark, audit_root)) if d.isDirectory() and d.getPath().getName().startswith("target=")
                 for f in fs.listStatus(d.getPath())]
    there = [f for f in log_files if f.getName() in set(covered)]
    # The files taken before are removed below; their names are kept for one epoch more.
    spark.createDataFrame([(n,) for n in [*new, *(f.getName() for f in there)]], "_file string").coalesce(1).write.mode("overwrite").parquet(f"{root}/files")
    fs.create(_path(spark, root, "COMMIT"), False).close()  # fails if it is there already
    for f in there:
        fs.delete(f, False)
    for old in epochs[:-1]:
        fs.delete(_path(spark, audit_root, EPOCHS, str(old)), True)
    return number


def outcome_state(spark: SparkSession, audit_root: str, load_id: str, target: str) -> tuple[bool, int]:
    """Whether a final outcome of this load exists, and how often it has ended in an unexpected error."""
    r = (read_audit(spark, audit_root).filter((F.col("target") == target) & (F.col("load_id") == load_id))
         .agg(F.count_if(F.col("status").isin(*FINAL)).alias("final"), F.count_if(F.col("status") == "ERROR").alias("errors")).first())
    return r["final"] > 0, r["errors"]


def has_outcome(spark: SparkSession, audit_root: str, load_id: str, target: str | None = None) -> bool:
    """A final outcome for this load already exists (a replayed batch adds none)."""
    cond = (F.col("load_id") == load_id) & F.col("status").isin(*FINAL)
    if target is not None:
        cond = (F.col("target") == target) & cond
    return read_audit(spark, audit_root).filter(cond).limit(1).count() > 0


def dead_letters(spark: SparkSession, audit_root: str) -> DataFrame:
    """Arrivals given up after repeated unexpected errors: what to look at and load by hand."""
    return (read_audit(spark, audit_root).filter(F.col("status") == "DEAD")
            .select("load_id", "feed", "target", "path", "arrived", "attempt", "error_type", "error"))
