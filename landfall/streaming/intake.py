"""File intake as a stream.

The stream carries arrivals only (path and time, never file contents): a
``binaryFile`` source with the content column pruned. Each micro-batch routes
arrivals to feeds by name prefix (W1), keeps the latest arrival per feed (T2),
audits the others, and runs one load per winner. The checkpoint records which
files were seen; load ids derive from feed, path and arrival time, so a replayed
batch rewrites its own snapshot folders and adds no second outcome.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from landfall.functions.paths import base_name, url_unquote, url_unquote_plus
from landfall.functions.predicates import route_prefix
from landfall.functions.text import outcome_message
from landfall.plans.run import MAX_ATTEMPTS, run_arrival
from landfall.session import shared_dir
from landfall.sinks.audit import AUDIT_SCHEMA, append_audit_rows, read_audit


# The binary file source's own fixed schema; only path and time are selected,
# so file contents are never read.
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def arrivals(spark: SparkSession, landing: str, glob: str | None = None, unit: str = "file",
             max_files_per_batch: int = 10000, archive_dir: str | None = None, marker: str | None = None) -> DataFrame:
    """Arrival stream of ``(path, arrived)``.

    ``unit='file'``: each landed file is one load. ``unit='directory'``: files sit
    in folders under ``landing`` (a producer's multi-part drop, published whole),
    and each folder is one load. With ``marker`` a folder is not taken before the
    file of that name is in it, which the producer writes last: parts that came in
    earlier batches, or come in later ones, start no load of their own. The
    marker holds a byte at least and its name begins with neither ``_`` nor ``.``
    (Spark gives no row for an empty file and does not list such names). A batch holds at most ``max_files_per_batch``
    files, which bounds everything the handler gathers per batch. With
    ``archive_dir`` Spark moves files of committed batches there, so listing the
    landing folder does not grow with history.
    """
    if marker is not None and (unit != "directory" or marker[:1] in ("_", ".")):
        raise ValueError("a marker is the visible name of a file in a landed folder (unit 'directory')")
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_batch))
    if marker is not None:
        reader = reader.option("pathGlobFilter", marker)
    elif glob:
        reader = reader.option("pathGlobFilter", glob)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    src = reader.load(landing if unit == "file" else landing.rstrip("/") + "/*")
    path = url_unquote(F.col("path"))  # the source hands paths over percent-encoded
    if unit == "directory":
        path = F.regexp_replace(path, r"/[^/]*$", "")
    elif unit != "file":
        raise ValueError("unit must be 'file' or 'directory'")
    return src.select(path.alias("path"), F.col("modificationTime").alias("arrived"))


def pending_folders(spark: SparkSession, landing: str, marker: str) -> DataFrame:
    """Landed folders whose marker is not there yet: ``path``, ``files``, ``bytes``, ``last_change``.
    Reads the listing only."""
    files = (spark.read.format("binaryFile").schema(BINARY_FILE_SCHEMA).load(landing.rstrip("/") + "/*")
             .select(url_unquote(F.col("path")).alias("file"), "modificationTime", "length"))
    return (files.groupBy(F.regexp_replace("file", r"/[^/]*$", "").alias("path"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("last_change"),
                 F.bool_or(base_name("file") == marker).alias("whole"))
            .filter(~F.col("whole")).drop("whole"))


# Schema of object-store notification records: a ``Records`` array whose
# entries name the store (bucket) and the key, which arrives ``+``-encoded.
NOTIFICATION_SCHEMA = (
    "Records array<struct<eventTime: string, eventName: string, "
    "s3: struct<bucket: struct<name: string>, object: struct<key: string, size: bigint>>>>"
)


def notified_arrivals(spark: SparkSession, events: str, scheme: str = "s3",
                      max_files_per_batch: int = 10000) -> DataFrame:
    """Arrival stream from notification records (JSON files in ``events``).

    Every record of an event counts (not only the first); the key is decoded
    once with ``+`` as a blank (F8), and the location is ``scheme://store/key``
    (S7). Event time is the arrival time, so the latest file per feed wins (T2).
    """
    ev = (spark.readStream.schema(NOTIFICATION_SCHEMA)
          .option("maxFilesPerTrigger", max_files_per_batch)
          .json(events))
    # Only records of a created object are arrivals; a deletion starts no load.
    created = F.col("r.eventName").isNull() | F.col("r.eventName").contains("ObjectCreated")
    rec = ev.select(F.explode("Records").alias("r")).filter(created)
    key = url_unquote_plus(F.col("r.s3.object.key"))
    path = F.concat(F.lit(scheme + "://"), F.col("r.s3.bucket.name"), F.lit("/"), key)
    # A fixed fallback keeps load ids stable when a batch is replayed.
    arrived = F.coalesce(F.try_to_timestamp(F.col("r.eventTime")), F.lit("1970-01-01").cast("timestamp"))
    return rec.select(path.alias("path"), arrived.alias("arrived"))


def route_path(path, routes: dict[str, str]):
    """Feed of a location by folder and name prefix. A prefix ``a/b_`` asks for files ``b_...`` in a
    folder ``a``; a prefix without a folder looks at the base name alone. More folders go first."""
    by_depth: dict[int, dict[str, str]] = {}
    for prefix, name in routes.items():
        by_depth.setdefault(prefix.count("/"), {})[prefix] = name
    tails = [route_prefix(F.regexp_extract(path, rf"((?:[^/]*/){{{depth}}}[^/]*)$", 1), own)
             for depth, own in sorted(by_depth.items(), reverse=True)]
    return F.coalesce(*tails)


class Intake:
    """``foreachBatch`` handler: route, keep the latest per feed, load, audit."""

    def __init__(self, specs, *, lake_root: str, audit_root: str, quarantine_root: str | None = None,
                 load_ts: str | None = None, parallel_loads: int = 4, jdbc: dict[str, dict] | None = None,
                 max_attempts: int = MAX_ATTEMPTS, glob: str | None = None):
        """``jdbc`` names, by feed, the database table (``run_load``'s ``jdbc``) that gets a copy;
        ``glob`` picks the files of a landed folder (all but its marker)."""
        self.jdbc = jdbc or {}
        self.max_attempts = max_attempts
        self.glob = glob
        self.parallel_loads = max(1, parallel_loads)
        self.specs = {s.name: s for s in specs}
        self.routes = {s.prefix: s.name for s in specs}
        self.kw = dict(lake_root=lake_root, audit_root=audit_root, quarantine_root=quarantine_root,
                       load_ts=load_ts)

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        units = batch.groupBy("path").agg(F.max("arrived").alias("arrived"))
        routed = units.withColumn("feed", route_path("path", self.routes))
        per_feed = (routed.groupBy("feed")
                    .agg(F.max_by(F.struct("path", "arrived"), F.struct("arrived", "path")).alias("w"),
                         F.count(F.lit(1)).alias("arrivals"))
                    .select("feed", F.col("w.path").alias("path"), F.col("w.arrived").alias("arrived"),
                            F.unix_micros("w.arrived").alias("micros"), "arrivals"))
        # One row per configured feed plus one for unrouted files: a bounded
        # set, safe to collect.
        groups = per_feed.collect()
        winners = [g for g in groups if g["feed"] is not None]
        if any(g["feed"] is None or g["arrivals"] > 1 for g in groups):
            won = spark.createDataFrame([(w["feed"], w["path"]) for w in winners],
                                        "feed string, won_path string")
            self._audit_others(routed, won)

        def one(w):
            """The unexpected error of a load, if any: the other feeds' loads go on first."""
            try:
                run_arrival(spark, self.specs[w["feed"]], w["path"], w["arrived"], jdbc=self.jdbc.get(w["feed"]), arrived=w["micros"],
                            glob=self.glob, max_attempts=self.max_attempts, **self.kw)
            except Exception as e:  # noqa: BLE001 - raised below
                return e
            return None

        # Loads of different feeds are independent Spark jobs; submitted from
        # a few threads they share the cluster's task slots.
        if self.parallel_loads == 1 or len(winners) < 2:
            errors = [one(w) for w in winners]
        else:
            with ThreadPoolExecutor(max_workers=self.parallel_loads) as pool:
                errors = list(pool.map(one, winners))
        # The batch is tried again as a whole: loads that have an outcome are not repeated, and an
        # arrival that keeps failing is given up after ``max_attempts`` errors.
        for e in errors:
            if e is not None:
                raise e

    def _audit_others(self, routed: DataFrame, won: DataFrame) -> None:
        # ``won`` holds at most one row per configured feed.
        others = (routed.join(F.broadcast(won), "feed", "left")
                  .filter(F.col("won_path").isNull() | (F.col("path") != F.col("won_path"))))
        status = F.when(F.col("feed").isNull(), F.lit("SKIPPED")).otherwise(F.lit("SUPERSEDED"))
        target = F.lit(None).cast("string")
        for name, spec in self.specs.items():
            target = F.when(F.col("feed") == name, F.lit(spec.target)).otherwise(target)
        rows = others.select(
            F.substring(F.sha2(F.concat_ws("\n", F.coalesce("feed", F.lit("")), "path",
                                           F.col("arrived").cast("string")), 256), 1, 24).alias("load_id"),
            F.col("feed"), target.alias("target"), base_name("path").alias("file"), status.alias("status"), "path", "arrived")
        fields = [f.split() for f in AUDIT_SCHEMA.split(", ")]
        rows = rows.select(*[F.col(n) if n in rows.columns else F.lit(None).cast(t).alias(n) for n, t in fields])
        rows = rows.select("*", outcome_message("feed", "status", "file", "error").alias("message"),
                           F.current_timestamp().alias("recorded_at"))
        # Ids are derived from feed, path and time, so a replayed batch finds
        # its rows already there and adds none.
        # Only the folders of these feeds' targets (and of unrouted files) are read.
        targets = sorted({s.target for s in self.specs.values()})
        seen = (read_audit(rows.sparkSession, self.kw["audit_root"])
                .filter(F.col("target").isin(targets) | F.col("target").isNull()).select("load_id"))
        rows = rows.join(seen, "load_id", "left_anti")
        append_audit_rows(rows, self.kw["audit_root"])


def default_checkpoint(spark: SparkSession, source: str) -> str:
    """A checkpoint folder for one intake source under the configured
    ``spark.checkpoint.dir``: the same for every run, so a restarted intake
    resumes where it stopped."""
    digest = hashlib.sha256(source.rstrip("/").encode()).hexdigest()[:16]
    return f"{shared_dir(spark)}/intake/{digest}"


def start_notified_intake(spark: SparkSession, events: str, specs, *, lake_root: str, audit_root: str,
                          checkpoint: str | None = None, scheme: str = "s3", available_now: bool = True,
                          processing_time: str | None = None, quarantine_root: str | None = None,
                          load_ts: str | None = None, parallel_loads: int = 4,
                          jdbc: dict[str, dict] | None = None, max_attempts: int = MAX_ATTEMPTS) -> StreamingQuery:
    """Intake driven by notification records instead of a folder listing."""
    handler = Intake(specs, lake_root=lake_root, audit_root=audit_root,
                     quarantine_root=quarantine_root, load_ts=load_ts, parallel_loads=parallel_loads, jdbc=jdbc,
                     max_attempts=max_attempts)
    w = (notified_arrivals(spark, events, scheme).writeStream
         .foreachBatch(handler)
         .option("checkpointLocation", checkpoint or default_checkpoint(spark, events)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "30 seconds")
    return w.start()


def start_intake(spark: SparkSession, landing: str, specs, *, lake_root: str, audit_root: str,
                 checkpoint: str | None = None, glob: str | None = None, unit: str = "file",
                 available_now: bool = True, processing_time: str | None = None,
                 quarantine_root: str | None = None, load_ts: str | None = None,
                 parallel_loads: int = 4, max_files_per_batch: int = 10000,
                 archive_dir: str | None = None, jdbc: dict[str, dict] | None = None,
                 marker: str | None = None, max_attempts: int = MAX_ATTEMPTS) -> StreamingQuery:
    """Start the intake. ``available_now`` takes what has landed and stops;
    otherwise it polls every ``processing_time``. With ``marker`` and a ``glob``,
    the glob picks the data files of a folder. Without ``checkpoint`` the
    stream keeps its progress under ``spark.checkpoint.dir``."""
    handler = Intake(specs, lake_root=lake_root, audit_root=audit_root,
                     quarantine_root=quarantine_root, load_ts=load_ts, parallel_loads=parallel_loads, jdbc=jdbc,
                     max_attempts=max_attempts, glob=glob if marker is not None else None)
    w = (arrivals(spark, landing, glob, unit, max_files_per_batch, archive_dir, marker).writeStream
         .foreachBatch(handler)
         .option("checkpointLocation", checkpoint or default_checkpoint(spark, landing)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "30 seconds")
    return w.start()
