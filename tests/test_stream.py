"""Arrival stream: two files of one feed in a batch, one unmatched file, a
later arrival, and a restart that finds nothing new."""

import time

from pyspark.sql import functions as F

from landfall.plans import feeds
from landfall.sinks.audit import read_audit
from landfall.sinks.lake import read_current
from landfall.streaming.intake import start_intake
from tests.conftest import write_text

HDR = "Patient MRN|Admit Date or Service Date\n"


def test_intake_latest_wins(spark, workdir):
    land = f"{workdir}/landing"
    kw = dict(lake_root=f"{workdir}/lake", audit_root=f"{workdir}/audit", checkpoint=f"{workdir}/ckpt",
              glob="*.txt", load_ts="2024-01-05 00:00:00.000")
    write_text(f"{land}/patient_visits_1.txt", HDR + "1|1/5/2024\n")
    time.sleep(0.05)
    write_text(f"{land}/patient_visits_2 x.txt", HDR + "2|1/5/2024\n")
    write_text(f"{land}/unknown_1.txt", "a\n1\n")
    start_intake(spark, land, feeds.ALL_FEEDS, **kw).awaitTermination()
    target = feeds.VISITS.target
    cur = read_current(spark, f"{workdir}/lake/{target}", kw["audit_root"], target)
    assert [(r["Patient MRN"], r["File Name"]) for r in cur.collect()] == [("2", "patient_visits_2 x.txt")]
    st = {(r["file"], r["status"]) for r in read_audit(spark, kw["audit_root"]).collect()}
    assert st == {("patient_visits_1.txt", "SUPERSEDED"), ("patient_visits_2 x.txt", "SUCCEEDED"),
                  ("unknown_1.txt", "SKIPPED")}
    write_text(f"{land}/patient_visits_3.txt", HDR + "3|1/5/2024\n")
    start_intake(spark, land, feeds.ALL_FEEDS, **kw).awaitTermination()
    cur = read_current(spark, f"{workdir}/lake/{target}", kw["audit_root"], target)
    assert [r["Patient MRN"] for r in cur.collect()] == ["3"]
    n = read_audit(spark, kw["audit_root"]).count()
    start_intake(spark, land, feeds.ALL_FEEDS, **kw).awaitTermination()  # restart: nothing new
    assert read_audit(spark, kw["audit_root"]).count() == n


def test_intake_from_notification_records(spark, workdir):
    import json

    from landfall.streaming.intake import start_notified_intake

    land = f"{workdir}/landing"
    write_text(f"{land}/patient_visits 1.txt", HDR + "1|1/5/2024\n")
    write_text(f"{land}/patient_visits+2.txt", HDR + "2|1/5/2024\n")

    def record(key, t):
        return {"eventTime": t, "eventName": "ObjectCreated:Put",
                "s3": {"bucket": {"name": ""}, "object": {"key": key, "size": 1}}}

    # Keys arrive +-encoded; the store is empty so that file://<store>/<key> is local.
    root = land.lstrip("/")
    ev = {"Records": [record(f"{root}/patient_visits+1.txt", "2024-01-05T00:00:01Z"),
                      record(f"{root}/patient_visits%2B2.txt", "2024-01-05T00:00:02Z")]}
    write_text(f"{workdir}/events/e1.json", json.dumps(ev) + "\n")
    kw = dict(lake_root=f"{workdir}/lake", audit_root=f"{workdir}/audit", checkpoint=f"{workdir}/ckpt",
              scheme="file", load_ts="2024-01-05 00:00:00.000")
    start_notified_intake(spark, f"{workdir}/events", feeds.ALL_FEEDS, **kw).awaitTermination()
    target = feeds.VISITS.target
    cur = read_current(spark, f"{workdir}/lake/{target}", kw["audit_root"], target)
    assert [(r["Patient MRN"], r["File Name"]) for r in cur.collect()] == [("2", "patient_visits+2.txt")]
    st = {(r["file"], r["status"]) for r in read_audit(spark, kw["audit_root"]).collect()}
    assert st == {("patient_visits 1.txt", "SUPERSEDED"), ("patient_visits+2.txt", "SUCCEEDED")}


def test_replayed_batch_adds_no_second_outcome(spark, workdir):
    from landfall.streaming.intake import Intake

    land = f"{workdir}/landing"
    write_text(f"{land}/patient_visits_1.txt", HDR + "1|1/5/2024\n")
    time.sleep(0.05)
    write_text(f"{land}/patient_visits_2.txt", HDR + "2|1/5/2024\n")
    write_text(f"{land}/other.txt", "a\n1\n")
    batch = (spark.read.format("binaryFile").load(land)
             .select(F.regexp_replace("path", "^file:", "").alias("path"), F.col("modificationTime").alias("arrived")))
    h = Intake(feeds.ALL_FEEDS, lake_root=f"{workdir}/lake", audit_root=f"{workdir}/audit",
               load_ts="2024-01-05 00:00:00.000")
    h(batch, 0)
    first = sorted((r["file"], r["status"]) for r in read_audit(spark, f"{workdir}/audit").collect())
    h(batch, 0)  # the same batch again, as after a crash
    again = sorted((r["file"], r["status"]) for r in read_audit(spark, f"{workdir}/audit").collect())
    assert first == again == [("other.txt", "SKIPPED"), ("patient_visits_1.txt", "SUPERSEDED"),
                              ("patient_visits_2.txt", "SUCCEEDED")]
