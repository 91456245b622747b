"""Guarded splitting, line ends, checksums, lost values, the pointer by arrival, whole drops, attempts
and the compacted audit."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from landfall.operators.rows import has_open_quote
from landfall.plans import feeds
from landfall.plans import run as R
from landfall.plans.load import build_load
from landfall.plans.run import run_arrival, run_load
from landfall.sinks.audit import append_audit, committed_epochs, compact_audit, dead_letters, read_audit
from landfall.sinks.lake import current_load_id, is_newest, read_current, read_snapshot, superseded_loads
from landfall.sources.delimited import read_head, record_report
from landfall.streaming.intake import arrivals, pending_folders, start_intake
from tests.conftest import write_text

HDR = "Patient MRN|Admit Date or Service Date|Note\n"
VISITS = feeds.VISITS


def roots(workdir):
    return {"lake_root": f"{workdir}/lake", "audit_root": f"{workdir}/audit"}


def rows_of(spark, workdir, out):
    return sorted(map(tuple, read_snapshot(spark, f"{workdir}/lake/{out.target}", out.load_id).select("Patient MRN", "Note").collect()))


# ---------------------------------------------------------------- splitting, guarded
def test_registered_feeds_split_and_read_alike(spark, workdir):
    lines = [f'{i}|1/5/2024|{"a ""quoted"" | note" if i % 9 == 0 else "plain"} {i:060d}' for i in range(25_000)]
    lines = [x if i % 9 else x.replace("|1/5/2024|", '|1/5/2024|"') + '"' for i, x in enumerate(lines)]
    p = write_text(f"{workdir}/patient_visits_1.txt", HDR + "\n".join(lines) + "\n")
    assert os.path.getsize(p) > 2_000_000
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert build_load(spark, VISITS, p, load_ts="x").rows.rdd.getNumPartitions() > 8
        out = run_load(spark, VISITS, p, **roots(workdir))
        whole = run_load(spark, VISITS.with_options(multi_line=True), p, **roots(workdir))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert (out.status, out.rows_target, whole.status) == ("SUCCEEDED", 25_000, "SUCCEEDED")
    assert rows_of(spark, workdir, out) == rows_of(spark, workdir, whole)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("record", ['5|1/5/2024|"two\nlines"', '5|"1/5/2024\n"|x', '"5\n6"|1/5/2024|x', '5|1/5/2024|"a\nb|c|d"', '5|1/5/2024|"a\n"', '5|1/5/2024|"a\n|""|""\nb"',
                                    '5|1/5/2024|"a\n""""', '5|1/5/2024|"a|b\n|"'])
def test_a_quoted_line_break_fails_a_feed_that_splits(spark, workdir, record, end):
    text = (HDR + "1|1/5/2024|x\n" + record + "\n7|1/5/2024|y\n").replace("\n", end)
    out = run_load(spark, VISITS, write_text(f"{workdir}/v.txt", text), **roots(workdir))
    assert out.status == "FAILED" and out.error_type == "DataError"
    with pytest.raises(LookupError):  # nothing was switched
        read_current(spark, f"{workdir}/lake/{VISITS.target}", f"{workdir}/audit", VISITS.target)


def test_the_guard_names_the_flag_and_the_flag_reads_the_file(spark, workdir):
    p = write_text(f"{workdir}/v.txt", HDR + '1|1/5/2024|"two\nlines"\n2|1/5/2024|x\n')
    out = run_load(spark, VISITS, p, **roots(workdir))
    assert out.error == "1 lines hold a quoted field with a line break; load feed visits with multi_line=True"
    out = run_load(spark, VISITS.with_options(multi_line=True), p, **roots(workdir))
    assert out.status == "SUCCEEDED" and rows_of(spark, workdir, out) == [("1", "two\nlines"), ("2", "x")]


def test_quotes_that_stay_on_their_line_pass_the_guard(spark, workdir):
    text = HDR + '1|1/5/2024|5" pipe\n2|1/5/2024|"""q"""\n3|1/5/2024|"a|b"\n4|1/5/2024|"x"y\n5|1/5/2024|""\n'
    out = run_load(spark, VISITS, write_text(f"{workdir}/v.txt", text), **roots(workdir))
    assert rows_of(spark, workdir, out) == [("1", '5" pipe'), ("2", '"q"'), ("3", "a|b"), ("4", '"x"y'), ("5", None)]


def test_random_broken_records_are_never_read_silently(spark, workdir):
    """Whatever stands in a quoted field with a line break, the lines are told from whole records."""
    rng = random.Random(3)
    texts = ["".join(rng.choice(['a', '"', '|', '\n', ' ']) for _ in range(rng.randint(1, 8))) for _ in range(400)]
    texts = [t if "\n" in t else t + "\n" for t in texts]
    got = {}
    for k, t in enumerate(texts):
        place = k % 3
        fields = [f"{k}", "1/5/2024", "x"]
        fields[place] = '"' + t.replace('"', '""') + '"'
        first = "|".join(fields).split("\n")[0]
        got[first] = True
    df = spark.createDataFrame([(x,) for x in got], "raw string")
    assert df.filter(~has_open_quote("raw", "|")).count() == 0
    shut = spark.createDataFrame([('a|b',), ('"a"|b',), ('a|"b""c"',), ('"x"y|z',), ('5"|6',), ('""|""',), ("",), (None,)], "raw string")
    assert shut.filter(has_open_quote("raw", "|")).count() == 0


# ---------------------------------------------------------------- line ends
@pytest.mark.parametrize("multi_line", [True, False])
def test_line_ends_stay_as_landed(spark, workdir, multi_line):
    unix = write_text(f"{workdir}/u.txt", "a|b\n1|\"x\r\ny\"\n2|z\n")
    dos = write_text(f"{workdir}/d.txt", "a|b\r\n1|\"x\ny\"\r\n2|z\r\n")
    both = write_text(f"{workdir}/b.txt", "a|b\r\n1|\"x\r\ny\"\r\n2|z\r\n")
    assert read_head(spark, unix) == (["a", "b"], None)
    assert read_head(spark, dos) == (["a", "b"], "\r\n") and read_head(spark, write_text(f"{workdir}/o.txt", "a\r\n1\r\n"))[1] is None
    spec = feeds.FeedSpec(name="t", prefix="t", target="t", rules=(), multi_line=multi_line)
    got = {}
    for name, p in (("unix", unix), ("dos", dos), ("both", both)):
        out = run_load(spark, spec, p, **roots(workdir))
        got[name] = sorted(map(tuple, read_snapshot(spark, f"{workdir}/lake/t", out.load_id).collect())) if out.status == "SUCCEEDED" else out.error_type
    if multi_line:  # Spark's parser still drops the CR of a CR LF inside quotes where records end in LF
        assert got["dos"] == [("1", "x\ny"), ("2", "z")] and got["both"] == [("1", "x\r\ny"), ("2", "z")] and got["unix"][1] == ("2", "z")
    else:  # a bare line feed does not end a record of a CR LF file, so that one splits and is whole
        assert got == {"unix": "DataError", "dos": [("1", "x\ny"), ("2", "z")], "both": "DataError"}


def test_mixed_line_ends_are_found(spark, workdir):
    p = write_text(f"{workdir}/m.txt", HDR.replace("\n", "\r\n") + "1|1/5/2024|x\r\n2|1/5/2024\nshort\r\n3|1/5/2024|y\n4|1/5/2024|z\r\n")
    out = run_load(spark, VISITS.with_options(long_rows="quarantine"), p, **roots(workdir))
    assert (out.status, out.error) == ("FAILED", "line ends differ within the file (2 records)")
    r = record_report(spark, p, "|", "\r\n").first()
    assert (r["lines"], r["open_quotes"], r["stray_ends"]) == (4, 0, 2)


# ---------------------------------------------------------------- content (A3) and lost values (F2)
def test_a_changed_value_fails_the_load(spark, workdir, monkeypatch):
    p = write_text(f"{workdir}/v.txt", HDR + "".join(f"{i}|1/5/2024|note\n" for i in range(50)))
    spec = VISITS.with_options(reconcile="content")
    good = run_load(spark, spec, p, **roots(workdir))
    assert good.status == "SUCCEEDED" and good.sum_written == good.sum_target is not None
    write = R.write_snapshot

    def changed(df, root, load_id, **kw):
        write(df, root, f"{load_id}-first", **kw)
        one = read_snapshot(spark, root, f"{load_id}-first", schema=df.schema)
        return write(one.withColumn("Note", F.when(F.col("Patient MRN") == "7", "other").otherwise(F.col("Note"))), root, load_id, **kw)

    monkeypatch.setattr(R, "write_snapshot", changed)
    bad = run_load(spark, spec, p, **roots(workdir))
    assert (bad.status, bad.error_type, bad.rows_target) == ("FAILED", "CountMismatch", 50) and bad.sum_written != bad.sum_target
    assert run_load(spark, VISITS, p, **roots(workdir)).status == "SUCCEEDED"  # the count alone does not see it
    a = {r["load_id"]: r for r in read_audit(spark, f"{workdir}/audit").collect()}
    assert a[good.load_id]["sum_written"] == good.sum_written and a[bad.load_id]["sum_target"] == bad.sum_target
    with pytest.raises(ValueError):
        VISITS.with_options(reconcile="all")


def test_lost_values_are_counted_and_audited(spark, workdir):
    text = "Patient MRN|Patient DOB|Patient Phone Number\n1|1/5/1980|555-1\n2|garbage|none\n3||\n4|2/30/1999|x\n5|NA|7\n6|  |8\n"
    out = run_load(spark, feeds.DEMOGRAPHICS, write_text(f"{workdir}/d.txt", text), **roots(workdir))
    assert out.status == "SUCCEEDED" and out.lost_values == {"Patient DOB": 2, "Patient Phone Number": 2}
    assert read_audit(spark, f"{workdir}/audit").first()["lost_values"] == out.lost_values
    strict = run_load(spark, VISITS, write_text(f"{workdir}/v.txt", HDR + "1|1/5/2024|x\n"), **roots(workdir))
    assert strict.lost_values is None


# ---------------------------------------------------------------- pointer by arrival
def test_an_older_file_that_is_loaded_late_stays_hidden(spark, workdir, monkeypatch):
    kw = roots(workdir)
    new, old = write_text(f"{workdir}/new.txt", HDR + "new|1/5/2024|x\n"), write_text(f"{workdir}/old.txt", HDR + "old|1/5/2024|x\n")
    os.utime(old, (time.time() - 3600,) * 2)
    copied = []
    monkeypatch.setattr(R, "replace_jdbc", lambda df, **o: copied.append(df.first()["Patient MRN"]))
    monkeypatch.setattr(R, "read_jdbc", lambda spark, **o: spark.range(1))
    first = run_load(spark, VISITS, new, jdbc={"url": "u", "table": "t"}, **kw)
    second = run_load(spark, VISITS, old, jdbc={"url": "u", "table": "t"}, **kw)  # finishes last, arrived first
    assert first.status == second.status == "SUCCEEDED" and first.arrived > second.arrived
    root = f"{workdir}/lake/{VISITS.target}"
    assert [r["Patient MRN"] for r in read_current(spark, root, kw["audit_root"], VISITS.target).collect()] == ["new"]
    assert copied == ["new"]  # nor does it replace the database table
    assert [r["load_id"] for r in superseded_loads(spark, root, kw["audit_root"], VISITS.target, keep=1).collect()] == [second.load_id]
    third = run_load(spark, VISITS, old, arrived=first.arrived + 1, **kw)
    assert current_load_id(spark, kw["audit_root"], VISITS.target) == third.load_id
    assert not is_newest(spark, kw["audit_root"], VISITS.target, first.arrived) and is_newest(spark, kw["audit_root"], VISITS.target, None)


# ---------------------------------------------------------------- whole drops
def test_a_folder_is_loaded_once_it_is_whole(spark, workdir):
    land = f"{workdir}/landing"
    kw = dict(**roots(workdir), checkpoint=f"{workdir}/ck", unit="directory", marker="DONE", glob="*.csv", max_files_per_batch=1)
    for k in range(3):
        write_text(f"{land}/patient_visits_1.txt/part-{k}.csv", HDR + f"{k}|1/5/2024|x\n")
    start_intake(spark, land, feeds.ALL_FEEDS, **kw).awaitTermination()
    assert read_audit(spark, kw["audit_root"]).count() == 0
    assert [(r["path"].split("/")[-1], r["files"]) for r in pending_folders(spark, land, "DONE").collect()] == [("patient_visits_1.txt", 3)]
    write_text(f"{land}/patient_visits_1.txt/DONE", "written by the producer, no data\n")
    start_intake(spark, land, feeds.ALL_FEEDS, **kw).awaitTermination()
    a = read_audit(spark, kw["audit_root"]).collect()
    assert [(r["file"], r["status"], r["rows_target"]) for r in a] == [("patient_visits_1.txt", "SUCCEEDED", 3)]
    assert pending_folders(spark, land, "DONE").count() == 0
    for bad in ({"unit": "file"}, {"marker": "_SUCCESS"}):
        with pytest.raises(ValueError):
            arrivals(spark, land, **{"unit": "directory", "marker": "DONE", **bad})


# ---------------------------------------------------------------- attempts (T4)
def test_a_poison_file_is_given_up_and_the_others_load(spark, workdir, monkeypatch):
    land, kw = f"{workdir}/landing", roots(workdir)
    write_text(f"{land}/patient_visits_1.txt", HDR + "1|1/5/2024|x\n")
    write_text(f"{land}/rx_orders_1.txt", "Order ID|Date Sent\n1|1/5/2024\n")
    write = R.write_snapshot

    def poison(df, root, load_id, **k):
        if VISITS.target in root:
            raise RuntimeError("[SINK_DOWN] 1|1/5/2024")
        return write(df, root, load_id, **k)

    monkeypatch.setattr(R, "write_snapshot", poison)
    go = lambda: start_intake(spark, land, feeds.ALL_FEEDS, checkpoint=f"{workdir}/ck", glob="*.txt", max_attempts=2, **kw).awaitTermination()
    states = lambda: sorted((r["feed"], r["status"], r["attempt"]) for r in read_audit(spark, kw["audit_root"]).collect())
    for n in (1, 2):
        with pytest.raises(Exception, match="SINK_DOWN"):
            go()
        assert states() == [("rx_orders", "SUCCEEDED", 1)] + [("visits", "ERROR", k + 1) for k in range(n)]
    go()  # the attempts are used up
    assert ("visits", "DEAD", 2) in states()
    d = dead_letters(spark, kw["audit_root"]).collect()
    assert [(r["feed"], r["path"].split("/")[-1], r["error_type"], r["error"]) for r in d] == [("visits", "patient_visits_1.txt", "RuntimeError", "SINK_DOWN")]
    monkeypatch.setattr(R, "write_snapshot", write)
    write_text(f"{land}/patient_visits_2.txt", HDR + "2|1/5/2024|x\n")
    go()
    assert ("visits", "SUCCEEDED", 1) in states()


def test_an_arrival_that_recovers_is_no_dead_letter(spark, workdir, monkeypatch):
    p, kw = write_text(f"{workdir}/v.txt", HDR + "1|1/5/2024|x\n"), roots(workdir)
    write, calls = R.write_snapshot, []

    def once(*a, **k):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("[LOST]")
        return write(*a, **k)

    monkeypatch.setattr(R, "write_snapshot", once)
    with pytest.raises(RuntimeError):
        run_arrival(spark, VISITS, p, "t", **kw)
    assert run_arrival(spark, VISITS, p, "t", **kw).attempt == 2 and run_arrival(spark, VISITS, p, "t", **kw) is None
    assert dead_letters(spark, kw["audit_root"]).count() == 0


# ---------------------------------------------------------------- the audit's epochs
def record(k):
    return {"load_id": f"id{k}", "feed": "visits", "target": f"t{k % 2}", "file": "f", "status": "SUCCEEDED", "rows_read": k, "arrived": k, "lost_values": {"a": k}, "sum_written": 2 ** 70 + k}


def test_compaction_loses_and_doubles_no_row(spark, workdir):
    root = f"{workdir}/audit"
    assert compact_audit(spark, root) is None and read_audit(spark, root).count() == 0
    for k in range(6):
        append_audit(spark, root, record(k))
    ids = lambda df: sorted(r["load_id"] for r in df.select("load_id").collect())
    rows = lambda df: sorted(map(str, df.collect()))
    before = read_audit(spark, root)
    want = rows(before)
    assert compact_audit(spark, root) == 1 and committed_epochs(spark, root) == [1]
    assert rows(read_audit(spark, root)) == want == rows(before)  # also for a reader that began before
    assert compact_audit(spark, root) is None  # nothing new
    during = read_audit(spark, root)
    for k in range(6, 9):
        append_audit(spark, root, record(k))
    assert ids(read_audit(spark, root)) == [f"id{k}" for k in range(9)]
    assert compact_audit(spark, root) == 2
    assert ids(during) == [f"id{k}" for k in range(6)]
    assert ids(read_audit(spark, root)) == [f"id{k}" for k in range(9)]
    assert current_load_id(spark, root, "t0") == "id8"
    left = lambda: len([f for d, _, names in os.walk(root) for f in names if f.endswith(".parquet") and "_epochs" not in d])
    assert left() == 3  # the log files of the first epoch are gone
    during = read_audit(spark, root)
    append_audit(spark, root, record(9))
    assert compact_audit(spark, root) == 3 and committed_epochs(spark, root) == [2, 3]
    assert left() == 1
    assert ids(during) == [f"id{k}" for k in range(9)]
    append_audit(spark, root, record(10))
    assert compact_audit(spark, root) == 4 and left() == 1
    assert ids(read_audit(spark, root)) == sorted(f"id{k}" for k in range(11))


def test_an_epoch_without_its_commit_does_not_count(spark, workdir):
    root = f"{workdir}/audit"
    append_audit(spark, root, record(1))
    assert compact_audit(spark, root) == 1
    append_audit(spark, root, record(2))
    read_audit(spark, root).limit(0).write.parquet(f"{root}/_epochs/2/rows")  # a compaction that died
    assert sorted(r["load_id"] for r in read_audit(spark, root).collect()) == ["id1", "id2"]
    assert compact_audit(spark, root) == 2 and read_audit(spark, root).count() == 2
