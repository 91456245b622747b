"""Lake snapshot replace, audit, reconciliation, delimited export."""



from landfall.plans import feeds
from landfall.plans.run import run_load
from landfall.sinks.audit import read_audit
from landfall.sinks.delimited import write_delimited
from landfall.sinks.lake import current_load_id, read_current
from landfall.sources.delimited import count_invalid_utf8, read_table_text
from tests.conftest import write_text

HDR = "Patient MRN|Admit Date or Service Date\n"


def test_replace_keeps_last_good_snapshot(spark, workdir):
    lake, audit = f"{workdir}/lake", f"{workdir}/audit"
    kw = dict(lake_root=lake, audit_root=audit, load_ts="2024-01-05 00:00:00.000")
    a = write_text(f"{workdir}/in/v_a.txt", HDR + "1|1/5/2024\n2|1/6/2024\n")
    b = write_text(f"{workdir}/in/v_b.txt", HDR + "3|1/7/2024\nx|garbage\n")
    c = write_text(f"{workdir}/in/v_c.txt", HDR + "4|1/8/2024\n")
    o1 = run_load(spark, feeds.VISITS, a, **kw)
    assert o1.status == "SUCCEEDED" and o1.rows_read == 2 and o1.rows_target == 2
    o2 = run_load(spark, feeds.VISITS, b, **kw)
    assert o2.status == "FAILED" and o2.error_type == "DataError"
    assert "unreadable date" in o2.error and "garbage" not in o2.error
    cur = read_current(spark, f"{lake}/{feeds.VISITS.target}", audit, feeds.VISITS.target)
    assert sorted(r["Patient MRN"] for r in cur.collect()) == ["1", "2"]
    o3 = run_load(spark, feeds.VISITS, c, **kw)
    assert o3.status == "SUCCEEDED"
    assert current_load_id(spark, audit, feeds.VISITS.target) == o3.load_id
    cur = read_current(spark, f"{lake}/{feeds.VISITS.target}", audit, feeds.VISITS.target)
    assert [r["Patient MRN"] for r in cur.collect()] == ["4"]
    a_rows = read_audit(spark, audit).orderBy("recorded_at").select("status", "file", "message").collect()
    assert [r["status"] for r in a_rows] == ["SUCCEEDED", "FAILED", "SUCCEEDED"]
    assert a_rows[1]["message"].startswith("The load visits has FAILED for file v_b.txt. Error: ")


def test_missing_source_and_quarantine_counts(spark, workdir):
    lake, audit = f"{workdir}/lake", f"{workdir}/audit"
    o = run_load(spark, feeds.VISITS, f"{workdir}/none.txt", lake_root=lake, audit_root=audit)
    assert o.status == "FAILED" and o.error_type == "SourceMissing"
    p = write_text(f"{workdir}/in/q.txt", HDR + "1|1/5/2024\n2|1/5/2024|x\n3|1/5/2024\n")
    spec = feeds.VISITS.with_options(long_rows="quarantine")
    o = run_load(spark, spec, p, lake_root=lake, audit_root=audit)
    assert (o.status, o.rows_read, o.rows_quarantined, o.rows_target) == ("SUCCEEDED", 3, 1, 2)


def test_invalid_utf8_fails_before_switch(spark, workdir):
    lake, audit = f"{workdir}/lake", f"{workdir}/audit"
    p = write_text(f"{workdir}/in/u.txt", (HDR + "1|1/5/2024\n").encode() + b"2\xff|1/5/2024\n")
    assert count_invalid_utf8(spark, p) == 1
    o = run_load(spark, feeds.VISITS, p, lake_root=lake, audit_root=audit)
    assert o.status == "FAILED" and o.error_type == "EncodingError"
    ok = write_text(f"{workdir}/in/u2.txt", HDR + "1|x�y\n".replace("x�y", "1/5/2024") + "2|1/5/2024\n")
    assert count_invalid_utf8(spark, ok) == 0


def test_comma_export_roundtrip(spark, workdir):
    df = spark.createDataFrame([("1", 'a,"b"', None), ("2", "line\nbreak", "")], "k string, v string, w string")
    write_delimited(df, f"{workdir}/out.csv")
    back = read_table_text(spark, f"{workdir}/out.csv", multi_line=True)
    got = sorted(tuple(r) for r in back.collect())
    # An empty text comes back as NULL, as in a staged export and re-read.
    assert got == [("1", 'a,"b"', None), ("2", "line\nbreak", None)]


def test_superseded_loads_lists_all_but_the_latest(spark, workdir):
    from landfall.sinks.lake import superseded_loads

    lake, audit = f"{workdir}/lake", f"{workdir}/audit"
    kw = dict(lake_root=lake, audit_root=audit, load_ts="2024-01-05 00:00:00.000")
    ids = []
    for i in range(3):
        p = write_text(f"{workdir}/in/v{i}.txt", HDR + f"{i}|1/5/2024\n")
        ids.append(run_load(spark, feeds.VISITS, p, **kw).load_id)
    old = superseded_loads(spark, f"{lake}/{feeds.VISITS.target}", audit, feeds.VISITS.target, keep=1).collect()
    assert sorted(r["load_id"] for r in old) == sorted(ids[:2])
    assert all(r["path"].endswith(f"load_id={r['load_id']}") for r in old)


def test_header_only_file_and_all_empty_row(spark, workdir):
    lake, audit = f"{workdir}/lake", f"{workdir}/audit"
    p = write_text(f"{workdir}/in/empty.txt", HDR)
    o = run_load(spark, feeds.VISITS, p, lake_root=lake, audit_root=audit)
    assert (o.status, o.rows_read, o.rows_target) == ("SUCCEEDED", 0, 0)
    cur = read_current(spark, f"{lake}/{feeds.VISITS.target}", audit, feeds.VISITS.target)
    assert cur.count() == 0 and "Patient MRN" in cur.columns
    p = write_text(f"{workdir}/in/blank.txt", HDR + "|\n")
    o = run_load(spark, feeds.VISITS, p, lake_root=lake, audit_root=audit)
    assert (o.status, o.rows_read, o.rows_target) == ("SUCCEEDED", 1, 1)
    row = read_current(spark, f"{lake}/{feeds.VISITS.target}", audit, feeds.VISITS.target).first()
    assert row["Patient MRN"] is None and row["Admit Date or Service Date"] is None


def test_folder_with_a_different_header_fails_as_header_error(spark, workdir):
    write_text(f"{workdir}/in/drop.txt/part-0.csv", HDR + "1|1/5/2024\n")
    write_text(f"{workdir}/in/drop.txt/part-1.csv", "Patient MRN|Visit Date\n2|1/5/2024\n")
    o = run_load(spark, feeds.VISITS, f"{workdir}/in/drop.txt", lake_root=f"{workdir}/lake",
                 audit_root=f"{workdir}/audit")
    assert (o.status, o.error_type) == ("FAILED", "HeaderError")


def test_utf8_check_can_be_switched_off(spark, workdir):
    p = write_text(f"{workdir}/in/u.txt", (HDR + "1|1/5/2024\n").encode() + b"2\xff|1/5/2024\n")
    o = run_load(spark, feeds.VISITS.with_options(strict_utf8=False), p, lake_root=f"{workdir}/lake",
                 audit_root=f"{workdir}/audit")
    assert (o.status, o.rows_target) == ("SUCCEEDED", 2)


def test_unexpected_error_is_noted_and_raised(spark, workdir, monkeypatch):
    import pytest

    import landfall.plans.run as R

    p = write_text(f"{workdir}/in/v.txt", HDR + "1|1/5/2024\n")

    def boom(*a, **k):
        raise RuntimeError("[SOME_SINK_FAILURE] value 1|1/5/2024 could not be written")

    monkeypatch.setattr(R, "write_snapshot", boom)
    with pytest.raises(RuntimeError):
        R.run_load(spark, feeds.VISITS, p, lake_root=f"{workdir}/lake", audit_root=f"{workdir}/audit")
    row = read_audit(spark, f"{workdir}/audit").first()
    assert (row["status"], row["error_type"], row["error"]) == ("ERROR", "RuntimeError", "SOME_SINK_FAILURE")
    assert "1/5/2024" not in row["message"]
