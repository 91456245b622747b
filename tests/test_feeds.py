"""Golden feeds: small landing files written by hand, loaded through each spec."""

import os

import pytest

from landfall.errors import HeaderError, SourceMissing
from landfall.plans import feeds
from landfall.plans.load import build_load, load
from landfall.sources.delimited import check_header, read_header
from tests.conftest import write_text

STAMP = "2024-01-05 06:07:08.009"


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_providers_golden(spark, workdir):
    p = write_text(os.path.join(workdir, "providers a b.txt"),
                   "Provider NPI|Provider Name|Degree|Current Status|Department ID|Department Name|"
                   "Section Name|Start Date|End Date|Specialty|Extra\n"
                   '1|Smith John|MD|Active|10|"Onc, ""A"""|S1|1/5/2024|12/31/9999|Heme|x\n'
                   "2|Cher|DO|NA|11|Rad|S2|2024-01-05||null|y\n"
                   '3|"Van Der\nBerg Anna"|RN|Active|12|Lab|S3|20240105|13/01/2024|N/A|z\n'
                   "\n"
                   "4|Doe Jane|MD\n")
    with pytest.raises(Exception, match="multi_line=True"):  # the feed says that no field has a line break
        load(spark, feeds.PROVIDERS, p, load_ts=STAMP).collect()
    got = rows(load(spark, feeds.PROVIDERS.with_options(multi_line=True), p, load_ts=STAMP))
    assert [list(r) for r in got][0] == list(feeds.PROVIDERS.output)
    by = {r["Provider NPI"]: r for r in got}
    assert len(got) == 4
    assert by["1"]["Provider Last Name"] == "Smith" and by["1"]["Provider First Name"] == "John"
    assert by["1"]["Department Name"] == 'Onc, "A"'
    assert by["1"]["Start Date"] == "01-05-2024" and by["1"]["End Date"] == "12-31-9999"
    assert by["2"]["Provider Last Name"] == "Cher" and by["2"]["Provider First Name"] is None
    assert by["2"]["Current Status"] is None and by["2"]["End Date"] is None and by["2"]["Specialty"] is None
    assert by["3"]["Provider Last Name"] == "Van Der\nBerg" and by["3"]["Provider First Name"] == "Anna"
    assert by["3"]["End Date"] == "01-13-2024"
    assert by["4"]["Degree"] == "MD" and by["4"]["Start Date"] is None  # short row padded
    assert {r["File Name"] for r in got} == {"providers a b.txt"}
    assert {r["Load Timestamp"] for r in got} == {STAMP}


def test_demographics_open_and_lenient(spark, workdir):
    p = write_text(os.path.join(workdir, "demo+1%20x.txt"),
                   "Patient MRN|Patient DOB|Patient Phone Number|Note\n"
                   "1|1/5/2024|(212) 555-0100|None\n"
                   "2|garbage|none|NA\n"
                   "3||NaN|\n")
    got = rows(load(spark, feeds.DEMOGRAPHICS, p, load_ts=STAMP))
    assert list(got[0]) == ["Patient MRN", "Patient DOB", "Patient Phone Number", "Note", "Load Timestamp", "File Name"]
    by = {r["Patient MRN"]: r for r in got}
    assert by["1"]["Patient DOB"] == "01-05-2024" and by["1"]["Patient Phone Number"] == "2125550100"
    assert by["1"]["Note"] == "None"
    assert by["2"]["Patient DOB"] is None and by["2"]["Patient Phone Number"] is None and by["2"]["Note"] is None
    assert by["3"]["Patient DOB"] is None and by["3"]["Patient Phone Number"] is None
    assert by["3"]["File Name"] == "demo+1%20x.txt"


def test_appointments_closed(spark, workdir):
    p = write_text(os.path.join(workdir, "appt.txt"),
                   "Patient MRN|Provider Name|Department ID|Department Name|Appointment Date|Appointment Time|"
                   "Appointment Type|Appointment Description|Appointment Status|Room\n"
                   "7|Lee Ann|1|D|01/05/2024|9:05:07|F|desc|Booked|R1\n")
    got = rows(load(spark, feeds.APPOINTMENTS, p, load_ts=STAMP))
    assert list(got[0]) == list(feeds.APPOINTMENTS.output)
    assert got[0]["Appointment Time"] == "09:05" and got[0]["Appointment Date"] == "01-05-2024"


def test_strict_time_fails_the_load(spark, workdir):
    p = write_text(os.path.join(workdir, "appt_bad.txt"),
                   "Patient MRN|Provider Name|Department ID|Department Name|Appointment Date|Appointment Time|"
                   "Appointment Type|Appointment Description|Appointment Status\n"
                   "7|Lee Ann|1|D|01/05/2024|09:05|F|desc|Booked\n")
    with pytest.raises(Exception) as e:
        load(spark, feeds.APPOINTMENTS, p, load_ts=STAMP).collect()
    assert "unreadable time" in str(e.value)


def test_rx_orders_rename_and_absent_rename(spark, workdir):
    p1 = write_text(os.path.join(workdir, "rx1.txt"), "pharmacyid|Date Sent|Drug Name\n9|1/2/2023|x\n")
    p2 = write_text(os.path.join(workdir, "rx2.txt"), "Date Sent|Drug Name\n1/2/2023|x\n")
    r1 = rows(load(spark, feeds.RX_ORDERS, p1, load_ts=STAMP))[0]
    r2 = rows(load(spark, feeds.RX_ORDERS, p2, load_ts=STAMP))[0]
    assert list(r1)[:3] == ["Pharmacy ID", "Date Sent", "Drug Name"] and r1["Pharmacy ID"] == "9"
    assert list(r2)[:2] == ["Date Sent", "Drug Name"] and r2["Date Sent"] == "01-02-2023"


def test_long_row_fails_or_quarantines(spark, workdir):
    p = write_text(os.path.join(workdir, "visits.txt"),
                   "Patient MRN|Admit Date or Service Date|Note\n1|1/5/2024|n\n2|1/6/2024|n|extra\n"
                   "3|1/7/2024|\"a|b\"\n")
    with pytest.raises(Exception) as e:
        load(spark, feeds.VISITS, p, load_ts=STAMP).collect()
    assert "more fields than the header" in str(e.value)
    fl = build_load(spark, feeds.VISITS.with_options(long_rows="quarantine"), p, load_ts=STAMP)
    kept = rows(fl.rows)
    q = rows(fl.quarantine)
    assert sorted(r["Patient MRN"] for r in kept) == ["1", "3"]
    assert q == [{"feed": "visits", "file": "visits.txt", "record_key": "2",
                  "raw_record": "2|1/6/2024|n|extra", "reason": "long_row"}]


def test_header_checks(spark, workdir):
    with pytest.raises(HeaderError):
        check_header(["a", "A"])
    with pytest.raises(HeaderError):
        check_header(["a", ""])
    with pytest.raises(HeaderError):
        check_header(["a"], required=["b"])
    p = write_text(os.path.join(workdir, "h.txt"), '"x|y"|b\n1|2\n')
    assert read_header(spark, p) == ["x|y", "b"]
    with pytest.raises(SourceMissing):
        read_header(spark, os.path.join(workdir, "nope.txt"))
    with pytest.raises(HeaderError):
        build_load(spark, feeds.VISITS, p)


def test_one_scan_per_load(spark, workdir):
    p = write_text(os.path.join(workdir, "v.txt"), "Patient MRN|Admit Date or Service Date\n1|1/5/2024\n")
    plan = load(spark, feeds.VISITS, p)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan csv") == 1
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_bom_and_other_charsets(spark, workdir):
    p = write_text(os.path.join(workdir, "bom.txt"),
                   b"\xef\xbb\xbfPatient MRN|Admit Date or Service Date\n1|1/5/2024\n")
    assert read_header(spark, p) == ["Patient MRN", "Admit Date or Service Date"]
    assert rows(load(spark, feeds.VISITS, p, load_ts=STAMP))[0]["Patient MRN"] == "1"
    p = write_text(os.path.join(workdir, "latin.txt"),
                   b"Patient MRN|Admit Date or Service Date|Note\n1|1/5/2024|caf\xe9\n")
    got = rows(load(spark, feeds.VISITS.with_options(encoding="ISO-8859-1"), p, load_ts=STAMP))
    assert got[0]["Note"] == "caf\u00e9"
