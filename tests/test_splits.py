"""A file reads alike at every size, as its feed declares."""

import pytest

from landfall.plans import feeds
from landfall.plans.load import build_load
from landfall.plans.run import run_load
from landfall.sinks.delimited import write_delimited
from landfall.sinks.lake import read_snapshot
from landfall.session import _own_folder
from landfall.streaming.intake import notified_arrivals, route_path
from tests.conftest import write_text

HDR = "Patient MRN|Admit Date or Service Date|Note\n"


@pytest.fixture(params=[None, "1k"])
def split_size(request, spark):
    if request.param:
        spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def load(spark, workdir, text, **options):
    p = write_text(f"{workdir}/v.txt", text)
    out = run_load(spark, feeds.VISITS.with_options(**options), p, lake_root=f"{workdir}/lake", audit_root=f"{workdir}/audit")
    rows = None
    if out.status == "SUCCEEDED":
        rows = read_snapshot(spark, f"{workdir}/lake/{out.target}", out.load_id).orderBy("Patient MRN").collect()
    return out, rows


@pytest.mark.parametrize("multi_line", [True, False])
@pytest.mark.parametrize("marks", [1, 2])
def test_inch_marks_lose_no_row(spark, workdir, split_size, multi_line, marks):
    lines = [f'{i:04d}|1/5/2024|{"5" + chr(34) + " pipe" if i in (200, 700)[:marks] else "x"}' for i in range(1000)]
    out, rows = load(spark, workdir, HDR + "\n".join(lines) + "\n", multi_line=multi_line)
    assert (out.status, out.rows_read, out.rows_target) == ("SUCCEEDED", 1000, 1000)
    assert rows[200]["Note"] == '5" pipe' and rows[201]["Note"] == "x"


@pytest.mark.parametrize("multi_line", [True, False])
def test_lines_of_blanks_are_skipped(spark, workdir, split_size, multi_line):
    lines = [f"{i:04d}|1/5/2024|x" for i in range(1000)]
    for k in range(10):
        lines.insert(90 * k, "   ")
    lines.insert(500, "")
    out, _ = load(spark, workdir, HDR + "\n".join(lines) + "\n", multi_line=multi_line)
    assert (out.status, out.rows_read, out.rows_target) == ("SUCCEEDED", 1000, 1000)


@pytest.mark.parametrize("multi_line", [True, False])
def test_long_rows_with_inch_marks_fail(spark, workdir, split_size, multi_line):
    out, _ = load(spark, workdir, HDR + '1|1/5/2024|x\n5" x|6" y|z|extra\n', multi_line=multi_line)
    assert out.status == "FAILED" and out.error_type == "DataError"
    out, rows = load(spark, workdir, HDR + '1|1/5/2024|"a|b ""q"" c"\n', multi_line=multi_line)
    assert out.status == "SUCCEEDED" and rows[0]["Note"] == 'a|b "q" c'


@pytest.mark.parametrize("multi_line", [True, False])
def test_bad_bytes_fail_the_load(spark, workdir, split_size, multi_line):
    body = (HDR + "".join(f"{i}|1/5/2024|x\n" for i in range(300))).encode() + b"9|1/5/2024|\xff\xfe\n"
    write_text(f"{workdir}/b.txt", body)
    out = run_load(spark, feeds.VISITS.with_options(multi_line=multi_line), f"{workdir}/b.txt", lake_root=f"{workdir}/lake", audit_root=f"{workdir}/audit")
    assert (out.status, out.error_type) == ("FAILED", "EncodingError")


def test_quoted_line_breaks_in_a_file_over_one_split(spark, workdir, split_size):
    text = HDR + "".join(f'{i:04d}|1/5/2024|"a {i}\nb"\n' for i in range(500))
    out, rows = load(spark, workdir, text, multi_line=True)
    assert out.rows_target == 500 and rows[7]["Note"] == "a 7\nb"


def test_files_without_breaks_split(spark, workdir):
    p = write_text(f"{workdir}/big.txt", HDR + "\n".join(f"{i}|1/5/2024|note {i}" for i in range(20000)) + "\n")
    for size in ("65536", "64k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            fl = build_load(spark, feeds.VISITS.with_options(multi_line=False), p, load_ts="x")
            assert fl.rows.rdd.getNumPartitions() > 1
            assert fl.rows.count() == 20000
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_export_keeps_blanks_and_empty_text(spark, workdir):
    df = spark.createDataFrame([(" lead", "trail "), ("in ner", ""), (None, 'q"|,')], "a string, b string")
    write_delimited(df.coalesce(1), f"{workdir}/out")
    lines = sorted(r["value"] for r in spark.read.text(f"{workdir}/out").collect())
    assert lines == sorted(["a,b", " lead,trail ", "in ner,", ',"q""|,"'])


def test_the_whole_error_is_audited(spark, workdir):
    names = [f"column {i:03d} with a long name" for i in range(40)]
    spec = feeds.PROVIDERS
    out = run_load(spark, spec, write_text(f"{workdir}/p.txt", "|".join(names) + "\n"), lake_root=f"{workdir}/lake", audit_root=f"{workdir}/audit")
    assert out.status == "FAILED" and all(repr(n) in out.error for n in spec.required() if n not in names)


def test_no_local_folder_on_a_cluster():
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", "remote"):
        with pytest.raises(RuntimeError):
            _own_folder(master)


def test_more_date_layouts(spark):
    from pyspark.sql import functions as F

    from landfall.functions.dates import reformat_date

    want = {
        "1/5/1980 12:00:00 AM": "01-05-1980", "1/5/1980 1:02 pm": "01-05-1980", "1/5/80": "01-05-1980", "1/5/24": "01-05-2024",
        "1980-01-05T10:11:12Z": "01-05-1980", "1980-01-05 10:11:12+00:00": "01-05-1980", "19800105 101112": "01-05-1980",
        "January 5 1980": "01-05-1980", "5 January 1980": "01-05-1980", "Jan-05-1980": "01-05-1980", "1980.01.05": "01-05-1980", "5-Jan-80": "01-05-1980",
        "1/5/1980 13:00:00 AM": None, "2/30/80": None, "19800105 251112": None, "garbage pm": None, "1980-01-05T10:11:12+99:00": None}
    df = spark.createDataFrame([(k,) for k in want], "v string")
    got = {r["v"]: r["d"] for r in df.select("v", reformat_date(F.col("v"), strict=False, pivot_year=2068).alias("d")).collect()}
    assert got == want


def test_routes_look_at_the_folder_and_the_name(spark):
    routes = {"visits/patient_visits": "visits", "providers": "providers"}
    paths = {"s3://b/visits/patient_visits_1.txt": "visits", "s3://b/archive/patient_visits_old.txt": None, "s3://b/x/providers_1.txt": "providers",
             "s3://b/x/visits/patient_visits_2.txt": "visits", "s3://b/providers/none.txt": None}
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert {r["path"]: r["f"] for r in df.select("path", route_path("path", routes).alias("f")).collect()} == paths


def test_a_deletion_record_is_no_arrival(spark, workdir):
    import json

    record = lambda name, key: {"eventName": name, "eventTime": "2024-01-05T00:00:00Z", "s3": {"bucket": {"name": "b"}, "object": {"key": key}}}
    write_text(f"{workdir}/events/e.json", json.dumps({"Records": [record("ObjectCreated:Put", "a.txt"), record("ObjectRemoved:Delete", "b.txt")]}))
    q = (notified_arrivals(spark, f"{workdir}/events").writeStream.format("memory").queryName("arrived_test")
         .option("checkpointLocation", f"{workdir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert [r["path"] for r in spark.table("arrived_test").collect()] == ["s3://b/a.txt"]


def test_jdbc_options_reach_the_loads(spark, monkeypatch):
    from landfall.__main__ import jdbc_options
    from landfall.streaming import intake

    monkeypatch.setenv("LANDFALL_JDBC_PASSWORD", "x")
    o = jdbc_options("jdbc:y", "t", "u")
    assert o == {"url": "jdbc:y", "table": "t", "user": "u", "password": "x"} and jdbc_options(None, "t", None) is None
    seen = []
    monkeypatch.setattr(intake, "run_arrival", lambda spark, spec, path, stamp, **kw: seen.append((spec.name, kw["jdbc"])))
    handler = intake.Intake([feeds.PROVIDERS], lake_root="l", audit_root="a", jdbc={"providers": o})
    handler(spark.createDataFrame([(f"s3://b/{feeds.PROVIDERS.prefix}_1.txt", None)], "path string, arrived timestamp"), 0)
    assert seen == [("providers", o)]
