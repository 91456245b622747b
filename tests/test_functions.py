"""Table-driven checks of every column function, with the fixture samples."""

import pytest
from pyspark.sql import functions as F

from landfall import functions as LF
from tests.conftest import one_col


def run(spark, expr_fn, values):
    df = one_col(spark, values)
    return [r[0] for r in df.select(expr_fn(F.col("v"))).collect()]


DATES = [
    ("1/5/2024", "01-05-2024"),
    ("01/05/2024", "01-05-2024"),
    ("2024-01-05", "01-05-2024"),
    ("20240105", "01-05-2024"),
    ("1/5/2024 3:04:05", "01-05-2024"),
    ("13/01/2024", "01-13-2024"),
    ("12/31/9999", "12-31-9999"),
    ("2024-01-05T03:04:05", "01-05-2024"),
    ("2024-01-05 00:00:00", "01-05-2024"),
    ("05-JAN-2024", "01-05-2024"),
    ("5 Jan 2024", "01-05-2024"),
    ("Jan 5, 2024", "01-05-2024"),
    ("January 5, 2024 10:00", "01-05-2024"),
    ("jan 5 2024", "01-05-2024"),
    (" 1/5/2024 ", "01-05-2024"),
    ("", None),
    ("   ", None),
    (None, None),
]


@pytest.mark.parametrize("strict", [True, False])
def test_reformat_date_readable(spark, strict):
    got = run(spark, lambda c: LF.reformat_date(c, strict=strict), [d[0] for d in DATES])
    assert got == [d[1] for d in DATES]


def test_reformat_date_lenient_unreadable(spark):
    assert run(spark, lambda c: LF.reformat_date(c, strict=False), ["garbage", "2/30/2024", "1/5/24"]) == [None] * 3


@pytest.mark.parametrize("bad", ["garbage", "2/30/2024"])
def test_reformat_date_strict_fails_without_value(spark, bad):
    with pytest.raises(Exception) as e:
        run(spark, lambda c: LF.reformat_date(c, strict=True, error="load check failed: d"), [bad])
    assert "load check failed: d" in str(e.value)
    assert bad not in str(e.value).split("load check failed")[1][:40]


def test_reformat_time(spark):
    assert run(spark, LF.reformat_time, ["09:05:07", "9:05:07", "9:5:7", None, ""]) == ["09:05", "09:05", "09:05", None, None]


@pytest.mark.parametrize("bad", ["09:05", "24:00:00", "x"])
def test_reformat_time_strict_fails(spark, bad):
    with pytest.raises(Exception):
        run(spark, lambda c: LF.reformat_time(c, error="load check failed: t"), [bad])


def test_timestamp_text_cuts_to_millis(spark):
    df = spark.sql("select timestamp_ntz'2024-01-05 06:07:08.123999' as ts")
    assert df.select(LF.timestamp_text("ts")).first()[0] == "2024-01-05 06:07:08.123"


def test_load_stamp_text():
    import datetime as dt

    assert LF.load_stamp_text(dt.datetime(2024, 1, 5, 6, 7, 8, 999999)) == "2024-01-05 06:07:08.999"


def test_digits_only(spark):
    got = run(spark, LF.digits_only, ["(212) 555-0100", "none", "٠١٢ 3", None])
    assert got == ["2125550100", "", "٠١٢3", None]


NAMES = [
    ("Smith John", "Smith", "John"),
    ("Van Der Berg Anna", "Van Der Berg", "Anna"),
    ("Smith, John", "Smith,", "John"),
    ("Cher", "Cher", None),
    ("", None, None),
    ("   ", None, None),
    (None, None, None),
    ("  lead trail  ", "  lead", "trail"),
    ("  one  ", "one", None),
    ("tab\tsep", "tab", "sep"),
    ("nb sp", "nb", "sp"),
]


def test_name_parts(spark):
    values = [n[0] for n in NAMES]
    assert run(spark, LF.family_name, values) == [n[1] for n in NAMES]
    assert run(spark, LF.given_name, values) == [n[2] for n in NAMES]


def test_null_tokens(spark):
    got = run(spark, LF.null_tokens, ["NA", "null", "", "None", "n/a", "#N/A", "x", None])
    assert got == [None, None, None, "None", None, None, "x", None]


def test_fill_and_empty(spark):
    assert run(spark, LF.fill_missing, [None, "a"]) == ["", "a"]
    assert run(spark, LF.empty_to_null, ["", "a", None]) == [None, "a", None]


def test_paths(spark):
    vals = ["s3://bucket/dir/a%20b.txt", "s3://bucket//x/a+b.txt", "http://h.example.com/p/q?x=1#f", "plain/a.txt"]
    assert run(spark, LF.location_store, vals) == ["bucket", "bucket", "h.example.com", ""]
    assert run(spark, LF.location_key, vals) == ["dir/a b.txt", "x/a+b.txt", "p/q", ""]
    assert run(spark, LF.base_name, ["a/b/c.txt", "c.txt", "a/b/"]) == ["c.txt", "c.txt", ""]
    assert run(spark, LF.strip_leading_slash, ["//a/b", "a"]) == ["a/b", "a"]
    assert run(spark, LF.url_unquote, ["a%20b", "a+b", "a%2520b", "bad%zz"]) == ["a b", "a+b", "a%20b", "bad%zz"]
    assert run(spark, LF.url_unquote_plus, ["a+b%21"]) == ["a b!"]


def test_route_and_terminal(spark):
    routes = {"in/a": "A", "in/ab": "AB", "in/c": "C"}
    assert run(spark, lambda c: LF.route_prefix(c, routes), ["in/abc", "in/a1", "in/c", "out/x"]) == ["AB", "A", "C", None]
    assert run(spark, LF.is_terminal, ["SUCCEEDED", "FAILED", "STOPPED", "RUNNING"]) == [True, True, True, False]


def test_outcome_message(spark):
    df = spark.createDataFrame([("f", "SUCCEEDED", "x.txt", None), ("f", "FAILED", "x.txt", None),
                                ("f", "STOPPED", "x.txt", "boom")], "feed string, status string, file string, error string")
    got = [r[0] for r in df.select(LF.outcome_message("feed", "status", "file", "error")).collect()]
    assert got == ["The load f has SUCCEEDED for file x.txt.",
                   "The load f has FAILED for file x.txt. Error: No error message provided",
                   "The load f has STOPPED for file x.txt. Error: boom"]
    assert df.select(LF.outcome_subject("feed", "status")).first()[0] == "Load finished - f - Status: SUCCEEDED"


def test_two_digit_years_only_with_a_pivot(spark):
    vals = ["1/5/24", "1/5/31", "12/31/99", "1/5/2024"]
    assert run(spark, lambda c: LF.reformat_date(c, strict=False), vals) == [None, None, None, "01-05-2024"]
    got = run(spark, lambda c: LF.reformat_date(c, strict=False, pivot_year=2030), vals)
    assert got == ["01-05-2024", "01-05-1931", "12-31-1999", "01-05-2024"]


def test_dispatch_equals_trying_every_layout(spark):
    from landfall.functions.dates import DATE_LAYOUTS

    vals = ["1/5/2024", "13/1/2024", "2/30/2024", "2024-1-5", "2024-01-05T03:04", "2024-01-05 3:04:05.5",
            "20240105", "2024010", "1-5-2024", "2024/1/5", "12024-01-05", "1/5/12024", "001/5/2024",
            "x1/5/2024", "1/5/2024x", "31/12/2024 23:59", "2024-13-01", "", "garbage", "1//2024",
            "0001-01-0001", "0012-05-2024", "0001/5/2024", "2024/13/1", "1/5/2024T", " 20240105 ",
            "05-JAN-2024", "5 Jan 2024", "Jan 5, 2024", "January 5, 2024", "Jan 5 2024", "2024-Jan-05",
            "5-Jxn-2024", "Foo 5, 2024", "5 5 2024", "1-Jan-24"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    every = F.coalesce(*[F.try_to_date(F.trim("v"), f) for f in DATE_LAYOUTS])
    got = df.select(LF.parse_date("v").alias("a"), every.alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got]
