"""Property checks: the native expressions equal the Python behaviour they
stand for, on seeded random text with Unicode white space and digits."""

import re
import urllib.parse

from hypothesis import given, settings
from hypothesis import strategies as st

from landfall import functions as LF

ALPHABET = st.sampled_from(list("ab Z,.-#")
                           + [" ", "\t", "\n", " ", " ", "　", "\x1c", "\x85"]
                           + list("0123456789") + ["١", "०", "１"])
TEXTS = st.lists(st.text(ALPHABET, max_size=12), min_size=50, max_size=120)


def py_family(s):
    p = s.rsplit(None, 1)
    return p[0] if p else None


def py_given(s):
    p = s.rsplit(None, 1)
    return p[1] if len(p) > 1 else None


@settings(max_examples=4, deadline=None)
@given(TEXTS)
def test_name_parts_match_rsplit(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select(LF.family_name("v"), LF.given_name("v")).collect()
    assert [r[0] for r in rows] == [py_family(v) for v in values]
    assert [r[1] for r in rows] == [py_given(v) for v in values]


@settings(max_examples=4, deadline=None)
@given(TEXTS)
def test_digits_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(LF.digits_only("v")).collect()]
    assert got == [re.sub(r"\D", "", v) for v in values]


PATHS = st.lists(st.text(st.sampled_from(list("ab/ +%20AF.")), max_size=14), min_size=50, max_size=100)


@settings(max_examples=4, deadline=None)
@given(PATHS)
def test_unquote_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(LF.url_unquote("v")).collect()]
    want = []
    for v in values:
        dec = urllib.parse.unquote(v)
        # A malformed escape leaves the whole text undecoded here (documented).
        want.append(dec if re.fullmatch(r"(?:[^%]|%[0-9A-Fa-f]{2})*", v) else v)
    assert got == want
