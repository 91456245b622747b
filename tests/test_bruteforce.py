"""Registered queries against a plain-Python recomputation on the smallest tables."""

import datetime as dt
import re
from decimal import ROUND_HALF_UP, Decimal

import pyarrow.parquet as pq

import __spark_entry__ as E
from landfall.plans.landings import FILE_NAMES, FIXED_STAMP

SF = "/root/testdata/sf0.001"


def rows(table):
    return pq.read_table(f"{SF}/{table}.parquet").to_pylist()


def money(x):
    return str(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def mdy(d):
    return d.strftime("%m-%d-%Y")


def split_name(s):
    parts = s.rsplit(None, 1)
    return (parts[0] if parts else None), (parts[1] if len(parts) > 1 else None)


def as_set(df):
    return sorted(tuple(sorted(r.asDict().items())) for r in df.collect())


def test_providers_by_hand(spark):
    want = []
    for p in rows("part"):
        fam, giv = split_name(p["p_name"])
        start = dt.date(1994, 1, 1) + dt.timedelta(days=p["p_size"])
        end = None if p["p_size"] % 2 == 0 else mdy(dt.date(1994, 1, 1) + dt.timedelta(days=p["p_size"] + 365))
        want.append({"Provider NPI": str(p["p_partkey"]), "Provider Last Name": fam, "Provider First Name": giv,
                     "Degree": p["p_type"], "Current Status": "Active" if p["p_size"] % 2 == 0 else "Inactive",
                     "Department ID": str(p["p_size"]), "Department Name": p["p_brand"], "Section Name": p["p_type"],
                     "Start Date": mdy(start), "End Date": end, "Specialty": money(p["p_retailprice"]),
                     "File Name": FILE_NAMES["providers"], "Load Timestamp": FIXED_STAMP})
    got = as_set(E.queries()["feed_providers"](spark, SF))
    assert got == sorted(tuple(sorted(w.items())) for w in want)


def test_demographics_by_hand(spark):
    want = []
    for c in rows("customer"):
        k = c["c_custkey"]
        dob = None if k % 17 == 0 else mdy(dt.date(1940, 1, 1) + dt.timedelta(days=k % 20000))
        seg = None if k % 23 == 0 else ("None" if k % 29 == 0 else c["c_mktsegment"])
        phone = re.sub(r"\D", "", c["c_name"]) or None
        want.append({"Patient MRN": str(k), "Patient DOB": dob, "Patient Phone Number": phone,
                     "Nation Key": str(c["c_nationkey"]), "Account Balance": money(c["c_acctbal"]), "Segment": seg,
                     "Load Timestamp": FIXED_STAMP, "File Name": FILE_NAMES["demographics"]})
    got = as_set(E.queries()["feed_demographics"](spark, SF))
    assert got == sorted(tuple(sorted(w.items())) for w in want)


def test_appointment_times_and_routes_by_hand(spark):
    want = sorted((e["event_id"], e["ts"].strftime("%H:%M")) for e in rows("events"))
    got = sorted(tuple(r) for r in E.queries()["time_strict"](spark, SF).collect())
    assert got == want
    routes = {"https://m.": "mobile", "http://blog.": "blog", "https://": "secure", "ftp://": "files"}
    want = []
    for pg in rows("pages"):
        hit = [routes[p] for p in sorted(routes, key=len, reverse=True) if pg["url"].startswith(p)]
        want.append((pg["page_id"], hit[0] if hit else None))
    got = sorted(tuple(r) for r in E.queries()["route_feed"](spark, SF).collect())
    assert got == sorted(want, key=lambda t: t[0])
