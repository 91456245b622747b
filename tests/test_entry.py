"""The driver contract: entry runs, every query has SQL, names are aliased."""

import __spark_entry__ as E
from landfall.plans.registry import QUERIES


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["Provider NPI", "Provider Last Name", "Provider First Name", "Degree", "Current Status",
                          "Department ID", "Department Name", "Section Name", "Start Date", "End Date",
                          "Specialty", "File Name", "Load Timestamp"]
    rows = df.collect()
    assert len(rows) == 200
    assert all(r["Start Date"] and len(r["Start Date"]) == 10 for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_column_queries_run_on_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    for name in ("rename_column", "name_parts", "date_strict", "route_feed", "head_rows", "long_rows"):
        df = E.queries()[name](spark, sf)
        assert df.count() >= 1, name


def test_feed_query_survives_several_actions(spark):
    df = E.queries()["feed_visits"](spark, "/root/testdata/sf0.001")
    n = df.count()
    assert len(df.collect()) == n
    assert df.limit(3).count() == 3
    df.write.format("noop").mode("overwrite").save()
