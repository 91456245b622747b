"""DataFrame operators: rename, projections, stamp and lineage, head preview."""

import pytest
from pyspark.sql import functions as F

from landfall.operators import (
    closed_projection,
    head_rows,
    open_projection,
    rename_column,
    replace_column,
    with_file_name,
    with_load_stamp,
    with_source_file,
)
from landfall.operators.counts import reconcile
from landfall.errors import CountMismatch


@pytest.fixture()
def df(spark):
    return spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "`id` int, `pharmacyid` string, `a.b` string")


def test_rename_is_exact_and_keeps_position(df):
    assert rename_column(df, "pharmacyid", "Pharmacy ID").columns == ["id", "Pharmacy ID", "a.b"]
    assert rename_column(df, "PharmacyID", "Pharmacy ID").columns == df.columns  # case differs: no rename
    assert rename_column(df, "absent", "x").columns == df.columns


def test_projections(df):
    assert closed_projection(df, ["a.b", "id"]).columns == ["a.b", "id"]
    with pytest.raises(KeyError):
        closed_projection(df, ["nope"])
    out = open_projection(df, replace={"pharmacyid": F.upper("pharmacyid")}, add={"Feed": F.lit("f")})
    assert out.columns == ["id", "pharmacyid", "a.b", "Feed"]
    assert [r["pharmacyid"] for r in out.orderBy("id").collect()] == ["A", "B"]
    assert replace_column(df, "id", F.col("id") * 10).columns == df.columns


def test_stamp_and_lineage(spark, df, tmp_path):
    out = with_file_name(with_load_stamp(df, "2024-01-05 00:00:00.000"), "a b.txt")
    assert out.columns[-2:] == ["Load Timestamp", "File Name"]
    assert {(r[-2], r[-1]) for r in out.collect()} == {("2024-01-05 00:00:00.000", "a b.txt")}
    p = tmp_path / "x y%20z.csv"
    p.write_text("k\n1\n")
    got = with_source_file(spark.read.option("header", True).csv(str(p))).collect()
    assert got[0]["File Name"] == "x y%20z.csv"


def test_head_and_reconcile(spark):
    df = spark.range(100).withColumn("k", (F.col("id") * 7) % 100)
    assert [r["k"] for r in head_rows(df, 3, order_by="k").collect()] == [0, 1, 2]
    assert head_rows(df, 10).count() == 10
    reconcile(5, 5)
    with pytest.raises(CountMismatch):
        reconcile(5, 4)
