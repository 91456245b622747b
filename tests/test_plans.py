"""Plan shapes that keep loads scalable: no shuffle in a load, pruned scans,
bounded broadcasts, hot files split by bytes."""

import __spark_entry__ as E
from landfall.plans import feeds
from landfall.plans.load import build_load
from tests.conftest import write_text

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feed_load_has_no_exchange_and_no_python(spark):
    for name in ("feed_providers", "feed_rx_orders", "feed_demographics"):
        p = plan(E.queries()[name](spark, SF))
        assert "Exchange" not in p, name
        assert "Python" not in p and "ArrowEval" not in p, name
        assert p.count("Scan csv") == 1, name


def test_column_queries_prune_their_scans(spark):
    p = plan(E.queries()["route_feed"](spark, SF))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in p and "html" not in p
    p = plan(E.queries()["closed_projection"](spark, SF))
    assert "ReadSchema: struct<s_suppkey:bigint,s_name:string>" in p


def test_no_cartesian_or_nested_loop_anywhere(spark):
    for name in ("feed_appointments", "route_feed", "message_text", "long_rows", "head_rows"):
        p = plan(E.queries()[name](spark, SF))
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, name


def test_a_hot_file_is_split_by_bytes(spark, workdir):
    # One part holds a third of the rows: it is cut into several tasks.
    hdr = "Patient MRN|Admit Date or Service Date\n"
    write_text(f"{workdir}/drop.txt/part-0.csv", hdr + "".join(f"{i}|1/5/2024\n" for i in range(3000)))
    for k in (1, 2):
        write_text(f"{workdir}/drop.txt/part-{k}.csv", hdr + "".join(f"{i}|1/5/2024\n" for i in range(1500)))
        write_text(f"{workdir}/drop.txt/part-{k + 2}.csv", hdr + "".join(f"{i}|1/5/2024\n" for i in range(1500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        fl = build_load(spark, feeds.VISITS.with_options(multi_line=False), f"{workdir}/drop.txt", load_ts="x")
        assert fl.rows.rdd.getNumPartitions() > 5
        assert fl.rows.count() == 9000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
