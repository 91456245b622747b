"""Registered queries over the driver's tables, with equivalent SQL for an
independent engine. Each query runs over whole tables; feed queries first land
the table as a feed file (``landings``) and load it through the library."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall import functions as LF
from landfall.operators.counts import head_rows
from landfall.operators.projection import (
    closed_projection,
    open_projection,
    qcol,
    rename_column,
    with_source_file,
)
from landfall.plans import landings as L
from landfall.plans.feeds import APPOINTMENTS, DEMOGRAPHICS, PROVIDERS, RX_ORDERS, VISITS
from landfall.plans.load import build_load
from landfall.plans.run import run_arrival, run_load
from landfall.plans.spec import FeedSpec, LoadStamp, FileName
from landfall.session import scratch_dir
from landfall.sinks.audit import compact_audit, dead_letters, read_audit
from landfall.sinks.lake import read_current
from landfall.sources.delimited import (
    CORRUPT,
    read_delimited,
    read_head,
    read_header,
    read_table_text,
    utf8_report,
)
from landfall.streaming.intake import pending_folders, start_intake

STAMP = L.FIXED_STAMP
FN = L.FILE_NAMES

# Routes of the routing check: prefix of a page address -> route name.
PAGE_ROUTES = {"https://m.": "mobile", "http://blog.": "blog", "https://": "secure", "ftp://": "files"}

# A raw visits feed with long rows sent to quarantine.
VISITS_RAW = FeedSpec(name="visits_raw", prefix="patient_visits_long", target="patient_visits_raw",
                      rules=(LoadStamp(), FileName()), long_rows="quarantine")


def _run_dir(spark: SparkSession, kind: str) -> str:
    return f"{scratch_dir(spark)}/{kind}/{uuid.uuid4().hex}"


def _feed(spec: FeedSpec, source_key: str | None = None):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        path = L.land_feed(spark, sf, source_key or spec.name)
        return build_load(spark, spec, path, load_ts=STAMP).rows
    return q


# ---------------------------------------------------------------- sources
def scan_delimited(spark, sf):
    """A ``|`` file, every column as text."""
    def make():
        c = L.table(spark, sf, "customer")
        return c.select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
                        F.col("c_nationkey").cast("string").alias("c_nationkey"),
                        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("c_acctbal"),
                        "c_mktsegment")
    path = L.land(spark, sf, "customer", make)
    header = read_header(spark, path)
    return read_delimited(spark, path, header).drop(CORRUPT)


def scan_quoted(spark, sf):
    """S2 with hard text: whole document texts (quotes, separators, line breaks) in a ``|`` file."""
    def make():
        d = L.table(spark, sf, "documents")
        return d.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang", "source")
    path = L.land(spark, sf, "documents", make)
    return read_delimited(spark, path, read_header(spark, path), multi_line=True).drop(CORRUPT)


def q_line_ends(spark, sf):
    """S2 in a file with CR LF record ends: line ends inside quoted fields stay as landed, in whole
    document texts whose lines end in CR LF (which the export makes of a line feed) or in CR."""
    def make():
        d = L.table(spark, sf, "documents")
        text = F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.replace("text", F.lit("\n"), F.lit("\r")))
        return d.select(F.col("doc_id").cast("string").alias("doc_id"), text.alias("text"))
    path = L.land(spark, sf, "documents_crlf", make, line_sep="\r\n")
    header, line_sep = read_head(spark, path)
    return read_delimited(spark, path, header, line_sep=line_sep).drop(CORRUPT)


def scan_comma(spark, sf):
    """K5 then S3: comma export with header, read back as text."""
    def make():
        s = L.table(spark, sf, "supplier")
        return s.select(F.col("s_suppkey").cast("string").alias("s_suppkey"), "s_name",
                        F.col("s_nationkey").cast("string").alias("s_nationkey"),
                        F.col("s_acctbal").cast("decimal(18,2)").cast("string").alias("s_acctbal"))
    path = L.land(spark, sf, "supplier", make, sep=",")
    return read_table_text(spark, path, sep=",")


# ---------------------------------------------------------------- projections
def q_rename_column(spark, sf):
    return rename_column(L.table(spark, sf, "part"), "p_name", "Part Name")


def q_closed_projection(spark, sf):
    return closed_projection(L.table(spark, sf, "supplier"), ["s_name", "s_suppkey"])


def q_open_projection(spark, sf):
    s = L.table(spark, sf, "supplier")
    return open_projection(s, replace={"s_name": F.upper("s_name")}, add={"Feed": F.lit("suppliers")})


def q_load_stamp(spark, sf):
    e = L.table(spark, sf, "events")
    return e.select("event_id", LF.timestamp_text("ts").alias("ts_text"), F.lit(STAMP).alias("Load Timestamp"))


def q_file_lineage(spark, sf):
    p = L.table(spark, sf, "pages").select("page_id", "url")
    key = LF.location_key("url")
    return with_source_file(p).select(
        "page_id", LF.location_store("url").alias("store"), key.alias("key"),
        LF.base_name(key).alias("key_name"), qcol("File Name"))


# ---------------------------------------------------------------- nulls
def _segment_text():
    k = F.col("c_custkey") % 5
    return (F.when(k == 0, F.lit("NA")).when(k == 1, F.lit("n/a")).when(k == 2, F.lit("None"))
            .when(k == 3, F.lit("")).otherwise(F.col("c_mktsegment")))


def q_null_tokens(spark, sf):
    c = L.table(spark, sf, "customer")
    return c.select("c_custkey", LF.null_tokens(_segment_text()).alias("segment"))


def q_fill_missing(spark, sf):
    c = L.table(spark, sf, "customer")
    filled = LF.fill_missing(LF.null_tokens(_segment_text()))
    return c.select("c_custkey", filled.alias("segment_filled"), LF.empty_to_null(filled).alias("segment_back"))


def q_empty_to_null(spark, sf):
    """N3 alone: empty text becomes NULL, blanks and other text stay."""
    c = L.table(spark, sf, "customer")
    k = F.col("c_custkey") % 3
    text = F.when(k == 0, F.lit("")).when(k == 1, F.lit(" ")).otherwise(F.col("c_name"))
    return c.select("c_custkey", LF.empty_to_null(text).alias("name_or_null"))


# ---------------------------------------------------------------- scalar functions
def q_date_strict(spark, sf):
    o = L.table(spark, sf, "orders")
    k = F.col("o_orderkey") % 4
    text = (F.when(k == 0, F.date_format("o_orderdate", "M/d/yyyy"))
            .when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .when(k == 2, F.date_format("o_orderdate", "yyyyMMdd"))
            .otherwise(F.col("o_orderdate").cast("string")))
    # The text is a column of its own, so the rule reads it rather than
    # recomputing it at each of its references.
    return (o.select("o_orderkey", text.alias("text"))
            .select("o_orderkey", LF.reformat_date("text", strict=True).alias("order_date")))


def q_date_lenient(spark, sf):
    e = L.table(spark, sf, "events")
    k = F.col("event_id") % 13
    text = (F.when(k == 0, F.lit("garbage")).when(k == 1, F.lit("2/30/2024"))
            .otherwise(F.date_format("ts", "M/d/yyyy H:m:s")))
    return (e.select("event_id", text.alias("text"))
            .select("event_id", LF.reformat_date("text", strict=False).alias("event_date")))


def q_time_strict(spark, sf):
    e = L.table(spark, sf, "events")
    return (e.select("event_id", F.date_format("ts", "H:mm:ss").alias("text"))
            .select("event_id", LF.reformat_time("text").alias("event_time")))


def q_digits_only(spark, sf):
    c = L.table(spark, sf, "customer")
    return c.select("c_custkey", LF.empty_to_null(LF.digits_only("c_name")).alias("phone"),
                    LF.digits_only(LF.as_text("c_custkey")).alias("key_digits"))


def q_name_parts(spark, sf):
    p = L.table(spark, sf, "part")
    spaced = F.concat(F.col("p_brand"), F.lit("  "), F.col("p_name"))
    return p.select("p_partkey",
                    LF.family_name("p_name").alias("family"), LF.given_name("p_name").alias("given"),
                    LF.family_name(spaced).alias("family_spaced"), LF.given_name(spaced).alias("given_spaced"),
                    LF.family_name("p_type").alias("family_single"), LF.given_name("p_type").alias("given_single"))


def _order_state(col="o_orderstatus", open_state="FAILED"):
    return (F.when(F.col(col) == "F", F.lit("SUCCEEDED")).when(F.col(col) == "O", F.lit(open_state))
            .otherwise(F.lit("STOPPED")))


def q_message_text(spark, sf):
    o = L.table(spark, sf, "orders").select(
        "o_orderkey", _order_state().alias("status"),
        F.concat(F.lit("visit_"), F.col("o_orderkey").cast("string"), F.lit(".txt")).alias("file"),
        F.when(F.col("o_orderpriority").startswith("1-"), F.lit(None)).otherwise(F.col("o_orderpriority")).alias("error"))
    return o.select("o_orderkey", LF.outcome_subject(F.lit("visits"), "status").alias("subject"),
                    LF.outcome_message(F.lit("visits"), "status", "file", "error").alias("message"))


# ---------------------------------------------------------------- predicates
def q_route_feed(spark, sf):
    p = L.table(spark, sf, "pages")
    return p.select("page_id", LF.route_prefix("url", PAGE_ROUTES).alias("route"))


def q_terminal_state(spark, sf):
    o = L.table(spark, sf, "orders").select("o_orderkey", _order_state(open_state="RUNNING").alias("state"))
    return o.select("o_orderkey", "state", LF.is_terminal("state").alias("terminal"))


# ---------------------------------------------------------------- counts and limits
def q_count_rows(spark, sf):
    rows = _feed(VISITS)(spark, sf)
    return rows.agg(F.count(F.lit(1)).alias("rows_read"))


def q_reconcile(spark, sf):
    """A3 over counts and content: the checksum observed in the write and that of the snapshot."""
    d = _run_dir(spark, "reconcile")
    out = run_load(spark, VISITS.with_options(reconcile="content"), L.land_feed(spark, sf, "visits"), lake_root=f"{d}/lake",
                   audit_root=f"{d}/audit", load_ts=STAMP)
    return (read_audit(spark, f"{d}/audit").filter(F.col("load_id") == out.load_id)
            .select("feed", "file", "status", "rows_read", "rows_quarantined", "rows_target",
                    (F.col("sum_written") == F.col("sum_target")).alias("content_equal")))


def q_head_rows(spark, sf):
    return head_rows(_feed(VISITS)(spark, sf), 10, order_by=qcol("Visit ID"))


# ---------------------------------------------------------------- row checks
def q_long_rows(spark, sf):
    """R1 in quarantine mode: every order with its outcome; the long ones keep
    their raw record."""
    o = L.table(spark, sf, "orders")
    line = F.concat(F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                                "o_orderstatus", "o_orderpriority"),
                    F.when(F.col("o_orderkey") % 50 == 0, F.lit("|extra")).otherwise(F.lit("")))
    path = L.land_lines(spark, sf, "orders_long", ["Visit ID", "Patient MRN", "Visit Status", "Priority"], line, o)
    fl = build_load(spark, VISITS_RAW, path, load_ts=STAMP)
    loaded = fl.rows.select(qcol("Visit ID").alias("visit_id"), F.lit("loaded").alias("outcome"),
                            F.lit(None).cast("string").alias("raw_record"))
    held = fl.quarantine.select(F.col("record_key").alias("visit_id"), F.col("reason").alias("outcome"),
                                "raw_record")
    return loaded.unionByName(held)


def q_strict_utf8(spark, sf):
    li = L.table(spark, sf, "lineitem")
    bad = (F.col("l_orderkey") % 97 == 0) & (F.col("l_linenumber") == 1)
    line = F.concat(F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                                "l_returnflag"),
                    F.when(bad, F.unhex(F.lit("FF")).cast("string")).otherwise(F.lit("")))
    return utf8_report(spark, L.land_bytes(spark, sf, "lineitem_bytes", line, li))


# ---------------------------------------------------------------- audit and intake
def _bad_providers(spark, sf):
    p = L.providers_source(spark, sf)
    bad = F.col("Provider NPI").cast("bigint") % 101 == 0
    return p.withColumn("Start Date", F.when(bad, F.lit("garbage")).otherwise(F.col("Start Date")))


def q_load_audit(spark, sf):
    d = _run_dir(spark, "audit")
    kw = dict(lake_root=f"{d}/lake", audit_root=f"{d}/audit", load_ts=STAMP)
    run_load(spark, DEMOGRAPHICS, L.land_feed(spark, sf, "demographics"), **kw)
    run_load(spark, PROVIDERS, L.land(spark, sf, "providers_bad", lambda: _bad_providers(spark, sf)), **kw)
    run_load(spark, PROVIDERS, f"{L.landing_root(spark, sf)}/{FN['providers_missing']}", **kw)
    run_load(spark, APPOINTMENTS, L.land_feed(spark, sf, "visits"), **kw)
    return read_audit(spark, f"{d}/audit").select(
        "feed", "file", "status", "rows_read", "rows_target", "error_type", "message",
        F.col("lost_values")["Patient DOB"].alias("lost_dates"), F.col("lost_values")["Patient Phone Number"].alias("lost_phones"))


def q_quoted_breaks(spark, sf):
    """S1's guard in a load: a feed that splits its files fails one with a quoted line break and loads
    it with ``multi_line``."""
    d = _run_dir(spark, "breaks")
    kw = dict(lake_root=f"{d}/lake", audit_root=f"{d}/audit", load_ts=STAMP)

    def make():
        note = F.when(F.col("Visit ID").cast("bigint") % 64 == 1, F.concat("Priority", F.lit("\nnext line"))).otherwise(F.concat(F.lit('5" '), "Priority"))
        return L.visits_source(spark, sf).withColumn("Note", note)

    path = L.land(spark, sf, "visits_breaks", make)
    run_load(spark, VISITS, path, **kw)
    run_load(spark, VISITS.with_options(multi_line=True), path, **kw)
    return read_audit(spark, f"{d}/audit").select("feed", "file", "status", "rows_target", "error")


def q_pointer_by_arrival(spark, sf):
    """K3: the older of two files is loaded last; the newer one's rows stay current."""
    d = _run_dir(spark, "pointer")
    kw = dict(lake_root=f"{d}/lake", audit_root=f"{d}/audit", load_ts=STAMP)
    run_load(spark, RX_ORDERS, L.land_feed(spark, sf, "rx_orders"), arrived=2_000_000, **kw)
    old = L.land(spark, sf, "rx_orders_old", lambda: L.rx_orders_source(spark, sf).withColumn("Quantity", F.lit("0")))
    run_load(spark, RX_ORDERS, old, arrived=1_000_000, **kw)
    return read_current(spark, f"{d}/lake/{RX_ORDERS.target}", f"{d}/audit", RX_ORDERS.target)


def q_dead_letters(spark, sf):
    """T4: an arrival whose database copy fails with an unexpected error is given up after three
    attempts; another feed's file loads."""
    d = _run_dir(spark, "dead")
    kw = dict(lake_root=f"{d}/lake", audit_root=f"{d}/audit", load_ts=STAMP)
    nowhere = {"url": "jdbc:nowhere:x", "table": "t"}
    for _ in range(4):
        try:
            run_arrival(spark, PROVIDERS, L.land_feed(spark, sf, "providers"), "fixed", jdbc=nowhere, **kw)
        except Exception:  # noqa: BLE001 - a stream would be started again
            pass
        run_arrival(spark, VISITS, L.land_feed(spark, sf, "visits"), "fixed", **kw)
    dead = dead_letters(spark, f"{d}/audit").select("load_id", F.lit(True).alias("dead"))
    return (read_audit(spark, f"{d}/audit").join(dead, "load_id", "left")
            .select("feed", "status", "attempt", "rows_target", F.coalesce("dead", F.lit(False)).alias("given_up")))


def q_audit_epochs(spark, sf):
    """The audit of many loads, compacted twice with loads in between, read as one table."""
    d = _run_dir(spark, "epochs")
    kw = dict(lake_root=f"{d}/lake", audit_root=f"{d}/audit", load_ts=STAMP)
    for wave in (("visits", VISITS), ("providers", PROVIDERS)), (("visits", VISITS),), (("demographics", DEMOGRAPHICS),):
        for key, spec in wave:
            run_load(spark, spec, L.land_feed(spark, sf, key), **kw)
        if key != "demographics":
            compact_audit(spark, f"{d}/audit")
    return read_audit(spark, f"{d}/audit").groupBy("feed", "status").agg(F.count(F.lit(1)).alias("loads"), F.sum("rows_target").alias("rows_target"))


def q_whole_drops(spark, sf):
    """A folder of parts is loaded once, when its marker is there, however the batches cut it; a
    folder without one is not."""
    d = _run_dir(spark, "drops")
    landing = f"{d}/landing"
    for wave in ("w1", "w2"):
        L.write_landing(spark, L.visits_source(spark, sf).withColumn("Wave", F.lit(wave)).repartition(3), f"{landing}/{FN['visits_wave'].format(wave=wave)}")
    L.write_marker(spark, f"{landing}/{FN['visits_wave'].format(wave='w1')}/DONE")
    start_intake(spark, landing, (VISITS,), lake_root=f"{d}/lake", audit_root=f"{d}/audit", checkpoint=f"{d}/checkpoint", glob="*.csv",
                 unit="directory", marker="DONE", max_files_per_batch=1, load_ts=STAMP).awaitTermination()
    loaded = read_audit(spark, f"{d}/audit").select("file", "status", "rows_target")
    held = pending_folders(spark, landing, "DONE").select(LF.base_name("path").alias("file"), F.lit("HELD").alias("status"), F.lit(None).cast("long").alias("rows_target"))
    return loaded.unionByName(held)


def _intake_run(spark, sf):
    d = _run_dir(spark, "intake")
    landing = f"{d}/landing"
    for wave in ("w1", "w2"):
        L.write_landing(spark, L.visits_source(spark, sf).withColumn("Wave", F.lit(wave)),
                        f"{landing}/{FN['visits_wave'].format(wave=wave)}")
    kw = dict(lake_root=f"{d}/lake", audit_root=f"{d}/audit", checkpoint=f"{d}/checkpoint",
              glob="*.csv", unit="directory", load_ts=STAMP)
    specs = (DEMOGRAPHICS, APPOINTMENTS, PROVIDERS, VISITS, RX_ORDERS)
    start_intake(spark, landing, specs, **kw).awaitTermination()
    L.write_landing(spark, L.visits_source(spark, sf).withColumn("Wave", F.lit("w3")),
                    f"{landing}/{FN['visits_wave'].format(wave='w3')}")
    start_intake(spark, landing, specs, **kw).awaitTermination()
    return d


def q_file_intake(spark, sf):
    d = _intake_run(spark, sf)
    return read_current(spark, f"{d}/lake/{VISITS.target}", f"{d}/audit", VISITS.target)


def q_latest_wins(spark, sf):
    d = _intake_run(spark, sf)
    return read_audit(spark, f"{d}/audit").select("feed", "file", "status", "rows_read", "rows_target")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "feed_providers": _feed(PROVIDERS),
    "feed_appointments": _feed(APPOINTMENTS),
    "feed_demographics": _feed(DEMOGRAPHICS),
    "feed_visits": _feed(VISITS),
    "feed_rx_orders": _feed(RX_ORDERS),
    "scan_delimited": scan_delimited,
    "scan_quoted": scan_quoted,
    "scan_comma": scan_comma,
    "rename_column": q_rename_column,
    "closed_projection": q_closed_projection,
    "open_projection": q_open_projection,
    "load_stamp": q_load_stamp,
    "file_lineage": q_file_lineage,
    "null_tokens": q_null_tokens,
    "fill_missing": q_fill_missing,
    "empty_to_null": q_empty_to_null,
    "date_strict": q_date_strict,
    "date_lenient": q_date_lenient,
    "time_strict": q_time_strict,
    "digits_only": q_digits_only,
    "name_parts": q_name_parts,
    "message_text": q_message_text,
    "route_feed": q_route_feed,
    "terminal_state": q_terminal_state,
    "count_rows": q_count_rows,
    "reconcile": q_reconcile,
    "head_rows": q_head_rows,
    "long_rows": q_long_rows,
    "strict_utf8": q_strict_utf8,
    "load_audit": q_load_audit,
    "line_ends": q_line_ends,
    "quoted_breaks": q_quoted_breaks,
    "pointer_by_arrival": q_pointer_by_arrival,
    "dead_letters": q_dead_letters,
    "audit_epochs": q_audit_epochs,
    "whole_drops": q_whole_drops,
    "file_intake": q_file_intake,
    "latest_wins": q_latest_wins,
}
