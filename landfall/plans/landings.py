"""Landing files made from the driver's tables, one per feed.

The tables are not feed files, so each is reshaped (with Spark, whole table) into
the columns a feed's landing file holds, then written as a ``|`` file: a folder
of part files that loads as one object. Every run of a registered query loads
these files through the library; they are written once per process and table.
"""

from __future__ import annotations

import hashlib
import os
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.session import parallelism, scratch_dir
from landfall.sinks.delimited import write_delimited

# Fixed values for the checks: the stamp every registered load uses, so that
# results do not depend on the clock, and the landed names.
FIXED_STAMP = "2024-01-05 06:07:08.009"
FILE_NAMES = {
    "demographics": "patient_demographics_20240105.txt",
    "appointments": "appointments_20240105.txt",
    "providers": "providers_20240105.txt",
    "visits": "patient_visits_20240105.txt",
    "rx_orders": "rx_orders_20240105.txt",
    "customer": "customer_20240105.txt",
    "documents": "documents_20240105.txt",
    "supplier": "supplier_20240105.csv",
    "orders_long": "patient_visits_long_20240105.txt",
    "lineitem_bytes": "rx_orders_bytes_20240105.txt",
    "providers_bad": "providers_bad_20240105.txt",
    "providers_missing": "providers_missing_20240105.txt",
    "documents_crlf": "documents_crlf_20240105.txt",
    "visits_breaks": "patient_visits_breaks_20240105.txt",
    "rx_orders_old": "rx_orders_20240104.txt",
    "visits_wave": "patient_visits_20240105_{wave}.txt",
}

_written: dict[str, str] = {}
_lock = threading.Lock()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _txt(c) -> Column:
    return F.col(c).cast("string")


def _money(c) -> Column:
    # Doubles as text through decimal(18,2): never in exponent form.
    return F.col(c).cast("decimal(18,2)").cast("string")


def _day(base: str, days: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), days.cast("int"))


def demographics_source(spark, sf_dir) -> DataFrame:
    """C1 from customer: birth date 1940-01-01 + custkey % 20000 days in one of
    three layouts, ``garbage`` where custkey % 17 = 0; phone from the name."""
    c = table(spark, sf_dir, "customer")
    dob = _day("1940-01-01", F.col("c_custkey") % 20000)
    layout = F.col("c_custkey") % 3
    dob_text = (F.when(F.col("c_custkey") % 17 == 0, F.lit("garbage"))
                .when(layout == 0, F.date_format(dob, "M/d/yyyy"))
                .when(layout == 1, F.date_format(dob, "yyyy-MM-dd"))
                .otherwise(F.date_format(dob, "yyyyMMdd")))
    seg = (F.when(F.col("c_custkey") % 23 == 0, F.lit("NA"))
           .when(F.col("c_custkey") % 29 == 0, F.lit("None"))
           .otherwise(F.col("c_mktsegment")))
    return c.select(
        _txt("c_custkey").alias("Patient MRN"),
        dob_text.alias("Patient DOB"),
        F.col("c_name").alias("Patient Phone Number"),
        _txt("c_nationkey").alias("Nation Key"),
        _money("c_acctbal").alias("Account Balance"),
        seg.alias("Segment"),
    )


def appointments_source(spark, sf_dir) -> DataFrame:
    """C2 from events: provider ``<event_type> u<user_id>``, date and time of ts."""
    e = table(spark, sf_dir, "events")
    return e.select(
        _txt("user_id").alias("Patient MRN"),
        F.concat(F.col("event_type"), F.lit(" u"), _txt("user_id")).alias("Provider Name"),
        _txt("event_id").alias("Department ID"),
        F.col("props").alias("Department Name"),
        F.date_format("ts", "M/d/yyyy").alias("Appointment Date"),
        F.date_format("ts", "H:mm:ss").alias("Appointment Time"),
        F.col("event_type").alias("Appointment Type"),
        _money("value").alias("Appointment Description"),
        F.when(F.col("event_id") % 19 == 0, F.lit("NA")).otherwise(F.lit("Booked")).alias("Appointment Status"),
        F.concat(F.lit("R"), _txt("event_id")).alias("Room"),
    )


def providers_source(spark, sf_dir) -> DataFrame:
    """C3 from part: start 1994-01-01 + p_size days, end a year later, empty
    where p_size is even."""
    p = table(spark, sf_dir, "part")
    start = _day("1994-01-01", F.col("p_size"))
    end = F.when(F.col("p_size") % 2 == 0, F.lit("")).otherwise(
        F.date_format(_day("1994-01-01", F.col("p_size") + 365), "yyyy-MM-dd"))
    return p.select(
        _txt("p_partkey").alias("Provider NPI"),
        F.col("p_name").alias("Provider Name"),
        F.col("p_type").alias("Degree"),
        F.when(F.col("p_size") % 2 == 0, F.lit("Active")).otherwise(F.lit("Inactive")).alias("Current Status"),
        _txt("p_size").alias("Department ID"),
        F.col("p_brand").alias("Department Name"),
        F.col("p_type").alias("Section Name"),
        F.date_format(start, "M/d/yyyy").alias("Start Date"),
        end.alias("End Date"),
        _money("p_retailprice").alias("Specialty"),
        F.lit("n/a").alias("Fax"),
    )


def visits_source(spark, sf_dir) -> DataFrame:
    """C4 from orders: the order date as ``yyyy-MM-dd HH:mm:ss`` text."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        _txt("o_custkey").alias("Patient MRN"),
        _txt("o_orderkey").alias("Visit ID"),
        _txt("o_orderdate").alias("Admit Date or Service Date"),
        F.col("o_orderstatus").alias("Visit Status"),
        _money("o_totalprice").alias("Charge"),
        F.col("o_orderpriority").alias("Priority"),
    )


def rx_orders_source(spark, sf_dir) -> DataFrame:
    """C5 from lineitem: ``pharmacyid`` from the supplier, date sent = ship date."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _txt("l_orderkey").alias("Order ID"),
        _txt("l_linenumber").alias("Line Number"),
        _txt("l_suppkey").alias("pharmacyid"),
        F.concat(F.lit("drug "), _txt("l_partkey")).alias("Drug Name"),
        _money("l_quantity").alias("Quantity"),
        F.date_format("l_shipdate", "M/d/yyyy").alias("Date Sent"),
        F.col("l_returnflag").alias("Return Flag"),
    )


SOURCES = {
    "demographics": demographics_source,
    "appointments": appointments_source,
    "providers": providers_source,
    "visits": visits_source,
    "rx_orders": rx_orders_source,
}


def landing_root(spark: SparkSession, sf_dir: str) -> str:
    tag = hashlib.sha256(os.path.abspath(sf_dir).encode()).hexdigest()[:10]
    return f"{scratch_dir(spark)}/landing/{os.path.basename(sf_dir.rstrip('/'))}-{tag}"


def _parts(spark: SparkSession) -> int:
    return max(2, parallelism(spark))


def write_landing(spark: SparkSession, df: DataFrame, path: str, sep: str = "|", line_sep: str | None = None) -> None:
    """A landing folder with the source's own partitions as its parts."""
    write_delimited(df, path, sep=sep, line_sep=line_sep)


def write_marker(spark: SparkSession, path: str) -> None:
    """A producer's marker: a file of one line end."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(at, True)
    out.write(10)
    out.close()


def land(spark: SparkSession, sf_dir: str, key: str, make, sep: str = "|", line_sep: str | None = None) -> str:
    """Write ``make()`` once as a landing folder named ``FILE_NAMES[key]``.

    Its parts are the source's partitions, so a load of the folder reads in
    parallel, with quoted line breaks allowed, and parts grow in number with the data.
    """
    path = f"{landing_root(spark, sf_dir)}/{FILE_NAMES[key]}"
    with _lock:
        if _written.get(path) != "ok":
            write_landing(spark, make(), path, sep, line_sep)
            _written[path] = "ok"
    return path


def land_feed(spark: SparkSession, sf_dir: str, feed: str) -> str:
    return land(spark, sf_dir, feed, lambda: SOURCES[feed](spark, sf_dir))


def land_lines(spark: SparkSession, sf_dir: str, key: str, header: list[str], lines: Column,
               source: DataFrame) -> str:
    """A landing whose rows are given as raw text (to make long rows): one text
    column whose name is the header line, written with a separator that never
    occurs, so nothing is quoted."""
    path = f"{landing_root(spark, sf_dir)}/{FILE_NAMES[key]}"
    with _lock:
        if _written.get(path) != "ok":
            name = "|".join(header)
            (source.select(lines.alias(name)).repartition(_parts(spark))
             .write.mode("overwrite").option("header", True).option("sep", "\u0001").csv(path))
            _written[path] = "ok"
    return path


def land_bytes(spark: SparkSession, sf_dir: str, key: str, lines: Column, source: DataFrame) -> str:
    """A text landing written byte for byte (may hold bytes that are not UTF-8)."""
    path = f"{landing_root(spark, sf_dir)}/{FILE_NAMES[key]}"
    with _lock:
        if _written.get(path) != "ok":
            source.select(lines.alias("value")).repartition(_parts(spark)).write.mode("overwrite").text(path)
            _written[path] = "ok"
    return path
