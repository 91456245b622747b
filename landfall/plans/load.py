"""One load as one lazy plan: scan -> null tokens -> feed rules -> empty to
NULL -> long-row check, with the counts observed in the same pass."""

from __future__ import annotations

import posixpath
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from landfall.errors import HeaderError
from landfall.functions.dates import load_stamp_text
from landfall.functions.nulls import empty_to_null, fill_missing, null_tokens
from landfall.operators.counts import observe_counts, observe_results
from landfall.operators.projection import qcol
from landfall.operators.rows import has_open_quote, is_long_row
from landfall.plans.spec import FeedSpec, RuleContext, long_row_message, open_quote_message
from landfall.sources.delimited import (
    ARRIVED,
    CORRUPT,
    check_header,
    read_delimited,
    read_head,
    with_arrival,
    without_blank_lines,
)

QUARANTINE_COLUMNS = ("feed", "file", "record_key", "raw_record", "reason")


@dataclass
class FeedLoad:
    spec: FeedSpec
    path: str
    file_name: str
    load_ts: str
    header: list[str]
    rows: DataFrame                 # target rows; counts observed on the way
    observation: Observation
    quarantine: DataFrame | None    # long rows, when the feed quarantines them
    columns: list[str]
    multi_line: bool = True
    line_sep: str | None = None
    results: Observation | None = None      # lost values and content sum
    lost: dict | None = None                # column -> measure of ``results``


def file_name_of(path: str) -> str:
    """F9 on the load path: the landed object's base name (a folder of parts
    counts as one object)."""
    return posixpath.basename(path.rstrip("/"))


def build_load(spark: SparkSession, spec: FeedSpec, path: str, *, load_ts: str | None = None,
               file_name: str | None = None, glob: str | None = None) -> FeedLoad:
    """Plan the load of one landed object. Only the header is read now. ``glob`` picks the
    files of a landed folder."""
    header, line_sep = read_head(spark, path, spec.sep, spec.multi_line, spec.encoding, glob)
    check_header(header, required=spec.required())
    enc = spec.encoding.replace("-", "").upper()
    read = read_delimited(spark, path, header, spec.sep, spec.multi_line, spec.encoding, line_sep=line_sep, glob=glob)
    raw = without_blank_lines(with_arrival(read), header)

    load_ts = load_ts or load_stamp_text()
    file_name = file_name if file_name is not None else file_name_of(path)
    ctx = RuleContext(spec.name, file_name, load_ts, spec.date_layouts, spec.pivot_year)

    long_row = is_long_row(F.col(CORRUPT), spec.sep, len(header))
    utf8 = spec.strict_utf8 and enc == "UTF8"
    whole = header + [CORRUPT]
    observed, obs = observe_counts(raw, long_row, whole if utf8 else [], [] if spec.multi_line else whole,
                                   line_sep is not None, ARRIVED)

    # N1 (and N2) first, then the rules in order, then N3 on every output column.
    # The cleaned values are a projection of their own: a rule that reads a
    # value several times (dates do) then reads a column, not the expression.
    cleaned = []
    for h in header:
        c = null_tokens(h, spec.null_tokens)
        cleaned.append((fill_missing(c) if spec.fill_missing else c).alias(h))
    cols = {h: qcol(h) for h in header}
    gone: dict[str, Column] = {}
    for rule in spec.rules:
        before, cols = cols, rule.apply(cols, ctx)
        for c in rule.may_lose():
            now = (F.trim(before[c]) != "") & F.coalesce(cols[c] == "", F.lit(True))
            gone[c] = gone[c] | now if c in gone else now
    lost = {c: f"_lost_{k}" for k, c in enumerate(gone)}
    if spec.output is not None:
        absent = [n for n in spec.output if n not in cols]
        if absent:
            raise HeaderError(f"output columns not produced: {absent}")
        cols = {n: cols[n] for n in spec.output}
    out = [empty_to_null(v).alias(k) for k, v in cols.items()]

    if not spec.multi_line:
        # A record that is short and has an open quote was cut at a line end: sure enough to fail in the
        # task. A last field that was cut shows in its neighbours only; ``run_load`` looks at the raw lines then.
        cut = F.when(F.col(CORRUPT).isNotNull(), has_open_quote(CORRUPT, spec.sep)).otherwise(False)
        observed = observed.filter(F.when(cut, F.raise_error(F.lit(open_quote_message(spec.name)))).otherwise(F.lit(True)))
    if spec.long_rows == "fail":
        msg = long_row_message(spec.name)
        kept = observed.filter(F.when(long_row, F.raise_error(F.lit(msg))).otherwise(F.lit(True)))
        quarantine = None
    else:
        kept = observed.filter(~long_row)
        # Spark refuses a CSV scan whose only needed column is the corrupt-record
        # one (e.g. ``count()`` here); this always-true test keeps a data column
        # in the scan.
        keeps_a_field = qcol(header[0]).isNull() | qcol(header[0]).isNotNull()
        quarantine = raw.filter(long_row & keeps_a_field).select(
            F.lit(spec.name).alias("feed"), F.lit(file_name).alias("file"),
            qcol(header[0]).alias("record_key"), F.col(CORRUPT).alias("raw_record"),
            F.lit("long_row").alias("reason"))
    rows, results = observe_results(kept.select(*cleaned).select(*out, *[v.alias(lost[c]) for c, v in gone.items()]), list(cols), lost, spec.reconcile == "content")
    return FeedLoad(spec, path, file_name, load_ts, header, rows, obs, quarantine, list(cols), spec.multi_line, line_sep, results, lost)


def load(spark: SparkSession, spec: FeedSpec, path: str, **kw) -> DataFrame:
    """The target rows of one landed object as a lazy DataFrame."""
    return build_load(spark, spec, path, **kw).rows

