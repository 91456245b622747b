"""Counts: rows read (A1) observed in the write's own pass, target count (A2),
reconciliation of counts and of content (A3), lost values, head preview (L1)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from landfall.errors import CountMismatch
from landfall.functions._col import sql_name


@dataclass(frozen=True)
class LoadCounts:
    rows_read: int
    rows_long: int
    rows_replaced_chars: int
    rows_with_quotes: int = 0
    arrived: int | None = None          # microseconds
    content_sum: int | None = None
    lost: dict = field(default_factory=dict)


def _holds(columns, text: str) -> str:
    """SQL test: one of the columns holds ``text``."""
    return " OR ".join(f"coalesce(instr({sql_name(c)}, '{text}') > 0, false)" for c in columns) or "false"


def observe_counts(df: DataFrame, long_row: Column, text_columns, quote_columns=(), line_feed: bool = False,
                   arrived: str | None = None) -> tuple[DataFrame, Observation]:
    """A1 without a second pass: the counts ride along the write job.

    ``rows_replaced_chars`` counts rows holding U+FFFD, which the reader puts in
    place of bytes that are not UTF-8; only then is the exact check (S5) run.
    ``rows_with_quotes`` counts rows holding a quote (or, with ``line_feed``, a
    line feed): where a quoted field was cut at a line end, its closing quote
    stays in a value, or the record is short and its raw text holds the quote, so
    without such rows no field was cut; only else are the raw lines looked at.
    ``text_columns`` and ``quote_columns`` are column names, ``arrived`` that of a time.
    """
    obs = Observation(f"load-{uuid.uuid4().hex}")
    quotes = _holds(quote_columns, '"') + (f" OR {_holds(quote_columns, chr(92) + 'n')}" if line_feed else "")
    observed = df.observe(
        obs,
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(long_row).alias("rows_long"),
        F.expr("count_if(" + _holds(text_columns, "\\uFFFD") + ")").alias("rows_replaced_chars"),
        F.expr(f"count_if({quotes})").alias("rows_with_quotes"),
        F.max(F.unix_micros(arrived) if arrived else F.lit(None).cast("long")).alias("arrived"),
    )
    return observed, obs


def row_hash(columns) -> Column:
    """64-bit hash of a row's values, as a number that can be summed without overflow."""
    return F.xxhash64(*[F.col(sql_name(c)) for c in columns]).cast("decimal(38,0)")


def content_sum(columns) -> Column:
    """A3 over content: the sum of the rows' hashes, the same for the same rows in any order."""
    return F.coalesce(F.sum(row_hash(columns)), F.lit(0).cast("decimal(38,0)"))


def observe_results(df: DataFrame, columns, lost: dict[str, str], content: bool) -> tuple[DataFrame, Observation | None]:
    """Rows as they are written, observed: how many values each column named in ``lost`` (column name ->
    name of a boolean column that marks a lost value) lost, and with ``content`` the sum of the row
    hashes. The marks are dropped."""
    measures = [F.count_if(F.col(mark)).alias(mark) for mark in lost.values()]
    measures += [content_sum(columns).cast("string").alias("content_sum")] if content else []
    if not measures:
        return df, None
    obs = Observation(f"results-{uuid.uuid4().hex}")
    return df.observe(obs, *measures).select(*[F.col(sql_name(c)) for c in columns]), obs


def counts_of(obs: Observation, results: Observation | None = None, lost: dict[str, str] | None = None) -> LoadCounts:
    m, r = obs.get, results.get if results is not None else {}
    total = r.get("content_sum")
    return LoadCounts(int(m.get("rows_read", 0) or 0), int(m.get("rows_long", 0) or 0),
                      int(m.get("rows_replaced_chars", 0) or 0), int(m.get("rows_with_quotes", 0) or 0), m.get("arrived"),
                      None if total is None else int(total), {c: int(r.get(mark) or 0) for c, mark in (lost or {}).items()})


def reconcile(rows_expected: int, rows_target: int) -> None:
    """A3: the target holds exactly the rows the load meant to write."""
    if rows_expected != rows_target:
        raise CountMismatch(f"target holds {rows_target} rows, load wrote {rows_expected}")


def reconcile_content(written: int, found: int) -> None:
    """A3: the target holds the very values the load wrote."""
    if written != found:
        raise CountMismatch("the target's rows are not the rows the load wrote (their checksums differ)")


def head_rows(df: DataFrame, n: int = 10, order_by=None) -> DataFrame:
    """L1: a preview of ``n`` rows, handed back (never logged).

    With ``order_by`` it is a top-k (each task keeps ``n`` rows, no full sort);
    without, it is whichever ``n`` rows the first splits yield.
    """
    if order_by is None:
        return df.limit(n)
    keys = order_by if isinstance(order_by, (list, tuple)) else [order_by]
    return df.orderBy(*keys).limit(n)
