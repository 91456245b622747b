"""Feed specification: what a landing file holds and which rules make it a target row."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall import functions as LF
from landfall.errors import CHECK_MARK
from landfall.functions.dates import DATE_LAYOUTS, DATE_OUT, TIME_OUT
from landfall.functions.nulls import NULL_TOKENS

LOAD_STAMP = "Load Timestamp"
FILE_NAME = "File Name"


@dataclass(frozen=True)
class RuleContext:
    feed: str
    file_name: str
    load_ts: str
    date_layouts: tuple
    pivot_year: int | None = None


class Rule:
    """A step over the ordered mapping ``name -> Column`` of the row being built."""

    def reads(self) -> tuple[str, ...]:
        """Input columns the rule needs; a missing one fails the load (R2)."""
        return ()

    def check_message(self, feed: str) -> str | None:
        """Text of the row check this rule runs inside tasks, if any."""
        return None

    def may_lose(self) -> tuple[str, ...]:
        """Columns whose text this rule may turn into nothing without failing; how often is counted."""
        return ()

    def apply(self, cols: dict[str, Column], ctx: RuleContext) -> dict[str, Column]:
        raise NotImplementedError


def _replace(cols: dict[str, Column], name: str, expr: Column) -> dict[str, Column]:
    out = dict(cols)
    out[name] = expr  # same key keeps its place (P4)
    return out


@dataclass(frozen=True)
class Rename(Rule):
    """Rename in place; an absent column is no error. Names compare exactly."""

    old: str
    new: str

    def apply(self, cols, ctx):
        if self.old not in cols:
            return cols
        return {(self.new if k == self.old else k): v for k, v in cols.items()}


@dataclass(frozen=True)
class DateText(Rule):
    """F1 (strict) or F2 (lenient) on one column, in place."""

    column: str
    strict: bool = True
    out: str = DATE_OUT

    def reads(self):
        return (self.column,)

    def check_message(self, feed):
        return f"{CHECK_MARK}: feed {feed}, column {self.column}: unreadable date" if self.strict else None

    def may_lose(self):
        return () if self.strict else (self.column,)

    def apply(self, cols, ctx):
        msg = self.check_message(ctx.feed) or ""
        expr = LF.reformat_date(cols[self.column], strict=self.strict, out=self.out,
                                layouts=ctx.date_layouts, error=msg, pivot_year=ctx.pivot_year)
        return _replace(cols, self.column, expr)


@dataclass(frozen=True)
class TimeText(Rule):
    """F3 on one column, in place."""

    column: str
    strict: bool = True
    out: str = TIME_OUT

    def reads(self):
        return (self.column,)

    def check_message(self, feed):
        return f"{CHECK_MARK}: feed {feed}, column {self.column}: unreadable time" if self.strict else None

    def may_lose(self):
        return () if self.strict else (self.column,)

    def apply(self, cols, ctx):
        msg = self.check_message(ctx.feed) or ""
        return _replace(cols, self.column, LF.reformat_time(cols[self.column], strict=self.strict,
                                                            out=self.out, error=msg))


@dataclass(frozen=True)
class Digits(Rule):
    """F5 on one column, in place."""

    column: str

    def reads(self):
        return (self.column,)

    def may_lose(self):
        return (self.column,)

    def apply(self, cols, ctx):
        return _replace(cols, self.column, LF.digits_only(cols[self.column]))


@dataclass(frozen=True)
class SplitName(Rule):
    """two new columns from one name column, appended."""

    column: str
    family: str
    given: str

    def reads(self):
        return (self.column,)

    def apply(self, cols, ctx):
        out = dict(cols)
        out[self.family] = LF.family_name(cols[self.column])
        out[self.given] = LF.given_name(cols[self.column])
        return out


@dataclass(frozen=True)
class LoadStamp(Rule):
    """P5: one stamp for the whole run, a literal in the plan."""

    column: str = LOAD_STAMP

    def apply(self, cols, ctx):
        out = dict(cols)
        out[self.column] = F.lit(ctx.load_ts)
        return out


@dataclass(frozen=True)
class FileName(Rule):
    """Base name of the landed object, a literal in the plan."""

    column: str = FILE_NAME

    def apply(self, cols, ctx):
        out = dict(cols)
        out[self.column] = F.lit(ctx.file_name)
        return out


@dataclass(frozen=True)
class FeedSpec:
    """One feed: where its files land, how they read, which rules run, where rows go.

    ``output`` set means a closed projection (P2) in that order; ``None`` keeps
    every input column in input order with new ones last (P3).

    ``strict_utf8``: bytes that are not UTF-8 fail the load (S5); the load pass
    counts rows holding U+FFFD and only then runs the exact check. Off, that
    per-value search is skipped.

    ``multi_line`` declares whether fields may hold line breaks: ``True`` parses
    each file in one task, ``False`` lets files split by bytes, and a file that
    has such a break after all fails its load. The choice is the feed's, never one
    by file size, so a file reads alike at every size.

    ``reconcile``: ``"rows"`` compares the target's row count (from the written
    footers), ``"content"`` also a checksum over all values, which reads the
    written rows back.

    ``pivot_year``: two-digit years after it belong to the century before.
    """

    name: str
    prefix: str
    target: str
    rules: tuple[Rule, ...]
    output: tuple[str, ...] | None = None
    fill_missing: bool = False
    sep: str = "|"
    null_tokens: tuple[str, ...] = NULL_TOKENS
    date_layouts: tuple[str, ...] = DATE_LAYOUTS
    pivot_year: int | None = 2068
    multi_line: bool = True
    long_rows: str = "fail"
    encoding: str = "UTF-8"
    strict_utf8: bool = True
    reconcile: str = "rows"

    def __post_init__(self):
        if not re.fullmatch(r"[A-Za-z0-9_.\-]+", self.target):
            raise ValueError("target must be a plain name (letters, digits, _ . -)")
        if self.long_rows not in ("fail", "quarantine"):
            raise ValueError("long_rows must be 'fail' or 'quarantine'")
        if self.reconcile not in ("rows", "content"):
            raise ValueError("reconcile must be 'rows' or 'content'")

    def required(self) -> tuple[str, ...]:
        seen: list[str] = []
        for r in self.rules:
            for c in r.reads():
                if c not in seen:
                    seen.append(c)
        return tuple(seen)

    def check_messages(self) -> list[str]:
        msgs = [m for r in self.rules if (m := r.check_message(self.name))]
        return msgs + [long_row_message(self.name), open_quote_message(self.name)]

    def with_options(self, **kw) -> "FeedSpec":
        from dataclasses import replace

        return replace(self, **kw)


def check_targets(specs) -> None:
    """Two feeds writing one target would overwrite each other's snapshot."""
    seen: dict[str, str] = {}
    for s in specs:
        if s.target in seen:
            raise ValueError(f"feeds {seen[s.target]} and {s.name} share target {s.target}")
        seen[s.target] = s.name


def open_quote_message(feed: str) -> str:
    return f"{CHECK_MARK}: feed {feed}: a quoted field holds a line break; load the feed with multi_line=True"


def long_row_message(feed: str) -> str:
    return f"{CHECK_MARK}: feed {feed}: a row has more fields than the header"
