"""Date and time reformatting."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions._col import col, null_string

# The layouts a date text may have, tried in this order. Month
# first comes before day first, so ``01/05/2024`` is 5 January and ``13/01/2024``
# falls through to 13 January. Each layout may carry a time of day, which is
# checked and then dropped. Month names (any case) come last. Two-digit years
# are read only when a feed states a pivot year (``SHORT_YEAR_LAYOUTS``).
DATE_LAYOUTS = (
    "M/d/yyyy[ H:m[:s][.SSSSSSSSS]]",
    "d/M/yyyy[ H:m[:s][.SSSSSSSSS]]",
    "yyyy-M-d[ H:m[:s][.SSSSSSSSS]]",
    "yyyy-M-d'T'H:m[:s][.SSSSSSSSS]",
    "yyyyMMdd",
    "M-d-yyyy[ H:m[:s][.SSSSSSSSS]]",
    "yyyy/M/d[ H:m[:s][.SSSSSSSSS]]",
    "d-MMM-yyyy[ H:m[:s][.SSSSSSSSS]]",
    "d MMM yyyy[ H:m[:s][.SSSSSSSSS]]",
    "MMM d, yyyy[ H:m[:s][.SSSSSSSSS]]",
    "MMMM d, yyyy[ H:m[:s][.SSSSSSSSS]]",
    "MMM d yyyy[ H:m[:s][.SSSSSSSSS]]",
    "MMMM d yyyy[ H:m[:s][.SSSSSSSSS]]",
    "d MMMM yyyy[ H:m[:s][.SSSSSSSSS]]",
    "MMM-d-yyyy[ H:m[:s][.SSSSSSSSS]]",
    "yyyy.M.d[ H:m[:s][.SSSSSSSSS]]",
)

# A 12-hour time, a zone suffix after a time, and a compact time: each is checked
# and cut off before the layouts are tried, so they need no layouts of their own.
_HALF_DAY = r"(?i)^(.*\S) +(?:0?[1-9]|1[0-2])(?::[0-5]?[0-9]){1,2}(?:\.[0-9]+)? ?[ap]\.?m\.?$"
_ZONE = r"^(.*[0-9]:[0-9]{1,2}(?::[0-9]{1,2}(?:\.[0-9]+)?)?) ?(?:Z|[+-](?:0[0-9]|1[0-8]):?[0-5][0-9])$"
_COMPACT_TIME = r"^([0-9]{8})[ T](?:[01][0-9]|2[0-3])[0-5][0-9](?:[0-5][0-9])?$"

DATE_OUT = "MM-dd-yyyy"
TIME_IN = "H:m:s"
TIME_OUT = "HH:mm"
STAMP_OUT = "yyyy-MM-dd HH:mm:ss.SSS"


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


# Two-digit-year layouts, used only when a feed states a pivot year.
SHORT_YEAR_LAYOUTS = (
    "M/d/yy[ H:m[:s][.SSSSSSSSS]]",
    "d/M/yy[ H:m[:s][.SSSSSSSSS]]",
    "M-d-yy[ H:m[:s][.SSSSSSSSS]]",
    "d-MMM-yy[ H:m[:s][.SSSSSSSSS]]",
)
_SHORT_YEAR = r"^[0-9]{1,2}([/-])(?:[0-9]{1,2}|[A-Za-z]{3})\1[0-9]{2}(?: |$)"


def parse_date(c, layouts=DATE_LAYOUTS, pivot_year: int | None = None) -> Column:
    """First layout that reads the trimmed text, as a DATE; NULL if none does.

    ``try_to_date`` works on local dates, so the session time zone never shifts
    a value. With ``pivot_year`` (2000-2099), two-digit years are read too: they
    land in 2000-2099 and those after the pivot move back a century.
    """
    t = F.trim(col(c))
    t = (F.when(t.rlike(_HALF_DAY), F.regexp_extract(t, _HALF_DAY, 1)).when(t.rlike(_ZONE), F.regexp_extract(t, _ZONE, 1))
         .when(t.rlike(_COMPACT_TIME), F.regexp_extract(t, _COMPACT_TIME, 1)).otherwise(t))
    if tuple(layouts) == DATE_LAYOUTS:
        parsed = _parse_default_layouts(t)
    else:
        parsed = F.coalesce(*[F.try_to_date(t, f) for f in layouts])
    if pivot_year is None:
        return parsed
    if not 2000 <= pivot_year <= 2099:
        raise ValueError("pivot_year must be within 2000-2099")
    short = F.coalesce(*[F.try_to_date(t, f) for f in SHORT_YEAR_LAYOUTS])
    short = F.when(F.year(short) > pivot_year, F.add_months(short, -1200)).otherwise(short)
    return F.coalesce(parsed, F.when(t.rlike(_SHORT_YEAR), short))


def _parse_default_layouts(t: Column) -> Column:
    """The ordered list ``DATE_LAYOUTS``, dispatched on the shape of the text's
    start, so each value meets only the layouts that could read it, in list
    order: usually one anchored regex test and one parse. A failed parse costs
    an exception inside Spark, so this is far cheaper than trying every layout
    in turn, and it gives the same result: a year field needs four or more
    digits, month and day any number (leading zeros), month names letters, and
    every layout has a fixed separator after its first field.
    """
    (m_d_y, d_m_y, y_m_d, y_m_d_t, ymd8, m_d_y_dash, y_m_d_slash,
     d_mon_y_dash, d_mon_y, mon_d_c_y, month_d_c_y, mon_d_y, month_d_y, d_month_y, mon_d_y_dash, y_m_d_dot) = DATE_LAYOUTS

    def d(layout):
        return F.try_to_date(t, layout)

    year_first = t.rlike(r"^[0-9]{4}")
    iso = F.when(F.instr(t, "T") > 0, d(y_m_d_t)).otherwise(d(y_m_d))
    return (F.when(t.rlike(r"^[0-9]+/"), F.coalesce(d(m_d_y), d(d_m_y), F.when(year_first, d(y_m_d_slash))))
            .when(t.rlike(r"^[0-9]+-"),
                  F.when(year_first, F.coalesce(iso, d(m_d_y_dash), d(d_mon_y_dash)))
                  .when(t.rlike(r"^[0-9]+-[A-Za-z]"), d(d_mon_y_dash))
                  .otherwise(d(m_d_y_dash)))
            .when(t.rlike(r"^[0-9]{8}$"), d(ymd8))
            .when(t.rlike(r"^[0-9]+ [A-Za-z]"), F.coalesce(d(d_mon_y), d(d_month_y)))
            .when(t.rlike(r"^[0-9]{4}\."), d(y_m_d_dot))
            .when(t.rlike(r"^[A-Za-z]{3}-[0-9]"), d(mon_d_y_dash))
            # Month-name layouts need letters, a blank, then a digit; other text
            # (e.g. ``garbage``) is settled without a failing parse.
            .when(t.rlike(r"^[A-Za-z]+ [0-9]"), F.coalesce(d(mon_d_c_y), d(month_d_c_y), d(mon_d_y), d(month_d_y))))


def reformat_date(c, strict: bool = True, out: str = DATE_OUT, layouts=DATE_LAYOUTS,
                  error: str = "unreadable date", pivot_year: int | None = None) -> Column:
    """F1 (strict) / F2 (lenient): any accepted layout to ``out``.

    NULL or blank stays NULL. Unreadable text is NULL when lenient and fails
    the task when strict; the message never holds the value.
    """
    c = col(c)
    parsed = parse_date(c, layouts, pivot_year)
    if strict:
        parsed = F.coalesce(parsed, F.raise_error(F.lit(error)).cast("date"))
    return F.when(_blank(c), null_string()).otherwise(F.date_format(parsed, out))


def reformat_time(c, strict: bool = True, layout: str = TIME_IN, out: str = TIME_OUT,
                  error: str = "unreadable time") -> Column:
    """``H:m:s`` text (hours 0-23) to ``HH:mm``; other layouts fail when strict.

    The parse lands on 1970-01-01, where no time zone has a gap.
    """
    c = col(c)
    parsed = F.try_to_timestamp(F.trim(c), F.lit(layout))
    if strict:
        parsed = F.coalesce(parsed, F.raise_error(F.lit(error)).cast("timestamp"))
    return F.when(_blank(c), null_string()).otherwise(F.date_format(parsed, out))


def timestamp_text(ts) -> Column:
    """timestamp as ``yyyy-MM-dd HH:mm:ss.SSS``; digits past the millisecond are cut."""
    return F.date_format(col(ts), STAMP_OUT)


def load_stamp_text(now: datetime | None = None) -> str:
    """P5 value: one stamp per run, the driver's local clock cut to milliseconds."""
    now = now or datetime.now()
    return now.strftime("%Y-%m-%d %H:%M:%S.") + f"{now.microsecond // 1000:03d}"
