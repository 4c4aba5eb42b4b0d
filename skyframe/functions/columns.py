"""Column -> Column helpers (survey §2.2). All are built-in expressions, so
they stay inside whole-stage codegen; none needs a Python worker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# B4
def make_date_col(y="year", m="month", d="day") -> Column:
    """Date from year/month/day; null when any part is null."""
    return F.make_date(_c(y), _c(m), _c(d))


# B5
def date_key(date_col="date") -> Column:
    """``yyyyMMdd`` text of a date."""
    return F.date_format(_c(date_col), "yyyyMMdd")


# B6
def pad_hhmm(col, numeric_float: bool = True) -> Column:
    """Numeric HHMM as four-digit text; null stays null.

    Float clocks (``dep_time``) are cast to int first, because
    ``lpad(cast(5.0 as string), 4, '0')`` would give ``05.0``.
    """
    c = _c(col)
    if numeric_float:
        c = c.cast("int")
    return F.lpad(c.cast("string"), 4, "0")


# B7
def recode_2400(col) -> Column:
    c = _c(col)
    return F.when(c == "2400", F.lit("0000")).otherwise(c)


# B8
def parse_stamp(date_key_col, hhmm_col) -> Column:
    """``yyyyMMdd`` + ``HHmm`` text to a timestamp; malformed -> null."""
    return F.try_to_timestamp(F.concat(_c(date_key_col), _c(hhmm_col)), F.lit("yyyyMMddHHmm"))


# B6-B8, arithmetic form
def clock_stamp(date_col, hhmm) -> Column:
    """Stamp of a numeric ``HHMM`` clock on a date. For 0 <= HHMM < 10000 it
    equals padding to four digits, recoding ``2400`` to ``0000`` and parsing
    ``yyyyMMddHHmm`` (invalid hour or minute -> null), without building and
    parsing text; other values take the text path."""
    d = _c(date_col)
    x = _c(hhmm).cast("int")
    h = F.when(x == 2400, F.lit(0)).otherwise(F.floor(x / 100).cast("int"))
    m = F.when(x == 2400, F.lit(0)).otherwise(x % 100)
    fast = F.try_make_timestamp(F.year(d), F.month(d), F.dayofmonth(d), h, m, F.lit(0))
    slow = parse_stamp(date_key(d), recode_2400(F.lpad(x.cast("string"), 4, "0")))
    return F.when(x.isNull(), F.lit(None).cast("timestamp")).when((x >= 0) & (x < 10000), fast).otherwise(slow)


# B9
def roll_midnight(col) -> Column:
    """+1 day when the stamp's hour is 0 (the published midnight rule)."""
    c = _c(col)
    return F.when(F.hour(c) == 0, c + F.expr("INTERVAL 1 DAY")).otherwise(c)


# B10
def minutes_between(later, earlier) -> Column:
    """Signed minutes from ``earlier`` to ``later`` (double, like the source)."""
    return (F.unix_timestamp(_c(later)) - F.unix_timestamp(_c(earlier))) / 60.0


# B15
def normalise_name(col) -> Column:
    """lower case, blanks to ``_``, dots removed: ``Alaska Airlines Inc.`` ->
    ``alaska_airlines_inc``."""
    return F.regexp_replace(F.regexp_replace(F.lower(_c(col)), " ", "_"), r"\.", "")


# B16
def display_name(col, unknown: str = "Unknown") -> Column:
    return F.coalesce(F.replace(_c(col), F.lit("_"), F.lit(" ")), F.lit(unknown))


# B18
def equals_ignore_case(col, value: str) -> Column:
    return F.lower(_c(col)) == F.lower(F.lit(value))


# B21
def clip(col, lo=None, hi=None) -> Column:
    """Null-safe clip (null stays null)."""
    c = _c(col)
    if lo is not None:
        c = F.when(c.isNull(), c).otherwise(F.greatest(c, F.lit(lo)))
    if hi is not None:
        c = F.when(c.isNull(), c).otherwise(F.least(c, F.lit(hi)))
    return c


# B22
def to_numeric_or_zero(col) -> Column:
    return F.coalesce(_c(col).try_cast("double"), F.lit(0.0))


# B25
def hour_mismatch(hour_col, ts_col) -> Column:
    """Aggregate: rows whose hour column disagrees with the stamp."""
    return F.count_if(F.hour(_c(ts_col)) != _c(hour_col))


# B26
def delay_band(col) -> Column:
    c = _c(col)
    return (F.when(c.isNull(), "unknown").when(c <= 0, "on_time")
            .when(c <= 15, "minor").otherwise("late"))


# B27
def clock_text(ts_col) -> Column:
    return F.date_format(_c(ts_col), "HH:mm")


# B29
def narrow_int(col) -> Column:
    return _c(col).cast("int")


# H7
def bin_right_closed(col, edges=(0.0, 500.0, 1000.0)) -> Column:
    """Right-closed bins ``(e0,e1] (e1,e2] ... (ek,inf)`` -> 0..k; outside
    the first edge or null -> -1 (the codes of an ordered category)."""
    c = _c(col)
    out = F.when(c.isNull() | (c <= edges[0]), F.lit(-1))
    for i in range(1, len(edges)):
        out = out.when(c <= edges[i], F.lit(i - 1))
    return out.otherwise(F.lit(len(edges) - 1))


# K0
def binarise_label(col, threshold: float = 0.0) -> Column:
    c = _c(col)
    return F.when(c.isNull(), F.lit(None).cast("int")).when(c > threshold, 1).otherwise(0)


# J13
def alert_severity(count_col) -> Column:
    """0 issues CLEAR, 1-2 INFO, 3-5 WARNING, more CRITICAL."""
    c = _c(count_col)
    return (F.when(c <= 0, "CLEAR").when(c <= 2, "INFO").when(c <= 5, "WARNING")
            .otherwise("CRITICAL"))


def epoch_seconds(ts_col) -> Column:
    return F.unix_timestamp(_c(ts_col))
