"""Cleaning of raw flight events (survey §2.2 B1-B14, plus the ordered
steps D3/D5/D6 of the batch ETL job).

``clean_flights`` writes the stamped rows once; the top-n probe of
``drop_tail`` (bounded by n rows), the bounded key sample, the carried
values and the rows of the fill all read that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.functions import columns as C
from skyframe.plans import ordered
from skyframe.plans.flights import OUTCOME_COLS, RAW_FIELDS, ROW_KEYS
from skyframe.session import written

CLOCK_FLOAT = ["dep_time", "arr_time"]
CLOCK_INT = ["sched_dep_time", "sched_arr_time"]
STAMP_COLS = ["sched_dep_time", "sched_arr_time", "dep_time", "arr_time"]
FFILL_COLS = ["wind_dir", "wind_speed", "wind_gust"]
# The 31-column contract of the processed table (raw fields + date, date_string).
CLEAN_FIELDS = RAW_FIELDS + ["date", "date_string"]


# B1
def drop_all_null(df: DataFrame, cols=OUTCOME_COLS) -> DataFrame:
    return df.na.drop(how="all", subset=list(cols))


# B2 / B3
def drop_any_null(df: DataFrame, cols=None) -> DataFrame:
    return df.na.drop(how="any", subset=list(cols) if cols else None)


# B12
def dedupe(df: DataFrame, cols=None) -> DataFrame:
    return df.dropDuplicates(list(cols)) if cols else df.dropDuplicates()


# B13
def drop_columns(df: DataFrame, names) -> DataFrame:
    return df.drop(*names)


# B14
def align_to_schema(df: DataFrame, cols=CLEAN_FIELDS) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns for the table contract: {missing}")
    return df.select(*cols)


# B15 over a frame's column names
def normalise_column_names(df: DataFrame) -> DataFrame:
    import re
    return df.toDF(*[re.sub(r"\.", "", re.sub(" ", "_", c.lower())) for c in df.columns])


def stamp_times(df: DataFrame) -> DataFrame:
    """Date, date key, clocks as stamps (padded text, 2400 recode and
    parse, computed arithmetically), midnight rule on the actual times."""
    df = df.withColumn("date", C.make_date_col("year", "month", "day"))
    df = df.withColumn("date_string", C.date_key("date"))
    df = df.withColumns({c: C.clock_stamp("date", c) for c in STAMP_COLS})
    return df.withColumns({c: C.roll_midnight(c) for c in CLOCK_FLOAT})


def _consistent():
    return ((F.col("dep_delay") == C.minutes_between("dep_time", "sched_dep_time"))
            & (F.col("arr_delay") == C.minutes_between("arr_time", "sched_arr_time")))


def keep_consistent(df: DataFrame) -> DataFrame:
    """B10 + B11: reported delays must equal recomputed minutes exactly."""
    return df.filter(_consistent())


def clean_flights(df: DataFrame, tail: int = 10, tie=ROW_KEYS, ffill=FFILL_COLS, widen=None) -> DataFrame:
    """The batch ETL cleaning in its published order.

    Cancellations (all outcomes null) and rows missing arrival data are
    dropped, clocks become stamps, the last ``tail`` departures are removed,
    wind columns are forward filled in departure order, rows whose reported
    delay disagrees with the stamps are dropped, and duplicates removed.
    ``tie`` completes the departure order so results are deterministic.

    Rows are shuffled once, by buckets of the departure order: equal rows
    share their place in it, so duplicates are removed where the fill has put
    them. With ``widen`` (a projection computing all fields from the columns
    of ``df``, which it keeps and which differ where any field does) only the
    columns of ``df`` are written and moved.
    The result reads the stamped rows from the shared folder; a caller that
    has written it elsewhere drops them (``session.scratch_scope``).
    """
    wide = widen(df) if widen else df
    rows = drop_any_null(drop_all_null(wide, OUTCOME_COLS), ["arr_time", "arr_delay", "air_time"])
    rows = stamp_times(rows)
    fields = rows.columns
    stored = df.columns if widen else fields
    # the check of the delays reads no filled column: its outcome is written with the rows
    rows = written(rows.select(*dict.fromkeys([*stored, "dep_time"]), _consistent().alias("_ok")), "stamped")
    rows = ordered.drop_tail(rows, tail, ["dep_time"], tie)
    rows = ordered.forward_fill(rows, list(ffill), ["dep_time"], tie, keep_bucket=True)
    rows = dedupe(rows.filter("_ok").select(*stored, ordered.BUCKET))
    return (stamp_times(widen(rows)) if widen else rows).select(*fields)
