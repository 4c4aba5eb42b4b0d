"""Presentation of registered query results: doubles rounded to a fixed
number of digits and stamps/dates as ISO text, so that two engines can be
compared value by value (the twin SQL applies the same rounding)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = F.round(c.cast("double"), digits)
        cols.append(c.alias(f.name))
    return df.select(*cols)
