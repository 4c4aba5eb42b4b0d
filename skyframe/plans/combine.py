"""Putting one-row results side by side without a join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(*frames: DataFrame) -> DataFrame:
    """One row holding the columns of several one-row (or empty) frames
    with distinct column names: a union by name and one aggregate that
    keeps each column's only non-null value. An empty input contributes
    nulls, like a left join would."""
    cols = [c for f in frames for c in f.columns]
    if len(cols) != len(set(cols)):
        raise ValueError("side_by_side needs distinct column names")
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
