"""Joins, set operations and ordered selections (survey D5-D9, E1-E4, G1,
A14).

All joins are equi-joins (no cross joins); strategy is left to Catalyst
and AQE. Small sides are never forced into a broadcast unless their size
is bounded by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.plans.ordered import total_order


def _null_safe_cond(keys, prefix):
    return [F.col(k).eqNullSafe(F.col(f"{prefix}{i}")) for i, k in enumerate(keys)]


def _renamed(df: DataFrame, keys, prefix):
    return df.select(*[F.col(k).alias(f"{prefix}{i}") for i, k in enumerate(keys)],
                     *[c for c in df.columns if c not in keys])


# D5
def order_by(df: DataFrame, cols, tie=()) -> DataFrame:
    return df.orderBy(*cols, *tie)


# D7
def top_k(df: DataFrame, k: int, order, ascending: bool = False, tie=()) -> DataFrame:
    """Top (or bottom) k rows, ties by ``tie``: each partition keeps k, one
    merge of k rows per partition (TakeOrderedAndProject)."""
    cols = [F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last() for c in order]
    return df.orderBy(*cols, *tie).limit(k)


# D8
def latest_n(df: DataFrame, key: str, ts: str, n: int = 12) -> DataFrame:
    """The ``n`` most recent distinct ids; a repeated id keeps its first
    occurrence (first seen wins; on equal stamps the smallest row).

    Only (id, first stamp) goes through the shuffle (one aggregate per id,
    map-side combined); a bounded top-n picks the ids, and their rows at
    the first stamp are fetched by a semi-join with those n keys
    (broadcast, n rows by construction)."""
    firsts = df.groupBy(key).agg(F.min(ts).alias("_first"))
    top = (firsts.orderBy(F.col("_first").desc(), F.col(key)).limit(n)
           .select(F.col(key).alias("_k"), "_first"))
    at_first = df.join(F.broadcast(top), F.col(key).eqNullSafe(F.col("_k")) & (F.col(ts) == F.col("_first")),
                       "left_semi")
    one = at_first.groupBy(key).agg(F.min_by(F.struct(*df.columns), F.struct(*total_order(df, [ts]))).alias("_r"))
    one = one.select("_r.*")
    return one.orderBy(F.col(ts).desc(), F.col(key)).limit(n)


# D9
def sort_by_time(df: DataFrame, ts: str, tie=()) -> DataFrame:
    return df.orderBy(F.col(ts).asc(), *tie)


# E2 / A14
def upsert_by_key(target: DataFrame, updates: DataFrame, keys, cols) -> DataFrame:
    """Set ``cols`` on the target row with the same key; create the row when
    absent (other columns null). A full outer join on the key; the update
    side wins for the listed columns."""
    keys, cols = list(keys), list(cols)
    u = _renamed(updates.select(*keys, *cols), keys, "_u")
    u = u.select(*[c for c in u.columns if c.startswith("_u")], *[F.col(c).alias(f"_new_{c}") for c in cols])
    joined = target.withColumn("_in_target", F.lit(True)).join(u, _null_safe_cond(keys, "_u"), "full_outer")
    out = []
    for f in target.schema.fields:
        c = f.name
        if c in keys:
            i = keys.index(c)
            out.append(F.when(F.col("_in_target").isNull(), F.col(f"_u{i}")).otherwise(F.col(c)).alias(c))
        elif c in cols:
            matched = F.col("_u0").isNotNull() if keys else F.lit(False)
            out.append(F.when(matched, F.col(f"_new_{c}")).otherwise(F.col(c)).cast(f.dataType).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


# E3
def join_baseline(current: DataFrame, baseline: DataFrame, key: str = "feature"):
    """(matched rows with baseline columns prefixed ``baseline_``, current
    rows without a baseline)."""
    b = baseline.select(F.col(key).alias("_bk"), *[F.col(c).alias(f"baseline_{c}") for c in baseline.columns if c != key])
    matched = current.join(b, F.col(key) == F.col("_bk"), "inner").drop("_bk")
    missing = current.join(baseline.select(key), key, "left_anti")
    return matched, missing


# E4 / M6 (batch)
def duplicate_guard(new: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose id was not seen before (left anti join)."""
    return new.join(seen.select(key).distinct(), key, "left_anti")


# G1
def append(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)
