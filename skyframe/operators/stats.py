"""Aggregations (survey §2.3 C1-C39).

Everything is a hash aggregate with Spark's own partial (map-side) and
final phases, so a hot group is combined before the shuffle. Scalars that
a later step needs (a table total, a min/max) are fetched as one number
and inlined as a literal rather than joined back. Exact quantiles use value
counts and the running sums of ``plans.ordered`` instead of collecting a
group's values into one task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.functions.columns import equals_ignore_case
from skyframe.plans import ordered
from skyframe.session import written


def scalar(df: DataFrame, expr: Column):
    """One aggregate value, fetched to the driver as a single number."""
    return df.agg(expr.alias("v")).first()["v"]


# C1, C2, C3
def max_of(df, col="dep_delay", alias="max_delay"):
    return df.agg(F.max(col).alias(alias))


def min_of(df, col="dep_delay", alias="min_delay"):
    return df.agg(F.min(col).alias(alias))


def row_count(df, alias="flight_count"):
    return df.agg(F.count(F.lit(1)).alias(alias))


# C4 / C8 / C15 / D7
def counts_by(df, keys, alias="flight_count", k: int | None = None, ascending: bool = False):
    """Group sizes ordered by size (desc by default), ties by key; optional top-k."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))
    size = F.col(alias).asc() if ascending else F.col(alias).desc()
    out = out.orderBy(size, *[F.col(c).asc_nulls_first() for c in keys])
    return out.limit(k) if k else out


# C5
def avg_for_value(df, key, value, col="dep_delay", avg_alias="avg_delay", n_alias="flight_count"):
    return (df.filter(equals_ignore_case(key, value))
            .agg(F.avg(col).alias(avg_alias), F.count(F.lit(1)).alias(n_alias)))


# C6 / C7 / C14
def mean_by(df, key="airline", col="dep_delay", alias="avg_dep_delay", k=None, ascending=False,
            drop_null_values=False):
    if drop_null_values:
        df = df.filter(F.col(col).isNotNull())
    out = df.groupBy(key).agg(F.avg(col).alias(alias))
    v = F.col(alias).asc_nulls_last() if ascending else F.col(alias).desc_nulls_last()
    out = out.orderBy(v, F.col(key).asc_nulls_first())
    return out.limit(k) if k else out


# C11 / C12
def means_for_value(df, key, value, cols, upper=True):
    f = F.upper(F.col(key)) == value.upper() if upper else equals_ignore_case(key, value)
    return df.filter(f).agg(*[F.avg(c).alias(f"avg_{c}") for c in cols])


# C16
def delay_by_temperature(df, temp="temp", delay="arr_delay", min_count=100):
    return (df.filter(F.col(delay).isNotNull() & F.col(temp).isNotNull())
            .groupBy(F.round(temp).cast("int").alias("temperature_in_degrees"))
            .agg(F.avg(delay).alias("average_arrival_delay"), F.count(F.lit(1)).alias("flight_count"))
            .filter(F.col("flight_count") > min_count)
            .orderBy("temperature_in_degrees"))


# C17
def preview(df, order, n=10):
    return df.orderBy(*order).limit(n)


# C18
def group_stat(df, cat, num, fn="mean"):
    """Summary of ``num`` per ``cat`` sorted descending. ``fn`` is a name
    (sum, mean, median, min, max, count, std) or any aggregate Column."""
    if isinstance(fn, Column):
        agg = fn
        return df.groupBy(cat).agg(agg.alias(num)).orderBy(F.col(num).desc_nulls_last(), cat)
    if fn == "median":
        out = group_quantiles(df, [cat], num, [0.5]).select(cat, F.col("q_0").alias(num))
        return out.orderBy(F.col(num).desc_nulls_last(), cat)
    fns = {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count,
           "std": F.stddev_samp}
    return df.groupBy(cat).agg(fns[fn](num).alias(num)).orderBy(F.col(num).desc_nulls_last(), cat)


# C19
def total_by(df, key="airline", col="distance", alias=None):
    alias = alias or f"total_{col}"
    return df.groupBy(key).agg(F.sum(col).alias(alias)).orderBy(F.col(alias).desc_nulls_last(), key)


# C20
def value_counts(df, col, normalize=True):
    """Counts per value (nulls dropped, like pandas) and the percent share."""
    base = df.filter(F.col(col).isNotNull())
    out = base.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        total = scalar(base, F.count(F.lit(1))) or 0
        out = out.withColumn("percent", F.try_divide(F.col("count") * 100.0, F.lit(float(total))))
    return out.orderBy(F.col("count").desc(), col)


# C21
def distinct_counts(df, cols, approx=False, rsd=0.02):
    if approx:
        return df.agg(*[F.approx_count_distinct(c, rsd).alias(f"n_{c}") for c in cols])
    # one narrow scan per column instead of every row once per column
    from skyframe.plans.combine import side_by_side
    return side_by_side(*[df.select(c).distinct().agg(F.count(c).alias(f"n_{c}")) for c in cols])


# C22
def fleet_size(df, key="airline", item="tailnum"):
    return (df.groupBy(key).agg(F.countDistinct(item).alias("fleet_size"))
            .orderBy(F.col("fleet_size").desc(), key))


def counts_by_value(df, group, col):
    """(group, _v, c): how often each value occurs, combined map-side."""
    values = df.select(*group, F.col(col).alias("_v")).filter(F.col("_v").isNotNull())
    return values.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("c"))


def group_quantiles(df, group, col, probs, num_buckets: int | None = None):
    """Exact linear-interpolated quantiles (pandas / numpy default) of
    ``col`` per group, without gathering a group's values into one task.

    Values are first reduced to counts per (group, value), so a value that
    most rows share is combined map-side; running sums over the distinct
    values then tell which value holds each wanted rank, and one aggregate
    picks them: no join. Output columns ``q_i``."""
    group = list(group)
    counts = written(counts_by_value(df, group, col), "value-counts")
    run = ordered.running_sums(counts, "_v", ["c"], num_buckets, group=group)
    picks = []
    for i, p in enumerate(probs):
        at = (F.col("total_c") - 1) * F.lit(float(p))          # 0-based position, between two ranks
        for name, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (F.col("cum_c") - F.col("c") <= rank) & (rank < F.col("cum_c"))
            picks.append(F.max(F.when(holds, F.col("_v"))).alias(f"_{name}{i}"))
        picks.append(F.max(at - F.floor(at)).alias(f"_f{i}"))
    out = run.groupBy(*group).agg(*picks)
    return out.select(*group, *[(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(f"q_{i}")
                                for i in range(len(probs))])


# C23
def describe(df, cols):
    """count, mean, std, min, 25 %, 50 %, 75 %, max per column (long form).
    Moments come from one wide aggregate; the quartiles of all columns from
    one distributed ranking of the (column, value) pairs."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    stack = "stack({}, {}) as (column, count, mean, std, min, max)".format(
        len(cols), ", ".join(f"'{c}', n{i}, m{i}, s{i}, lo{i}, hi{i}" for i, c in enumerate(cols)))
    moments = df.agg(*aggs).selectExpr(stack)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                                for c in cols]))
    long = df.select(pairs.alias("p")).select("p.column", "p.v")
    q = group_quantiles(long, ["column"], "v", [0.25, 0.5, 0.75]).select(
        "column", F.col("q_0").alias("p25"), F.col("q_1").alias("p50"), F.col("q_2").alias("p75"))
    return moments.join(q, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50",
                                                    "p75", "max")


# C24
def null_profile(df, cols=None, limit=0.05):
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    stack = "stack({}, {}) as (column, nulls)".format(
        len(cols), ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols)))
    out = wide.selectExpr("_rows", stack)
    ratio = F.try_divide(F.col("nulls").cast("double"), F.col("_rows"))
    return out.select("column", "nulls", ratio.alias("null_ratio"),
                      (F.coalesce(ratio, F.lit(0.0)) > limit).alias("over_limit"))


# C25
def cancellations_by(df, key="airline", outcome=("dep_time", "dep_delay", "arr_time", "arr_delay", "air_time")):
    cancelled = F.lit(True)
    for c in outcome:
        cancelled = cancelled & F.col(c).isNull()
    return (df.filter(cancelled).groupBy(key).agg(F.count(F.lit(1)).alias("cancelled"))
            .orderBy(F.col("cancelled").desc(), key))


# C26
def hourly(df, hour="hour", delay="dep_delay"):
    return (df.groupBy(hour).agg(F.count(F.lit(1)).alias("flight_count"),
                                 F.avg(delay).alias("avg_dep_delay")).orderBy(hour))


# C27
def daily_counts(df, keys=("airline", "date")):
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("daily_flight_count")).orderBy(*keys)


# C28
def routes_by_total_delay(df, key="route", col="dep_delay", k=5):
    totals = df.groupBy(key).agg(F.sum(col).alias("total_delay"))
    top = totals.orderBy(F.col("total_delay").desc_nulls_last(), key).limit(k).withColumn("side", F.lit("top"))
    bottom = totals.orderBy(F.col("total_delay").asc_nulls_last(), key).limit(k).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


# C29
def duplicate_profile(df, cols=None):
    """Every row that belongs to a group of identical rows (on ``cols``),
    with the group size. Aggregate + join, not a window: the aggregate is
    combined map-side, and AQE splits a hot key on the join."""
    cols = list(cols or df.columns)
    groups = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"))
              .filter(F.col("copies") > 1)
              .select(*[F.col(c).alias(f"_d{i}") for i, c in enumerate(cols)], "copies"))
    cond = [F.col(c).eqNullSafe(F.col(f"_d{i}")) for i, c in enumerate(cols)]
    return df.join(groups, cond, "inner").select(*df.columns, "copies")


# C30
def loss_report(before: DataFrame, after: DataFrame):
    b = before.agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.agg(F.count(F.lit(1)).alias("rows_after"))
    from skyframe.plans.combine import side_by_side
    out = side_by_side(b, a)
    return out.select("rows_before", "rows_after",
                      (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
                      F.try_divide((F.col("rows_before") - F.col("rows_after")) * 100.0,
                                   F.col("rows_before")).alias("percent_removed"))


# C31
def histogram(df, col, bins=10):
    """Equal-width bins over [min, max]; the last bin is closed (numpy)."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, count long")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    out = df.filter(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return out.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"), "count").orderBy("bin")


# C32
def box_stats(df, col, whisker=1.5):
    q = group_quantiles(df, [], col, [0.25, 0.5, 0.75]).first()
    q1, med, q3 = q["q_0"], q["q_1"], q["q_2"]
    iqr = q3 - q1
    lo_f, hi_f = q1 - whisker * iqr, q3 + whisker * iqr
    x = F.col(col)
    return df.filter(x.isNotNull()).agg(
        F.lit(q1).alias("q1"), F.lit(med).alias("median"), F.lit(q3).alias("q3"),
        F.lit(iqr).alias("iqr"),
        F.min(F.when(x >= lo_f, x)).alias("whisker_low"),
        F.max(F.when(x <= hi_f, x)).alias("whisker_high"),
        F.count_if((x < lo_f) | (x > hi_f)).alias("outliers"))


# C33
def kde(df, col, points=200, cut=3.0):
    """Gaussian kernel density on an even grid (Scott bandwidth, grid from
    min - cut*bw to max + cut*bw). Values are first reduced to value counts.

    A kernel term is exactly 0.0 in double precision beyond 40 bandwidths
    (exp(-800) underflows), so each value adds its terms only to the grid
    points within that reach, summed per point (at most ``points`` keys,
    combined map-side). The bandwidth shrinks as n^(-1/5), so on large
    inputs a value reaches a small share of the grid."""
    n, sd, lo, hi = df.agg(F.count(col), F.stddev_samp(col), F.min(col), F.max(col)).first()
    spark = df.sparkSession
    if not n or sd is None or sd == 0:
        return spark.createDataFrame([], "point int, x double, density double")
    bw = sd * n ** (-1.0 / 5.0)
    start, stop = lo - cut * bw, hi + cut * bw
    vc = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("w"))
    norm = 1.0 / (n * bw * math.sqrt(2 * math.pi))
    step = (stop - start) / (points - 1)
    reach = 40.0 * bw
    v = F.col(col)
    i0 = F.greatest(F.lit(0), F.ceil((v - reach - start) / step).cast("int"))
    i1 = F.least(F.lit(points - 1), F.floor((v + reach - start) / step).cast("int"))
    near = vc.select("w", col, F.explode(F.when(i0 <= i1, F.sequence(i0, i1))
                                         .otherwise(F.array().cast("array<int>"))).alias("point"))
    x = F.lit(start) + F.lit(stop - start) * F.col("point") / F.lit(points - 1)
    terms = near.select("point", (F.col("w") * F.exp(-0.5 * F.pow((v - x) / F.lit(bw), 2))).alias("t"))
    every = spark.range(points).select(F.col("id").cast("int").alias("point"), F.lit(0.0).alias("t"))
    return (terms.unionByName(every).groupBy("point").agg((F.sum("t") * norm).alias("density"))
            .select("point", x.alias("x"), "density"))


# C34
def correlation_matrix(df, cols):
    """Pearson correlation for every unordered pair (lower triangle), long,
    over the rows where both are present.

    One scan for the means and one for all pairs: each Arrow batch gives, by
    matrix products, the pair counts, sums, squares and cross products of
    the values around those means; Spark adds them up per pair."""
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    mean = np.array([0.0 if m is None else m for m in means])
    lower = np.tril_indices(len(cols), -1)
    names = ["n", "sa", "sb", "saa", "sbb", "sab"]

    def moments(batches):
        for batch in batches:
            x = np.stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns], 1)
            have = ~np.isnan(x)
            x, have = np.where(have, x - mean, 0.0), have.astype(float)
            sums = {"n": have.T @ have, "sa": x.T @ have, "saa": (x * x).T @ have, "sab": x.T @ x}
            sums |= {"sb": sums["sa"].T, "sbb": sums["saa"].T}
            yield pa.RecordBatch.from_arrays(
                [pa.array(lower[0], pa.int32()), pa.array(lower[1], pa.int32())] + [pa.array(sums[k][lower]) for k in names],
                names=["a", "b", *names])

    parts = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]).mapInArrow(
        moments, "a int, b int, " + ", ".join(f"{k} double" for k in names))
    s = parts.groupBy("a", "b").agg(*[F.sum(k).alias(k) for k in names])
    n, sa, sb, saa, sbb, sab = (F.col(k) for k in names)
    spread = F.sqrt((n * saa - sa * sa) * (n * sbb - sb * sb))
    labels = F.array(*[F.lit(c) for c in cols])
    return s.select(F.get(labels, F.col("a")).alias("feature_a"), F.get(labels, F.col("b")).alias("feature_b"),
                    F.try_divide(n * sab - sa * sb, spread).alias("corr"))


# C35
def correlated_with(df, cols, target, min_abs=0.03, exclude=()):
    others = [c for c in cols if c != target and c not in exclude]
    wide = df.agg(*[F.corr(c, target).alias(f"c{i}") for i, c in enumerate(others)])
    stack = "stack({}, {}) as (feature, corr)".format(
        len(others), ", ".join(f"'{c}', c{i}" for i, c in enumerate(others)))
    return wide.selectExpr(stack).filter(F.abs("corr") >= min_abs)


def redundant_pairs(df, cols, threshold=0.70):
    return correlation_matrix(df, cols).filter(F.abs("corr") > threshold)


# C36
def share_of_total(df, key="airline", col="distance", alias="distance_ratio_by_total"):
    total = scalar(df, F.sum(col))
    return (df.groupBy(key).agg(F.try_divide(F.sum(col), F.lit(total)).alias(alias))
            .orderBy(F.col(alias).desc_nulls_last(), key))


# C37
def live_board_stats(df, delay="dep_delay"):
    d = F.col(delay)
    return df.agg(F.count(F.lit(1)).alias("total"),
                  F.count_if(d.isNull()).alias("waiting"),
                  F.count_if(d.isNotNull()).alias("predicted"),
                  F.coalesce(F.round(F.avg(F.when(d > 0, d))), F.lit(0.0)).alias("avg_positive_delay"))


# C39
def mean_vector(df, cols):
    return df.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in cols])

