"""Drift test sets and live event envelopes (survey H12-H15, B23).

Noise is counter-based: a hash of the row's key, the seed and the column's
name gives uniform numbers, and their Box-Muller transform normal ones. The
same rows get the same noise in any partitioning, retry or engine, and two
columns that share a shift simply name the same one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.functions.columns import clip, normalise_name
from skyframe.operators import sampling as S

# The published airline mix multipliers of the drift set.
AIRLINE_MULTIPLIERS = {"united_air_lines_inc": 1.25, "alaska_airlines_inc": 0.75,
                       "american_airlines_inc": 1.15, "delta_air_lines_inc": 0.85,
                       "southwest_airlines_co": 1.20}


def uniform(key_cols, seed: int, name: str) -> Column:
    """A number in [0, 1) that depends on the row's key, the seed and the name only."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(name), *[F.col(c).cast("string") for c in key_cols])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def normal(key_cols, seed: int, name: str, mu: float, sigma: float) -> Column:
    """N(mu, sigma) by the Box-Muller transform of two such numbers."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - uniform(key_cols, seed, name + ":r")))
    return F.lit(mu) + F.lit(sigma) * radius * F.cos(F.lit(2 * math.pi) * uniform(key_cols, seed, name + ":a"))


# H12
def shift_normal(df: DataFrame, col: str, mu: float, sigma: float, seed: int, key_cols, also=None,
                 share: float = 0.7) -> DataFrame:
    """``col + N(mu, sigma)``; ``also`` gets ``share`` of the same shift."""
    s = normal(key_cols, seed, col, mu, sigma)
    out = {col: F.col(col) + s}
    if also and also in df.columns:
        out[also] = F.col(also) + s * share
    return df.withColumns(out)


# H13
def scale_normal(df: DataFrame, col: str, mu: float, sigma: float, seed: int, key_cols, lo=None, hi=None,
                 also=None, power: float = 0.8) -> DataFrame:
    """``col * N(mu, sigma)`` clipped to [lo, hi]; ``also`` is scaled by the
    factor to ``power`` (a factor below zero counts as zero there)."""
    f = normal(key_cols, seed, col, mu, sigma)
    out = {col: clip(F.col(col) * f, lo, hi)}
    if also and also in df.columns:
        out[also] = F.col(also) * F.pow(F.greatest(f, F.lit(0.0)), power)
    return df.withColumns(out)


# H14
def jitter_hours(df: DataFrame, seed: int, key_cols, p: float = 0.15, shifts=(-2, -1, 1, 2), minutes=(0, 15, 30, 45),
                 hour: str = "hour", minute: str = "minute") -> DataFrame:
    """With probability ``p`` shift the hour (clipped 0..23) and draw a new
    minute from a fixed set."""
    def pick(values, name):
        return F.get(F.array(*[F.lit(x) for x in values]),
                     F.floor(uniform(key_cols, seed, name) * len(values)).cast("int"))

    hit = uniform(key_cols, seed, "jitter") < p
    moved = F.greatest(F.lit(0), F.least(F.lit(23), F.col(hour) + pick(shifts, "shift")))
    return df.withColumns({hour: F.when(hit, moved).otherwise(F.col(hour)),
                           minute: F.when(hit, pick(minutes, "minute")).otherwise(F.col(minute))})


# H15
def make_drift_set(df: DataFrame, key_cols, seed: int = 42, multipliers=AIRLINE_MULTIPLIERS,
                   target: str = "dep_delay") -> DataFrame:
    """20 % sample, target dropped, airline mix shifted, rows shuffled, then
    weather, distance and clock drift."""
    x = S.sample_n(df, key_cols, 0.2, seed).drop(target)
    x = x.withColumn("_airline_key", normalise_name("airline"))
    x = S.resample_groups(x, "_airline_key", multipliers, key_cols, seed).drop("_airline_key")
    at = [*key_cols, "copy"]
    x = shift_normal(x, "temp", 5.0, 2.0, seed, at, also="dewp")
    x = scale_normal(x, "humid", 1.12, 0.03, seed, at, 0.0, 100.0)
    x = scale_normal(x, "wind_speed", 1.18, 0.05, seed, at)
    x = scale_normal(x, "distance", 1.12, 0.08, seed, at, also="air_time")
    x = jitter_hours(x, seed, at)
    return shift_normal(x, "pressure", -2.5, 1.5, seed, at)


# B23
def event_envelope(df: DataFrame, now_epoch: int | None = None, ttl_s: int = 3600, key_cols=None,
                   target: str = "dep_delay") -> DataFrame:
    """Live event fields: id (random, or a hash of ``key_cols`` for
    repeatable runs), send time, constant type, expiry and a null target."""
    now = F.unix_timestamp() if now_epoch is None else F.lit(now_epoch).cast("long")
    ident = (F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols]), 256) if key_cols
             else F.expr("uuid()"))
    return df.withColumns({"id": ident, "timestamp": now, "data_type": F.lit("FLIGHTS"),
                           "expiry_time": now + ttl_s, target: F.lit(None).cast("double")})
