"""Fixed-window rate limit without a per-key sequential task (survey M11).

Rule per key: a window opens at the first request (or at a given start,
the login) and reopens at the first request at least ``window_s`` after the
current window's start; inside a window the first ``limit`` requests pass,
later ones are refused (refused requests still belong to the window, they
just do not count).

The window starts form a chain: ``s0`` = the key's start, ``s(k+1) =
next(s(k))`` with ``next(r)`` = first request at or after ``t(r) + window``.
A single key holding a third of all requests must not be folded in one
task, so the chain is computed with joins on the requests' positions:

1. every request gets its position in the order (key, time, id) by the
   distributed rank; ids may be of any type and may repeat;
2. ``next`` for every request by a backward fill over the union of the
   requests and their probe times ``t + window`` (range-bucketed, so skew
   in the key does not matter);
3. pointer doubling ``J(k+1) = J(k)(J(k))`` (one join per level, over rows
   that still have a pointer only);
4. the chain from each key's start by doubling its reachable set
   (``O(k+1) = O(k) + J(k)(O(k))``), ``log2`` of the chain length rounds;
5. each request's window start by a forward fill over the key's order and
   its position in the window by the distributed rank.

Every intermediate is written to the shared checkpoint folder, so the
lineage of the rounds stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.plans import ordered
from skyframe.session import scratch_path


def _persist(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def next_pointers(x: DataFrame, window: int) -> DataFrame:
    """(at, nxt) for requests (k, t, at): the position of the first request
    of the same key at or after ``t + window``, where there is one."""
    data = x.select("k", "t", "at", F.lit(0).alias("kind"))
    probe = x.select("k", (F.col("t") + window).alias("t"), "at", F.lit(1).alias("kind"))
    u = data.unionByName(probe).withColumns({
        "neg_t": -F.col("t"), "neg_at": -F.col("at"),
        "cand": F.when(F.col("kind") == 0, F.struct(F.col("k").alias("ck"), F.col("at").alias("cid")))})
    # descending time: data at the same instant comes before the probe, so
    # "last candidate before" = "first request at or after" in time order
    filled = ordered.forward_fill(u, ["cand"], ["k", "neg_t", "kind", "neg_at"], tie=[])
    return filled.filter((F.col("kind") == 1) & F.col("cand.ck").eqNullSafe(F.col("k"))).select(
        "at", F.col("cand.cid").alias("nxt"))


def window_starts(x: DataFrame, window: int) -> DataFrame:
    """(at) of every request (k, t, at) that opens a window."""
    levels = [_persist(next_pointers(x, window), "rl-next")]
    while not levels[-1].isEmpty():
        p = levels[-1]
        q = p.select(F.col("at").alias("mid"), F.col("nxt").alias("nxt2"))
        levels.append(_persist(p.join(q, F.col("nxt") == F.col("mid")).select("at", F.col("nxt2").alias("nxt")), "rl-jump"))
    reach = _persist(x.groupBy("k").agg(F.min("at").alias("at")).select("at"), "rl-reach")
    for p in levels:
        reach = _persist(reach.unionByName(reach.join(p, "at").select(F.col("nxt").alias("at"))).distinct(), "rl-reach")
    return reach


def rate_limit(df: DataFrame, key: str = "user_id", ts: str = "ts", rid: str = "event_id", limit: int = 20,
               window_s: float = 60, num_buckets: int | None = None, starts: DataFrame | None = None) -> DataFrame:
    """``df`` plus ``accepted``. ``rid`` orders requests of the same instant.
    ``starts`` (the key and ``start``, an epoch second) opens a key's first
    window at its login; keys without one start at their first request."""
    x = df.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp"))).withColumn("_login", F.lit(0))
    if starts is not None:
        login = starts.select(F.col(key), (F.col("start") * 1_000_000).cast("long").alias("_t"), F.lit(-1).alias("_login"))
        x = x.unionByName(login, allowMissingColumns=True)
    x = _persist(ordered.with_rank(x, [key, "_t", "_login", rid], tie=None, num_buckets=num_buckets, rank_col="_at",
                                   size_col=None), "rl-order")
    opened = window_starts(x.select(F.col(key).alias("k"), F.col("_t").alias("t"), F.col("_at").alias("at")),
                           int(round(window_s * 1_000_000)))
    y = x.join(opened.select(F.col("at").alias("_sid")), F.col("_at") == F.col("_sid"), "left").withColumnRenamed(
        "_sid", "_wstart")
    y = _persist(y, "rl-opened")
    y = ordered.forward_fill(y, ["_wstart"], ["_at"], tie=[], num_buckets=num_buckets).filter("_login = 0")
    y = _persist(y, "rl-windows")
    r = ordered.with_rank(y, ["_at"], group=["_wstart"], tie=[], num_buckets=num_buckets, rank_col="_pos", size_col=None)
    return r.select(*df.columns, (F.col("_pos") <= limit).alias("accepted"))
