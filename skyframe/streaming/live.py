"""Live operators (survey M1-M14) in two forms: a batch twin over a table
and the Structured Streaming query over a file stream. Each batch twin is
exactly what one micro-batch (or the stream's final state) computes.

Event stamps in the driver files are ``TIMESTAMP_NTZ``; watermarks need
``TIMESTAMP``, so ``as_event_time`` casts under the UTC session zone.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


# M8 + M9
def metric_windows(df: DataFrame, ts: str = "ts", every: str = "1 minute", value: str = "value",
                   error_col: str = "event_type", error_value: str = "error", watermark: str | None = None) -> DataFrame:
    """Tumbling windows: count, sum / avg / max of ``value``, and the error
    ratio in percent. With ``watermark`` this is the streaming form
    (append mode emits each window once the watermark passes it)."""
    if watermark:
        df = df.withWatermark(ts, watermark)
    err = F.when(F.col(error_col) == error_value, 1).otherwise(0)
    return (df.groupBy(F.window(ts, every).alias("w"))
            .agg(F.count(F.lit(1)).alias("events"), F.sum(value).alias("value_sum"), F.avg(value).alias("value_avg"),
                 F.max(value).alias("value_max"), F.sum(err).alias("errors"))
            .select(F.col("w.start").alias("window_start"), "events", "value_sum", "value_avg", "value_max", "errors",
                    F.try_divide(F.col("errors") * 100.0, F.col("events")).alias("error_pct")))


# M9
def metric_ratio(metrics: DataFrame, above, below: str, alias: str, scale: float = 100.0) -> DataFrame:
    """``scale`` times the sum of the metrics ``above`` over ``below``:
    m1 / m2 with one name, (m1 + m2) / m3 with two; null over zero."""
    total = sum((F.col(c) for c in ([above] if isinstance(above, str) else above)), F.lit(0))
    return metrics.withColumn(alias, F.try_divide(total * F.lit(scale), F.col(below)))


# M10
def breach_alarm(metrics: DataFrame, metric: str, op: str, threshold: float, periods: int,
                 order: str = "window_start", keys=(), num_buckets: int | None = None) -> DataFrame:
    """ALARM on a window when it and the ``periods - 1`` windows before it
    (per key, in ``order``) all breach.

    Windows are numbered with the distributed rank of ``plans.ordered``;
    each window then adds its breach flag to the ``periods`` positions
    whose run it belongs to, and one aggregate keyed by (key, position)
    counts the run. Position keys are unique, so no task holds a whole
    key or the whole table, however long the time span."""
    from skyframe.plans import ordered
    from skyframe.session import written
    ops = {">": F.col(metric) > threshold, ">=": F.col(metric) >= threshold, "<": F.col(metric) < threshold,
           "<=": F.col(metric) <= threshold}
    keys = list(keys)
    b = metrics.withColumn("breach", ops[op].cast("int"))
    r = ordered.with_rank(written(b, "metric-windows"), [order], group=keys, num_buckets=num_buckets, rank_col="_pos", size_col=None)
    runs = (r.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "breach",
                     F.explode(F.sequence(F.col("_pos"), F.col("_pos") + (periods - 1))).alias("_end"))
            .groupBy(*[f"_k{i}" for i in range(len(keys))], "_end")
            .agg(F.count(F.lit(1)).alias("_n"), F.min("breach").alias("_min")))
    cond = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_pos") == F.col("_end")]
    full = (F.col("_n") == periods) & (F.col("_min") == 1)
    return (r.join(runs, cond, "left")
            .select(*b.columns, F.when(full, "ALARM").otherwise("OK").alias("state")))


# M11 (one session's fold; used by the batch and the streaming form)
def _rate_fold(times, window_s: float, limit: int, state=None):
    start, count = state if state else (None, 0)
    out = []
    for t in times:
        if start is None or t >= start + window_s:
            start, count = t, 0
        ok = count < limit
        if ok:
            count += 1
        out.append(ok)
    return out, (start, count)


def rate_limit(df: DataFrame, key: str = "user_id", ts: str = "ts", limit: int = 20, window_s: int = 60,
               rid: str = "event_id", method: str = "chain", starts: DataFrame | None = None) -> DataFrame:
    """Per key: a window opens at the first request and reopens at the first
    request at least ``window_s`` later; inside a window the first
    ``limit`` requests pass, later ones are refused and not counted.

    ``method="chain"`` (default) computes the window chain with id-keyed
    joins and distributed ranks (``streaming.ratelimit``), so one key may
    hold any share of the requests. ``method="fold"`` runs the sequential
    rule per key in ``applyInPandas`` (one key's rows in one task; for
    small inputs)."""
    if method == "chain":
        from skyframe.streaming.ratelimit import rate_limit as chain
        return chain(df, key, ts, rid, limit, window_s, starts=starts)
    schema = T.StructType(df.schema.fields + [T.StructField("accepted", T.BooleanType())])

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([ts] + [c for c in pdf.columns if c != ts], kind="mergesort")
        secs = pdf[ts].astype("datetime64[us]").astype("int64") / 1e6
        ok, _ = _rate_fold(secs.tolist(), window_s, limit)
        return pdf.assign(accepted=ok)

    return df.groupBy(key).applyInPandas(fold, schema)


def rate_limit_stream(stream: DataFrame, key: str = "user_id", ts: str = "ts", limit: int = 20,
                      window_s: int = 60, ttl_s: int | None = None) -> DataFrame:
    """Streaming form: keyed state (window start, count) per key, updated by
    each micro-batch's requests in time order, however they are chunked
    (``applyInPandasWithState``; it holds one key's requests of one
    micro-batch). With ``ttl_s`` (3,600 s for a session) a key's state is
    dropped that many seconds after its last micro-batch; Spark then runs
    batches without data for as long as the query is up, so it is for
    queries that stay up, not for ``availableNow``."""
    from pyspark.sql.streaming.state import GroupStateTimeout
    out_schema = T.StructType(stream.schema.fields + [T.StructField("accepted", T.BooleanType())])
    state_schema = T.StructType([T.StructField("start", T.DoubleType()), T.StructField("count", T.LongType())])

    def step(k, pdfs, state):
        if ttl_s and state.hasTimedOut:
            state.remove()
            return
        prev = state.get if state.exists else None
        st = (prev[0], int(prev[1])) if prev else None
        pdf = pd.concat(list(pdfs))
        pdf = pdf.sort_values([ts] + [c for c in pdf.columns if c != ts], kind="mergesort")
        secs = pdf[ts].astype("datetime64[us]").astype("int64") / 1e6
        ok, st = _rate_fold(secs.tolist(), window_s, limit, st)
        state.update((float(st[0]), int(st[1])))
        if ttl_s:
            state.setTimeoutDuration(ttl_s * 1000)
        yield pdf.assign(accepted=ok)

    return stream.groupBy(key).applyInPandasWithState(step, out_schema, state_schema, "append",
                                                      GroupStateTimeout.ProcessingTimeTimeout if ttl_s
                                                      else GroupStateTimeout.NoTimeout)


# M12
def session_spans(df: DataFrame, key: str = "user_id", ts: str = "ts", gap: str = "1 hour", ttl_s: int = 3600,
                  watermark: str | None = None, tie=None, num_buckets: int | None = None) -> DataFrame:
    """Gap sessions per key: start, last activity, requests, expiry = last +
    ttl. A new session starts when the gap to the previous event of the key
    is at least ``gap``.

    Streaming (``watermark`` given): Spark's ``session_window``. Batch: the
    range-bucket pattern, so one key with a third of all events is still
    spread over many tasks: per (key, bucket) the last stamp and the number
    of session starts are summarised, carried forward over the small
    summary table, and sessions are aggregated with map-side combining."""
    if watermark:
        s = df.withWatermark(ts, watermark).groupBy(key, F.session_window(ts, gap).alias("s")).agg(
            F.min(ts).alias("start"), F.max(ts).alias("last_active"), F.count(F.lit(1)).alias("requests"))
        return s.select(key, "start", "last_active", "requests",
                        (F.unix_timestamp("last_active") + ttl_s).alias("expiry_time"))
    from skyframe.plans import ordered
    from skyframe.session import written
    gap_s = F.expr(f"INTERVAL {gap}")
    tie = list(tie) if tie is not None else [c for c in df.columns if c not in (key, ts)]
    keys = ordered.total_order(df, [key, ts], tie)
    B = ordered.BUCKET
    x = ordered.range_buckets(written(df.select(*keys), "session-keys"), keys, num_buckets)
    w = Window.partitionBy(key, B).orderBy(*[F.col(k) for k in keys[1:]])
    per = x.groupBy(key, B).agg(F.max(ts).alias("_last"))
    before = Window.partitionBy(key).orderBy(B).rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select(key, B, F.max("_last").over(before).alias("_prev_last"))
    y = x.join(carry, [key, B]).withColumn("_prev", F.coalesce(F.lag(ts).over(w), F.col("_prev_last")))
    y = y.withColumn("_brk", F.when(F.col("_prev").isNull() | (F.col(ts) >= F.col("_prev") + gap_s), 1).otherwise(0))
    starts = y.groupBy(key, B).agg(F.sum("_brk").alias("_n"))
    offs = starts.select(key, B, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    run = Window.partitionBy(key, B).orderBy(*[F.col(k) for k in keys[1:]]).rowsBetween(Window.unboundedPreceding, 0)
    z = y.join(offs, [key, B]).withColumn("_sid", F.sum("_brk").over(run) + F.col("_off"))
    s = z.groupBy(key, "_sid").agg(F.min(ts).alias("start"), F.max(ts).alias("last_active"),
                                   F.count(F.lit(1)).alias("requests"))
    return s.select(key, "start", "last_active", "requests",
                    (F.unix_timestamp("last_active") + ttl_s).alias("expiry_time"))


# M4
def change_events(old: DataFrame, new: DataFrame, key, target: str = "dep_delay",
                  compat_any_numeric: bool = False) -> DataFrame:
    """NEW_FLIGHT for keys absent from ``old``; DELAY_PREDICTED when the
    target goes from null to a number (or, compatibly, whenever the new
    value is a number)."""
    key = list(key)
    o = old.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(key)], F.col(target).alias("_old"),
                   F.lit(True).alias("_seen"))
    cond = [F.col(k).eqNullSafe(F.col(f"_o{i}")) for i, k in enumerate(key)]
    j = new.join(o, cond, "left")
    predicted = (F.col(target).isNotNull() if compat_any_numeric
                 else F.col("_old").isNull() & F.col(target).isNotNull())
    ev = (F.when(F.col("_seen").isNull(), "NEW_FLIGHT").when(predicted, "DELAY_PREDICTED"))
    return j.withColumn("event", ev).filter(F.col("event").isNotNull()).select(*new.columns, "event")


# M5
def expire(df: DataFrame, now_epoch: int, expiry: str = "expiry_time") -> DataFrame:
    return df.filter(F.col(expiry) > now_epoch)


# M6
def dedupe_stream(df: DataFrame, key, ts: str = "ts", watermark: str | None = None) -> DataFrame:
    """Drop repeated ids; streaming form keeps state only within the watermark."""
    key = [key] if isinstance(key, str) else list(key)
    if watermark:
        return df.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(key)
    from skyframe.plans.ordered import total_order
    # on equal stamps the smallest row, so a recomputation keeps the same one
    first = df.groupBy(*key).agg(F.min_by(F.struct(*df.columns), F.struct(*total_order(df, [ts]))).alias("_r"))
    return first.select("_r.*")


def one_per_key(df: DataFrame, keys) -> DataFrame:
    """The smallest row (all orderable columns, in their order) of every key:
    which of several rows of a key is taken never depends on their order."""
    from skyframe.plans.ordered import total_order
    keys, order = list(keys), total_order(df, [])
    # a row whose columns all have an order is moved once, not beside its own order
    smallest = F.min(F.struct(*df.columns)) if order == df.columns else F.min_by(F.struct(*df.columns), F.struct(*order))
    first = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(smallest.alias("_r"))
    return first.select("_r.*")


# M7
def live_board(df: DataFrame, as_of_epoch: int, key: str = "id", arrived: str = "arrived",
               predicted_at: str = "predicted_at", n: int = 12, linger_s: int = 3) -> DataFrame:
    """The board at one instant: ids arrived by then, minus those whose
    prediction is older than ``linger_s``; newest ``n`` (first seen wins;
    among rows tied at an id's first arrival, the earliest prediction).

    Only (id, first arrival, its prediction stamp) is shuffled; the filter
    and a bounded top-n pick the ids, and their rows are fetched by a
    semi-join with those n keys (broadcast, n rows by construction)."""
    seen = df.filter(F.col(arrived) <= as_of_epoch)
    firsts = (seen.groupBy(key).agg(F.min(F.struct(F.col(arrived).alias("a"), F.col(predicted_at).alias("p")))
                                    .alias("_f"))
              .select(F.col(key).alias("_k"), F.col("_f.a").alias("_a"), F.col("_f.p").alias("_p")))
    on = firsts.filter(F.col("_p").isNull() | (F.col("_p") > as_of_epoch) | (F.col("_p") + linger_s > as_of_epoch))
    top = on.orderBy(F.col("_a").desc(), F.col("_k")).limit(n)
    cond = (F.col(key).eqNullSafe(F.col("_k")) & (F.col(arrived) == F.col("_a"))
            & F.col(predicted_at).eqNullSafe(F.col("_p")))
    rows = seen.join(F.broadcast(top), cond, "left_semi")
    from skyframe.plans.ordered import total_order
    one = rows.groupBy(key).agg(F.min_by(F.struct(*df.columns), F.struct(*total_order(df, [arrived]))).alias("_r"))
    one = one.select("_r.*")
    return one.orderBy(F.col(arrived).desc(), F.col(key)).limit(n)


# M14
def source_lag(df: DataFrame, ts: str = "ts", now=None) -> DataFrame:
    now_c = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return df.agg((F.unix_timestamp(now_c) - F.unix_timestamp(F.max(ts))).alias("lag_seconds"))


# M3
def upsert_batch(updates: DataFrame, table_path: str, keys, cols, part: str, one_per: bool = False) -> None:
    """Set ``cols`` of a micro-batch's records on the rows of a Parquet table
    with the same ``keys``, and add records the table does not hold.

    The table is partitioned by ``part``, a column that the key decides (a
    record's day): only the partitions of the batch are read, staged and
    overwritten. Setting the same values again changes nothing, so a batch
    that is replayed after a crash leaves the table as it was. Of several
    records with the same key in one micro-batch the smallest counts; with
    ``one_per`` the caller has seen to that. A partition is written by as
    many tasks as its rows are worth, dealt by the hash of the key."""
    from skyframe.session import scratch_path, written
    from skyframe.sources.files import path_exists

    spark = updates.sparkSession
    stage = scratch_path(spark, "upsert")
    updates = written(updates if one_per else one_per_key(updates, keys), "updates")
    if path_exists(spark, table_path):
        touched = updates.select(F.col(part).alias("_part")).distinct()     # the days of one micro-batch
        target = spark.read.schema(updates.schema).parquet(table_path)
        old = target.join(F.broadcast(touched), F.col(part).eqNullSafe(F.col("_part")), "left_semi")
        known = old.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(old.columns)])
        at = {c: F.col(f"_o{i}") for i, c in enumerate(old.columns)}
        # one join sets the columns of known records (of a null first key none, as in upsert_by_key) and brings new ones
        joined = known.join(updates.withColumn("_set", F.lit(True)), [at[k].eqNullSafe(F.col(k)) for k in keys], "full_outer")
        absent = F.lit(True)
        for c in updates.columns:
            if c not in (*keys, *cols):
                absent = absent & at[c].isNull()
        joined.select(*[(F.coalesce(at[c], F.col(c)) if c in keys else F.when(F.col("_set") & F.col(keys[0]).isNotNull(), F.col(c)).otherwise(at[c])
                         if c in cols else F.when(absent, F.col(c)).otherwise(at[c])).alias(c)
                        for c in updates.columns]).write.parquet(stage)
        staged = spark.read.schema(updates.schema).parquet(stage)
    else:
        staged = updates
    (staged.repartitionByRange(F.col(part), F.xxhash64(*keys)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(table_path))


# M1 + M2 + M3 (the streaming pipeline)
def scoring_stream(events: DataFrame, model, reference_aggs: DataFrame | None, out_path: str, checkpoint: str,
                   keys, prediction: str = "dep_delay", part: str = "date"):
    """Streaming features (stream-static join with training aggregates),
    scoring of whole records (every field is kept, the prediction is put
    into it), and an upsert of each micro-batch into the table at
    ``out_path`` by ``keys`` (see ``upsert_batch``)."""
    from skyframe.operators.features import group_aggregates, serving_features
    from skyframe.session import scratch_path, scratch_scope

    aggs = None
    if reference_aggs is not None:
        # the training aggregates are computed once per model and written to
        # the shared folder; every micro-batch joins the small tables
        spark = reference_aggs.sparkSession
        paths = [scratch_path(spark, "ref-airline"), scratch_path(spark, "ref-daily")]
        for t, p in zip(group_aggregates(reference_aggs), paths):
            t.write.parquet(p)
        aggs = tuple(spark.read.parquet(p) for p in paths)

    def per_batch(batch: DataFrame, batch_id: int):
        with scratch_scope(batch.sparkSession):
            score_and_set(one_per_key(batch, keys))

    def score_and_set(batch: DataFrame):
        # the whole record goes with its features, so no join puts them together again
        feats = serving_features(batch.withColumn("_rec", F.struct(*batch.columns)), aggregates=aggs, passthrough=["_rec"])
        value = F.round("prediction", 2)
        records = model.transform(feats).select(*[(value if c == prediction else F.col("_rec").getField(c)).alias(c)
                                                  for c in batch.columns])
        upsert_batch(records, out_path, keys, [prediction], part, one_per=True)

    return (events.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
