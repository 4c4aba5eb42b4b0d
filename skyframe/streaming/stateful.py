"""Streaming forms with keyed state: change events (M4), alarms (M10), the
live board (M7) and expiry (M5).

State is small and per key: whether a record has a prediction, the last
breach flags, or one visible flight. Event-time timers take a key's state
away when it expires or leaves the board, so state holds live keys only.
Rows of one micro-batch are put in order first, so the results do not depend
on how the input is cut into batches, as long as a key's rows arrive in
order; a restart goes on from the checkpoint.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from skyframe.plans import ordered
from skyframe.session import written

#: The state store that arbitrary state behind an aggregate needs.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _ordered(pdfs, by) -> pd.DataFrame:
    return pd.concat(list(pdfs)).sort_values(list(by), kind="mergesort", na_position="first")


def _millis(stamps: pd.Series) -> int:
    return int(stamps.max().timestamp() * 1000)


# M4, batch
def change_log_events(log: DataFrame, key, target: str = "dep_delay", order: str = "timestamp") -> DataFrame:
    """Events of a log of record images: NEW_FLIGHT at a key's first image,
    DELAY_PREDICTED where the target goes from null to a number. Images are
    numbered by the distributed rank and each joined with the one before, so
    a key may hold any share of the log."""
    key = list(key)
    images = written(ordered.with_rank(log, [order], group=key, tie=[target], rank_col="_pos", size_col=None), "images")
    before = images.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], (F.col("_pos") + 1).alias("_next"),
                           F.col(target).isNotNull().alias("_had"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)] + [F.col("_pos") == F.col("_next")]
    predicted = ~F.coalesce("_had", F.lit(False)) & F.col(target).isNotNull()
    event = F.when(F.col("_pos") == 1, "NEW_FLIGHT").when(predicted, "DELAY_PREDICTED")
    return images.join(before, same, "left").withColumn("event", event).filter("event is not null").select(*log.columns, "event")


# M4 + M5
def change_events_stream(stream: DataFrame, key, target: str = "dep_delay", order: str = "timestamp",
                         ttl_s: int | None = None, watermark: str = "10 minutes") -> DataFrame:
    """``change_log_events`` of a stream of record images; state holds, per
    key, whether the last image had a target. With ``ttl_s`` (``order`` is
    then a timestamp) a key's state is dropped when the watermark passes its
    last image by that many seconds; an image that comes later is new."""
    out = T.StructType([*stream.schema.fields, T.StructField("event", T.StringType())])
    state_type = T.StructType([T.StructField("had", T.BooleanType())])
    if ttl_s:
        stream = stream.withWatermark(order, watermark)

    def step(k, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        seen, had = state.exists, state.exists and state.get[0]
        pdf, events = _ordered(pdfs, [order, target]), []
        for has in pdf[target].notna().tolist():
            events.append("NEW_FLIGHT" if not seen else "DELAY_PREDICTED" if has and not had else None)
            seen, had = True, has
        state.update((bool(had),))
        if ttl_s:
            state.setTimeoutTimestamp(max(_millis(pdf[order]) + ttl_s * 1000, state.getCurrentWatermarkMs() + 1))
        pdf = pdf.assign(event=events)
        yield pdf[pdf["event"].notna()]

    return stream.groupBy(*key).applyInPandasWithState(
        step, out, state_type, "append", GroupStateTimeout.EventTimeTimeout if ttl_s else GroupStateTimeout.NoTimeout)


# M10
def breach_alarm_stream(windows: DataFrame, metric: str, op: str, threshold: float, periods: int,
                        order: str = "window_start", keys=()) -> DataFrame:
    """``live.breach_alarm`` behind a watermarked window aggregate: closed
    windows arrive in order, state holds a key's last ``periods - 1`` flags.
    As in the batch form a window follows the last one that exists: a gap
    without events neither breaches nor ends a run."""
    ops = {">": F.col(metric) > threshold, ">=": F.col(metric) >= threshold, "<": F.col(metric) < threshold,
           "<=": F.col(metric) <= threshold}
    flagged = windows.withColumn("breach", ops[op].cast("int"))
    out = T.StructType([*flagged.schema.fields, T.StructField("state", T.StringType())])
    # without key columns all windows have one key; they are few: one a period
    flagged = flagged if keys else flagged.withColumn("_all", F.lit(0))
    windows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return flagged.groupBy(*(keys or ["_all"])).transformWithStateInPandas(
        _Run(periods, order, [f.name for f in out.fields[:-1]]), out, "Append", "None")


class _Run(StatefulProcessor):
    """The last breach flags of a key."""

    def __init__(self, periods: int, order: str, names: list[str]):
        self.periods, self.order, self.names = periods, order, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.flags = handle.getValueState("flags", "flags array<int>")

    def handleInputRows(self, key, rows, timerValues):
        flags, states = list(self.flags.get()[0]) if self.flags.exists() else [], []
        pdf = _ordered(rows, [self.order])
        for flag in pdf["breach"].tolist():
            flags = [*flags, 1 if flag == 1 else 0][-self.periods:]
            states.append("ALARM" if len(flags) == self.periods and all(flags) else "OK")
        self.flags.update((flags,))
        yield pdf[self.names].assign(state=states)

    def close(self) -> None:
        pass


# M7
def board_changes_stream(stream: DataFrame, key: str = "id", at: str = "at", predicted: str = "predicted",
                         linger_s: int = 3, watermark: str = "0 seconds") -> DataFrame:
    """(key, arrived, change, instant) of a stream of sightings of flights
    (``at`` a timestamp; ``predicted`` whether the record has a prediction):
    ENTER at a flight's first sighting, LEAVE ``linger_s`` seconds after its
    first prediction, by an event-time timer. State is one row per flight
    that is on; a flight that has left and is sighted again enters again."""
    out = T.StructType([stream.schema[key], T.StructField("arrived", T.TimestampType()),
                        T.StructField("change", T.StringType()), T.StructField("instant", T.TimestampType())])
    state_type = T.StructType([T.StructField("arrived", T.LongType()), T.StructField("leaves", T.LongType())])

    def row(k, arrived, change, instant):
        return pd.DataFrame({key: [k[0]], "arrived": [pd.Timestamp(arrived, unit="ms")], "change": [change],
                             "instant": [pd.Timestamp(instant, unit="ms")]})

    def step(k, pdfs, state):
        if state.hasTimedOut:
            arrived, leaves = state.get
            state.remove()
            yield row(k, arrived, "LEAVE", leaves)
            return
        arrived, leaves = state.get if state.exists else (-1, -1)
        pdf = _ordered(pdfs, [at])
        for stamp, has in zip(pdf[at], pdf[predicted]):
            now = int(stamp.timestamp() * 1000)
            if 0 <= leaves <= now:
                yield row(k, arrived, "LEAVE", leaves)
                arrived, leaves = -1, -1
            if arrived < 0:
                arrived = now
                yield row(k, arrived, "ENTER", now)
            if has and leaves < 0:
                leaves = now + linger_s * 1000
        state.update((arrived, leaves))
        if leaves >= 0:
            state.setTimeoutTimestamp(max(leaves, state.getCurrentWatermarkMs() + 1))

    return stream.withWatermark(at, watermark).groupBy(key).applyInPandasWithState(
        step, out, state_type, "append", GroupStateTimeout.EventTimeTimeout)


def board_at(changes: DataFrame, instant, n: int = 12, key: str = "id") -> DataFrame:
    """The board at one instant: flights that had entered and not left, the
    newest ``n``. A bounded top-n over one row per flight."""
    last = changes.filter(F.col("instant") <= F.lit(instant)).groupBy(key).agg(
        F.max_by(F.struct("change", "arrived"), F.struct("instant", F.col("change") == "ENTER")).alias("l"))
    on = last.filter(F.col("l.change") == "ENTER").select(key, F.col("l.arrived").alias("arrived"))
    return on.orderBy(F.col("arrived").desc(), key).limit(n)
