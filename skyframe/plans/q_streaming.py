"""Registered live / streaming queries (M) as batch twins over ``events``
and the flight table; the streaming forms are exercised in tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyframe.plans.flights import ROW_KEYS
from skyframe.plans.output import present
from skyframe.plans.q_flights import raw
from skyframe.plans.registry import query, with_flights
from skyframe.session import ensure_session_conf, scratch_path
from skyframe.streaming import live as L
from skyframe.streaming import stateful as ST
from skyframe.tables import table


def events(spark, sf_dir):
    ensure_session_conf(spark)
    return L.as_event_time(table(spark, sf_dir, "events"))


@query("metric_windows_1m", """
SELECT CAST(time_bucket(INTERVAL 1 minute, ts) AS VARCHAR) AS window_start, count(*) AS events,
       round(sum(value), 6) AS value_sum, round(avg(value), 6) AS value_avg, round(max(value), 6) AS value_max,
       CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS errors,
       round(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) * 100.0 / count(*), 6) AS error_pct,
       round((sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) + max(value)) / sum(value), 6) AS load_ratio
FROM events GROUP BY 1""")
def q_metric_windows(spark, sf_dir):
    """M8 + M9: one-minute tumbling metrics, the error ratio m1 / m2 and a
    ratio (m1 + m2) / m3."""
    m = L.metric_windows(events(spark, sf_dir), every="1 minute")
    return present(L.metric_ratio(m, ["errors", "value_max"], "value_sum", "load_ratio", 1.0))


_W5 = """WITH m AS (SELECT time_bucket(INTERVAL 5 minute, ts) AS ws, count(*) AS events,
       sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) * 100.0 / count(*) AS error_pct FROM events GROUP BY 1),
b AS (SELECT *, CASE WHEN error_pct > 30.0 THEN 1 ELSE 0 END AS breach FROM m)"""


@query("error_alarm_5m", _W5 + """
SELECT CAST(ws AS VARCHAR) AS window_start, events, round(error_pct, 6) AS error_pct, breach,
       CASE WHEN count(*) OVER w = 2 AND min(breach) OVER w = 1 THEN 'ALARM' ELSE 'OK' END AS state
FROM b WINDOW w AS (ORDER BY ws ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)""")
def q_alarm(spark, sf_dir):
    """Error share above 30 % for 2 consecutive five-minute windows."""
    m = L.metric_windows(events(spark, sf_dir), every="5 minutes").select("window_start", "events", "error_pct")
    return present(L.breach_alarm(m, "error_pct", ">", 30.0, 2))


def _streamed(spark, df, name, build):
    """The rows of a stream over ``df``, written in chunks of ascending time, run to its end."""
    src, out = scratch_path(spark, name), scratch_path(spark, f"{name}-out")
    df.repartitionByRange(8, "ts").write.parquet(src)
    stream = build(spark.readStream.schema(df.schema).parquet(src))
    (stream.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, f"{name}-ck"))
     .trigger(availableNow=True).start(out).awaitTermination())
    return spark.read.schema(stream.schema).parquet(out)


@query("error_alarm_stream", _W5 + """
SELECT CAST(ws AS VARCHAR) AS window_start, events, round(error_pct, 6) AS error_pct, breach,
       CASE WHEN count(*) OVER w = 2 AND min(breach) OVER w = 1 THEN 'ALARM' ELSE 'OK' END AS state
FROM b WHERE ws + INTERVAL 5 minute <= (SELECT max(ts) - INTERVAL 10 minute FROM events)
WINDOW w AS (ORDER BY ws ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)""")
def q_alarm_stream(spark, sf_dir):
    """M8 + M10 as one streaming query: watermarked windows, then the keyed
    run of breaches; windows that the watermark has not closed are not out."""
    def build(stream):
        m = L.metric_windows(stream, every="5 minutes", watermark="10 minutes").select("window_start", "events", "error_pct")
        return ST.breach_alarm_stream(m, "error_pct", ">", 30.0, 2)

    return present(_streamed(spark, events(spark, sf_dir), "alarm", build))


@query("change_log_stream", """
WITH l AS (SELECT user_id, event_id, ts, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v FROM events),
p AS (SELECT *, lag(v) OVER w AS before, row_number() OVER w AS pos FROM l
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, v NULLS FIRST))
SELECT user_id, event_id, round(v, 6) AS v, CASE WHEN pos = 1 THEN 'NEW_FLIGHT' ELSE 'DELAY_PREDICTED' END AS event
FROM p WHERE pos = 1 OR (before IS NULL AND v IS NOT NULL)""")
def q_change_log_stream(spark, sf_dir):
    """M4 on a stream of record images (an error event has no value)."""
    value = F.when(F.col("event_type") != "error", F.col("value"))
    images = events(spark, sf_dir).select("user_id", "event_id", "ts", value.alias("v"))
    out = _streamed(spark, images, "changes", lambda s: ST.change_events_stream(s, ["user_id"], "v", "ts"))
    return present(out.select("user_id", "event_id", "v", "event"))


@query("session_spans", """
WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                 OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 1 hour THEN 1 ELSE 0 END AS brk
           FROM events),
s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, CAST(min(ts) AS VARCHAR) AS start, CAST(max(ts) AS VARCHAR) AS last_active, count(*) AS requests,
       CAST(floor(epoch(max(ts))) AS BIGINT) + 3600 AS expiry_time
FROM s GROUP BY user_id, sid""")
def q_sessions(spark, sf_dir):
    """Gap sessions (1 hour) with start, last activity and expiry."""
    return present(L.session_spans(events(spark, sf_dir)))


@query("rate_limit", """
WITH RECURSIVE r AS (SELECT user_id, ts, epoch(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
                     FROM events),
f(user_id, rn, t, ws, cnt, ok) AS (
  SELECT user_id, rn, t, t, 1, true FROM r WHERE rn = 1
  UNION ALL
  SELECT r.user_id, r.rn, r.t,
         CASE WHEN r.t >= f.ws + 60 THEN r.t ELSE f.ws END,
         CASE WHEN r.t >= f.ws + 60 THEN 1 WHEN f.cnt < 20 THEN f.cnt + 1 ELSE f.cnt END,
         CASE WHEN r.t >= f.ws + 60 THEN true ELSE f.cnt < 20 END
  FROM f JOIN r ON r.user_id = f.user_id AND r.rn = f.rn + 1)
SELECT user_id, count(*) FILTER (WHERE ok) AS accepted, count(*) FILTER (WHERE NOT ok) AS refused FROM f GROUP BY user_id""")
def q_rate_limit(spark, sf_dir):
    """20 requests per 60 s per user, refused ones not counted."""
    r = L.rate_limit(events(spark, sf_dir).select("user_id", "ts", "event_id"), "user_id", "ts", 20, 60, "event_id")
    return r.groupBy("user_id").agg(F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("refused"))


@query("rate_limit_burst", """
WITH RECURSIVE r AS (SELECT user_id % 3 AS gate, ts, epoch(ts) AS t, row_number() OVER (PARTITION BY user_id % 3 ORDER BY ts, event_id) AS rn
                     FROM events),
f(gate, rn, t, ws, cnt, ok) AS (
  SELECT gate, rn, t, t, 1, true FROM r WHERE rn = 1
  UNION ALL
  SELECT r.gate, r.rn, r.t,
         CASE WHEN r.t >= f.ws + 86400 THEN r.t ELSE f.ws END,
         CASE WHEN r.t >= f.ws + 86400 THEN 1 WHEN f.cnt < 20 THEN f.cnt + 1 ELSE f.cnt END,
         CASE WHEN r.t >= f.ws + 86400 THEN true ELSE f.cnt < 20 END
  FROM f JOIN r ON r.gate = f.gate AND r.rn = f.rn + 1)
SELECT gate, count(*) FILTER (WHERE ok) AS accepted, count(*) FILTER (WHERE NOT ok) AS refused FROM f GROUP BY gate""")
def q_rate_limit_burst(spark, sf_dir):
    """M11 where the limit bites: 20 requests per day for three gateways."""
    ev = events(spark, sf_dir).select((F.col("user_id") % 3).alias("gate"), "ts", "event_id")
    r = L.rate_limit(ev, "gate", "ts", 20, 86400, "event_id")
    return r.groupBy("gate").agg(F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("refused"))


@query("change_events", with_flights("""
, old AS (SELECT * REPLACE (NULL::DOUBLE AS dep_delay) FROM v_flights WHERE year <= 1998)
SELECT event, count(*) AS events FROM (
  SELECT CASE WHEN o.l_orderkey IS NULL THEN 'NEW_FLIGHT'
              WHEN o.dep_delay IS NULL AND n.dep_delay IS NOT NULL THEN 'DELAY_PREDICTED' END AS event
  FROM v_flights n LEFT JOIN old o USING (l_orderkey, l_linenumber, l_partkey, l_suppkey)) t
WHERE event IS NOT NULL GROUP BY event"""))
def q_change_events(spark, sf_dir):
    """M4: change events between two snapshots of the flight table."""
    new = raw(spark, sf_dir)
    old = new.filter(F.col("year") <= 1998).withColumn("dep_delay", F.lit(None).cast("double"))
    return L.change_events(old, new, ROW_KEYS).groupBy("event").agg(F.count(F.lit(1)).alias("events"))


_NOW = 1705276800  # 2024-01-15 00:00:00 UTC, the clock of the expiry check


@query("expire_ttl", f"""
SELECT event_type, count(*) AS live FROM events
WHERE CAST(floor(epoch(ts)) AS BIGINT) + 3600 > {_NOW} GROUP BY event_type""")
def q_expire(spark, sf_dir):
    """M5: rows whose expiry (event + 3600 s) is after the clock."""
    ev = events(spark, sf_dir).withColumn("expiry_time", F.unix_timestamp("ts") + 3600)
    return L.expire(ev, _NOW).groupBy("event_type").agg(F.count(F.lit(1)).alias("live"))


@query("dedupe_first_seen", """
SELECT e.user_id, e.event_type, e.event_id FROM events e
JOIN (SELECT user_id, event_type, min(ts) AS ts FROM events GROUP BY ALL) f USING (user_id, event_type, ts)""")
def q_dedupe(spark, sf_dir):
    """M6 batch twin: one row per (user, event type), the first seen."""
    return L.dedupe_stream(events(spark, sf_dir), ["user_id", "event_type"]).select("user_id", "event_type", "event_id")


_BOARD_T = 1704931200  # 2024-01-11 00:00:00 UTC


@query("live_board", f"""
WITH e AS (SELECT event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) AS arrived,
                  CAST(floor(epoch(ts)) AS BIGINT) + CAST(floor(value) AS BIGINT) * 600 AS predicted_at FROM events),
s AS (SELECT * FROM e WHERE arrived <= {_BOARD_T})
SELECT id, arrived, predicted_at FROM s WHERE predicted_at IS NULL OR predicted_at + 3 > {_BOARD_T}
ORDER BY arrived DESC, id LIMIT 12""")
def q_board(spark, sf_dir):
    """M7: the board at one instant (12 newest, 3 s linger after scoring)."""
    ev = events(spark, sf_dir).select(F.col("event_id").alias("id"), F.unix_timestamp("ts").alias("arrived"),
                                      (F.unix_timestamp("ts") + F.floor("value").cast("long") * 600).alias("predicted_at"))
    return L.live_board(ev, _BOARD_T, "id", "arrived", "predicted_at", 12, 3)


@query("source_lag", """
SELECT CAST(epoch(TIMESTAMP '2024-02-01 00:00:00') AS BIGINT) - CAST(floor(epoch(max(ts))) AS BIGINT) AS lag_seconds
FROM events""")
def q_lag(spark, sf_dir):
    """Age of the newest record against a fixed clock."""
    return L.source_lag(events(spark, sf_dir), now="2024-02-01 00:00:00")
