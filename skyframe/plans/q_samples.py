"""Registered sampling, feature and relational queries (D, E, G, H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyframe.functions.columns import normalise_name
from skyframe.operators import features as FE
from skyframe.operators import relational as R
from skyframe.operators import sampling as S
from skyframe.plans.flights import ROW_KEYS
from skyframe.plans.output import present
from skyframe.plans.q_flights import cleaned, raw
from skyframe.plans.registry import query, with_flights
from skyframe.session import ensure_session_conf
from skyframe.tables import table

SEED = 42
KEYS = ", ".join(ROW_KEYS)
HASH_SQL = f"md5(concat_ws('|', {KEYS}, '{SEED}'))"
HASHED = f", s AS (SELECT *, {HASH_SQL} AS h FROM v_flights)"


@query("stratified_sample", with_flights(HASHED + f"""
, r AS (SELECT airline, route, {KEYS},
          row_number() OVER (PARTITION BY airline, route ORDER BY h, {KEYS}) AS row_num,
          count(*) OVER (PARTITION BY airline, route) AS group_size FROM s)
SELECT * FROM r WHERE row_num <= ceil(group_size * CAST(0.3 AS DOUBLE))"""))
def q_stratified(spark, sf_dir):
    """H1 (+ D1 rank in group, D2 group size): 30 % of every airline-route."""
    df = raw(spark, sf_dir).select("airline", "route", *ROW_KEYS)
    return S.stratified_sample(df, ["airline", "route"], ROW_KEYS, 0.3, SEED)


@query("sample_n", with_flights(HASHED + f"""
, r AS (SELECT {KEYS}, row_number() OVER (ORDER BY h, {KEYS}) AS rr, count(*) OVER () AS n FROM s)
SELECT {KEYS} FROM r WHERE rr <= floor(n * CAST(0.2 AS DOUBLE))"""))
def q_sample_n(spark, sf_dir):
    """H2: int(0.2 * N) rows in seeded order."""
    return S.sample_n(raw(spark, sf_dir).select(*ROW_KEYS), ROW_KEYS, 0.2, SEED)


# Drift multipliers for the driver airlines (the published five, re-keyed).
MULTIPLIERS = {"nation_air_1_inc": 1.25, "nation_air_2_inc": 0.75, "nation_air_3_inc": 1.15,
               "nation_air_4_inc": 0.85, "nation_air_5_inc": 1.20}
_MULT_SQL = ", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in MULTIPLIERS.items())


@query("resample_groups", with_flights(HASHED + f"""
, r AS (SELECT *, replace(replace(lower(airline), ' ', '_'), '.', '') AS airline_key FROM s),
r2 AS (SELECT airline_key, {KEYS}, row_number() OVER (PARTITION BY airline_key ORDER BY h, {KEYS}) AS rr,
              count(*) OVER (PARTITION BY airline_key) AS n FROM r),
m AS (SELECT * FROM (VALUES {_MULT_SQL}) t(mk, mult)),
c AS (SELECT r2.*, mult, greatest(1, least(CAST(floor(n * mult) AS BIGINT), CAST(n * 2.0 AS BIGINT))) AS new_n
      FROM r2 LEFT JOIN m ON airline_key = mk),
x AS (SELECT airline_key, 1 + CAST('0x' || substr(md5(concat_ws('|', '{SEED}', airline_key, j)), 1, 12) AS BIGINT) % n AS rr
      FROM (SELECT airline_key, n, unnest(generate_series(1, new_n - n)) AS j
            FROM (SELECT DISTINCT airline_key, n, new_n FROM c WHERE new_n > n) g) y),
dr AS (SELECT airline_key, rr, count(*) AS drawn FROM x GROUP BY ALL),
d AS (SELECT c.*, CASE WHEN mult IS NULL THEN 1 WHEN new_n >= n THEN 1 + coalesce(drawn, 0)
                       ELSE CASE WHEN c.rr <= new_n THEN 1 ELSE 0 END END AS copies
      FROM c LEFT JOIN dr ON c.airline_key = dr.airline_key AND c.rr = dr.rr)
SELECT airline_key, {KEYS}, CAST(unnest(generate_series(1, copies)) AS BIGINT) AS copy FROM d WHERE copies > 0"""))
def q_resample(spark, sf_dir):
    """H3: airline mix drift by per-group multipliers (cap 2x), up-sampled with replacement."""
    df = raw(spark, sf_dir).select(normalise_name("airline").alias("airline_key"), *ROW_KEYS)
    out = S.resample_groups(df, "airline_key", MULTIPLIERS, ROW_KEYS, SEED)
    return out.withColumn("copy", F.col("copy").cast("long"))


RATIO = 0.2 / (1 - 0.2)


@query("split_3way", with_flights(HASHED + f"""
, r AS (SELECT {KEYS}, row_number() OVER (ORDER BY h, {KEYS}) AS rr, count(*) OVER () AS n FROM s),
t AS (SELECT *, ceil(n * CAST(0.2 AS DOUBLE)) AS n_test FROM r)
SELECT {KEYS}, CASE WHEN rr <= n_test THEN 'test'
                    WHEN rr <= n_test + ceil((n - n_test) * CAST({RATIO!r} AS DOUBLE)) THEN 'validation'
                    ELSE 'train' END AS split FROM t"""))
def q_split(spark, sf_dir):
    """H4: exact train / validation / test labels."""
    return S.split_3way(raw(spark, sf_dir).select(*ROW_KEYS), ROW_KEYS, 0.2, 0.2, SEED)


@query("train_val_combined", with_flights(HASHED + f"""
, r AS (SELECT {KEYS}, row_number() OVER (ORDER BY h, {KEYS}) AS rr, count(*) OVER () AS n FROM s),
t AS (SELECT *, ceil(n * CAST(0.2 AS DOUBLE)) AS n_test FROM r)
SELECT CASE WHEN rr <= n_test + ceil((n - n_test) * CAST({RATIO!r} AS DOUBLE)) THEN 'validation' ELSE 'train' END AS split,
       count(*) AS rows FROM t WHERE rr > n_test GROUP BY 1"""))
def q_combined(spark, sf_dir):
    """H5: the train + validation union used for the final fit and baseline."""
    sp = S.split_3way(raw(spark, sf_dir).select(*ROW_KEYS), ROW_KEYS, 0.2, 0.2, SEED)
    return S.combine_train_val(sp).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@query("kfold_labels", with_flights(HASHED + f"""
, r AS (SELECT {KEYS}, row_number() OVER (ORDER BY h, {KEYS}) - 1 AS i, count(*) OVER () AS n FROM s),
q AS (SELECT *, floor(n / 10) AS q, n - floor(n / 10) * 10 AS rem FROM r)
SELECT {KEYS}, CAST(CASE WHEN i < (q + 1) * rem THEN floor(i / (q + 1))
                         ELSE rem + floor((i - (q + 1) * rem) / q) END AS INTEGER) AS fold FROM q"""))
def q_kfold(spark, sf_dir):
    """H6: 10 contiguous folds over the seeded order."""
    return S.kfold(raw(spark, sf_dir).select(*ROW_KEYS), ROW_KEYS, 10, SEED)


@query("shuffled_positions", with_flights(HASHED + f"""
SELECT {KEYS}, row_number() OVER (ORDER BY h, {KEYS}) AS position FROM s"""))
def q_shuffle(spark, sf_dir):
    """The seeded file order, as an exact distributed position."""
    return S.hash_rank(raw(spark, sf_dir).select(*ROW_KEYS), ROW_KEYS, SEED, rank="position", size=None)


_FEATURE_CTES = """
, tot AS (SELECT sum(distance) AS tot FROM clean_flights),
pa AS (SELECT airline AS pa_airline, sum(distance) / (SELECT tot FROM tot) AS distance_ratio_by_total,
              count(DISTINCT tailnum) AS aircraft_count_by_airline FROM clean_flights GROUP BY airline),
fx AS (SELECT * FROM clean_flights JOIN pa ON airline = pa_airline)"""


AIRLINE_KEYS = sorted(f"nation_air_{k}_inc" for k in range(25))


def build_features_sql(airlines) -> str:
    """The twin for a table in which exactly these airlines (normalised, sorted) occur."""
    one_hot = ", ".join(
        f"CASE WHEN replace(replace(lower(airline), ' ', '_'), '.', '') = '{v}' THEN 1 ELSE 0 END AS {v}" for v in airlines[1:])
    return with_flights(_FEATURE_CTES + f"""
SELECT year, month, day, round(dep_delay, 6) AS dep_delay, round(arr_delay, 6) AS arr_delay,
       round(distance, 6) AS distance, hour, minute, round(temp, 6) AS temp, round(humid, 6) AS humid,
       round(wind_dir, 6) AS wind_dir, round(wind_speed, 6) AS wind_speed, round(precip, 6) AS precip,
       round(pressure, 6) AS pressure, round(visib, 6) AS visib,
       round(distance_ratio_by_total, 6) AS distance_ratio_by_total, aircraft_count_by_airline,
       CASE WHEN distance IS NULL OR distance <= 0 THEN -1 WHEN distance <= 500 THEN 0
            WHEN distance <= 1000 THEN 1 ELSE 2 END AS distance_category,
       {one_hot}, {KEYS}
FROM fx""", clean=True)


@query("build_features", build_features_sql(AIRLINE_KEYS))
def q_build_features(spark, sf_dir):
    """H11 = D4 group features + E1 lookups + H7 bins + H10 selection + H8
    one-hot (first level dropped) on the processed table."""
    out, _ = FE.build_features(cleaned(spark, sf_dir), passthrough=ROW_KEYS)
    return present(out)


_SERVING_SQL = ", ".join(f"CAST(0.0 AS DOUBLE) AS {v}" for v in FE.SERVING_AIRLINES)


@query("serving_features", with_flights(_FEATURE_CTES + f"""
SELECT CAST(year AS DOUBLE) AS year, CAST(month AS DOUBLE) AS month, CAST(day AS DOUBLE) AS day,
       round(arr_delay, 6) AS arr_delay, round(distance, 6) AS distance, CAST(hour AS DOUBLE) AS hour,
       CAST(minute AS DOUBLE) AS minute, round(temp, 6) AS temp, round(humid, 6) AS humid,
       round(wind_dir, 6) AS wind_dir, round(wind_speed, 6) AS wind_speed, round(precip, 6) AS precip,
       round(pressure, 6) AS pressure, round(visib, 6) AS visib,
       round(distance_ratio_by_total, 6) AS distance_ratio_by_total,
       CAST(CASE WHEN distance IS NULL OR distance <= 0 THEN -1 WHEN distance <= 500 THEN 0
            WHEN distance <= 1000 THEN 1 ELSE 2 END AS DOUBLE) AS distance_category,
       CAST(aircraft_count_by_airline AS DOUBLE) AS aircraft_count_by_airline, {_SERVING_SQL}, {KEYS}
FROM fx""", clean=True))
def q_serving_features(spark, sf_dir):
    """H9 + B17: the fixed 28-input serving vector (unknown airlines all 0)."""
    return present(FE.serving_features(cleaned(spark, sf_dir), passthrough=ROW_KEYS))


@query("daily_flight_feature", with_flights("""
SELECT airline, CAST(date AS VARCHAR) AS date, count(*) AS rows, max(dc) AS daily_flight_count
FROM (SELECT *, count(airline) OVER (PARTITION BY airline, date) AS dc FROM clean_flights) t
GROUP BY airline, date""", clean=True))
def q_daily_feature(spark, sf_dir):
    """D4 count per (airline, date) put back on each row, summarised."""
    df = FE.group_transform(cleaned(spark, sf_dir), ["airline", "date"], "airline", "count", "daily_flight_count")
    return present(df.groupBy("airline", "date").agg(F.count(F.lit(1)).alias("rows"),
                                                     F.max("daily_flight_count").alias("daily_flight_count")))


@query("latest_users", """
SELECT e.event_id, CAST(e.ts AS VARCHAR) AS ts, e.user_id, e.event_type, round(e.value, 6) AS value, e.props
FROM events e JOIN (SELECT user_id, min(ts) AS ts FROM events GROUP BY user_id) f USING (user_id, ts)
ORDER BY e.ts DESC, e.user_id LIMIT 12""")
def q_latest_users(spark, sf_dir):
    """The 12 newest users, each at their first event."""
    ensure_session_conf(spark)
    return present(R.latest_n(table(spark, sf_dir, "events"), "user_id", "ts", 12))


@query("new_user_events", """
SELECT event_id, user_id, event_type FROM events e
WHERE ts >= TIMESTAMP '2024-01-02' AND NOT EXISTS (
  SELECT 1 FROM events p WHERE p.ts < TIMESTAMP '2024-01-02' AND p.user_id = e.user_id)""")
def q_new_user_events(spark, sf_dir):
    """Later events of ids never seen on the first day (anti join)."""
    ensure_session_conf(spark)
    ev = table(spark, sf_dir, "events")
    cut = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    return R.duplicate_guard(ev.filter(F.col("ts") >= cut), ev.filter(F.col("ts") < cut), "user_id").select(
        "event_id", "user_id", "event_type")


@query("append_sources", with_flights("""
SELECT source, count(*) AS rows, count(date) AS with_date FROM (
  SELECT 'raw' AS source, NULL AS date FROM v_flights
  UNION ALL SELECT 'processed' AS source, date FROM clean_flights) t GROUP BY source""", clean=True))
def q_append(spark, sf_dir):
    """G1: union by name with missing columns filled by null."""
    a = raw(spark, sf_dir).select("airline").withColumn("source", F.lit("raw"))
    b = cleaned(spark, sf_dir).select("airline", "date").withColumn("source", F.lit("processed"))
    u = R.append(a, b)
    return u.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.count("date").alias("with_date"))


@query("upsert_predictions", with_flights(f"""
, t AS (SELECT * REPLACE (NULL::DOUBLE AS dep_delay) FROM v_flights),
u AS (SELECT {KEYS}, dep_delay FROM clean_flights),
m AS (SELECT coalesce(t.l_orderkey, u.l_orderkey) AS k, CASE WHEN u.l_orderkey IS NOT NULL THEN u.dep_delay ELSE t.dep_delay END AS dd
      FROM t FULL OUTER JOIN u USING ({KEYS}))
SELECT count(*) AS rows, count(dd) AS predicted, round(sum(dd), 6) AS delay_sum FROM m""", clean=True))
def q_upsert(spark, sf_dir):
    """Predictions set onto the raw rows by key."""
    target = raw(spark, sf_dir).withColumn("dep_delay", F.lit(None).cast("double"))
    updates = cleaned(spark, sf_dir).select(*ROW_KEYS, "dep_delay")
    up = R.upsert_by_key(target, updates, ROW_KEYS, ["dep_delay"])
    return present(up.agg(F.count(F.lit(1)).alias("rows"), F.count("dep_delay").alias("predicted"),
                          F.sum("dep_delay").alias("delay_sum")))


@query("upsert_creates_rows", with_flights(f"""
, m AS (SELECT c.l_orderkey IS NULL AS created, c.airline, u.dep_delay AS dd
        FROM clean_flights c RIGHT JOIN v_flights u USING ({KEYS}))
SELECT created, count(*) AS rows, count(airline) AS with_airline, count(dd) AS with_delay, round(sum(dd), 6) AS delay_sum
FROM m GROUP BY created""", clean=True))
def q_upsert_creates(spark, sf_dir):
    """A14's other branch: delays of all raw rows set onto the processed
    table, which creates the rows the cleaning took out."""
    target = cleaned(spark, sf_dir).withColumn("created", F.lit(False))
    up = R.upsert_by_key(target, raw(spark, sf_dir), ROW_KEYS, ["dep_delay"])
    return present(up.groupBy(F.coalesce("created", F.lit(True)).alias("created")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("airline").alias("with_airline"), F.count("dep_delay").alias("with_delay"),
        F.sum("dep_delay").alias("delay_sum")))


_DRIFT_MULT = {"nation_air_1_inc": 1.25, "nation_air_2_inc": 0.75}
_DRIFT_VALUES = ", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in _DRIFT_MULT.items())


def _uniform_sql(name):
    return (f"(CAST('0x' || substr(md5(concat_ws('|', '{SEED}', '{name}', {KEYS}, copy)), 1, 13) AS BIGINT)"
            " / 4503599627370496.0e0)")


def _normal_sql(name, mu, sigma):
    return (f"(CAST({mu} AS DOUBLE) + CAST({sigma} AS DOUBLE) * sqrt(-2.0e0 * ln(1.0e0 - {_uniform_sql(name + ':r')}))"
            f" * cos(2.0e0 * pi() * {_uniform_sql(name + ':a')}))")


def _pick_sql(values, name):
    return f"list_extract([{', '.join(map(str, values))}], CAST(floor({_uniform_sql(name)} * {len(values)}) AS BIGINT) + 1)"


@query("drift_set", with_flights(HASHED + f"""
, smp AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY h, {KEYS}) AS place, count(*) OVER () AS every FROM s)
          WHERE place <= floor(every * CAST(0.2 AS DOUBLE))),
r AS (SELECT *, replace(replace(lower(airline), ' ', '_'), '.', '') AS airline_key FROM smp),
r2 AS (SELECT *, row_number() OVER (PARTITION BY airline_key ORDER BY h, {KEYS}) AS rr,
              count(*) OVER (PARTITION BY airline_key) AS n FROM r),
m AS (SELECT * FROM (VALUES {_DRIFT_VALUES}) t(mk, mult)),
c AS (SELECT r2.*, mult, greatest(1, least(CAST(floor(n * mult) AS BIGINT), CAST(n * 2.0 AS BIGINT))) AS new_n
      FROM r2 LEFT JOIN m ON airline_key = mk),
x AS (SELECT airline_key, 1 + CAST('0x' || substr(md5(concat_ws('|', '{SEED}', airline_key, j)), 1, 12) AS BIGINT) % n AS rr
      FROM (SELECT airline_key, n, unnest(generate_series(1, new_n - n)) AS j
            FROM (SELECT DISTINCT airline_key, n, new_n FROM c WHERE new_n > n) g) y),
dr AS (SELECT airline_key, rr, count(*) AS drawn FROM x GROUP BY ALL),
d AS (SELECT c.*, CASE WHEN mult IS NULL THEN 1 WHEN new_n >= n THEN 1 + coalesce(drawn, 0)
                       ELSE CASE WHEN c.rr <= new_n THEN 1 ELSE 0 END END AS copies
      FROM c LEFT JOIN dr ON c.airline_key = dr.airline_key AND c.rr = dr.rr),
e AS (SELECT *, unnest(generate_series(1, copies)) AS copy FROM d WHERE copies > 0),
z AS (SELECT airline, {KEYS}, copy, temp + {_normal_sql('temp', 5.0, 2.0)} AS temp,
             dewp + 0.7e0 * {_normal_sql('temp', 5.0, 2.0)} AS dewp,
             greatest(0e0, least(100e0, humid * {_normal_sql('humid', 1.12, 0.03)})) AS humid,
             wind_speed * {_normal_sql('wind_speed', 1.18, 0.05)} AS wind_speed,
             distance * {_normal_sql('distance', 1.12, 0.08)} AS distance,
             air_time * pow(greatest({_normal_sql('distance', 1.12, 0.08)}, 0e0), 0.8e0) AS air_time,
             pressure + {_normal_sql('pressure', -2.5, 1.5)} AS pressure,
             CASE WHEN {_uniform_sql('jitter')} < 0.15e0
                  THEN greatest(0, least(23, hour + {_pick_sql((-2, -1, 1, 2), 'shift')})) ELSE hour END AS hour,
             CASE WHEN {_uniform_sql('jitter')} < 0.15e0 THEN {_pick_sql((0, 15, 30, 45), 'minute')} ELSE minute END AS minute
      FROM e)
SELECT airline, {KEYS}, CAST(copy AS BIGINT) AS copy, round(temp, 6) AS temp, round(dewp, 6) AS dewp, round(humid, 6) AS humid,
       round(wind_speed, 6) AS wind_speed, round(distance, 6) AS distance, round(air_time, 6) AS air_time,
       round(pressure, 6) AS pressure, hour, minute FROM z"""))
def q_drift_set(spark, sf_dir):
    """The rows of the monitoring drift set."""
    from skyframe.operators import perturb as P
    d = P.make_drift_set(raw(spark, sf_dir), ROW_KEYS, SEED, _DRIFT_MULT)
    return present(d.select("airline", *ROW_KEYS, F.col("copy").cast("long").alias("copy"), "temp", "dewp", "humid",
                            "wind_speed", "distance", "air_time", "pressure", "hour", "minute"))


_CLOCK = 1704067200


@query("event_envelope", with_flights(f"""
SELECT count(*) AS rows, count(DISTINCT sha256(concat_ws('|', {KEYS}))) AS ids, min(timestamp) AS sent,
       max(expiry_time) AS expires, count(dep_delay) AS with_target
FROM (SELECT *, {_CLOCK} AS timestamp, {_CLOCK} + 3600 AS expiry_time, NULL::DOUBLE AS dep_delay2 FROM v_flights) t
WHERE dep_delay2 IS NULL""".replace("count(dep_delay)", "count(dep_delay2)")))
def q_envelope(spark, sf_dir):
    """B23 with a given clock and repeatable ids."""
    from skyframe.operators import perturb as P
    e = P.event_envelope(raw(spark, sf_dir), _CLOCK, 3600, key_cols=ROW_KEYS)
    return e.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"), F.min("timestamp").alias("sent"),
                 F.max("expiry_time").alias("expires"), F.count("dep_delay").alias("with_target"))


_DRIFT_CASE = " ".join(
    f"WHEN airline_key = '{k}' THEN greatest(1, least(CAST(floor(n * CAST({v} AS DOUBLE)) AS BIGINT), n * 2))"
    for k, v in _DRIFT_MULT.items())


@query("drift_set_sizes", with_flights(HASHED + f"""
, r AS (SELECT airline, row_number() OVER (ORDER BY h, {KEYS}) AS rr, count(*) OVER () AS n FROM s),
g AS (SELECT airline, replace(replace(lower(airline), ' ', '_'), '.', '') AS airline_key, count(*) AS n
      FROM r WHERE rr <= floor(n * CAST(0.2 AS DOUBLE)) GROUP BY airline)
SELECT airline, CASE {_DRIFT_CASE} ELSE n END AS rows FROM g"""))
def q_drift_sizes(spark, sf_dir):
    """H15 sizes: 20 % seeded sample, then the airline mix multipliers."""
    from skyframe.operators import perturb as P
    d = P.make_drift_set(raw(spark, sf_dir), ROW_KEYS, SEED, _DRIFT_MULT)
    return d.groupBy("airline").agg(F.count(F.lit(1)).alias("rows"))
