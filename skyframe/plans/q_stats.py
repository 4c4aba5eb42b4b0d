"""Registered statistics queries: chat menu (C1-C13), notebook profiling
(C18-C39) and the column helpers of §2.2 exercised on the flight table."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyframe.functions import columns as C
from skyframe.operators import named_queries as NQ
from skyframe.operators import stats
from skyframe.plans.output import present
from skyframe.plans.flights import CORE_FIELDS, materialise, widen
from skyframe.plans.q_flights import cleaned, raw
from skyframe.plans.registry import query, with_flights

# Session window of the registered menu queries: a part of the flights' time range.
WINDOW = (800000000, 900000000)
NUMERIC = ["dep_delay", "arr_delay", "distance", "air_time", "temp", "dewp", "humid",
           "wind_speed", "wind_gust", "pressure", "precip", "visib"]


def live(spark, sf_dir):
    """Raw flights as live events: epoch ``timestamp`` of the scheduled
    departure and the constant partition key ``data_type``. The stamp is
    stored, in files by stamp ranges, so a window's bounds reach the scan."""
    ts = (F.unix_date(C.make_date_col()).cast("long") * 86400 + F.col("hour") * 3600 + F.col("minute") * 60)
    stored = materialise(spark, f"live{sf_dir}", lambda: raw(spark, sf_dir).withColumn("timestamp", ts).select(
        *CORE_FIELDS, "timestamp").repartitionByRange("timestamp"))
    return widen(stored).withColumn("data_type", F.lit("FLIGHTS"))


LIVE_CTE = """live AS (SELECT *, CAST(date_diff('day', DATE '1970-01-01', make_date(year, month, day)) AS BIGINT) * 86400
                      + hour * 3600 + minute * 60 AS timestamp, 'FLIGHTS' AS data_type FROM v_flights),
win AS (SELECT * FROM live WHERE timestamp BETWEEN 800000000 AND 900000000 AND dep_delay IS NOT NULL)"""


def windowed(spark, sf_dir):
    return NQ.in_session_window(live(spark, sf_dir), *WINDOW)


def _menu(sql_body):
    return with_flights(sql_body, ctes=LIVE_CTE)


@query("named_max_delay", _menu("SELECT round(max(dep_delay), 6) AS max_delay FROM win"))
def q_max_delay(spark, sf_dir):
    """C1 over the session window (B19, bounds checked by B20)."""
    return present(stats.max_of(windowed(spark, sf_dir)))


@query("named_min_delay", _menu("SELECT round(min(dep_delay), 6) AS min_delay FROM win"))
def q_min_delay(spark, sf_dir):
    """C2."""
    return present(stats.min_of(windowed(spark, sf_dir)))


@query("named_flight_count", _menu("SELECT count(*) AS flight_count FROM win"))
def q_flight_count(spark, sf_dir):
    """C3."""
    return stats.row_count(windowed(spark, sf_dir))


@query("named_flights_by_airline", _menu(
    "SELECT airline, count(*) AS flight_count FROM win GROUP BY airline"))
def q_flights_by_airline(spark, sf_dir):
    """C4."""
    return stats.counts_by(windowed(spark, sf_dir), "airline")


AIRLINE = "nation air 7 inc."
ROUTE = "nation_7-nation_3"


@query("named_avg_delay_by_airline", _menu(f"""
SELECT round(avg(dep_delay), 6) AS avg_delay, count(*) AS flight_count FROM win
WHERE lower(airline) = lower('{AIRLINE}')"""))
def q_avg_delay_by_airline(spark, sf_dir):
    """C5 (B18 case-insensitive airline match)."""
    return present(stats.avg_for_value(windowed(spark, sf_dir), "airline", AIRLINE))


@query("named_max_delay_airline", _menu("""
SELECT airline, round(avg(dep_delay), 6) AS avg_dep_delay FROM win GROUP BY airline
ORDER BY avg(dep_delay) DESC, airline LIMIT 1"""))
def q_max_delay_airline(spark, sf_dir):
    """C6."""
    return present(stats.mean_by(windowed(spark, sf_dir), k=1))


@query("named_min_delay_airline", _menu("""
SELECT airline, round(avg(dep_delay), 6) AS avg_dep_delay FROM win GROUP BY airline
ORDER BY avg(dep_delay) ASC, airline LIMIT 1"""))
def q_min_delay_airline(spark, sf_dir):
    """C7."""
    return present(stats.mean_by(windowed(spark, sf_dir), k=1, ascending=True))


@query("named_flights_by_route", _menu("""
SELECT route, count(*) AS flight_count FROM win GROUP BY route ORDER BY flight_count DESC, route LIMIT 10"""))
def q_flights_by_route(spark, sf_dir):
    """C8."""
    return stats.counts_by(windowed(spark, sf_dir), "route", k=10)


@query("named_max_flights_route", _menu("""
SELECT route, count(*) AS flight_count FROM win GROUP BY route ORDER BY flight_count DESC, route LIMIT 1"""))
def q_max_flights_route(spark, sf_dir):
    """C9."""
    return stats.counts_by(windowed(spark, sf_dir), "route", k=1)


@query("named_min_flights_route", _menu("""
SELECT route, count(*) AS flight_count FROM win GROUP BY route ORDER BY flight_count ASC, route LIMIT 1"""))
def q_min_flights_route(spark, sf_dir):
    """C10."""
    return stats.counts_by(windowed(spark, sf_dir), "route", k=1, ascending=True)


@query("named_weather_by_route", _menu(f"""
SELECT round(avg(temp), 6) AS avg_temp, round(avg(pressure), 6) AS avg_pressure,
       round(avg(wind_speed), 6) AS avg_wind_speed FROM win WHERE upper(route) = upper('{ROUTE}')"""))
def q_weather_by_route(spark, sf_dir):
    """C11."""
    return present(stats.means_for_value(windowed(spark, sf_dir), "route", ROUTE, ["temp", "pressure", "wind_speed"]))


@query("named_distance_by_route", _menu(f"""
SELECT round(avg(distance), 6) AS avg_distance FROM win WHERE upper(route) = upper('{ROUTE}')"""))
def q_distance_by_route(spark, sf_dir):
    """C12."""
    return present(stats.means_for_value(windowed(spark, sf_dir), "route", ROUTE, ["distance"]))


_ANSWERS_SQL = _menu(f"""
SELECT * FROM (
  SELECT 'max_delay' AS query_type, CAST(0 AS BIGINT) AS line,
         'The maximum departure delay is ' || printf('%.2f', max(dep_delay)) || ' minutes.' AS answer FROM win
  UNION ALL SELECT 'min_delay', 0, 'The minimum departure delay is ' || printf('%.2f', min(dep_delay)) || ' minutes.' FROM win
  UNION ALL SELECT 'flight_count', 0, 'There are currently ' || format('{{:,}}', count(*)) || ' flights in your session.' FROM win
  UNION ALL SELECT 'flights_by_airline', 0, 'Flight counts by airline:'
  UNION ALL SELECT 'flights_by_airline', row_number() OVER (ORDER BY n DESC, airline),
                   '- ' || airline || ': ' || format('{{:,}}', n) || ' flights'
            FROM (SELECT airline, count(*) AS n FROM win GROUP BY airline) a
  UNION ALL SELECT 'avg_delay_by_airline', 0, CASE WHEN count(*) = 0 THEN '❌ No data found for airline ''{AIRLINE}''.'
                   ELSE '{AIRLINE} has an average departure delay of '
                   || printf('%.2f', avg(dep_delay)) || ' minutes (' || format('{{:,}}', count(*)) || ' flights).' END
            FROM win WHERE lower(airline) = lower('{AIRLINE}')
  UNION ALL SELECT * FROM (SELECT 'max_delay_airline', 0, 'The airline with the most delays is ' || airline
                   || ' with an average delay of ' || printf('%.2f', avg(dep_delay)) || ' minutes.'
            FROM win GROUP BY airline ORDER BY avg(dep_delay) DESC, airline LIMIT 1)
  UNION ALL SELECT * FROM (SELECT 'min_delay_airline', 0, 'The airline with the least delays is ' || airline
                   || ' with an average delay of ' || printf('%.2f', avg(dep_delay)) || ' minutes.'
            FROM win GROUP BY airline ORDER BY avg(dep_delay) ASC, airline LIMIT 1)
  UNION ALL SELECT 'flights_by_route', 0, 'Flight counts by route (Top 10):'
  UNION ALL SELECT * FROM (SELECT 'flights_by_route', row_number() OVER (ORDER BY n DESC, route),
                   '- ' || route || ': ' || format('{{:,}}', n) || ' flights'
            FROM (SELECT route, count(*) AS n FROM win GROUP BY route) r ORDER BY n DESC, route LIMIT 10)
  UNION ALL SELECT * FROM (SELECT 'max_flights_route', 0, 'The route with the most flights is ' || route || ' with '
                   || format('{{:,}}', count(*)) || ' flights.' FROM win GROUP BY route ORDER BY count(*) DESC, route LIMIT 1)
  UNION ALL SELECT * FROM (SELECT 'min_flights_route', 0, 'The route with the least flights is ' || route || ' with '
                   || format('{{:,}}', count(*)) || ' flights.' FROM win GROUP BY route ORDER BY count(*) ASC, route LIMIT 1)
  UNION ALL SELECT 'weather_by_route', 0, CASE WHEN count(*) = 0 THEN '❌ No data found for route ''{ROUTE}''.'
                   ELSE 'For route {ROUTE}, the average temperature is ' || printf('%.1f', avg(temp))
                   || '°F, wind speed is ' || printf('%.2f', avg(wind_speed)) || ' mph, and pressure is '
                   || printf('%.1f', avg(pressure)) || ' hPa.' END FROM win WHERE upper(route) = upper('{ROUTE}')
  UNION ALL SELECT 'distance_by_route', 0, CASE WHEN count(*) = 0 THEN '❌ No data found for route ''{ROUTE}''.'
                   ELSE 'The average distance for route {ROUTE} is ' || printf('%.1f', avg(distance))
                   || ' miles.' END FROM win WHERE upper(route) = upper('{ROUTE}')
  UNION ALL SELECT 'not_a_query', 0, '❌ Error: Unsupported query type ''not_a_query''. Please use a valid query_type.'
  UNION ALL SELECT 'missing_airline', 0,
                   '❌ Error: ''airline'' parameter is required. Example: ''alaska_airlines_inc'', ''horizon_air'''
  UNION ALL SELECT 'empty_window', 0, 'No flight data available in your session yet. Please wait for flights to arrive and be processed by the prediction system.'
) t""")


@query("named_query_answers", _ANSWERS_SQL)
def q_named_answers(spark, sf_dir):
    """C13 + B28: every menu entry (plus a bad type and a missing
    parameter) answered as text over the window."""
    df = live(spark, sf_dir)
    empty = NQ.in_session_window(df, *WINDOW).isEmpty()
    parts = []
    for qt in NQ.QUERY_TYPES + ["not_a_query"]:
        a = NQ.run_named_query(df, qt, *WINDOW, airline=AIRLINE, route=ROUTE, empty=empty)
        parts.append(a.select(F.lit(qt).alias("query_type"), "line", "answer"))
    parts.append(NQ.run_named_query(df, "avg_delay_by_airline", *WINDOW, empty=empty)
                 .select(F.lit("missing_airline").alias("query_type"), "line", "answer"))
    # before the first flight: the empty window is answered whatever is asked
    parts.append(NQ.run_named_query(df, "avg_delay_by_airline", 1, 1000)
                 .select(F.lit("empty_window").alias("query_type"), "line", "answer"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- notebook statistics over the raw table --------------------------------

@query("group_stat_median", with_flights("""
SELECT airline, round(quantile_cont(dep_delay, 0.5), 6) AS dep_delay FROM v_flights
WHERE dep_delay IS NOT NULL GROUP BY airline"""))
def q_group_median(spark, sf_dir):
    """C18 (median per airline, exact, distributed rank)."""
    return present(stats.group_stat(raw(spark, sf_dir), "airline", "dep_delay", "median"))


@query("group_stat_sum", with_flights("""
SELECT origin, round(sum(arr_delay), 6) AS arr_delay FROM v_flights GROUP BY origin"""))
def q_group_sum(spark, sf_dir):
    """C18 (sum)."""
    return present(stats.group_stat(raw(spark, sf_dir), "origin", "arr_delay", "sum"))


@query("group_stat_custom", with_flights("""
SELECT airline, round(sum(CASE WHEN dep_delay > 15 THEN distance ELSE 0e0 END) / sum(distance), 6) AS late_distance_share
FROM v_flights GROUP BY airline"""))
def q_group_custom(spark, sf_dir):
    """C18 (an aggregate of the caller's own): the share of an airline's distance flown with a late departure."""
    late = F.sum(F.when(F.col("dep_delay") > 15, F.col("distance")).otherwise(0.0)) / F.sum("distance")
    return present(stats.group_stat(raw(spark, sf_dir), "airline", "late_distance_share", late))


@query("total_distance_by_airline", with_flights("""
SELECT airline, round(sum(distance), 6) AS total_distance FROM v_flights GROUP BY airline"""))
def q_total_distance(spark, sf_dir):
    """C19."""
    return present(stats.total_by(raw(spark, sf_dir), "airline", "distance"))


@query("value_counts_airline", with_flights("""
SELECT airline, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent
FROM v_flights WHERE airline IS NOT NULL GROUP BY airline"""))
def q_value_counts(spark, sf_dir):
    """C20."""
    return present(stats.value_counts(raw(spark, sf_dir), "airline"))


@query("distinct_counts", with_flights("""
SELECT count(DISTINCT airline) AS n_airline, count(DISTINCT route) AS n_route,
       count(DISTINCT tailnum) AS n_tailnum, count(DISTINCT origin) AS n_origin FROM v_flights"""))
def q_distinct_counts(spark, sf_dir):
    """C21."""
    return stats.distinct_counts(raw(spark, sf_dir), ["airline", "route", "tailnum", "origin"])


@query("fleet_size", with_flights("""
SELECT airline, count(DISTINCT tailnum) AS fleet_size FROM v_flights GROUP BY airline"""))
def q_fleet_size(spark, sf_dir):
    """C22."""
    return stats.fleet_size(raw(spark, sf_dir))


def _describe_sql(cols):
    parts = [f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25,
       round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75,
       round(max({c}), 6) AS max FROM v_flights""" for c in cols]
    return with_flights("\nUNION ALL\n".join(parts))


DESCRIBE_COLS = ["dep_delay", "distance", "temp", "wind_dir"]


@query("describe", _describe_sql(DESCRIBE_COLS))
def q_describe(spark, sf_dir):
    """C23."""
    return present(stats.describe(raw(spark, sf_dir), DESCRIBE_COLS))


def _null_sql(cols):
    parts = [f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS nulls,
       round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS null_ratio,
       count(*) FILTER (WHERE {c} IS NULL) / count(*) > 0.05 AS over_limit FROM v_flights""" for c in cols]
    return with_flights("\nUNION ALL\n".join(parts))


NULL_COLS = ["dep_time", "dep_delay", "arr_time", "arr_delay", "air_time", "wind_dir", "wind_speed",
             "wind_gust", "temp", "airline"]


@query("null_profile", _null_sql(NULL_COLS))
def q_null_profile(spark, sf_dir):
    """C24."""
    return present(stats.null_profile(raw(spark, sf_dir), NULL_COLS))


@query("cancellations_by_airline", with_flights("""
SELECT airline, count(*) AS cancelled FROM v_flights
WHERE dep_time IS NULL AND dep_delay IS NULL AND arr_time IS NULL AND arr_delay IS NULL AND air_time IS NULL
GROUP BY airline"""))
def q_cancellations(spark, sf_dir):
    """C25."""
    return stats.cancellations_by(raw(spark, sf_dir))


@query("hourly_stats", with_flights("""
SELECT hour, count(*) AS flight_count, round(avg(dep_delay), 6) AS avg_dep_delay FROM v_flights GROUP BY hour"""))
def q_hourly(spark, sf_dir):
    """C26."""
    return present(stats.hourly(raw(spark, sf_dir)))


@query("daily_counts", with_flights("""
SELECT airline, CAST(date AS VARCHAR) AS date, count(*) AS daily_flight_count FROM clean_flights
GROUP BY airline, date""", clean=True))
def q_daily_counts(spark, sf_dir):
    """C27 on the processed table."""
    return present(stats.daily_counts(cleaned(spark, sf_dir)))


@query("routes_by_total_delay", with_flights("""
(SELECT route, round(sum(dep_delay), 6) AS total_delay, 'top' AS side FROM v_flights GROUP BY route
 ORDER BY sum(dep_delay) DESC NULLS LAST, route LIMIT 5)
UNION ALL
(SELECT route, round(sum(dep_delay), 6) AS total_delay, 'bottom' AS side FROM v_flights GROUP BY route
 ORDER BY sum(dep_delay) ASC NULLS LAST, route LIMIT 5)"""))
def q_routes_by_total_delay(spark, sf_dir):
    """C28."""
    return present(stats.routes_by_total_delay(raw(spark, sf_dir)))


DUP_COLS = ["airline", "route", "flight", "tailnum", "year", "month", "day", "hour", "minute"]


@query("duplicate_profile", with_flights(f"""
SELECT {', '.join(DUP_COLS)}, l_orderkey, l_linenumber, l_partkey, l_suppkey, copies FROM v_flights
JOIN (SELECT {', '.join(DUP_COLS)}, count(*) AS copies FROM v_flights GROUP BY ALL HAVING count(*) > 1) g
USING ({', '.join(DUP_COLS)})"""))
def q_duplicate_profile(spark, sf_dir):
    """Members of groups that repeat the same flight on the same minute."""
    df = raw(spark, sf_dir).select(*DUP_COLS, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return stats.duplicate_profile(df, DUP_COLS)


@query("loss_report", with_flights("""
SELECT (SELECT count(*) FROM v_flights) AS rows_before, (SELECT count(*) FROM clean_flights) AS rows_after,
       (SELECT count(*) FROM v_flights) - (SELECT count(*) FROM clean_flights) AS rows_removed,
       round(((SELECT count(*) FROM v_flights) - (SELECT count(*) FROM clean_flights)) * 100.0
             / (SELECT count(*) FROM v_flights), 6) AS percent_removed""", clean=True))
def q_loss_report(spark, sf_dir):
    """Rows removed by cleaning."""
    return present(stats.loss_report(raw(spark, sf_dir), cleaned(spark, sf_dir)))


@query("histogram_distance", with_flights("""
, mm AS (SELECT min(distance) AS lo, max(distance) AS hi FROM v_flights),
b AS (SELECT CAST(least(floor((distance - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin, lo, hi FROM v_flights, mm
      WHERE distance IS NOT NULL)
SELECT bin, round(lo + bin * ((hi - lo) / 10), 6) AS lower, round(lo + (bin + 1) * ((hi - lo) / 10), 6) AS upper,
       count(*) AS count FROM b GROUP BY bin, lo, hi"""))
def q_histogram(spark, sf_dir):
    """C31."""
    return present(stats.histogram(raw(spark, sf_dir), "distance", 10))


@query("box_stats_delay", with_flights("""
, q AS (SELECT quantile_cont(dep_delay, 0.25) AS q1, quantile_cont(dep_delay, 0.5) AS med,
               quantile_cont(dep_delay, 0.75) AS q3 FROM v_flights)
SELECT round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
       round(min(dep_delay) FILTER (WHERE dep_delay >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
       round(max(dep_delay) FILTER (WHERE dep_delay <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
       count(*) FILTER (WHERE dep_delay < q1 - 1.5 * (q3 - q1) OR dep_delay > q3 + 1.5 * (q3 - q1)) AS outliers
FROM v_flights, q WHERE dep_delay IS NOT NULL GROUP BY q1, med, q3"""))
def q_box(spark, sf_dir):
    """C32."""
    return present(stats.box_stats(raw(spark, sf_dir), "dep_delay"))


@query("kde_distance", with_flights("""
, s AS (SELECT count(distance) AS n, stddev_samp(distance) AS sd, min(distance) AS lo, max(distance) AS hi FROM v_flights),
p AS (SELECT n, sd * pow(n, -1.0 / 5.0) AS bw, lo, hi FROM s),
g AS (SELECT i AS point, (lo - 3.0 * bw) + ((hi + 3.0 * bw) - (lo - 3.0 * bw)) * i / 199 AS x, n, bw
      FROM p, range(200) t(i)),
vc AS (SELECT distance, count(*) AS w FROM v_flights WHERE distance IS NOT NULL GROUP BY distance)
SELECT CAST(point AS INTEGER) AS point, round(x, 6) AS x,
       round(sum(w * exp(-0.5 * pow((distance - x) / bw, 2))) * (1.0 / (n * bw * sqrt(2 * pi()))), 6) AS density
FROM g, vc GROUP BY point, x, n, bw"""))
def q_kde(spark, sf_dir):
    """C33."""
    return present(stats.kde(raw(spark, sf_dir), "distance", points=200))


CORR_COLS = ["dep_delay", "arr_delay", "distance", "air_time", "temp", "dewp", "wind_speed", "wind_gust"]


def _corr_sql(cols, where=""):
    parts = [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS corr FROM v_flights"
             for i, a in enumerate(cols) for b in cols[:i]]
    return "\nUNION ALL\n".join(parts)


@query("correlation_matrix", with_flights(_corr_sql(CORR_COLS)))
def q_corr(spark, sf_dir):
    """C34 (lower triangle, long form)."""
    return present(stats.correlation_matrix(raw(spark, sf_dir), CORR_COLS))


@query("redundant_pairs", with_flights(
    "SELECT * FROM (" + _corr_sql(CORR_COLS) + ") t WHERE abs(corr) > 0.7"))
def q_redundant(spark, sf_dir):
    """C35 (pairs above 0.70)."""
    return present(stats.redundant_pairs(raw(spark, sf_dir), CORR_COLS, 0.70))


TARGET_EXCLUDE = ["air_time", "dewp", "wind_gust"]


@query("correlated_with_target", with_flights("SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(corr({c}, dep_delay), 6) AS corr FROM v_flights"
    for c in NUMERIC if c != "dep_delay" and c not in TARGET_EXCLUDE) + ") t WHERE abs(corr) >= 0.03"))
def q_correlated(spark, sf_dir):
    """C35 (features whose |corr| with the target is at least 0.03)."""
    return present(stats.correlated_with(raw(spark, sf_dir), NUMERIC, "dep_delay", 0.03, TARGET_EXCLUDE))


@query("share_of_total", with_flights("""
SELECT airline, round(sum(distance) / (SELECT sum(distance) FROM v_flights), 6) AS distance_ratio_by_total
FROM v_flights GROUP BY airline"""))
def q_share(spark, sf_dir):
    """C36."""
    return present(stats.share_of_total(raw(spark, sf_dir)))


@query("live_board_stats", _menu("""
SELECT count(*) AS total, count(*) FILTER (WHERE dep_delay IS NULL) AS waiting,
       count(*) FILTER (WHERE dep_delay IS NOT NULL) AS predicted,
       round(coalesce(round(avg(CASE WHEN dep_delay > 0 THEN dep_delay END)), 0.0), 6) AS avg_positive_delay
FROM live"""))
def q_live_board(spark, sf_dir):
    """C37 over the whole live table (waiting = not yet scored)."""
    return present(stats.live_board_stats(live(spark, sf_dir)))


MEAN_COLS = ["temp", "humid", "wind_dir", "wind_speed", "pressure", "distance"]


@query("mean_vector", with_flights("SELECT " + ", ".join(
    f"round(coalesce(avg({c}), 0.0), 6) AS {c}" for c in MEAN_COLS) + " FROM v_flights"))
def q_mean_vector(spark, sf_dir):
    """C39."""
    return present(stats.mean_vector(raw(spark, sf_dir), MEAN_COLS))


# ---- §2.2 column helpers ----------------------------------------------------

@query("airline_names", with_flights("""
SELECT DISTINCT airline, replace(replace(lower(airline), ' ', '_'), '.', '') AS airline_key,
       coalesce(replace(replace(replace(lower(airline), ' ', '_'), '.', ''), '_', ' '), 'Unknown') AS display
FROM v_flights"""))
def q_airline_names(spark, sf_dir):
    """B15 + B16."""
    df = raw(spark, sf_dir).select("airline").distinct()
    return df.select("airline", C.normalise_name("airline").alias("airline_key"),
                     C.display_name(C.normalise_name("airline")).alias("display"))


@query("delay_bands", with_flights("""
SELECT CASE WHEN dep_delay IS NULL THEN 'unknown' WHEN dep_delay <= 0 THEN 'on_time'
            WHEN dep_delay <= 15 THEN 'minor' ELSE 'late' END AS band, count(*) AS flights
FROM v_flights GROUP BY 1"""))
def q_delay_bands(spark, sf_dir):
    """B26."""
    return raw(spark, sf_dir).groupBy(C.delay_band("dep_delay").alias("band")).agg(F.count(F.lit(1)).alias("flights"))


@query("distance_codes", with_flights("""
SELECT CASE WHEN distance IS NULL OR distance <= 0 THEN -1 WHEN distance <= 500 THEN 0
            WHEN distance <= 1000 THEN 1 ELSE 2 END AS distance_category, count(*) AS flights
FROM v_flights GROUP BY 1"""))
def q_distance_codes(spark, sf_dir):
    """H7 right-closed bins."""
    return (raw(spark, sf_dir).groupBy(C.bin_right_closed("distance").alias("distance_category"))
            .agg(F.count(F.lit(1)).alias("flights")))


@query("stamp_checks", with_flights("""
SELECT count(*) AS rows, count(*) FILTER (WHERE hour(sched_dep_time) <> hour) AS hour_mismatch,
       count(*) FILTER (WHERE strftime(dep_time, '%H:%M') = '00:00') AS midnight_departures,
       count(DISTINCT strftime(sched_dep_time, '%H:%M')) AS distinct_clocks
FROM clean_flights""", clean=True))
def q_stamp_checks(spark, sf_dir):
    """B25 + B27 on the processed table."""
    df = cleaned(spark, sf_dir)
    return df.agg(F.count(F.lit(1)).alias("rows"), C.hour_mismatch("hour", "sched_dep_time").alias("hour_mismatch"),
                  F.count_if(C.clock_text("dep_time") == "00:00").alias("midnight_departures"),
                  F.countDistinct(C.clock_text("sched_dep_time")).alias("distinct_clocks"))


@query("clipped_numeric", with_flights("""
SELECT count(*) AS rows,
       round(sum(CASE WHEN humid IS NULL THEN NULL ELSE greatest(least(humid * 1.12, 100.0), 0.0) END), 6) AS humid_clipped,
       round(sum(coalesce(TRY_CAST(tailnum AS DOUBLE), 0.0)), 6) AS tail_numeric,
       CAST(sum(CAST(temp AS INTEGER)) AS BIGINT) AS temp_int,
       CAST(sum(CASE WHEN dep_delay IS NULL THEN NULL WHEN dep_delay > 0 THEN 1 ELSE 0 END) AS BIGINT) AS delayed
FROM v_flights"""))
def q_clipped(spark, sf_dir):
    """B21, B22, B29, K0."""
    df = raw(spark, sf_dir)
    return present(df.agg(F.count(F.lit(1)).alias("rows"),
                          F.sum(C.clip(F.col("humid") * 1.12, 0.0, 100.0)).alias("humid_clipped"),
                          F.sum(C.to_numeric_or_zero("tailnum")).alias("tail_numeric"),
                          F.sum(C.narrow_int("temp")).alias("temp_int"),
                          F.sum(C.binarise_label("dep_delay")).alias("delayed")))
