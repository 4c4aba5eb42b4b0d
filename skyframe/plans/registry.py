"""Name -> (Spark query, DuckDB twin) registry used by ``__spark_entry__``.

Each registered callable takes ``(spark, sf_dir)`` and returns a
DataFrame over the whole driver tables. The SQL twin (when given) is an
independent formulation that DuckDB runs over the same Parquet files.
"""

from __future__ import annotations

from collections.abc import Callable

from skyframe.plans.flights import FLIGHTS_SQL

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# DuckDB twin of clean_flights (CTE chain over v_flights).
CLEAN_CTES = """
cf0 AS (
  SELECT * FROM v_flights
  WHERE NOT (dep_time IS NULL AND dep_delay IS NULL AND arr_time IS NULL AND arr_delay IS NULL AND air_time IS NULL)
    AND arr_time IS NOT NULL AND arr_delay IS NOT NULL AND air_time IS NOT NULL),
cf1 AS (SELECT *, make_date(year, month, day) AS date FROM cf0),
cf2 AS (SELECT *, strftime(date, '%Y%m%d') AS date_string FROM cf1),
cf3 AS (SELECT * REPLACE (
    CASE WHEN dep_time IS NULL THEN NULL ELSE lpad(CAST(CAST(dep_time AS INTEGER) AS VARCHAR), 4, '0') END AS dep_time,
    CASE WHEN arr_time IS NULL THEN NULL ELSE lpad(CAST(CAST(arr_time AS INTEGER) AS VARCHAR), 4, '0') END AS arr_time,
    lpad(CAST(sched_dep_time AS VARCHAR), 4, '0') AS sched_dep_time,
    lpad(CAST(sched_arr_time AS VARCHAR), 4, '0') AS sched_arr_time) FROM cf2),
cf4 AS (SELECT * REPLACE (
    try_strptime(date_string || CASE WHEN dep_time = '2400' THEN '0000' ELSE dep_time END, '%Y%m%d%H%M') AS dep_time,
    try_strptime(date_string || CASE WHEN arr_time = '2400' THEN '0000' ELSE arr_time END, '%Y%m%d%H%M') AS arr_time,
    try_strptime(date_string || CASE WHEN sched_dep_time = '2400' THEN '0000' ELSE sched_dep_time END, '%Y%m%d%H%M') AS sched_dep_time,
    try_strptime(date_string || CASE WHEN sched_arr_time = '2400' THEN '0000' ELSE sched_arr_time END, '%Y%m%d%H%M') AS sched_arr_time) FROM cf3),
cf5 AS (SELECT * REPLACE (
    CASE WHEN hour(dep_time) = 0 THEN dep_time + INTERVAL 1 DAY ELSE dep_time END AS dep_time,
    CASE WHEN hour(arr_time) = 0 THEN arr_time + INTERVAL 1 DAY ELSE arr_time END AS arr_time) FROM cf4),
cf6 AS (SELECT * EXCLUDE (rn_desc, n_all) FROM (
    SELECT *, row_number() OVER (ORDER BY dep_time DESC NULLS LAST, l_orderkey DESC, l_linenumber DESC,
                                 l_partkey DESC, l_suppkey DESC) AS rn_desc,
           count(*) OVER () AS n_all FROM cf5) t WHERE n_all <= 10 OR rn_desc > 10),
cf7 AS (SELECT * REPLACE (
    last_value(wind_dir IGNORE NULLS) OVER w AS wind_dir,
    last_value(wind_speed IGNORE NULLS) OVER w AS wind_speed,
    last_value(wind_gust IGNORE NULLS) OVER w AS wind_gust) FROM cf6
  WINDOW w AS (ORDER BY dep_time ASC NULLS FIRST, l_orderkey, l_linenumber, l_partkey, l_suppkey
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
clean_flights AS (SELECT DISTINCT * FROM cf7
  WHERE dep_delay = date_diff('second', sched_dep_time, dep_time) / 60.0
    AND arr_delay = date_diff('second', sched_arr_time, arr_time) / 60.0)
"""


def with_flights(body: str, clean: bool = False, ctes: str = "") -> str:
    parts = [f"v_flights AS ({FLIGHTS_SQL})"]
    if clean:
        parts.append(CLEAN_CTES.strip())
    if ctes.strip():
        parts.append(ctes.strip().rstrip(","))
    return "WITH " + ",\n".join(parts) + "\n" + body
