"""The fixed menu of twelve flight statistics behind the chat tool (survey
C1-C13, B19, B20, B28).

``run_named_query`` answers one ``query_type`` over the predicted flights
of a session window and returns the answer as rows of text (one row per
line). Every number is computed by a Spark aggregate; only the formatting
of the final, already aggregated rows happens in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyframe.functions.columns import equals_ignore_case
from skyframe.operators import stats
from skyframe.plans import ordered

# The supported query types and the answer texts.
QUERY_TYPES = [
    "max_delay", "min_delay", "flight_count", "flights_by_airline", "avg_delay_by_airline",
    "max_delay_airline", "min_delay_airline", "flights_by_route", "max_flights_route",
    "min_flights_route", "weather_by_route", "distance_by_route",
]
NO_DATA = ("No flight data available in your session yet. Please wait for flights to arrive "
           "and be processed by the prediction system.")
NEED_AIRLINE = "❌ Error: 'airline' parameter is required. Example: 'alaska_airlines_inc', 'horizon_air'"
NEED_ROUTE = "❌ Error: 'route' parameter is required. Example: 'SEA-SFO', 'SEA-PHX'"
UNSUPPORTED = "❌ Error: Unsupported query type '{}'. Please use a valid query_type."
NO_AIRLINE = "❌ No data found for airline '{}'."
NO_ROUTE = "❌ No data found for route '{}'."


class WindowError(ValueError):
    pass


# B20
def check_window(start: int, end: int) -> tuple[int, int]:
    if start is None or end is None or start <= 0 or end <= 0:
        raise WindowError("window bounds must be positive epoch seconds")
    if end <= start:
        raise WindowError("window end must be after its start")
    return int(start), int(end)


# B19
def in_session_window(df: DataFrame, start: int, end: int, ts="timestamp", target="dep_delay",
                      partition_key=("data_type", "FLIGHTS")) -> DataFrame:
    """Predicted rows (target not null) of the constant partition key with
    ``start <= ts <= end`` (bounds included, every page: no row limit). On
    a table with a physical stamp column the range filter reaches the
    Parquet scan as a pushed predicate."""
    start, end = check_window(start, end)
    cond = F.col(ts).between(start, end) & F.col(target).isNotNull()
    if partition_key and partition_key[0] in df.columns:
        cond = cond & (F.col(partition_key[0]) == partition_key[1])
    return df.filter(cond)


# B28 helpers
def f2(c: Column) -> Column:
    return F.format_string("%.2f", c)


def f1(c: Column) -> Column:
    return F.format_string("%.1f", c)


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def answer(df: DataFrame, query_type: str, airline: str | None = None, route: str | None = None,
           empty: bool | None = None) -> DataFrame:
    """Rows ``(line, answer)`` for one query type over already-windowed rows.
    An empty window is answered before type and parameters are looked at;
    callers that ask several questions of one window pass ``empty``."""
    spark = df.sparkSession

    def msg(text: str) -> DataFrame:
        return spark.range(1).select(F.lit(0).cast("long").alias("line"), F.lit(text).alias("answer"))

    if df.isEmpty() if empty is None else empty:
        return msg(NO_DATA)
    if query_type not in QUERY_TYPES:
        return msg(UNSUPPORTED.format(query_type))
    if query_type == "avg_delay_by_airline" and not airline:
        return msg(NEED_AIRLINE)
    if query_type in ("weather_by_route", "distance_by_route") and not route:
        return msg(NEED_ROUTE)

    def one(agg_df: DataFrame, text: Column) -> DataFrame:
        return agg_df.select(F.lit(0).cast("long").alias("line"), text.alias("answer"))

    if query_type == "max_delay":
        return one(stats.max_of(df), F.concat(F.lit("The maximum departure delay is "), f2(F.col("max_delay")), F.lit(" minutes.")))
    if query_type == "min_delay":
        return one(stats.min_of(df), F.concat(F.lit("The minimum departure delay is "), f2(F.col("min_delay")), F.lit(" minutes.")))
    if query_type == "flight_count":
        return one(stats.row_count(df), F.concat(F.lit("There are currently "), thousands(F.col("flight_count")),
                                                 F.lit(" flights in your session.")))
    if query_type in ("flights_by_airline", "flights_by_route"):
        key = "airline" if query_type == "flights_by_airline" else "route"
        k = None if key == "airline" else 10
        title = "Flight counts by airline:" if key == "airline" else "Flight counts by route (Top 10):"
        counts = stats.counts_by(df, key, "n", k=k).withColumn("_neg_n", -F.col("n"))
        if k:
            # at most k rows after the bounded top-k: a plain window numbers them
            line = F.row_number().over(Window.orderBy(F.col("_neg_n").asc(), F.col(key).asc_nulls_first()))
            ranked = counts.withColumn("line", line)
        else:
            ranked = ordered.number_rows(counts, ["_neg_n"], tie=[key], name="line")
        rows = ranked.select(
            F.col("line").cast("long").alias("line"),
            F.concat(F.lit("- "), F.col(key), F.lit(": "), thousands(F.col("n")), F.lit(" flights")).alias("answer"))
        return msg(title).unionByName(rows)
    if query_type == "avg_delay_by_airline":
        sub = df.filter(equals_ignore_case("airline", airline))
        res = sub.agg(F.avg("dep_delay").alias("a"), F.count(F.lit(1)).alias("n"))
        text = F.when(F.col("n") == 0, F.lit(NO_AIRLINE.format(airline))).otherwise(
            F.concat(F.lit(f"{airline} has an average departure delay of "), f2(F.col("a")),
                     F.lit(" minutes ("), thousands(F.col("n")), F.lit(" flights).")))
        return one(res, text)
    if query_type in ("max_delay_airline", "min_delay_airline"):
        asc = query_type == "min_delay_airline"
        top = stats.mean_by(df, "airline", "dep_delay", "a", k=1, ascending=asc)
        word = "least" if asc else "most"
        return one(top, F.concat(F.lit(f"The airline with the {word} delays is "), F.col("airline"),
                                 F.lit(" with an average delay of "), f2(F.col("a")), F.lit(" minutes.")))
    if query_type in ("max_flights_route", "min_flights_route"):
        asc = query_type == "min_flights_route"
        top = stats.counts_by(df, "route", "n", k=1, ascending=asc)
        word = "least" if asc else "most"
        return one(top, F.concat(F.lit(f"The route with the {word} flights is "), F.col("route"),
                                 F.lit(" with "), thousands(F.col("n")), F.lit(" flights.")))
    sub = df.filter(F.upper(F.col("route")) == route.upper())
    if query_type == "weather_by_route":
        res = sub.agg(F.avg("temp").alias("t"), F.avg("pressure").alias("p"), F.avg("wind_speed").alias("w"),
                      F.count(F.lit(1)).alias("n"))
        text = F.when(F.col("n") == 0, F.lit(NO_ROUTE.format(route))).otherwise(F.concat(
            F.lit(f"For route {route}, the average temperature is "), f1(F.col("t")),
            F.lit("°F, wind speed is "), f2(F.col("w")), F.lit(" mph, and pressure is "), f1(F.col("p")),
            F.lit(" hPa.")))
        return one(res, text)
    res = sub.agg(F.avg("distance").alias("d"), F.count(F.lit(1)).alias("n"))
    text = F.when(F.col("n") == 0, F.lit(NO_ROUTE.format(route))).otherwise(F.concat(
        F.lit(f"The average distance for route {route} is "), f1(F.col("d")), F.lit(" miles.")))
    return one(res, text)


# C13
def run_named_query(df: DataFrame, query_type: str, start: int, end: int, airline: str | None = None,
                    route: str | None = None, ts: str = "timestamp", empty: bool | None = None) -> DataFrame:
    """Dispatcher: validated window (B20), predicted rows inside it (B19),
    then the requested statistic as text rows. A bad window raises
    ``WindowError``; a bad type or missing parameter is an answer row."""
    return answer(in_session_window(df, start, end, ts), query_type, airline, route, empty)
