"""Registered source / sink round trips (A1-A18). Each query writes data
derived from the driver tables into a fresh folder under the shared
checkpoint folder, reads it back through the operator and aggregates it;
the SQL twin computes the same aggregate from the tables directly."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.operators import features as FE
from skyframe.plans.flights import ROW_KEYS, flights_stored, widen
from skyframe.plans.combine import side_by_side
from skyframe.plans.output import present
from skyframe.plans.q_flights import cleaned, raw
from skyframe.plans.registry import query, with_flights
from skyframe.session import ensure_session_conf, scratch_path
from skyframe.sources import files as A
from skyframe.streaming import capture as CP
from skyframe.tables import table


@query("lake_roundtrip", with_flights("""
SELECT airline, round(avg(dep_delay), 6) AS avg_dep_delay, count(*) AS flights FROM v_flights
WHERE dep_delay IS NOT NULL GROUP BY airline"""))
def q_lake(spark, sf_dir):
    """A6 partitioned lake write + A7 catalog table + A8 SQL database view."""
    path = scratch_path(spark, "lake")
    A.write_lake(raw(spark, sf_dir), path, by=("year", "month", "day"))
    A.register_table(spark, path, "flight_events")
    A.register_database(spark, "flightdb", {"flight_events": "flight_events"})
    return present(spark.sql("""SELECT airline, avg(dep_delay) AS avg_dep_delay, count(*) AS flights
                                FROM flightdb.flight_events WHERE dep_delay IS NOT NULL GROUP BY airline"""))


_AGG_SQL = """SELECT count(*) AS rows, count(dep_delay) AS with_delay, round(sum(dep_delay), 6) AS delay_sum,
       round(sum(distance), 6) AS distance_sum, count(DISTINCT route) AS routes FROM {}"""


def _agg(df):
    return present(df.agg(F.count(F.lit(1)).alias("rows"), F.count("dep_delay").alias("with_delay"),
                          F.sum("dep_delay").alias("delay_sum"), F.sum("distance").alias("distance_sum"),
                          F.countDistinct("route").alias("routes")))


@query("json_events_roundtrip", with_flights(_AGG_SQL.format("v_flights")))
def q_json(spark, sf_dir):
    """A1: gzip JSON lines in nested year folders, scanned recursively with
    an explicit schema."""
    df = raw(spark, sf_dir)
    path = scratch_path(spark, "landing")
    df.withColumn("y", F.col("year")).write.partitionBy("y").option("compression", "gzip").json(path)
    return _agg(A.read_events(spark, path, df.schema))


@query("concatenated_json", with_flights(_AGG_SQL.format("v_flights")))
def q_concat(spark, sf_dir):
    """A3: several objects per line (``{..}{..}``), one line per order."""
    ensure_session_conf(spark)
    # an order's rows meet as the stored columns; the texts are built behind that shuffle
    df = widen(flights_stored(spark, sf_dir).repartition("l_orderkey"))
    lines = df.groupBy("l_orderkey").agg(
        F.concat_ws("", F.collect_list(F.to_json(F.struct(*df.columns)))).alias("value"))
    path = scratch_path(spark, "concat")
    lines.select("value").write.option("compression", "gzip").text(path)
    good, _ = A.read_concatenated_json(spark, path, df.schema)
    return _agg(good)


@query("quarantine_split", with_flights("""
SELECT count(*) FILTER (WHERE l_linenumber <> 7) AS parsed, count(*) FILTER (WHERE l_linenumber = 7) AS quarantined,
       round(sum(dep_delay) FILTER (WHERE l_linenumber <> 7), 6) AS parsed_delay_sum FROM v_flights"""))
def q_quarantine(spark, sf_dir):
    """Unparseable records go to their own output (line 7 of each
    order is written truncated)."""
    df = raw(spark, sf_dir)
    js = F.to_json(F.struct(*df.columns))
    text = df.select(F.when(F.col("l_linenumber") == 7, F.expr("substring(to_json(struct(*)), 1, 40)"))
                     .otherwise(js).alias("value"))
    good, bad = A.quarantine(text, df.schema, path=scratch_path(spark, "quarantine"))
    g = good.agg(F.count(F.lit(1)).alias("parsed"), F.sum("dep_delay").alias("parsed_delay_sum"))
    b = bad.agg(F.count(F.lit(1)).alias("quarantined"))
    return present(side_by_side(g, b).select("parsed", "quarantined", "parsed_delay_sum"))


@query("csv_roundtrip", with_flights("""
SELECT count(*) AS rows, round(sum(dep_delay), 6) AS delay_sum, round(sum(temp), 6) AS temp_sum,
       CAST(min(dep_time) AS VARCHAR) AS first_departure, count(DISTINCT date_string) AS days FROM clean_flights""",
                                     clean=True))
def q_csv(spark, sf_dir):
    """A10 write (floats as %.6f) + A9 read with stamps parsed back."""
    df = cleaned(spark, sf_dir)
    path = scratch_path(spark, "csv")
    out = df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
                          for c in ["dep_time", "arr_time", "sched_dep_time", "sched_arr_time"]})
    A.write_csv(out, path, compression="gzip")
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name in (
        "dep_time", "arr_time", "sched_dep_time", "sched_arr_time", "date") else f.dataType) for f in df.schema.fields])
    back = A.read_sample_csv(spark, path, schema, ts_cols=["dep_time", "arr_time", "sched_dep_time", "sched_arr_time"],
                             date_cols=["date"])
    return present(back.agg(F.count(F.lit(1)).alias("rows"), F.sum("dep_delay").alias("delay_sum"),
                            F.sum("temp").alias("temp_sum"), F.min("dep_time").alias("first_departure"),
                            F.countDistinct("date_string").alias("days")))


@query("capture_prediction_range", with_flights("""
SELECT count(*) AS records_in, count(*) FILTER (WHERE l_linenumber NOT IN (6, 7)) AS records_clean,
       28 AS feature_count, round(min(dep_delay) FILTER (WHERE l_linenumber NOT IN (6, 7)), 6) AS min_prediction,
       round(max(dep_delay) FILTER (WHERE l_linenumber NOT IN (6, 7)), 6) AS max_prediction FROM clean_flights""",
                                                clean=True))
def q_capture(spark, sf_dir):
    """A11 capture files + B24 parse (wrong length and non-numeric
    predictions dropped) + C38 prediction range."""
    feats = FE.serving_features(cleaned(spark, sf_dir), passthrough=["dep_delay", "l_linenumber"])
    path = scratch_path(spark, "capture")
    # line 7 of an order is logged with a feature missing, line 6 with a non-numeric prediction
    line = F.col("l_linenumber")
    text = F.format_string("%.2f", F.col("dep_delay"))
    CP.write_capture(feats, path, FE.MODEL_INPUTS, F.when(line == 6, F.lit("n/a")).otherwise(text),
                     F.when(line == 7, len(FE.MODEL_INPUTS) - 1).otherwise(len(FE.MODEL_INPUTS)))
    parsed, _ = CP.parse_capture(A.read_capture(spark, path), FE.MODEL_INPUTS)
    return present(CP.prediction_range(A.read_capture(spark, path), parsed, len(FE.MODEL_INPUTS)))


@query("attribute_map_decode", with_flights("""
SELECT count(*) AS rows, count(dep_delay) AS with_delay, round(sum(dep_delay), 6) AS delay_sum,
       count(DISTINCT airline) AS airlines, CAST(sum(flight) AS BIGINT) AS flight_sum,
       CAST(sum(hour) AS BIGINT) AS hour_sum, count(DISTINCT dest) AS stops FROM v_flights"""))
def q_attr(spark, sf_dir):
    """Typed attribute maps (S / N / NULL, nested M and L) decoded to typed columns."""
    df = raw(spark, sf_dir).select("airline", "route", "dep_delay", "flight", F.struct("hour", "minute").alias("clock"),
                                   F.array("origin", "dest").alias("stops"))
    enc = df.select(A.encode_attribute_map(df, df.columns).alias("item"))
    dec = enc.select(A.decode_attribute_map("item", df.schema).alias("r")).select("r.*")
    return present(dec.agg(F.count(F.lit(1)).alias("rows"), F.count("dep_delay").alias("with_delay"),
                           F.sum("dep_delay").alias("delay_sum"), F.countDistinct("airline").alias("airlines"),
                           F.sum("flight").alias("flight_sum"), F.sum("clock.hour").alias("hour_sum"),
                           F.countDistinct(F.get("stops", 1)).alias("stops")))


@query("source_fallback", with_flights("""
SELECT 'with_extra' AS mode, count(*) AS rows FROM v_flights
UNION ALL SELECT 'primary_only', count(*) FROM v_flights WHERE year <= 1998"""))
def q_fallback(spark, sf_dir):
    """Extra data is unioned only when its path exists."""
    df = raw(spark, sf_dir)
    extra = scratch_path(spark, "extra")
    df.filter(F.col("year") >= 1999).write.parquet(extra)
    primary = df.filter(F.col("year") <= 1998)
    a = A.source_or_fallback(spark, primary, extra, spark.read.parquet)
    b = A.source_or_fallback(spark, primary, extra + "-missing", spark.read.parquet)
    return (a.agg(F.count(F.lit(1)).alias("rows")).withColumn("mode", F.lit("with_extra"))
            .unionByName(b.agg(F.count(F.lit(1)).alias("rows")).withColumn("mode", F.lit("primary_only"))))


@query("incremental_events", """
SELECT 1 AS run, count(*) FILTER (WHERE day(ts) <= 15) AS rows FROM events
UNION ALL SELECT 2, count(*) FILTER (WHERE day(ts) > 15) FROM events
UNION ALL SELECT 3, 0""")
def q_incremental(spark, sf_dir):
    """A2: a bookmarked file stream; each run reads only new files."""
    ensure_session_conf(spark)
    ev = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    src, out, ck = scratch_path(spark, "inc-src"), scratch_path(spark, "inc-out"), scratch_path(spark, "inc-ck")
    first, second = ev.filter(F.dayofmonth("ts") <= 15), ev.filter(F.dayofmonth("ts") > 15)

    def sink(batch, batch_id):
        batch.write.mode("append").parquet(out)

    counts = []
    for run, part in ((1, first), (2, second), (3, None)):
        before = spark.read.parquet(out).count() if run > 1 else 0
        if part is not None:
            part.write.mode("append").json(f"{src}/run={run}")
        A.read_events_incremental(spark, src, ev.schema, ck, sink)
        counts.append((run, spark.read.parquet(out).count() - before))
    return spark.createDataFrame(counts, "run int, rows long")


@query("metrics_document", with_flights("""
SELECT count(*) AS rows, round(sqrt(avg(pow(dep_delay - arr_delay, 2))), 6) AS rmse,
       sqrt(avg(pow(dep_delay - arr_delay, 2))) <= 15 AS passed FROM clean_flights""", clean=True))
def q_metrics_doc(spark, sf_dir):
    """A18 + L7 + L8: rmse and the quality gate as a JSON document."""
    from skyframe.operators import models as M
    gate = M.quality_gate(M.rmse(cleaned(spark, sf_dir), "dep_delay", "arr_delay"), "<=", 15.0)
    path = scratch_path(spark, "metrics")
    A.write_metrics(gate, path)
    back = spark.read.schema("rows long, rmse double, passed boolean").json(path)
    return present(back)


@query("table_contract", with_flights("""
SELECT count(*) AS rows, 31 AS columns, count(date) AS with_date, count(DISTINCT date_string) AS days
FROM clean_flights""", clean=True))
def q_contract(spark, sf_dir):
    """The processed table cut to its 31-column contract, in order."""
    from skyframe.operators.clean import CLEAN_FIELDS, align_to_schema
    df = align_to_schema(cleaned(spark, sf_dir), CLEAN_FIELDS)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"),
                  F.count("date").alias("with_date"), F.countDistinct("date_string").alias("days"))


@query("predictions_partitioned", with_flights("""
SELECT year, month, count(*) AS rows, round(sum(dep_delay), 6) AS delay_sum FROM clean_flights
GROUP BY year, month""", clean=True))
def q_predictions(spark, sf_dir):
    """Prediction JSON lines in year=/month=/day= folders, partition
    columns recovered from the folder names."""
    df = cleaned(spark, sf_dir).select("year", "month", "day", *ROW_KEYS, "dep_delay")
    path = scratch_path(spark, "predictions")
    df.repartitionByRange("year", "month", "day").write.partitionBy("year", "month", "day").option(
        "compression", "gzip").json(path)
    schema = T.StructType([df.schema[c] for c in [*ROW_KEYS, "dep_delay", "year", "month", "day"]])
    back = A.read_predictions(spark, path, schema)
    return present(back.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"),
                                                    F.sum("dep_delay").alias("delay_sum")))


@query("consume_once_labels", """
SELECT count(*) AS rows, count(*) FILTER (WHERE quality = 1) AS good, 0 AS files_left FROM labels""")
def q_consume_once(spark, sf_dir):
    """A retrain file is read once and removed after its batch."""
    ensure_session_conf(spark)
    lab = table(spark, sf_dir, "labels")
    src, out, ck = scratch_path(spark, "once-src"), scratch_path(spark, "once-out"), scratch_path(spark, "once-ck")
    lab.write.option("header", True).csv(src)
    A.consume_once(spark, src, lab.schema, ck, lambda b, i: b.write.mode("append").parquet(out))
    left = len(A.list_files(spark, src, ".csv"))
    got = spark.read.parquet(out)
    return got.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("quality") == 1).alias("good"),
                   F.lit(left).alias("files_left"))


@query("landing_stream", """
SELECT year(ts) AS year, month(ts) AS month, count(*) AS rows FROM events GROUP BY 1, 2""")
def q_landing(spark, sf_dir):
    """A13 + A4: events streamed in bounded batches into the gzip JSON
    landing layout (year/month/day/hour) and read back."""
    from skyframe.streaming.live import as_event_time
    ensure_session_conf(spark)
    ev = as_event_time(table(spark, sf_dir, "events"))
    src, land, ck = scratch_path(spark, "ev-src"), scratch_path(spark, "landing"), scratch_path(spark, "land-ck")
    ev.write.parquet(src)
    q = A.write_landing(A.open_stream(spark, src, ev.schema, max_files=4, fmt="parquet"), land, ck,
                        interval="1 second")
    q.processAllAvailable()
    q.stop()
    back = A.read_predictions(spark, land, ev.schema)
    return back.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"))
