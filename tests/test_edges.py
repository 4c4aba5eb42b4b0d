"""Hand-made edge frames (FIXTURES.md §4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyframe.functions import columns as C
from skyframe.operators import clean, named_queries as NQ
from skyframe.plans import ordered
from skyframe.streaming import live as L


def test_clock_texts_and_midnight_rule(spark):
    rows = [(1, 2400.0, 2355), (2, 0.0, 5), (3, 5.0, 30), (4, 30.0, 1230), (5, 1230.0, 1200), (6, None, 100)]
    df = spark.createDataFrame(rows, "k int, dep_time double, sched_dep_time int").withColumns(
        {"year": F.lit(2022), "month": F.lit(6), "day": F.lit(29)})
    out = {r["k"]: r for r in df.withColumn("date", C.make_date_col()).withColumn("ds", C.date_key("date"))
           .withColumn("t", F.when(F.col("dep_time").isNotNull(), C.pad_hhmm("dep_time")))
           .withColumn("s", C.parse_stamp("ds", C.recode_2400("t")))
           .withColumn("r", C.roll_midnight("s")).collect()}
    assert out[1]["t"] == "2400" and out[1]["r"] == dt.datetime(2022, 6, 30, 0, 0)
    assert out[2]["r"] == dt.datetime(2022, 6, 30, 0, 0)
    assert out[3]["t"] == "0005" and out[3]["r"] == dt.datetime(2022, 6, 30, 0, 5)
    assert out[4]["r"] == dt.datetime(2022, 6, 30, 0, 30)
    assert out[5]["r"] == dt.datetime(2022, 6, 29, 12, 30)
    assert out[6]["t"] is None and out[6]["r"] is None


def test_midnight_keeps_and_drops(spark):
    # scheduled 23:55, departs 00:10 -> +1 day -> 15 minutes late: kept
    # scheduled 00:05, departs 00:10 -> departure rolled, schedule not: dropped
    rows = [(1, 10.0, 2355, 15.0, 100.0, 30, 0.0), (2, 10.0, 5, 5.0, 100.0, 30, 0.0)]
    df = spark.createDataFrame(rows, "k int, dep_time double, sched_dep_time int, dep_delay double, "
                                     "arr_time double, sched_arr_time int, arr_delay double")
    df = df.withColumns({"year": F.lit(2022), "month": F.lit(6), "day": F.lit(29)})
    kept = [r["k"] for r in clean.keep_consistent(clean.stamp_times(df).withColumn(
        "arr_delay", C.minutes_between("arr_time", "sched_arr_time"))).collect()]
    assert kept == [1]


def test_distance_codes(spark):
    df = spark.createDataFrame([(None,), (0.0,), (500.0,), (500.01,), (1000.0,), (1000.01,)], "d double")
    assert [r[0] for r in df.select(C.bin_right_closed("d")).collect()] == [-1, -1, 0, 1, 1, 2]


def test_names(spark):
    df = spark.createDataFrame([("Alaska Airlines Inc.",)], "a string")
    assert df.select(C.normalise_name("a")).first()[0] == "alaska_airlines_inc"
    from skyframe.operators.features import SERVING_AIRLINES, one_hot_fixed
    row = one_hot_fixed(df, "a").first()
    assert all(row[c] == 0 for c in SERVING_AIRLINES)


def test_forward_fill_leading_nulls_and_empty_bucket(spark):
    rows = [(i, None if i < 3 or 10 <= i < 30 else float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "o int, v double")
    out = {r["o"]: r["v"] for r in ordered.forward_fill(df, ["v"], ["o"], num_buckets=8).collect()}
    assert out[0] is None and out[2] is None and out[3] == 3.0
    assert all(out[i] == 9.0 for i in range(10, 30))
    assert out[35] == 35.0


def test_drop_tail_small_table_keeps_all(spark):
    df = spark.range(8).withColumnRenamed("id", "o")
    assert ordered.drop_tail(df, 10, ["o"]).count() == 8
    df = spark.range(25).withColumnRenamed("id", "o")
    assert sorted(r[0] for r in ordered.drop_tail(df, 10, ["o"]).collect()) == list(range(15))


def test_drop_tail_with_identical_rows(spark):
    rows = [(1,)] * 5 + [(2,)] * 12
    df = spark.createDataFrame(rows, "o int")
    out = sorted(r[0] for r in ordered.drop_tail(df, 10, ["o"]).collect())
    assert out == [1] * 5 + [2] * 2


@pytest.mark.parametrize("n,expected", [(0, "CLEAR"), (1, "INFO"), (2, "INFO"), (3, "WARNING"), (5, "WARNING"),
                                        (6, "CRITICAL")])
def test_severity(spark, n, expected):
    assert spark.range(1).select(C.alert_severity(F.lit(n))).first()[0] == expected


def test_rate_limit_edges(spark):
    base = dt.datetime(2024, 1, 1)
    times = [base + dt.timedelta(seconds=i) for i in range(21)] + [base + dt.timedelta(seconds=60)]
    df = spark.createDataFrame([(1, t, i) for i, t in enumerate(times)], "user_id int, ts timestamp, event_id int")
    out = [r["accepted"] for r in L.rate_limit(df).orderBy("event_id").collect()]
    assert out[:20] == [True] * 20 and out[20] is False and out[21] is True


def test_window_rules(spark):
    df = spark.createDataFrame([(10, 1.0), (20, 2.0), (30, None)], "timestamp long, dep_delay double")
    assert NQ.in_session_window(df, 10, 20).count() == 2
    with pytest.raises(NQ.WindowError):
        NQ.check_window(20, 20)
    with pytest.raises(NQ.WindowError):
        NQ.check_window(0, 20)
    ans = NQ.run_named_query(df.withColumn("airline", F.lit("x")), "max_delay", 100, 200).first()["answer"]
    assert ans.startswith("No flight data")
    ans = NQ.run_named_query(df.withColumn("airline", F.lit("x")), "bogus", 1, 200).first()["answer"]
    assert "Unsupported" in ans
