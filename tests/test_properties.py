"""Properties: bucketed plans equal global windows, split sizes, bias identities."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from skyframe.operators import bias as BI
from skyframe.operators import sampling as S
from skyframe.plans import ordered
from skyframe.plans.flights import ROW_KEYS, flights
from tests.conftest import SF_SMALL


def test_bucketed_forward_fill_equals_global_window(spark):
    df = flights(spark, SF_SMALL).select("l_shipdate" if False else "year", "month", "day", "wind_dir", *ROW_KEYS)
    keys = ["year", "month", "day", *ROW_KEYS]
    got = ordered.forward_fill(df, ["wind_dir"], keys[:3], ROW_KEYS, num_buckets=7)
    w = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("wind_dir", F.last("wind_dir", ignorenulls=True).over(w))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_distributed_rank_equals_row_number(spark):
    df = flights(spark, SF_SMALL).select("airline", *ROW_KEYS)
    got = ordered.with_rank(df, ["l_partkey"], group=["airline"], tie=ROW_KEYS, num_buckets=5)
    w = Window.partitionBy("airline").orderBy("l_partkey", *ROW_KEYS)
    want = df.withColumns({"row_num": F.row_number().over(w).cast("long"),
                           "group_size": F.count(F.lit(1)).over(Window.partitionBy("airline"))})
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_split_sizes_add_up(spark):
    df = flights(spark, SF_SMALL).select(*ROW_KEYS)
    n = df.count()
    counts = {r["split"]: r["count"] for r in S.split_3way(df, ROW_KEYS).groupBy("split").count().collect()}
    assert sum(counts.values()) == n
    assert (counts["train"], counts["validation"], counts["test"]) == S.split_sizes(n)
    folds = S.kfold(df, ROW_KEYS, k=10).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in folds)[-1] - sorted(r["count"] for r in folds)[0] <= 1


def test_bias_identities(spark):
    df = flights(spark, SF_SMALL)
    m = {r["metric"]: r["value"] for r in BI.bias_report(df, "carrier", ["C1", "C2", "C3"], "dep_delay").collect()}
    assert math.isclose(m["LP"], math.sqrt(2) * abs(m["DPL"]), rel_tol=1e-9)
    assert math.isclose(m["TVD"], abs(m["DPL"]), rel_tol=1e-9)
    assert math.isclose(m["KS"], abs(m["DPL"]), rel_tol=1e-9)
    assert m["KL"] >= 0 and m["JS"] >= 0


def test_bucketed_sessions_equal_session_window(spark):
    from skyframe.streaming import live as L
    from skyframe.tables import table
    ev = L.as_event_time(table(spark, SF_SMALL, "events")).select("user_id", "ts", "event_id")
    # a single hot key spread over many buckets
    hot = ev.withColumn("user_id", F.lit(1))
    for df in (ev, hot):
        got = L.session_spans(df, tie=["event_id"], num_buckets=9)
        want = (df.groupBy("user_id", F.session_window("ts", "1 hour").alias("s"))
                .agg(F.min("ts").alias("start"), F.max("ts").alias("last_active"),
                     F.count(F.lit(1)).alias("requests"))
                .select("user_id", "start", "last_active", "requests",
                        (F.unix_timestamp("last_active") + 3600).alias("expiry_time")))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_profile_approx_distinct_close(spark):
    from skyframe.operators import quality as QY
    df = flights(spark, SF_SMALL)
    ex = {r["feature"]: r["n_distinct"] for r in QY.profile(df, ["route", "tailnum", "distance"]).collect()}
    ap = {r["feature"]: r["n_distinct"] for r in QY.profile(df, ["route", "tailnum", "distance"],
                                                            approx_distinct=True).collect()}
    assert all(abs(ap[k] - ex[k]) <= 0.1 * ex[k] for k in ex)
