"""Stateful streams equal their batch forms over any chunking; a restart adds nothing; state falls after expiry."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.operators import quality as Q
from skyframe.operators import text as TX
from skyframe.streaming import live as L
from skyframe.streaming import stateful as S

IMAGES = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("v", T.DoubleType())])


def images(spark, n=120, keys=7, seed=1):
    r = random.Random(seed)
    rows = [(r.randrange(keys), 1_700_000_000 + 10 * i, r.choice([None, 1.0, 2.0])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, s long, v double").select("id", F.timestamp_seconds("s").alias("ts"), "v")


def chunks(df, cuts, src):
    """``df`` in files of ascending time, cut at random places."""
    rows = sorted(df.collect(), key=lambda r: r["ts"])
    at = [0, *sorted(random.Random(cuts).sample(range(1, len(rows)), cuts)), len(rows)]
    for a, b in zip(at[:-1], at[1:]):
        df.sparkSession.createDataFrame(rows[a:b], df.schema).coalesce(1).write.mode("append").parquet(src)


def run(spark, src, schema, build, out, ck):
    stream = build(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src))
    q = (stream.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out))
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out), q


@pytest.mark.parametrize("cuts", [0, 3])
def test_change_events_stream_equals_batch_and_restarts(spark, cuts):
    df = images(spark, 60)
    src, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("st-src-", "st-out-", "st-ck-"))
    chunks(df, cuts, src)
    build = lambda s: S.change_events_stream(s, ["id"], "v", "ts")
    want = sorted(map(tuple, S.change_log_events(df, ["id"], "v", "ts").collect()), key=str)
    for _ in range(2):
        got, _ = run(spark, src, df.schema, build, out, ck)
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_state_falls_after_expiry(spark):
    rows = [(i, 1_700_000_000 + i, 1.0) for i in range(20)] + [(99, 1_700_000_000 + 9000, 1.0), (98, 1_700_000_000 + 18000, 1.0)]
    df = spark.createDataFrame(rows, "id long, s long, v double").select("id", F.timestamp_seconds("s").alias("ts"), "v")
    src, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("st-src-", "st-out-", "st-ck-"))
    for part in (df.filter("id < 50"), df.filter("id = 99"), df.filter("id = 98")):
        part.coalesce(1).write.mode("append").parquet(src)
    got, q = run(spark, src, df.schema, lambda s: S.change_events_stream(s, ["id"], "v", "ts", ttl_s=3600), out, ck)
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(totals) >= 20 and totals[-1] <= 2
    assert got.filter("event = 'NEW_FLIGHT'").count() == 22


def test_alarm_stream_equals_batch(spark):
    r = random.Random(3)
    rows = [(1_700_000_000 + 20 * i + (900 if i > 100 else 0), r.choice(["error", "ok"]), 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "s long, event_type string, value double").select(
        F.timestamp_seconds("s").alias("ts"), "event_type", "value")
    src, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("st-src-", "st-out-", "st-ck-"))
    chunks(df, 3, src)

    def build(s):
        return S.breach_alarm_stream(L.metric_windows(s, every="1 minute", watermark="0 seconds").select(
            "window_start", "events", "error_pct"), "error_pct", ">", 50.0, 2)

    got = {x["window_start"]: (x["events"], x["state"]) for x in run(spark, src, df.schema, build, out, ck)[0].collect()}
    batch = L.breach_alarm(L.metric_windows(df, every="1 minute"), "error_pct", ">", 50.0, 2).collect()
    want = {x["window_start"]: (x["events"], x["state"]) for x in batch}
    assert len(got) >= len(want) - 1 and all(want[w] == v for w, v in got.items())


def test_board_stream_equals_batch_at_every_instant(spark):
    r, base = random.Random(5), 1_700_000_000
    rows, facts = [], []
    for i in range(30):
        arrived = base + r.randrange(60)
        predicted = arrived + r.randrange(20) if r.random() < 0.7 else None
        facts.append((i, arrived, predicted))
        rows += [(i, arrived, False)] + ([(i, predicted, True)] if predicted else [])
    rows.append((1000, base + 500, False))
    df = spark.createDataFrame(rows, "id long, s long, predicted boolean").select("id", F.timestamp_seconds("s").alias("at"), "predicted")
    src, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("st-src-", "st-out-", "st-ck-"))
    ordered = df.withColumnRenamed("at", "ts")
    chunks(ordered, 2, src)
    got, _ = run(spark, src, ordered.schema, lambda s: S.board_changes_stream(s.withColumnRenamed("ts", "at")), out, ck)
    changes = spark.createDataFrame(got.collect(), got.schema)
    facts = spark.createDataFrame(facts, "id long, arrived long, predicted_at long")
    for t in (base + 10, base + 35, base + 79):
        want = [x["id"] for x in L.live_board(facts, t, n=5).collect()]
        stamp = spark.sql(f"select timestamp_seconds({t})").first()[0]
        assert [x["id"] for x in S.board_at(changes, stamp, n=5).collect()] == want


def test_sketches_of_days_add_up(spark):
    df = spark.range(0, 20000).select((F.col("id") % 5000).alias("a"), (F.col("id") % 3).cast("string").alias("b"))
    days = Q.distinct_sketches(df.filter("a < 3000")).unionByName(Q.distinct_sketches(df.filter("a >= 2000")))
    got = {r["feature"]: r["n_distinct"] for r in Q.merged_distinct(days).collect()}
    assert abs(got["a"] - 5000) < 0.08 * 5000 and got["b"] == 3
    exact = {r["feature"]: r["n_distinct"] for r in Q.profile(df).collect()}
    assert exact == {"a": 5000, "b": 3}
    assert "Expand" not in Q.profile(df, approx_distinct=True)._jdf.queryExecution().executedPlan().toString()


def test_many_queries_meet_the_corpus_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(TX, "QUERY_BLOCK", 10)
    r = random.Random(2)
    corpus = [(i, [float(r.randint(-3, 3)) for _ in range(4)]) for i in range(60)]
    asked = [(f"q{i}", [float(r.randint(-3, 3)) for _ in range(4)]) for i in range(35)]
    got = TX.top_passages(spark.createDataFrame(corpus, "vec_id long, embedding array<double>"),
                          spark.createDataFrame(asked, "query string, q array<double>"), k=3)
    want = sorted((q, p, s) for q, v in asked for s, p in
                  [(-s, p) for s, p in sorted((-sum(a * b for a, b in zip(v, w)), p) for p, w in corpus)[:3]])
    assert sorted(map(tuple, got.collect())) == want
