"""Rules with a fixed order, crashes between steps, and inputs that arrive in pieces."""

import datetime as dt
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe import session
from skyframe.operators import features as FE
from skyframe.operators import models as M
from skyframe.operators import named_queries as NQ
from skyframe.operators import quality as QY
from skyframe.operators import text as TX
from skyframe.sources import files as A
from skyframe.streaming import live as L


def test_routing_counts_by_check_type_only(spark):
    rows = [("a", "domain_content_check"), ("b", "baseline_drift_check"), ("c", "null_check"), ("null_col", "completeness_check"),
            ("d", "data_type_check"), ("e", "non_negative_check")]
    df = spark.createDataFrame([(f, k, "") for f, k in rows], "feature_name string, constraint_check_type string, description string")
    r = QY.route_violations(df).first()
    assert (r["issues"], r["data_quality"], r["drift"], r["severity"]) == (6, 2, 1, "CRITICAL")


def test_empty_window_is_answered_first(spark):
    df = spark.createDataFrame([], "timestamp long, dep_delay double, airline string, route string, data_type string")

    def ask(*a, **k):
        return [r["answer"] for r in NQ.run_named_query(df, *a, **k).collect()]

    for question in ("avg_delay_by_airline", "weather_by_route", "no_such_query", "max_delay"):
        assert ask(question, 1, 10) == [NQ.NO_DATA]
    full = spark.createDataFrame([(5, 1.0, "A", "X-Y", "FLIGHTS")], df.schema)
    assert [r["answer"] for r in NQ.run_named_query(full, "no_such_query", 1, 10).collect()] == [
        "❌ Error: Unsupported query type 'no_such_query'. Please use a valid query_type."]
    assert [r["answer"] for r in NQ.run_named_query(full, "avg_delay_by_airline", 1, 10).collect()] == [NQ.NEED_AIRLINE]


def test_session_window_bites_at_both_bounds(spark):
    df = spark.createDataFrame([(i, 1.0, "FLIGHTS") for i in range(10)] + [(5, None, "FLIGHTS"), (5, 1.0, "OTHER")],
                               "timestamp long, dep_delay double, data_type string")
    assert sorted(r["timestamp"] for r in NQ.in_session_window(df, 3, 6).collect()) == [3, 4, 5, 6]


def test_concatenated_json_with_braces_in_text(spark):
    path = tempfile.mkdtemp(prefix="sk-cat-")
    objects = [{"a": 1, "t": "x}{y"}, {"a": 2, "t": 'q"}{"'}, {"a": 3, "t": ""}]
    with open(os.path.join(path, "f.txt"), "w") as f:
        f.write("".join(json.dumps(o) for o in objects) + "\n" + '{"a": 4, "t": "z"} {"a": 5, "t":\n' + "\n" + '{"a": "no"}\n')
    good, bad = A.read_concatenated_json(spark, path, T.StructType.fromDDL("a int, t string"))
    assert sorted((r["a"], r["t"]) for r in good.collect()) == [(1, "x}{y"), (2, 'q"}{"'), (3, ""), (4, "z")]
    assert sorted(r["raw"] for r in bad.collect()) == ['{"a": "no"}', '{"a": 5, "t":']


def test_nested_attribute_maps(spark):
    schema = "id int, ok boolean, at struct<x:double,name:string>, tags array<string>, deep array<struct<n:int>>"
    rows = [(1, True, (1.5, 'a"b'), ["p", None], [(1,), (None,)]), (2, None, None, None, []), (None, False, (None, None), [], None)]
    df = spark.createDataFrame(rows, schema)
    back = df.select(A.encode_attribute_map(df, df.columns).alias("item")).select(
        A.decode_attribute_map("item", df.schema).alias("r")).select("r.*")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_files_of_an_uncommitted_batch_survive(spark):
    src, ck, out = (tempfile.mkdtemp(prefix=p) for p in ("sk-src-", "sk-ck-", "sk-out-"))
    ck, out = ck + "/c", out + "/o"
    spark.range(10).select(F.col("id").cast("int")).coalesce(2).write.mode("append").option("header", True).csv(src)
    schema = T.StructType.fromDDL("id int")
    calls = []

    def crash(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/{batch_id}")
        calls.append(batch_id)
        raise RuntimeError("lost after the sink, before the commit")

    with pytest.raises(Exception):
        A.consume_once(spark, src, schema, ck, crash)
    assert calls and any(f.endswith(".csv") for f in os.listdir(src))
    A.consume_once(spark, src, schema, ck, lambda b, i: b.write.mode("overwrite").parquet(f"{out}/{i}"))
    got = [r["id"] for r in spark.read.option("recursiveFileLookup", True).parquet(out).collect()]
    assert sorted(got) == list(range(10)) and not any(f.endswith(".csv") for f in os.listdir(src))


def _requests(spark, seconds, key="u"):
    t0 = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(key, t0 + dt.timedelta(seconds=s), f"r{i:04d}") for i, s in enumerate(seconds)],
                                 "user_id string, ts timestamp, event_id string")


def test_stream_limit_does_not_depend_on_chunks(spark):
    seconds = list(range(11, -1, -1))              # one file, newest first
    df = _requests(spark, seconds)
    src = tempfile.mkdtemp(prefix="sk-rl-")
    df.coalesce(1).write.mode("overwrite").parquet(src)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        q = (L.rate_limit_stream(spark.readStream.schema(df.schema).parquet(src), limit=3).writeStream.outputMode("append")
             .format("memory").queryName("rl_chunks").option("checkpointLocation", tempfile.mkdtemp())
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {r["event_id"] for r in spark.table("rl_chunks").filter("accepted").collect()}
    assert got == {"r0009", "r0010", "r0011"}


@pytest.mark.parametrize("login", [None, -30])
def test_limit_with_text_ids_and_login(spark, login):
    rnd = random.Random(3)
    seconds = sorted(rnd.uniform(0, 600) for _ in range(120))
    df = _requests(spark, seconds)
    start0 = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    starts = None if login is None else spark.createDataFrame([("u", start0 + login)], "user_id string, start long")
    got = {r["event_id"]: r["accepted"] for r in L.rate_limit(df, limit=5, window_s=60, starts=starts).collect()}
    begin, count = (seconds[0] if login is None else login), 0
    for i, s in enumerate(seconds):
        if s >= begin + 60:
            begin, count = s, 0
        assert got[f"r{i:04d}"] == (count < 5)
        count += count < 5
    assert not all(got.values())


def test_upsert_adds_sets_and_replays(spark):
    schema = "k int, y int, a string, p double"
    old = spark.createDataFrame([(i, 1990 + i % 3, f"a{i}", None) for i in range(9)], schema)
    new = spark.createDataFrame([(i, 1990 + i % 3, f"a{i}", 1.0) for i in range(6, 14) if i % 3], schema)
    path = tempfile.mkdtemp(prefix="sk-up-") + "/t"
    L.upsert_batch(old, path, ["k"], ["p"], "y")
    want = sorted([(i, 1990 + i % 3, f"a{i}", 1.0 if i >= 6 and i % 3 else None) for i in range(9)]
                  + [(i, 1990 + i % 3, f"a{i}", 1.0) for i in range(9, 14) if i % 3])
    for _ in range(2):
        L.upsert_batch(new, path, ["k"], ["p"], "y")
        got = spark.read.schema(old.schema).parquet(path).select("k", "y", "a", "p")
        assert sorted(map(tuple, got.collect())) == want


def test_newest_on_equal_stamps_is_the_smallest_row(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, t, "b"), (1, t, "a"), (2, t, "d"), (2, t, "c")]
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "id int, ts timestamp, v string").repartition(3)
        assert {r["v"] for r in L.dedupe_stream(df, "id").collect()} == {"a", "c"}


def test_early_stop_waits_for_patience():
    assert M.best_round([5, 4, 4.5, 4.4, 3, 3.5], patience=3) == 5
    assert M.best_round([5, 4] + [4.5] * 9 + [1], patience=10) == 12
    assert M.best_round([5, 4] + [4.5] * 10 + [1], patience=10) == 2
    assert M.best_round([3]) == 1


def test_history_events_explode(spark):
    schema = ("session_id string, eventId string, eventTimestamp long, payload array<struct<conversational:"
              "struct<role:string,content:struct<text:string>>>>")
    rows = [("s", "e1", 5, [(("USER", ("hi",)),), (None,), (("ASSISTANT", ("",)),), (("ASSISTANT", ("yes",)),)]),
            ("s", "e2", 6, []), ("t", "e3", 1, None)]
    got = TX.explode_events(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["eventId"], r["part"], r["role"], r["text"]) for r in got) == [("e1", 0, "USER", "hi"), ("e1", 3, "ASSISTANT", "yes")]


def test_lookup_beyond_the_broadcast_bound(spark, monkeypatch):
    df = spark.createDataFrame([(i % 5 or None, i) for i in range(50)], "k int, v int")
    near = FE.group_transform(df, "k", "v", "sum", "s").collect()
    monkeypatch.setattr(FE, "BROADCAST_ROWS", 1)
    assert sorted(map(str, FE.group_transform(df, "k", "v", "sum", "s").collect())) == sorted(map(str, near))


def test_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())


def test_scratch_can_be_dropped(spark):
    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    kept, session._SCRATCH[:] = [p for p in session._SCRATCH if p != path], [path]
    assert session.drop_scratch(spark) == 1 and not A.path_exists(spark, path)
    session._SCRATCH[:] = kept
