"""Model jobs on small inputs, explanation efficiency, and the file-stream
sources / sinks (scoring stream, consume-once, landing)."""

import math
import os
import tempfile
import time

from pyspark.sql import functions as F

from skyframe.operators import clean
from skyframe.operators import features as FE
from skyframe.operators import models as M
from skyframe.operators import sampling as S
from skyframe.plans.flights import ROW_KEYS, flights, materialise
from skyframe.sources import files as A
from skyframe.streaming import live as L
from skyframe.tables import table
from tests.conftest import SF_SMALL


def _cleaned(spark):
    """The processed table, written once: model fits read it many times."""
    return materialise(spark, "test-processed", lambda: clean.clean_flights(flights(spark, SF_SMALL)))


def test_parse_params():
    p = M.parse_params({"learning_rate": "0.09", "max_depth": "2", "booster": "gbtree", "flag": "True",
                        "n_estimators": "250"})
    assert p["eta"] == 0.09 and p["max_depth"] == 2 and p["flag"] is True and p["num_round"] == 250


def test_train_gate_and_explain_efficiency(spark):
    feats, inputs = FE.build_features(_cleaned(spark), passthrough=ROW_KEYS)
    split = S.split_3way(feats, ROW_KEYS)
    model = M.train_regressor(split.filter("split = 'train'"), inputs, params={"num_round": 5})
    gate = M.quality_gate(M.rmse(M.score_batch(model, split.filter("split = 'test'")), "dep_delay", "prediction"),
                          "<", 1e9).first()
    assert gate["passed"] and gate["rows"] > 0
    base = {c: 0.0 for c in inputs}
    test = split.filter("split = 'test'")
    local = M.explain(model, test, inputs, base, ROW_KEYS, samples=10)
    sums = local.groupBy(*ROW_KEYS).agg(F.sum("value").alias("s"))
    base_row = spark.createDataFrame([tuple(0.0 for _ in inputs)], ", ".join(f"`{c}` double" for c in inputs))
    f0 = model.transform(base_row).first()["prediction"]
    fx = model.transform(test).select(*ROW_KEYS, "prediction")
    chk = sums.join(fx, ROW_KEYS).collect()
    assert chk and all(math.isclose(r["s"], r["prediction"] - f0, abs_tol=1e-6) for r in chk)
    imp = M.split_count_importance(model, inputs)
    assert len(imp) == len(inputs) and sum(s for _, s, _ in imp) > 0


def test_tune_and_cross_validate_small(spark):
    feats, inputs = FE.build_features(_cleaned(spark), passthrough=ROW_KEYS)
    small = {"eta": (0.05, 0.1), "max_depth": (2, 3), "colsample_bytree": (0.5, 1.0), "num_round": (2, 4)}
    best, metrics = M.tune(feats, inputs[:5], max_jobs=2, parallelism=2, ranges=small)
    assert len(metrics) == 2 and all(m[1] > 0 for m in metrics)
    folds = S.kfold(feats, ROW_KEYS, k=3)
    cv = M.cross_validate(folds, inputs[:5], k=3, params={"num_round": 3}).collect()
    assert len(cv) == 4


def test_scoring_stream(spark):
    cleaned = _cleaned(spark)
    train = FE.serving_features(cleaned, passthrough=["dep_delay"])
    model = M.train_regressor(train, FE.MODEL_INPUTS, params={"num_round": 3})
    src, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("sk-live-", "sk-pred-", "sk-ck-"))
    cleaned.repartition(3).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(cleaned.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out += "/table"
    q = L.scoring_stream(stream, model, cleaned, out, ck, ROW_KEYS, part="year")
    q.awaitTermination()
    scored = spark.read.schema(cleaned.schema).parquet(out)
    assert scored.count() == cleaned.dropDuplicates(ROW_KEYS).count()
    assert scored.filter(F.col("dep_delay").isNull()).count() == 0
    # every other field of the record is kept
    rest = [c for c in cleaned.columns if c != "dep_delay"]
    assert scored.select(rest).exceptAll(cleaned.select(rest)).count() == 0


def test_consume_once_removes_files(spark):
    src, ck, got = tempfile.mkdtemp(prefix="sk-once-"), tempfile.mkdtemp(), []
    table(spark, SF_SMALL, "labels").write.mode("overwrite").option("header", True).csv(src)
    schema = table(spark, SF_SMALL, "labels").schema
    A.consume_once(spark, src, schema, ck, lambda b, i: got.append(b.count()), clean_source="delete")
    assert sum(got) == table(spark, SF_SMALL, "labels").count()
    # completed files are removed by the source's cleaner after the commit
    for _ in range(30):
        left = [f for f in os.listdir(src) if f.endswith(".csv")]
        if not left:
            break
        time.sleep(1)
    assert left == []


def test_landing_and_partitioned_read(spark):
    ev = L.as_event_time(table(spark, SF_SMALL, "events"))
    src, land, ck = tempfile.mkdtemp(prefix="sk-ev-"), tempfile.mkdtemp(prefix="sk-land-"), tempfile.mkdtemp()
    ev.write.mode("overwrite").parquet(src)
    stream = A.open_stream(spark, src, ev.schema, max_files=10, fmt="parquet")
    q = A.write_landing(stream, land, ck, interval="1 second")
    q.processAllAvailable()
    q.stop()
    back = A.read_predictions(spark, land, ev.schema)
    assert back.count() == ev.count()
    assert {"year", "month", "day", "hour"} <= set(back.columns)
    assert A.read_events(spark, land, ev.schema, compression="gzip").count() == ev.count()


def test_quarantine_output_parses_a_line_once(spark):
    lines = spark.createDataFrame([('{"a": 1, "raw": "x"}',), ('{"a": 2',), (None,), ('{"a": 1, "raw": "x"}',)], "value string")
    schema = "a int, raw string"
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(schema)
    group = "quarantine-jobs"
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    counted = lines.select(F.udf(count, "string")("value").alias("value"))
    try:
        spark.sparkContext.setJobGroup(group, "quarantine")
        good, bad = A.quarantine(counted, schema, path=tempfile.mkdtemp(prefix="sk-quar-") + "/t")
        assert sorted(map(tuple, good.collect())) == [(1, "x"), (1, "x")]
        assert sorted((r["raw"] or "") for r in bad.collect()) == ["", '{"a": 2']
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert seen.value == 4
    plain_good, plain_bad = A.quarantine(lines, schema)
    assert plain_good.schema == good.schema and plain_good.exceptAll(good).count() == 0 and plain_bad.count() == 2


def test_fixed_point_text_is_the_formatter_s(spark):
    values = [0.0, -0.0, 1.0, -1.5, 0.0000005, -0.0000005, 0.0000004, -0.0000004, 2.0000005, 1.0000015, 123456.7890125,
              -99999999999.5, 1e11, 1e15, 1e300, -1e300, float("nan"), float("inf"), -float("inf"), None, 0.1 + 0.2]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select(A._fixed_point("x", "%.6f").alias("a"), F.format_string("%.6f", "x").alias("b"))
    assert [r["a"] for r in got.collect()] == [r["b"] for r in got.collect()]
    text = "".join(got.select("a")._jdf.queryExecution().toString())
    assert "decimal(18,6)" in text


def test_upsert_sets_and_adds_with_one_join(spark, monkeypatch):
    schema = "k int, d string, x int, p double"
    path = tempfile.mkdtemp(prefix="sk-ups-") + "/t"
    first = spark.createDataFrame([(1, "a", 10, None), (2, "a", 20, 2.0), (None, "b", 30, 3.0), (5, "c", 50, 5.0)], schema)
    L.upsert_batch(first, path, ["k"], ["p"], "d")
    joins = []
    plain = type(first).join
    monkeypatch.setattr(type(first), "join", lambda self, other, *a, **k: joins.append(a[-1]) or plain(self, other, *a, **k))
    L.upsert_batch(spark.createDataFrame([(1, "a", 99, 1.5), (None, "b", 98, 3.5), (3, "a", 40, 4.0)], schema),
                   path, ["k"], ["p"], "d")
    got = sorted((tuple(r) for r in spark.read.schema(schema).parquet(path).select("k", "d", "x", "p").collect()), key=str)
    assert got == sorted([(1, "a", 10, 1.5), (2, "a", 20, 2.0), (None, "b", 30, 3.0), (3, "a", 40, 4.0), (5, "c", 50, 5.0)], key=str)
    assert joins == ["left_semi", "full_outer"]
