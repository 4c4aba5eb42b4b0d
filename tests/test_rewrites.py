"""Distributed rewrites checked against brute force on small fixtures:
keyed breach alarms (M10), one-scan retrieval (N4), the shared-join
profile checks (J3-J5) and the bucket-keyed cleaning dedupe (B12)."""

import datetime as dt
import random

import numpy as np

from skyframe.operators import quality as QY
from skyframe.operators import text as TX
from skyframe.plans import ordered
from skyframe.streaming import live as L


def _alarm_brute(rows, periods, threshold):
    """Sequential rule: per key, a window is ALARM when it and the
    periods - 1 windows before it (in start order) all breach."""
    out = {}
    by_key = {}
    for key, start, v in rows:
        by_key.setdefault(key, []).append((start, v))
    for key, items in by_key.items():
        items.sort()
        for i, (start, v) in enumerate(items):
            run = items[max(0, i - periods + 1): i + 1]
            ok = len(run) == periods and all(x > threshold for _, x in run)
            out[(key, start)] = "ALARM" if ok else "OK"
    return out


def test_breach_alarm_keys_gaps_and_hot_key(spark):
    rnd = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    # one hot key with most windows, small keys, a null key; missing windows
    for key, n in (("hot", 400), ("a", 7), ("b", 1), (None, 5)):
        minute = 0
        for _ in range(n):
            minute += rnd.choice([5, 5, 5, 10])
            rows.append((key, t0 + dt.timedelta(minutes=minute), rnd.choice([10.0, 40.0, 40.0])))
    df = spark.createDataFrame(rows, "k string, window_start timestamp, error_pct double")
    for periods in (1, 2, 3):
        got = {(r["k"], r["window_start"]): r["state"] for r in
               L.breach_alarm(df, "error_pct", ">", 30.0, periods, keys=["k"], num_buckets=6).collect()}
        assert got == _alarm_brute(rows, periods, 30.0)


def test_breach_alarm_columns_unchanged(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 5 * i), float(i)) for i in range(4)],
                               "window_start timestamp, v double")
    out = L.breach_alarm(df, "v", ">=", 1.0, 2)
    assert out.columns == ["window_start", "v", "breach", "state"]
    assert [r["state"] for r in out.orderBy("window_start").collect()] == ["OK", "OK", "ALARM", "ALARM"]


def test_top_passages_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    vecs = rng.normal(size=(300, 8)).astype(np.float32)
    vecs[10] = vecs[11]          # a tie: broken by the smaller id
    corpus = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)],
                                   "vec_id long, embedding array<float>")
    queries = [(q, [float(x) for x in rng.normal(size=8)]) for q in range(5)]
    queries.append((5, [float(x) for x in vecs[10].astype(np.float64)]))
    got = {}
    for r in TX.top_passages(corpus, spark.createDataFrame(queries, "query long, q array<double>"), k=3).collect():
        got.setdefault(r["query"], []).append((r["score"], r["vec_id"]))
    for qid, q in queries:
        scores = vecs.astype(np.float64) @ np.array(q)
        order = sorted(range(len(vecs)), key=lambda i: (-scores[i], i))[:3]
        assert [v for _, v in sorted(got[qid], key=lambda t: (-t[0], t[1]))] == order


def test_profile_checks_equal_single_checks(spark):
    base = spark.createDataFrame([(1, 2.0, "x"), (2, 3.0, "y"), (3, None, "z")], "a int, b double, c string")
    cur = spark.createDataFrame([(1.5, -1.0, "x"), (None, None, None), (2.0, 4.0, "q")],
                                "a double, b double, c string")
    bp, cp = QY.profile(base, distinct=False), QY.profile(cur, distinct=False)
    one = sorted(tuple(r) for r in QY.profile_checks(bp, cp).collect())
    parts = (QY.check_data_type(bp, cp).unionByName(QY.check_completeness(bp, cp))
             .unionByName(QY.check_non_negative(bp, cp)))
    assert one == sorted(tuple(r) for r in parts.collect())
    # a: integral -> fractional and 3/3 -> 2/3 complete; b: 2/3 on both
    # sides but negative now; c: 3/3 -> 2/3 complete
    assert {(r[0], r[1]) for r in one} == {("a", "data_type_check"), ("a", "completeness_check"),
                                           ("b", "non_negative_check"), ("c", "completeness_check")}
    # distinct counts are only skipped when asked
    assert all(r["n_distinct"] is None for r in bp.collect())
    assert {r["feature"]: r["n_distinct"] for r in QY.profile(base).collect()} == {"a": 3, "b": 2, "c": 3}


def test_range_buckets_are_ordered_even_and_repeatable(spark):
    rnd = random.Random(4)
    # one order value holds most rows; the tie-break splits it
    rows = [(rnd.choice([1, 2, 2, 2, 2, 2, None]), rnd.random()) for _ in range(4000)]
    df = spark.createDataFrame(rows, "o int, t double").repartition(5)
    b = ordered.range_buckets(df, ["o", "t"], 8)
    got = [(r["o"], r["t"], r[ordered.BUCKET]) for r in b.collect()]
    in_order = [x[2] for x in sorted(got, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))]
    assert in_order == sorted(in_order) and set(in_order) == set(range(8))
    sizes = [in_order.count(i) for i in range(8)]
    assert max(sizes) < 2 * min(sizes)
    # the bucket is an expression of the key: no shuffle, no copy
    assert "Exchange" not in b._jdf.queryExecution().optimizedPlan().toString()
    one = spark.createDataFrame([(3, 0.5)] * 50, "o int, t double")
    assert one.count() == ordered.range_buckets(one, ["o", "t"], 8).filter("_bucket >= 0").count()


def test_domain_share_from_shared_counts(spark):
    base = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    cur = spark.createDataFrame([("x",), ("x",), ("q",), (None,)], "c string")
    counts = QY.categorical_counts(base, cur, ["c"])
    dom = QY.check_domain(base, cur, ["c"], counts=counts).collect()[0]
    assert abs(dom["share"] - 2 / 3) < 1e-12 and dom["violation"]
    drift = QY.categorical_drift(base, cur, ["c"], counts=counts).collect()[0]
    assert abs(drift["distance"] - max(abs(1 / 2 - 2 / 3), abs(1 / 2 - 0), abs(0 - 1 / 3))) < 1e-12


def test_drop_tail_keeps_every_other_row(spark):
    rnd = random.Random(11)
    # a hot order value, nulls, identical rows, and rows that share order and tie but not the rest
    rows = [(rnd.choice([1, 2, 3, 3, 3, None]), i % 4, i) for i in range(300)] + [(9, 0, 7)] * 6 + [
        (8, 1, 100), (8, 1, 200), (8, 1, 300)]
    df = spark.createDataFrame(rows, "o int, t int, v int")
    in_order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    for n in (1, 5, 6, 7, 8, 10, 40):
        got = ordered.drop_tail(df, n, ["o"], ["t"])
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(in_order[:-n], key=repr)


def test_kde_equals_direct_sums(spark):
    import numpy as np

    from skyframe.operators import stats
    rnd = random.Random(5)
    # many rows and a long tail: the 40-bandwidth reach covers few grid points
    vals = np.array([rnd.gauss(0, 1) for _ in range(20000)] + [rnd.uniform(50, 400) for _ in range(20)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    bw = vals.std(ddof=1) * len(vals) ** -0.2
    for r in stats.kde(df, "v", points=200).collect():
        want = np.exp(-0.5 * ((vals - r["x"]) / bw) ** 2).sum() / (len(vals) * bw * np.sqrt(2 * np.pi))
        assert abs(r["density"] - want) <= 1e-9 * max(1.0, want)


def test_quantiles_with_a_value_in_most_rows(spark):
    import numpy as np

    from skyframe.operators import stats
    rnd = random.Random(23)
    rows = [("hot", 5.0)] * 900 + [("hot", rnd.random() * 10) for _ in range(100)] + [("one", 2.0), (None, 1.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    out = stats.group_quantiles(df, ["g"], "v", [0.0, 0.25, 0.5, 0.9, 1.0])
    for r in out.collect():
        v = [x for g, x in rows if g == r["g"]]
        assert np.allclose(list(r)[1:], np.quantile(v, [0.0, 0.25, 0.5, 0.9, 1.0]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # equal values are combined before the first shuffle; these counts are written and read by the plan above
    assert "partial_count" in stats.counts_by_value(df, ["g"], "v")._jdf.queryExecution().executedPlan().toString()


def test_correlations_equal_numpy(spark):
    import numpy as np

    from skyframe.operators import stats
    rng = np.random.default_rng(1)
    x = rng.normal(1e6, 1, 500)
    m = np.stack([x, x + rng.normal(0, 2, 500), rng.normal(0, 1, 500), np.full(500, 3.0)], 1)
    rows = [tuple(None if rng.random() < 0.1 and j == 2 else float(v) for j, v in enumerate(r)) for r in m]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(4)
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in stats.correlation_matrix(df, ["a", "b", "c", "d"]).collect()}
    arr = np.array([[np.nan if v is None else v for v in r] for r in rows])
    for i, p in enumerate("abc"):
        for j, q in enumerate("abc"[:i]):
            ok = ~np.isnan(arr[:, i]) & ~np.isnan(arr[:, j])
            assert abs(got[(p, q)] - np.corrcoef(arr[ok, i], arr[ok, j])[0, 1]) < 1e-9
    assert got[("d", "a")] is None


def test_cuts_of_repeated_keys_have_exact_sizes(spark):
    from skyframe.operators import sampling as S
    # most rows share one key, so every cut falls inside it
    rows = [(1, i) for i in range(700)] + [(k, 0) for k in range(2, 302)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(6)
    assert S.sample_n(df, ["k"], 0.35).count() == 350
    sizes = {r["split"]: r["count"] for r in S.split_3way(df, ["k"]).groupBy("split").count().collect()}
    assert (sizes["train"], sizes["validation"], sizes["test"]) == S.split_sizes(1000)
    folds = sorted(r["count"] for r in S.kfold(df, ["k"], k=7).groupBy("fold").count().collect())
    assert folds == [142] + [143] * 6
    assert S.kfold(df, ["k"], k=7).select("k", "v").exceptAll(df).count() == 0


def test_cut_descends_into_full_bins(spark, monkeypatch):
    from skyframe.operators import sampling as S
    monkeypatch.setattr(S, "CUT_ROWS", 3)
    monkeypatch.setattr(S, "_DIGITS", 1)
    df = spark.range(500).withColumnRenamed("id", "k")
    whole = [r["k"] for r in df.orderBy(S.seeded_hash(["k"], 42), "k").collect()]
    assert {r["k"] for r in S.sample_n(df, ["k"], 0.3).collect()} == set(whole[:150])


def test_upsampling_draws_with_replacement(spark):
    from skyframe.operators import sampling as S
    df = spark.createDataFrame([("a", i) for i in range(200)] + [("b", i) for i in range(100)] + [("c", i) for i in range(5)]
                               + [(None, 1)], "g string, k int")
    out = S.resample_groups(df, "g", {"a": 1.5, "b": 0.3, "zz": 2.0}, ["g", "k"])
    n = {r["g"]: r["count"] for r in out.groupBy("g").count().collect()}
    assert n == {"a": 300, "b": 30, "c": 5, None: 1}
    per_row = [r["count"] for r in out.filter("g = 'a'").groupBy("k").count().collect()]
    assert len(per_row) == 200 and max(per_row) > 2      # a row may be drawn more than once


def test_latest_n_first_seen_equals_brute_force(spark):
    from skyframe.operators import relational as R
    rnd = random.Random(9)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, rnd.choice([None] + list(range(40))), t0 + dt.timedelta(minutes=rnd.randrange(500)))
            for i in range(600)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp")
    first = {}
    for eid, uid, ts in rows:
        if uid not in first or ts < first[uid][0]:
            first[uid] = (ts, eid)
    newest = sorted(first.items(), key=lambda kv: (-kv[1][0].timestamp(), kv[0] is not None, kv[0] or 0))[:12]
    got = R.latest_n(df, "user_id", "ts", 12).collect()
    assert [(r["user_id"], r["ts"]) for r in got] == [(u, v[0]) for u, v in newest]
    # the kept row is one of that id's rows at its first stamp
    at = {(u, ts): set() for u, (ts, _) in first.items()}
    for eid, uid, ts in rows:
        if (uid, ts) in at:
            at[(uid, ts)].add(eid)
    assert all(r["event_id"] in at[(r["user_id"], r["ts"])] for r in got)


def test_live_board_equals_brute_force(spark):
    rnd = random.Random(13)
    rows = []
    for i in range(500):
        arrived = rnd.randrange(100)
        pred = rnd.choice([None, arrived + rnd.randrange(0, 30)])
        rows.append((i, rnd.randrange(60), arrived, pred))
    df = spark.createDataFrame(rows, "event_id long, id long, arrived long, predicted_at long")
    for as_of in (20, 60, 99):
        first = {}
        for _, k, a, p in rows:
            if a > as_of:
                continue
            cand = (a, -1 if p is None else p)
            if k not in first or cand < first[k]:
                first[k] = cand
        on = [(k, a, p) for k, (a, p) in first.items() if p == -1 or p > as_of or p + 3 > as_of]
        want = [(k, a) for k, a, _ in sorted(on, key=lambda t: (-t[1], t[0]))[:12]]
        got = L.live_board(df, as_of, n=12, linger_s=3).collect()
        assert [(r["id"], r["arrived"]) for r in got] == want
        for r in got:
            p = first[r["id"]][1]
            assert r["predicted_at"] == (None if p == -1 else p)


def test_grouped_rank_equals_brute_force(spark):
    rnd = random.Random(17)
    # a hot group across many buckets, a null group, many single-row groups
    rows = ([("hot", rnd.randrange(50), i) for i in range(400)]
            + [(None, rnd.randrange(50), 1000 + i) for i in range(30)]
            + [(f"g{i}", rnd.randrange(50), 2000 + i) for i in range(60)]
            + [("mid", 7, 3000 + i) for i in range(25)])
    df = spark.createDataFrame(rows, "g string, o int, t int")
    for nb in (1, 3, 9):
        got = {r["t"]: (r["row_num"], r["group_size"]) for r in
               ordered.with_rank(df, ["o"], group=["g"], tie=["t"], num_buckets=nb).collect()}
        by = {}
        for g, o, t in rows:
            by.setdefault(g, []).append((o, t))
        want = {}
        for g, items in by.items():
            for i, (o, t) in enumerate(sorted(items)):
                want[t] = (i + 1, len(items))
        assert got == want


def test_running_sums_equal_brute_force(spark):
    rnd = random.Random(19)
    rows = ([("hot", float(v), rnd.randrange(5)) for v in range(300)]
            + [(None, float(v), 1) for v in range(20)]
            + [(f"f{i}", float(rnd.randrange(100)) + i / 1000, 2) for i in range(40)])
    df = spark.createDataFrame(rows, "feature string, v double, nb long")
    for nb in (1, 4, 11):
        got = {(r["feature"], r["v"]): (r["cum_nb"], r["total_nb"]) for r in
               ordered.running_sums(df, "v", ["nb"], nb, group=["feature"]).collect()}
        want = {}
        for f, v, _ in rows:
            want[(f, v)] = (sum(n for g, u, n in rows if g == f and u <= v), sum(n for g, _, n in rows if g == f))
        assert got == want
