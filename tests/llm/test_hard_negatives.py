"""Hard negatives against a plain search over all pairs."""

import math
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm import hard_negatives as H

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                     T.StructField("label", T.IntegerType())])


def plain(rows, every=3, positives=5, negatives=3):
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows
            if i is not None and v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, lab in {(i, tuple(v), lab) for i, v, lab in kept if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in kept if j != i)
        near = [(j, -s) for s, j, other in scored if other == lab][:positives]
        for p, ps in near:
            far = [(j, -s) for s, j, other in scored if other != lab and 50 * ps <= -100 * s <= 95 * ps][:negatives]
            out += [(i, p, r + 1, j, ps, s) for r, (j, s) in enumerate(far)]
    return sorted(out)


def got(spark, rows, every=3, **kw):
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    out = H.mine(df.withColumns({c: F.lit(1) for c in ("id", "key", "score", "rank", "v")}), F.col("id") % every == 0, **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()))


def random_rows(seed, n, dim, labels, grid):
    r = random.Random(seed)
    return [(i, [r.randint(-grid, grid) / grid for _ in range(dim)], r.randrange(labels)) for i in range(n)]


def test_equals_plain_search_with_many_ties(spark, monkeypatch):
    monkeypatch.setattr(H, "TILE", 16)
    monkeypatch.setattr(H, "STRIP", 3)
    rows = random_rows(3, 130, 4, 3, 2)
    assert got(spark, rows) == plain(rows)


def test_equals_plain_search_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_ANCHORS", 7)
    monkeypatch.setattr(H, "GROUP_ROWS", 10)
    rows = random_rows(4, 90, 6, 2, 7)
    assert got(spark, rows, positives=2, negatives=4) == plain(rows, positives=2, negatives=4)


def test_odd_rows(spark):
    rows = random_rows(5, 40, 3, 2, 3)
    rows += [(100, None, 1), (101, [1.0, 2.0, 3.0], None), (102, [1.0, None, 0.5], 0), (105, [1.0, float("nan"), 0.5], 0),
             (108, [1.0, float("inf"), 0.5], 1), (None, [1.0, 1.0, 1.0], 0), (111, [0.0, 0.0, 0.0], 1), (7, [0.5, 1.0, 0.5], 1),
             (3, [0.5, 1.0, 0.5], 1), (9, [9000.0, 20000.0, 8000.0], 0), (12, [9000.0, 20000.0, 8000.0], 1)]
    assert got(spark, rows) == plain(rows)
    assert got(spark, [(i, [1.0], 5) for i in range(6)]) == []
    assert got(spark, []) == []


def test_common_part_of_vectors(spark):
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 1.0, 1.0], 1), (2, [0.5, 0.75, 9.0], 2), (4, [], 2)]
    assert got(spark, rows) == [(0, 1, 1, 2, 131072, 81920)]
