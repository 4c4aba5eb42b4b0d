"""The conversation trie against a plain one in memory."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm import prefix_trie as P
from tests.llm.cases import words

CONVERSATIONS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                              T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def plain(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    convs = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        convs[c] = own.get(c - c % 20, [])[:h] + ts[h:]
    members, ends = {}, {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
        ends.setdefault(tuple(ts), []).append(c)
    kids, out = {}, {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    for node in sorted(members, key=len, reverse=True):
        below = kids.get(node, [])
        saved = (len(members[node]) - 1) * (len(words(node[-1][1])) if node else 0)
        out[node] = (sum(out[k][0] for k in below) if below else 1, saved + sum(out[k][1] for k in below))
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids.get(n, [])), *out[n],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest())
                  for n, m in members.items())


def got(spark, rows, **kw):
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(3)
    out = P.prefix_trie(df.withColumns({c: F.lit(1) for c in ("c", "depth", "pos", "h1", "size", "total")}), **kw)
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert out.columns == cols
    return sorted(map(tuple, out.collect()))


def random_rows(seed, convs, longest, kinds):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(3 * convs), convs):
        for t in range(r.randint(0, longest)):
            rows.append((c, t, r.choice(["user", "bot"]), r.choice(kinds)))
    return rows


def test_forest_sums_equal_plain_sums():
    r = np.random.default_rng(5)
    for n in (1, 2, 7, 200):
        for shape in ("random", "chain", "star"):
            parent = {"random": lambda i: int(r.integers(-1, i)) if i else -1, "chain": lambda i: i - 1,
                      "star": lambda i: 0 if i else -1}[shape]
            up = np.array([parent(i) for i in range(n)])
            depth = np.zeros(n, np.int64)
            for i in range(n):
                depth[i] = depth[up[i]] + 1 if up[i] >= 0 else 0
            w = r.integers(0, 9, (n, 2))
            want = w.copy()
            for i in reversed(range(n)):
                if up[i] >= 0:
                    want[up[i]] += want[i]
            place, size = P.preorder(up, depth)
            back = np.argsort(place)
            moved = np.where(up[back] < 0, -1, place[up[back]])
            assert np.array_equal(P.centroid_sums(moved, size[back], w[back]), want[back])


@pytest.mark.parametrize("bound", [4096, 5])
def test_trie_equals_plain(spark, bound):
    rows = random_rows(1, 60, 6, ["a b", "c", "", None, "d  e\tf"])
    assert got(spark, rows, bound=bound) == plain(rows)


def test_trie_of_odd_rows(spark):
    rows = [(0, 0, "u", "hi there"), (0, 1, None, None), (0, None, "u", "first"), (1, 5, "u", "x"), (1, 5, "u", "x"),
            (1, 5, "a", "tie"), (21, 0, "u", "alone"), (22, 0, None, ""), (None, 0, "u", "nobody"), (40, 0, "u", "y " * 5000),
            (41, 0, "u", "y " * 5000), (59, 0, "u", "z")]
    assert got(spark, rows, bound=3) == plain(rows)


def test_trie_of_a_long_conversation_and_copies(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 7)
    monkeypatch.setattr(P, "CHUNK", 30)
    rows = [(20, t, "u", f"t{t % 3}") for t in range(130)]
    rows += [(c, t, "u", "same words") for c in range(100, 160) for t in range(4)]
    assert got(spark, rows, bound=8) == plain(rows)


def test_trie_of_no_rows(spark):
    assert got(spark, []) == []
