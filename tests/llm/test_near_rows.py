"""Near copies by bottom-k sketches against plain classes; both dedup stages by row."""

import random

import numpy as np
import pytest

from skyframe.llm import bottomk_join as B
from skyframe.llm import ngram_join as N
from skyframe.llm.exact_dedup import drop_exact
from tests.llm.cases import clashing, documents, odd_texts
from tests.llm.test_operators import near_texts, plain_classes


@pytest.mark.parametrize("shard_sets,bucket", [(2000, 1_000_000), (3, 40)])
def test_bottomk_classes(spark, shard_sets, bucket):
    texts = near_texts()
    ids = list(range(100, 100 + len(texts)))
    got = B.near_classes(clashing(documents(spark, texts, ids)).repartition(5), shard_sets=shard_sets, bucket_values=bucket)
    rows = {tuple(r) for r in got.collect()}
    assert {r[:3] for r in rows} == plain_classes(texts, ids, percent=85)
    assert all(kept == (i == c) for i, _, c, kept in rows)


def test_bottomk_odd_texts(spark):
    texts = odd_texts()
    got = B.near_classes(documents(spark, texts))
    assert {tuple(r)[:3] for r in got.collect()} == plain_classes(texts, range(len(texts)), percent=85)
    assert B.near_classes(documents(spark, [])).collect() == []


def test_estimates_stay_near_the_similarity():
    r = np.random.default_rng(2)
    assert B.estimate_bound(85) < 0.85 * B.KEEP
    for _ in range(300):
        both, one = int(r.integers(170, 600)), int(r.integers(0, 15))
        other = int(both / 0.85) - both - one
        x = np.unique(r.integers(0, 1 << 63, both + one + max(other, 0), dtype=np.uint64))
        mark = r.permutation(len(x))
        a = np.sort(x[mark[:both + one]])
        b = np.sort(np.concatenate([x[mark[:both]], x[mark[both + one:]]]))
        if 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)):
            assert B.passes(a, b, 85)
        got = B.groups_of({1: a, 2: b}, 85)
        assert (got[1] == got[2]) == (100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)))


def test_many_candidates_are_verified_at_once(monkeypatch):
    monkeypatch.setattr(B, "FEW", 0)
    test_estimates_stay_near_the_similarity()


@pytest.mark.parametrize("classes", [N.near_classes, B.near_classes])
def test_null_ids_link(spark, classes):
    base = [f"w{i}" for i in range(60)]
    one, two = " ".join(base), " ".join(base[:59] + ["other"])
    got = {(r[0], r[2]) for r in classes(documents(spark, [one, two], [1, None])).collect()}
    assert got == {(1, 1), (None, 1)}
    got = [r[2] for r in classes(documents(spark, [one, two, one], [None, None, None])).collect()]
    assert got == [None] * 3


@pytest.mark.parametrize("drop", [N.drop_near, drop_exact])
def test_rows_that_repeat_an_id_go_one_by_one(spark, drop):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    left = drop(documents(spark, [b, a, b], [3, 5, 5])).collect()
    assert sorted((r["doc_id"], r["text"]) for r in left) == [(3, b), (5, a)]
    left = drop(documents(spark, [a, a, a, b], [7, 7, 7, None])).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left) == [(0, b), (7, a)]
    left = drop(documents(spark, [a, a, b], [None, None, None])).collect()
    assert sorted(r["text"] for r in left) == [a, b]
    empty = clashing(documents(spark, []))
    assert drop(empty).collect() == [] and drop(empty).columns == empty.columns


def test_sets_of_one_common_list_go_only_where_they_can_link(spark):
    """Templated texts that share a passage and do not link make no routes over its lists."""
    rnd = random.Random(9)
    common = [f"c{i}" for i in range(60)]
    texts = [" ".join(common + [f"x{rnd.randrange(10 ** 9)}" for _ in range(40)]) for _ in range(60)]
    texts += [texts[0] + " end", texts[33] + " end"]
    got = N.near_classes(documents(spark, texts), shard_sets=3, bucket_shingles=40)
    assert {tuple(r) for r in got.collect()} == plain_classes(texts, range(len(texts)))


def test_lists_of_a_split_block_are_joined_by_set(spark, monkeypatch):
    """Joins by node meet one row of a set, however many lists it is in."""
    made, table = {}, N._table
    monkeypatch.setattr(N, "_table", lambda spark, df, name, rows=None: made.setdefault(name, df) and table(spark, df, name, rows))
    rnd = random.Random(4)
    common = [f"c{i}" for i in range(60)]
    texts = [" ".join(common + [f"x{rnd.randrange(10 ** 9)}" for _ in range(12)]) for _ in range(30)]
    got = N.near_classes(documents(spark, texts), shard_sets=3, bucket_shingles=40)
    assert {tuple(r) for r in got.collect()} == plain_classes(texts, range(len(texts)))
    sets = made["set-lists"].collect()
    assert len(sets) == len({r["node"] for r in sets}) < sum(len(r["lists"]) for r in sets)
    for name in ("split-lists", "mine-need"):       # the lists are set out behind the join, or without one
        plan = made[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" in plan and "Join" not in plan.split("Generate")[0]
