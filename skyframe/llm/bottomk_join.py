"""Near duplicates by bottom-k sketches of one hash function.

A document's sketch holds the ``KEEP`` smallest hashes of its shingle set,
or the whole set when it has no more. Of the ``KEEP`` smallest hashes of a
union, the share that lies in both sets estimates their similarity, and all
of those lie in both sketches. So sets at the threshold share ``least``
retained values or more: for whole sets that is exact, for longer ones a
Chernoff bound makes a miss rarer than ``MISS`` for a pair.

1. Sketches. One pass writes each row's sketch; counts of the retained values
   (a table of fixed size) order them from rare to frequent.
2. Inverted lists. Sketches with ``least`` values in common share some of
   their rarest ones. Lists of those values, dealt to buckets by hash, give
   the overlaps; sketches that share too few have no link. The lists connect
   the rest to blocks, which are put into shards of bounded size.
3. Search. In a shard the lists of all retained values count the overlaps of
   a set with those before it. Where an overlap reaches ``least``, the union
   of the two sketches estimates the similarity; what passes is verified on
   the full sets. One link to a group is enough.
4. Blocks larger than a shard are split, and sets go to the other shards in
   which they may still have a link to another component.

Equal sets are one node from the start. Pairs are never listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm.ngram_join import (
    _FLUSH, _PART, PACKED, SKETCH, _classes, _lists, _sum_sketch, _table, least_overlap, least_overlap_col, link_members,
    pack_prefixes, set_classes, shingle_sets, signature, with_row_key)
from skyframe.llm.texts import ragged, slices
from skyframe.session import scratch_path

#: Retained values of a set, and the chance that a pair at the threshold is missed.
KEEP = 64
MISS = 1e-9


def estimate_bound(percent: int, keep: int = KEEP, miss: float = MISS) -> int:
    """Of ``keep`` values of a union, how many lie in both sets of a pair at the threshold, but for a chance of ``miss``."""
    t = percent / 100

    def unlikely(m: int) -> bool:
        q = m / keep
        gap = (q * math.log(q / t) if q else 0.0) + ((1 - q) * math.log((1 - q) / (1 - t)) if q < 1 else 0.0)
        return keep * gap >= -math.log(miss)

    if percent >= 100:
        return keep
    return 1 + max((m for m in range(int(t * keep) + 1) if unlikely(m)), default=-1)


def least(n, percent: int, keep: int = KEEP):
    """Retained values that a set of n shares with any set it links to."""
    exact = least_overlap(n, percent)
    return np.where(100 * np.asarray(n) < percent * keep, exact, np.minimum(exact, estimate_bound(percent, keep)))


def _sketches(docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(id, row, n, node, sketch) of every row, and the parts of every task's counts of retained values."""
    spark = docs.sparkSession
    schema = T.StructType([docs.schema["id"], T.StructField("row", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("node", T.LongType()), T.StructField("sketch", T.BinaryType()),
                           T.StructField("part", T.IntegerType()), T.StructField("counts", T.BinaryType()),
                           T.StructField("kind", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, id_type = np.zeros(SKETCH, np.uint32), None
        for batch in batches:
            id_type = batch.schema.field("id").type
            for piece in slices(batch, "text"):
                sets = shingle_sets(piece.column("text"), k)
                m = len(sets)
                kept = [s[:KEEP] for s in sets]
                if m:
                    slot = (np.concatenate(kept) & np.uint64(SKETCH - 1)).astype(np.int64)
                    np.add.at(counts, slot, np.uint32(1))
                yield pa.RecordBatch.from_arrays([
                    piece.column("id"), piece.column("row"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([signature(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in kept], pa.binary()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()),
                    pa.array(np.zeros(m, np.int32))], names=schema.names)
        if id_type is not None:
            m = SKETCH // _PART
            yield pa.RecordBatch.from_arrays([
                pa.nulls(m, id_type), *[pa.nulls(m, pa.int64())] * 3, pa.nulls(m, pa.binary()),
                pa.array(range(m), pa.int32()),
                pa.array([counts[p * _PART:(p + 1) * _PART].astype("<u8").tobytes() for p in range(m)], pa.binary()),
                pa.array(np.ones(m, np.int32))], names=schema.names)

    path = scratch_path(spark, "bottom-k")
    docs.mapInArrow(run, schema).write.partitionBy("kind").parquet(path)
    rows = spark.read.schema(schema).parquet(path)
    return rows.filter("kind = 0").select("id", "row", "n", "node", "sketch"), rows.filter("kind = 1").select("part", "counts")


def _rare_values(rows: DataFrame, order: np.ndarray, percent: int, buckets: int, hot: int) -> DataFrame:
    """Packed rarest retained values of every sketch: one row per bucket and merged run of rows."""
    shared = rows.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value
        runs, held, seen, salt = [], 0, set(), TaskContext.get().partitionId()
        for batch in batches:
            for node, n, sketch in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "sketch"))):
                if node in seen:
                    continue
                seen.add(node)
                s = np.frombuffer(sketch, np.uint64)
                need = int(least(n, percent))
                count = rank[(s & np.uint64(SKETCH - 1)).astype(np.int64)]
                o = np.argsort(count, kind="stable")[:len(s) - need + 1 + need // 8]
                runs.append((s[o], np.full(len(o), node, "<i8"), np.full(len(o), n, "<i4"), count[o] >= hot))
                held += len(o)
                if held > _FLUSH:
                    yield pack_prefixes(runs, buckets, salt)
                    runs, held, seen, salt = [], 0, set(), salt + 1
        if runs:
            yield pack_prefixes(runs, buckets, salt)

    return rows.filter("n > 0").select("node", "n", "sketch").mapInArrow(run, PACKED)


def estimate(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(values in both, values) among the KEEP smallest of the union of two sketches."""
    values, count = np.unique(np.concatenate([a, b]), return_counts=True)
    return int((count[:KEEP] == 2).sum()), min(len(values), KEEP)


def passes(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether the estimate from two sets' sketches leaves room for a link."""
    both, of = estimate(x[:KEEP], y[:KEEP])
    return both >= min(estimate_bound(percent), least_overlap(of, percent))


class Lists:
    """Inverted lists of the first ``keep`` values of some sets (of all values without it)."""

    def __init__(self, sets: list[np.ndarray], keep: int | None = None):
        cut = [s[:keep] for s in sets]
        values = np.concatenate(cut) if cut else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in cut])
        order = np.argsort(values, kind="stable")
        self.owner, self.n = owner[order], len(sets)
        self.values, self.start = np.unique(values[order], return_index=True)
        self.count = np.diff(np.append(self.start, len(order)))

    def overlaps(self, values: np.ndarray) -> np.ndarray:
        """How many of the ascending values each set holds."""
        at = np.searchsorted(self.values, values)
        inside = at < len(self.values)
        at = at[inside][self.values[at[inside]] == values[inside]]
        return np.bincount(self.owner[ragged(self.start[at], self.count[at])], minlength=self.n)


#: Candidates of one set up to which each is estimated; more are verified at once by the lists of whole sets.
FEW = 200


class Search:
    """Sets of one shard with their groups: retained lists for overlaps, whole lists for the exact check."""

    def __init__(self, sets: list[np.ndarray], searched: int, percent: int):
        self.sets, self.percent, self.size = sets, percent, np.array([len(s) for s in sets], np.int64)
        self.retained, self.searched = Lists(sets[:searched], KEEP), searched
        self.whole: Lists | None = None
        self.group = np.arange(len(sets))

    def join(self, i: int, j: int) -> None:
        a, b = sorted((self.group[i], self.group[j]))
        if a != b:
            self.group[self.group == b] = a

    def link(self, i: int, upto: int) -> list[int]:
        """Join set i with the group of every set before ``upto`` that it links to; one set of each such group."""
        x = self.sets[i]
        near = np.flatnonzero(self.retained.overlaps(x[:KEEP])[:upto] >= int(least(len(x), self.percent)))
        near = near[self.group[near] != self.group[i]]
        small, large = np.minimum(self.size[near], len(x)), np.maximum(self.size[near], len(x))
        near = near[100 * small >= self.percent * large]
        if len(near) <= FEW:
            near = near[[passes(x, self.sets[j], self.percent) for j in near.tolist()]] if len(near) else near
        if not len(near):
            return []
        if self.whole is None:
            self.whole = Lists(self.sets[:self.searched])
        both = self.whole.overlaps(x)[near]
        near = near[100 * both >= self.percent * (self.size[near] + len(x) - both)]
        near = near[np.unique(self.group[near], return_index=True)[1]]
        for j in near.tolist():
            self.join(i, j)
        return near.tolist()


def groups_of(sets: dict[int, np.ndarray], percent: int) -> dict[int, int]:
    """The group of every set, after a search of each among those before it."""
    nodes = sorted(sets, key=lambda v: (len(sets[v]), v))
    search = Search([sets[v] for v in nodes], len(nodes), percent)
    for i in range(len(nodes)):
        search.link(i, i)
    return dict(zip(nodes, search.group.tolist()))


def links_of(here: dict, sent: dict, comp: dict, percent: int) -> list[tuple[int, int]]:
    """Components (``comp`` by node) that a sent set and one that lies here link."""
    nodes = sorted(here) + sorted(sent)
    search, first, edges = Search([*map(here.get, sorted(here)), *map(sent.get, sorted(sent))], len(here), percent), {}, []
    search.group = np.array([first.setdefault(comp[v], i) for i, v in enumerate(nodes)])
    for i in range(len(here), len(nodes)):
        edges += [(comp[nodes[i]], comp[nodes[j]]) for j in search.link(i, len(here))]
    return edges


def near_classes(docs: DataFrame, k: int = 5, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
                 shard_sets: int = 2000, bucket_values: int = 1_000_000) -> DataFrame:
    """``id_col``, n_shingles, component_id, kept: one row for each row of ``docs``.

    Two documents link when 100 * intersection >= ``percent`` * union of
    their sets of ``k``-word shingles; component_id is the smallest id that
    links reach, and ``kept`` says whether it is the row's own. Links are
    verified on full sets; one between two sets of more than ``KEEP``
    shingles is missed with a chance below ``MISS``.

    Null, empty and blank texts have no shingles, link with nothing and are
    their own component. Equal sets link. Rows that repeat an id are separate
    rows with the same id. A null id is never the smallest (a component of
    null ids alone has a null component_id, and its rows are kept). An empty
    table gives an empty result. Other columns are neither read nor kept.
    """
    spark = docs.sparkSession
    docs = with_row_key(docs, id_col, text_col)
    rows, counts = _sketches(docs, k)
    classes = _table(spark, set_classes(rows), "nodes")
    order = _sum_sketch(counts)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, int(order.sum()) // bucket_values + 1)
    packed = _rare_values(rows, order, percent, buckets, max(bucket_values // 4, 2))
    members = _table(spark, _lists(packed, percent), "lists")
    # the least that a set of n and any set it links to share of their rarest values
    smallest = least_overlap_col(least_overlap_col(F.col("n"), percent), percent)
    need = F.floor(F.least(smallest, F.lit(estimate_bound(percent))) / 8) + 1
    links = link_members(docs, classes, members, need, k, percent, shard_sets, groups_of, links_of)
    out = _classes(spark, rows.drop("sketch"), classes, links)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
