"""Near duplicates: exact Jaccard join of word n-gram sets by T-occurrence search.

A text's set holds the 64-bit hashes of its distinct ``k``-word shingles.
Equal sets are one node from the start, so copies cost one row each. A pair
with similarity t or more shares at least T(n) = ceil(t * n) shingles of the
set with n of them, which gives, step by step:

1. Order. A count sketch of fixed size over all texts orders shingles from
   rare to frequent; any order that is the same everywhere is valid.
2. Prefixes. Two linked sets share ``j`` shingles of their first
   n - T(n) + j. Those prefixes are dealt to buckets by hash, in packed rows
   that a task has merged first; a bucket returns its lists of two nodes or
   more. Shingles of which the sketch counts very many go past the buckets
   and get a node of their own instead, so no bucket grows with one shingle.
3. Survivors. Nodes with too few shared prefix shingles have no link. The
   lists connect the others to blocks; no link leaves a block. Blocks are
   put into shards of bounded size; a larger block is split.
4. Search. In a shard, an inverted index maps shingles to the groups found
   so far. For each set DivideSkip finds the groups that hold T of its
   shingles: identical short lists are merged by a heap, long ones probed by
   binary search. Members of those groups are checked exactly, until one links.
5. Split blocks. Groups that still lie apart in different shards are joined
   by searching one set of each group in the first shard of its lists, then
   every set in each other shard with which it shares a list and no group.

Links become classes by connected components; pairs of copies or of members
of the same class are never listed.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm.bitmaps import flag_members, keep_rows
from skyframe.llm.components import components, few_tasks
from skyframe.llm.texts import buffers, lower, mix, slices, spans_hash, window_positions, windows_hash, words
from skyframe.session import scratch_path

SKETCH = 1 << 20  # counters of the order sketch
_PART = 1 << 14
_FLUSH = 1_000_000  # prefix shingles a task merges before it hands them on


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (A-Z lower-cased); a text of fewer than k words is one shingle."""
    buf, off = buffers(column)
    buf = lower(buf)
    starts, ends, first = words(buf, off)
    h = spans_hash(buf, starts, ends)
    windows, (at, text) = windows_hash(h, k), window_positions(first, k)
    edge = np.searchsorted(text, np.arange(len(off)))
    flat = windows[at]
    count = np.diff(first)
    short = {n: mix(windows_hash(h, n) + np.uint64(n)) for n in range(1, k) if (count == n).any()}
    out = []
    for i in range(len(off) - 1):
        n = int(count[i])
        if n >= k:
            out.append(np.unique(flat[edge[i]:edge[i + 1]]))
        elif n:
            out.append(short[n][first[i]:first[i] + 1])
        else:
            out.append(flat[:0])
    return out


def signature(s: np.ndarray) -> int:
    """64-bit hash of a set, as a signed number."""
    return int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64))


def least_overlap(n, percent: int):
    return (percent * n + 99) // 100


def _spare(n, percent: int):
    """Prefix shingles beyond the first that a link must share."""
    return least_overlap(n, percent) // 8


def _table(spark: SparkSession, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written and read again; a narrow one of at most ``rows`` rows by few tasks."""
    path = scratch_path(spark, name)
    (df if rows is None else few_tasks(df, rows)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _profile(docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(id, row, n, node) of every row, and the parts of every task's sketch."""
    spark = docs.sparkSession
    schema = T.StructType([docs.schema["id"], T.StructField("row", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("node", T.LongType()),
                           T.StructField("part", T.IntegerType()), T.StructField("counts", T.BinaryType()),
                           T.StructField("kind", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.uint32)
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("id").type
            for piece in slices(batch, "text"):
                sets = shingle_sets(piece.column("text"), k)
                m = len(sets)
                if m:
                    slot = np.concatenate(sets) & np.uint64(SKETCH - 1)
                    sketch += np.bincount(slot.astype(np.int64), minlength=SKETCH).astype(np.uint32)
                yield pa.RecordBatch.from_arrays([
                    piece.column("id"), piece.column("row"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([signature(s) for s in sets], pa.int64()), pa.nulls(m, pa.int32()),
                    pa.nulls(m, pa.binary()), pa.array(np.zeros(m, np.int32))], names=schema.names)
        if id_type is not None:
            parts = range(SKETCH // _PART)
            m = len(parts)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(m, id_type), *[pa.nulls(m, pa.int64())] * 3, pa.array(parts, pa.int32()),
                pa.array([sketch[p * _PART:(p + 1) * _PART].astype("<u8").tobytes() for p in parts], pa.binary()),
                pa.array(np.ones(m, np.int32))], names=schema.names)

    path = scratch_path(spark, "shingle-profile")
    docs.mapInArrow(run, schema).write.partitionBy("kind").parquet(path)
    rows = spark.read.schema(schema).parquet(path)
    return rows.filter("kind = 0").select("id", "row", "n", "node"), rows.filter("kind = 1").select("part", "counts")


def _sum_sketch(parts: DataFrame) -> np.ndarray:
    """Sums of the tasks' sketches: merged where they are read, then by part; SKETCH counters reach the driver."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for p, c in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                c = np.frombuffer(c, "<u8")
                total[p] = total[p] + c if p in total else c
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                          pa.array([c.tobytes() for c in total.values()], pa.binary())],
                                         names=["part", "counts"])

    schema = "part int, counts binary"
    got = parts.mapInArrow(merge, schema).repartition("part").mapInArrow(merge, schema).collect()
    out = np.zeros(SKETCH, np.int64)
    for part, counts in got:
        out[part * _PART:(part + 1) * _PART] = np.frombuffer(counts, "<u8").astype(np.int64)
    return out


PACKED = "bucket int, hot boolean, nodes binary, sizes binary, counts binary, shingles binary"


def pack_prefixes(runs: list, buckets: int, salt: int) -> pa.RecordBatch:
    """One row per bucket of runs (shingles, nodes, sizes, hot); hot shingles are spread by ``salt``."""
    h = np.concatenate([r[0] for r in runs])
    node = np.concatenate([r[1] for r in runs])
    size = np.concatenate([r[2] for r in runs])
    often = np.concatenate([r[3] for r in runs])
    bucket = ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    bucket = np.where(often, (bucket + salt) % buckets, bucket) * 2 + often
    o = np.lexsort((node, bucket))
    h, node, size, bucket = h[o], node[o], size[o], bucket[o]
    head = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (node[1:] != node[:-1])]))
    count = np.diff(np.append(head, len(h))).astype("<u4")
    of = bucket[head]
    cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]]))
    low = np.append(head, len(h))
    rows = [(int(of[a]) >> 1, bool(of[a] & 1), node[head[a:b]].tobytes(), size[head[a:b]].tobytes(),
             count[a:b].tobytes(), h[low[a]:low[b]].tobytes() if of[a] & 1 else
             (h[low[a]:low[b]] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes())
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
    cols = list(zip(*rows))
    kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)],
                                      names=["bucket", "hot", "nodes", "sizes", "counts", "shingles"])


def _prefixes(docs: DataFrame, order: np.ndarray, k: int, percent: int, buckets: int, hot: int) -> DataFrame:
    """Packed prefix shingles: one row per bucket and merged run of texts; shingles counted ``hot`` times or more apart."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value
        runs, held, seen, salt = [], 0, set(), TaskContext.get().partitionId()
        for batch in batches:
            for piece in slices(batch, "text"):
                for s in shingle_sets(piece.column("text"), k):
                    n = len(s)
                    node = signature(s) if n else 0
                    if not n or node in seen:
                        continue
                    seen.add(node)
                    count = rank[(s & np.uint64(SKETCH - 1)).astype(np.int64)]
                    m = n - least_overlap(n, percent) + 1 + _spare(n, percent)
                    o = np.argsort(count, kind="stable")[:m]
                    runs.append((s[o], np.full(len(o), node, "<i8"), np.full(len(o), n, "<i4"), count[o] >= hot))
                    held += len(o)
                if held > _FLUSH:
                    yield pack_prefixes(runs, buckets, salt)
                    runs, held, seen, salt = [], 0, set(), salt + 1
        if runs:
            yield pack_prefixes(runs, buckets, salt)

    return docs.select("text").mapInArrow(run, PACKED)


def _lists(packed: DataFrame, percent: int) -> DataFrame:
    """list, node, n, low: the members of each prefix shingle's list, with the node the list is hung on."""
    names = ["list", "node", "n", "low"]

    def meet(table: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        bucket = table.column("bucket")[0].as_py()
        hs, nodes, sizes = [], [], []
        for hot, node, size, count, shingle in zip(*(table.column(c).to_pylist() for c in (
                "hot", "nodes", "sizes", "counts", "shingles"))):
            count = np.frombuffer(count, "<u4")
            node = np.repeat(np.frombuffer(node, "<i8"), count)
            size = np.repeat(np.frombuffer(size, "<i4"), count)
            if hot:
                own = -(np.frombuffer(shingle, "<u8") >> np.uint64(1)).astype(np.int64) - 1
                for x, v in zip(out, (own, node, size, own)):
                    x.append(v.astype(np.int64))
            else:
                hs.append(np.frombuffer(shingle, "<u4"))
                nodes.append(node)
                sizes.append(size)
        if hs:
            h, node, size = np.concatenate(hs), np.concatenate(nodes), np.concatenate(sizes).astype(np.int64)
            o = np.lexsort((node, size, h))
            h, node, size = h[o], node[o], size[o]
            same = np.concatenate([[False], (h[1:] == h[:-1]) & (node[1:] == node[:-1])])
            h, node, size = h[~same], node[~same], size[~same]
            # sizes too far apart for a link end a list
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (100 * size[:-1] < percent * size[1:])])
            head = np.flatnonzero(new)
            length = np.diff(np.append(head, len(h)))
            number = np.repeat((bucket << 40) + np.arange(len(head)), length)
            low = np.repeat(np.minimum.reduceat(node, head), length)
            keep = np.repeat(length > 1, length)
            for x, v in zip(out, (number, node, size, low)):
                x.append(v[keep])
        cols = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
        return pa.table([pa.array(c) for c in cols], names=names)

    return packed.groupBy("bucket").applyInArrow(meet, "list long, node long, n long, low long")


def divide_skip(lists: list[list[int]], need: int) -> list[int]:
    """Values that occur in at least ``need`` of the ascending lists.

    Equal lists are taken together with a weight. The longest lists are set
    aside as long as they cannot reach ``need`` alone; the others are merged
    with a heap, and what the merge leaves possible is looked up in the long
    lists by binary search.
    """
    if len(lists) < need:
        return []
    groups = sorted(Counter(map(tuple, lists)).items(), key=lambda g: -len(g[0]))
    budget = min(need - 1, need / (0.0085 * max(len(groups[0][0]), 2).bit_length() + 1))
    aside, split = 0, 0
    while split < len(groups) - 1 and len(groups[split][0]) > 1 and aside + groups[split][1] <= budget:
        aside += groups[split][1]
        split += 1
    long, short = groups[:split], groups[split:]
    out = []

    def settle(value: int, weight: int) -> None:
        if weight < need - aside:
            return
        for postings, w in long:
            if weight >= need:
                break
            i = bisect_left(postings, value)
            if i < len(postings) and postings[i] == value:
                weight += w
        if weight >= need:
            out.append(value)

    last, total = None, 0
    for value, w in heapq.merge(*([(v, w) for v in postings] for postings, w in short)):
        if value != last:
            if last is not None:
                settle(last, total)
            last, total = value, 0
        total += w
    if last is not None:
        settle(last, total)
    return out


class Groups:
    """Inverted index from shingles to groups of sets, with union-find over the groups.

    ``shared`` holds the ascending shingles that more than one set of the
    shard has; only these are indexed, by their positions.
    """

    def __init__(self, percent: int, shared: np.ndarray):
        self.percent, self.shared = percent, shared
        self.postings: dict[int, list[int]] = {}
        self.parent: list[int] = []
        self.members: list[list[np.ndarray]] = []

    def find(self, g: int) -> int:
        while self.parent[g] != g:
            self.parent[g] = self.parent[self.parent[g]]
            g = self.parent[g]
        return g

    def new(self) -> int:
        self.parent.append(len(self.parent))
        self.members.append([])
        return len(self.parent) - 1

    def merge(self, a: int, b: int) -> int:
        a, b = sorted((self.find(a), self.find(b)))
        if a != b:
            self.parent[b] = a
            self.members[a] += self.members[b]
            self.members[b] = []
        return a

    def linked(self, x: np.ndarray, y: np.ndarray) -> bool:
        a, b = len(x), len(y)
        if 100 * min(a, b) < self.percent * max(a, b):
            return False
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= self.percent * (a + b - both)

    def _places(self, x: np.ndarray) -> list[int]:
        at = np.searchsorted(self.shared, x)
        at = at[at < len(self.shared)]
        return at[self.shared[at] == x[:len(at)]].tolist()

    def search(self, x: np.ndarray, skip: int = -1) -> list[int]:
        """Groups other than ``skip`` with a set that links to x."""
        get = self.postings.get
        lists = [p for p in map(get, self._places(x)) if p]
        found: list[int] = []
        tried = {self.find(skip)} if skip >= 0 else set()
        for g in divide_skip(lists, least_overlap(len(x), self.percent)):
            g = self.find(g)
            if g not in tried:
                tried.add(g)
                if any(self.linked(x, y) for y in self.members[g]):
                    found.append(g)
        return found

    def add(self, x: np.ndarray, g: int) -> None:
        g = self.find(g)
        self.members[g].append(x)
        for h in self._places(x):
            p = self.postings.get(h)
            if p is None:
                self.postings[h] = [g]
            elif p[-1] < g:
                p.append(g)
            elif p[-1] != g and p[bisect_left(p, g)] != g:
                insort(p, g)


def _shared(sets) -> np.ndarray:
    """Shingles of two sets or more, ascending."""
    if not sets:
        return np.zeros(0, np.uint64)
    h, count = np.unique(np.concatenate(list(sets)), return_counts=True)
    return h[count > 1]


def _own_sets(table: pa.Table, k: int) -> dict[int, np.ndarray]:
    """Sets by node; rows whose text is not the node's (an id may repeat) are left out."""
    out: dict[int, np.ndarray] = {}
    nodes = table.column("node").to_pylist()
    at = 0
    for batch in table.select(["text"]).to_batches():
        for piece in slices(batch, "text"):
            for s in shingle_sets(piece.column("text"), k):
                if nodes[at] not in out and len(s) and signature(s) == nodes[at]:
                    out[nodes[at]] = s
                at += 1
    return out


def _groups_of(sets: dict[int, np.ndarray], percent: int) -> dict[int, int]:
    """The group of every set, after a search of each among those before it."""
    index, place = Groups(percent, _shared(sets.values())), {}
    for node in sorted(sets, key=lambda v: (len(sets[v]), v)):
        x = sets[node]
        found = index.search(x)
        g = found[0] if found else index.new()
        for other in found[1:]:
            g = index.merge(g, other)
        index.add(x, g)
        place[node] = g
    return {node: index.find(g) for node, g in place.items()}


def _links_of(here: dict, sent: dict, comp: dict, percent: int) -> list[tuple[int, int]]:
    """Components (``comp`` by node) that a sent set and one that lies here link."""
    index, slot, edges = Groups(percent, _shared([*here.values(), *sent.values()])), {}, []
    for node, x in sorted(here.items()):
        c = comp[node]
        if c not in slot:
            slot[c] = index.new()
        index.add(x, slot[c])
    comp_of = {s: c for c, s in slot.items()}
    for node, x in sorted(sent.items()):
        c = comp[node]
        if c not in slot:
            slot[c] = index.new()
            comp_of[slot[c]] = c
        for g in index.search(x, slot[c]):
            edges.append((c, comp_of[g]))
            kept = index.merge(slot[c], g)
            comp_of[kept] = c
    return edges


def _search_shards(rows: DataFrame, k: int, percent: int, groups_of=_groups_of) -> DataFrame:
    """node, label: the smallest node of each group found among the sets of a shard."""

    def search(table: pa.Table) -> pa.Table:
        group = groups_of(_own_sets(table, k), percent)
        least: dict[int, int] = {}
        for node, g in group.items():
            least[g] = min(least.get(g, node), node)
        return pa.table([pa.array(list(group), pa.int64()), pa.array([least[g] for g in group.values()], pa.int64())],
                        names=["node", "label"])

    return rows.groupBy("shard").applyInArrow(search, "node long, label long")


def _search_across(index_rows: DataFrame, query_rows: DataFrame, k: int, percent: int, links_of=_links_of) -> DataFrame:
    """u, v: groups linked by a set that was sent to a (shard, part) and one that lies there."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        edges = []
        if left.num_rows and right.num_rows:
            comp = {n: c for t in (left, right) for n, c in zip(t.column("node").to_pylist(), t.column("comp").to_pylist())}
            edges = links_of(_own_sets(left, k), _own_sets(right, k), comp, percent)
        return pa.table([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())],
                        names=["u", "v"])

    # both sides come from the same documents: fresh names tell their columns apart
    sides = [d.select(*[F.col(c).alias(c) for c in d.columns]) for d in (index_rows, query_rows)]
    return sides[0].groupBy("shard", "part").cogroup(sides[1].groupBy("shard", "part")).applyInArrow(
        search, "u long, v long")


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The columns of ``nodes`` (with the key of one of their rows) and the text; only those texts are shuffled."""
    few = flag_members(docs.select("row", "text"), nodes, ["row"], "__wanted").filter("__wanted")
    return few.groupBy("row").agg(F.first("text").alias("text")).join(nodes, "row")


def with_row_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, row): rows of the same id and text have the same key, null ids too."""
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"))


def near_classes(docs: DataFrame, k: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text",
                 shard_sets: int = 2000, bucket_shingles: int = 1_000_000) -> DataFrame:
    """``id_col``, n_shingles, component_id: one row for each row of ``docs``.

    Two documents link when 100 * intersection >= ``percent`` * union of
    their shingle sets; component_id is the smallest id that links reach.

    Null, empty and blank texts have no shingles, link with nothing and are
    their own component. Equal sets link. Rows that repeat an id are
    separate rows with the same id. A null id is never the smallest (a
    component of null ids alone has a null component_id). An empty table
    gives an empty result. Other columns are neither read nor kept.
    """
    rows, classes, links = _near_links(with_row_key(docs, id_col, text_col), k, percent, shard_sets, bucket_shingles)
    return _classes(docs.sparkSession, rows, classes, links).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _near_links(docs: DataFrame, k: int, percent: int, shard_sets: int = 2000, bucket_shingles: int = 1_000_000):
    """(rows, classes, links): every row, every distinct set, and the component of the sets that link."""
    spark = docs.sparkSession
    rows, sketch = _profile(docs, k)
    classes = _table(spark, set_classes(rows), "nodes")
    order = _sum_sketch(sketch)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, int(order.sum()) // bucket_shingles + 1)
    members = _table(spark, _lists(_prefixes(docs, order, k, percent, buckets, max(bucket_shingles // 4, 2)), percent), "lists")
    need = F.floor(least_overlap_col(least_overlap_col(F.col("n"), percent), percent) / 8) + 1
    return rows, classes, link_members(docs, classes, members, need, k, percent, shard_sets, _groups_of, _links_of)


def set_classes(rows: DataFrame) -> DataFrame:
    """(node, id, row, n): every distinct set with its smallest id and the key of one of its rows."""
    return rows.filter("n > 0").groupBy("node").agg(F.min("id").alias("id"), F.min("row").alias("row"), F.max("n").alias("n"))


def link_members(docs: DataFrame, classes: DataFrame, members: DataFrame, need: Column, k: int, percent: int,
                 shard_sets: int, groups_of, links_of) -> DataFrame:
    """(node, comp) of the sets that share ``need`` lists (a column of n) with others; comp is a node of the component.

    ``groups_of(sets, percent)`` and ``links_of(here, sent, comp, percent)``
    search the sets of one shard, and those sent to it.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = members.groupBy("node", "low").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n"))
    m = members.count()
    near = _table(spark, near, "near", m)
    alive = near.groupBy("node").agg(F.sum("c").alias("c"), F.max("n").alias("n")).filter(F.col("c") >= need).select("node")
    blocks = components(spark, near.join(alive, "node", "left_semi").select(F.col("node").alias("u"), F.col("low").alias("v")))
    placed = _table(spark, alive.join(blocks, "node").select("node", F.col("root").alias("block")), "blocks", m)

    sizes = _table(spark, placed.groupBy("block").agg(F.count(F.lit(1)).alias("size")), "block-sizes", m)
    total, largest = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    shards = max(parts, -(-total // shard_sets))
    salt = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / shard_sets).cast("long"))
    placed = placed.join(sizes, "block").select(
        "node", (F.col("size") > shard_sets).alias("split"),
        F.pmod(F.xxhash64("block", salt), F.lit(shards)).cast("int").alias("shard"))
    placed = _table(spark, placed.join(classes.select("node", "row"), "node"), "shards", m)
    found = _search_shards(_texts(docs, placed).select("shard", "node", "text"), k, percent, groups_of)
    found = _table(spark, found.join(placed, "node"), "found")
    links = found.select("node", F.col("label").alias("comp"))

    if largest > shard_sets:
        split = found.filter("split").select("node", "shard", "row")
        texts = _table(spark, _texts(docs, split.select("node", "row")).select("node", "text"), "split-texts")
        # joins by node meet one row of a set: its lists, no more than its text has prefix shingles, are held together
        members = members.groupBy("node").agg(F.max("n").alias("n"), F.collect_list("list").alias("lists"))
        members = _table(spark, members.join(split.select("node"), "node", "left_semi"), "set-lists", m)
        for every in (False, True):
            links = _join_shards(spark, texts, members, split.join(links, "node"), links, every, need, k, percent,
                                 shard_sets, links_of)
    return links


def least_overlap_col(n: Column, percent: int) -> Column:
    return F.floor((n * percent + 99) / 100)


#: A list that lies in more shards than this is used to route a set only where its narrower lists cannot do.
WIDE = 8


def _routes(spark, mine: DataFrame, need: Column) -> DataFrame:
    """(node, target): the earlier shards that may hold a link of a set to another component.

    Two sets that link share ``need`` lists. With w of a set's lists wide
    (in many shards), a link shares need - w of its narrow ones or more, so
    these alone say where the set can go, and a list that very many sets
    share makes no rows. Only sets with ``need`` wide lists are routed by them.
    """
    m = mine.count()
    there = mine.groupBy("list", "shard").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    there = _table(spark, there.select("list", F.col("shard").alias("target"), "lo", "hi"), "there", m)
    width = there.groupBy("list").agg((F.count(F.lit(1)) > WIDE).alias("wide"))
    mine = _table(spark, mine.drop("target").join(width, "list"), "mine-wide", m)
    sets = mine.groupBy("node", "shard", "comp").agg(F.count_if("wide").alias("w"), F.max("n").alias("n"),
                                                     F.collect_list(F.struct("list", "wide")).alias("lists"))
    mine = _table(spark, sets.select("node", "shard", "comp", "w", need.alias("need"), F.inline("lists")), "mine-need", m)

    def reached(rows, wanted):
        met = rows.join(there, "list").filter("target < shard and (lo != comp or hi != comp)")
        return met.groupBy("node", "target").agg(F.count(F.lit(1)).alias("c"), F.max(wanted).alias("least")).filter(
            "c >= least").select("node", "target")

    narrow = reached(mine.filter("not wide and w < need"), F.col("need") - F.col("w"))
    return narrow.union(reached(mine.filter("w >= need"), F.col("need")))


def _join_shards(spark, texts, members, split, links, every: bool, need: Column, k: int, percent: int, shard_sets: int,
                 links_of) -> DataFrame:
    """Links of nodes to groups after searching across the shards of split blocks.

    First one set of each group in the first shard of its lists; then, with
    ``every``, each set in every earlier shard that may hold a link to
    another group. The sets sent to one shard are dealt to parts of about a
    quarter of ``shard_sets``, each with a copy of what lies there.
    ``members`` has one row (node, n, lists) of each set of the split blocks.
    """
    m = members.agg(F.coalesce(F.sum(F.size("lists")), F.lit(0))).first()[0]
    split = _table(spark, split, "split", m)
    mine = members.join(split.select("node", "shard", "comp"), "node").select("node", "n", "shard", "comp", F.explode("lists").alias("list"))
    mine = _table(spark, mine, "split-lists", m)
    apart = _table(spark, mine.groupBy("list").agg(
        F.min("comp").alias("a"), F.max("comp").alias("b"), F.min("shard").alias("target")).filter("a != b"), "apart", m)
    mine = _table(spark, mine.join(apart, "list"), "mine", m)
    if every:
        routes = _routes(spark, mine, need)
    else:
        routes = mine.filter("shard != target").groupBy("comp", "target").agg(F.min("node").alias("node")).select("node", "target")
    routes = _table(spark, routes, "routes")
    wanted = _table(spark, routes.groupBy(F.col("target").alias("shard")).agg(
        F.ceil(F.count(F.lit(1)) / max(1, shard_sets // 4)).cast("int").alias("parts")), "wanted", m)
    index = split.join(wanted, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    queries = routes.withColumnRenamed("target", "shard").join(wanted, "shard").join(split.select("node", "comp"), "node").select(
        "shard", "node", "comp", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))
    columns = ["shard", "part", "node", "comp", "text"]
    edges = _search_across(index.join(texts, "node").select(*columns), queries.join(texts, "node").select(*columns), k,
                           percent, links_of)
    roots = components(spark, _table(spark, edges, "links")).select(F.col("node").alias("comp"), "root")
    roots = _table(spark, roots, "roots", m)
    return _table(spark, links.join(roots, "comp", "left").select(
        "node", F.coalesce("root", "comp").alias("comp")), "merged", m)


def _classes(spark, rows: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, row, n, comp, component_id): every row with the smallest id of its class; comp is null without shingles.

    Tables are written before joins on keys that many rows share.
    """
    m = classes.count()
    named = _table(spark, classes.select("node", "id").join(links, "node", "left").select(
        "node", "id", F.coalesce("comp", "node").alias("comp")), "named", m)
    least = _table(spark, named.groupBy("comp").agg(F.min("id").alias("component_id")), "least", m)
    named = _table(spark, named.join(least, "comp").select("node", "comp", "component_id"), "components", m)
    out = rows.filter("n > 0").join(named, "node").select("id", "row", "n", "comp", "component_id")
    return out.unionByName(rows.filter("n = 0").select(
        "id", "row", "n", F.lit(None).cast("long").alias("comp"), F.col("id").alias("component_id")))


def drop_near(docs: DataFrame, k: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, with all columns.

    The row with the smallest id stays (null ids last), of several rows with
    that id the one with the smallest hash of id and text; rows that repeat
    both are one, of which the smallest by all columns stays. Rows without
    shingles stay. An empty table stays empty. Other columns may have any
    name but those that begin with two underscores.
    """
    rows, classes, links = _near_links(with_row_key(docs, id_col, text_col), k, percent)
    every = _table(docs.sparkSession, _classes(docs.sparkSession, rows, classes, links).filter("n > 0"), "near-rows")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    best = every.groupBy("comp").agg(first.alias("b")).select("comp", F.col("b.row").alias("best"))
    fate = every.groupBy("comp", "row").agg(F.count(F.lit(1)).alias("copies")).join(best, "comp")
    return keep_rows(docs, fate.select("row", (F.col("row") == F.col("best")).alias("kept"), "copies"), id_col, text_col)
