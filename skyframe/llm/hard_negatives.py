"""Hard negatives of anchors: slot-decomposed selection over score windows.

Rows are packed into tiles of vectors, anchors into blocks of bounded size;
a cell is a group of tiles and a block of anchors, so neither the driver nor
a plan holds the anchors, and every score is made once, by a matrix product
in the cell's task. The first pass keeps each anchor's best rows of its own
label, per cell and then over all cells: its positives.

A positive with score p allows negatives from ``low`` to ``high`` percent of
p, so the windows of one anchor overlap. Their upper limits cut the scores
into disjoint slots. The second pass keeps the first ``k`` rows of every
(anchor, slot), in each cell, before the shuffle and after it; a positive's
answer is then read from its own slot downwards: the first ``k`` rows of the
slots from there on, as far as its lower limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyframe.session import written

#: Rows of a tile; also the base of the tie order inside one.
TILE = 4096
#: Rows that meet a block of anchors in one task, and anchors of a block.
GROUP_ROWS, BLOCK_ANCHORS = 1 << 17, 1 << 16
#: Anchors that one matrix product takes.
STRIP = 256
#: Components from here on are treated like infinite ones: sums of their products fit a long.
LARGE = float(1 << 27)
_PACKED = "ids binary, keys binary, labels binary, vectors binary, upper binary, lower binary, n int, part int"


def vectors(rows: DataFrame, id_col: str, vector_col: str, label: Column, scale: int = 256) -> DataFrame:
    """(id, label, v, key) of the rows that take part; v holds floor(scale * x)."""
    cells = F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    sound = F.forall(vector_col, lambda x: F.coalesce(
        ~F.isnan(x.cast("double")) & (F.abs(F.lit(float(scale)) * x.cast("double")) < LARGE), F.lit(False)))
    good = rows.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & sound)
    out = good.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                      cells.cast("array<int>").alias("v")).filter(F.col("label").isNotNull())
    return out.withColumn("key", F.xxhash64("id", "label", "v"))


def _pack(rows: DataFrame, parts: int, limits: int = 0) -> DataFrame:
    """Tiles of up to TILE rows, ascending by id, dealt to ``parts``; with ``limits`` columns upper_i, lower_i."""
    names = ["id", "key", "label", "v", *[f"{s}_{i}" for s in ("upper", "lower") for i in range(limits)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() * 7919
        for batch in batches:
            for lo in range(0, batch.num_rows, TILE):
                part = batch.slice(lo, TILE)
                ids = np.asarray(part.column("id"))
                order = np.argsort(ids, kind="stable")
                lists = part.column("v")
                off = np.asarray(lists.offsets).astype(np.int64)
                flat, width = np.asarray(lists.values), np.diff(off)
                v = np.zeros((len(ids), int(width.max(initial=0))), np.int32)
                v[np.arange(v.shape[1]) < width[:, None]] = flat[off[0]:off[-1]]
                ends = [np.stack([np.asarray(part.column(f"{s}_{i}")) for i in range(limits)], 1)[order] if limits
                        else np.zeros(0, np.int64) for s in ("upper", "lower")]
                data = [ids[order], np.asarray(part.column("key"))[order], np.asarray(part.column("label"))[order],
                        v[order], *ends]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes()], pa.binary()) for x in data]
                    + [pa.array([len(ids)], pa.int32()), pa.array([at % parts], pa.int32())],
                    names=[c.split()[0] for c in _PACKED.split(", ")])
                at += 1

    return rows.select(*names).mapInArrow(run, _PACKED)


def _open(table: pa.Table, limits: int = 0) -> Iterator[tuple]:
    for row in table.select(["ids", "keys", "labels", "vectors", "upper", "lower", "n"]).to_pylist():
        n = row["n"]
        out = [np.frombuffer(row[c], np.int64) for c in ("ids", "keys", "labels")]
        out.append(np.frombuffer(row["vectors"], np.int32).reshape(n, -1) if n else np.zeros((0, 0), np.int32))
        if limits:
            out += [np.frombuffer(row[c], np.int64).reshape(n, limits) for c in ("upper", "lower")]
        yield tuple(out)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; vectors of different length are compared on their common part."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(width, 1)
    if most < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of every group, by score from high to low, then by id."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    head = np.flatnonzero(np.diff(g, prepend=g[0] - 1)) if len(g) else np.zeros(0, np.int64)
    place = np.arange(len(g)) - np.repeat(head, np.diff(np.append(head, len(g))))
    return order[place < k]


def _meet(tiles: DataFrame, anchors: DataFrame, groups: int, blocks: int, find, schema: str) -> DataFrame:
    """``find(anchor table, tile table)`` for every cell; tiles go to each block and blocks to each group."""
    left = anchors.withColumnRenamed("part", "block").withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = tiles.withColumnRenamed("part", "group").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return left.groupBy("group", "block").cogroup(right.groupBy("group", "block")).applyInArrow(find, schema)


def _columns(parts: list, names: list[str]) -> pa.Table:
    cols = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(len(names))]
    return pa.table([pa.array(c.astype(np.int64)) for c in cols], names=names)


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k rows of every key; Spark keeps k a task before it shuffles."""
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("other"))
    return found.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product of floor(``scale`` * x); higher ones come
    first, ties by the smaller id. Rows for which ``anchor`` holds (a
    condition on ``id``) are anchors; an anchor's positives are its first
    rows of the same label, and for each of them the first rows of another
    label with low * p <= 100 * n <= high * p are returned.

    Rows with a null id, label, vector or component, or one that is not
    finite (or of 2**27 and more after scaling), take no part. A row is never
    paired with one of its own id. Rows that repeat an id are rows of their
    own; anchors that repeat id, label and vector are one anchor. An anchor
    without positives, or without rows in a window, returns nothing for it.
    Vectors of different length are compared on their common part. An empty
    table gives an empty result. Other columns are neither read nor kept.
    """
    spark = rows.sparkSession
    base = vectors(rows, id_col, vector_col, F.col("label") if label is None else label, scale)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    queries = written(base.filter(anchor).dropDuplicates(["key"]), "anchors")
    groups = max(parts, -(-rows.count() // GROUP_ROWS))
    blocks = max(1, -(-queries.count() // BLOCK_ANCHORS))
    tiles = written(_pack(base, groups), "tiles")

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        out, others = [], list(_open(right))
        for ids, keys, labels, v in _open(left):
            found = []
            for oid, _, olabel, ov in others:
                for lo in range(0, len(ids), STRIP):
                    s = _scores(v[lo:lo + STRIP], ov)
                    mine = (labels[lo:lo + STRIP, None] == olabel) & (ids[lo:lo + STRIP, None] != oid)
                    a, b = np.nonzero(mine)
                    score = s[a, b]
                    top = _first(a, score, oid[b], positives)
                    found.append((a[top] + lo, score[top], oid[b[top]]))
            if found:
                a, score, other = (np.concatenate([f[i] for f in found]) for i in range(3))
                top = _first(a, score, other, positives)
                out.append((keys[a[top]], score[top], other[top]))
        return _columns(out, ["key", "score", "other"])

    near = _meet(tiles, _pack(queries, blocks), groups, blocks, best, "key long, score long, other long")
    near = written(_ranked(near, ["key"], positives), "positives")

    # floor and ceiling of the percentages, and the slot of each upper limit, from the highest down
    limit = near.withColumns({"hi": F.expr(f"({high} * score - pmod({high} * score, 100)) div 100"),
                              "lo": F.expr(f"-((-{low} * score - pmod(-{low} * score, 100)) div 100)")})
    limit = limit.filter("lo <= hi")
    slot = F.dense_rank().over(Window.partitionBy("key").orderBy(F.col("hi").desc()))
    limit = written(limit.withColumn("slot", slot - 1), "limits")
    least = F.min("lo").over(Window.partitionBy("key"))
    ends = limit.withColumn("least", least).groupBy("key").pivot("slot", list(range(positives))).agg(
        F.max("hi").alias("hi"), F.min("least").alias("lo"))
    nothing = F.lit(-(1 << 62))
    ends = ends.select("key", *[F.coalesce(f"{i}_hi", nothing).alias(f"upper_{i}") for i in range(positives)],
                       F.col("0_lo").alias("floor"))
    ends = ends.select("*", *[F.greatest(F.col("floor"), F.col(f"upper_{i + 1}") + 1 if i + 1 < positives else F.col("floor"))
                              .alias(f"lower_{i}") for i in range(positives)]).drop("floor")

    def hard(left: pa.Table, right: pa.Table) -> pa.Table:
        out, others = [], list(_open(right))
        for ids, keys, labels, v, upper, lower in _open(left, positives):
            top, floor = upper[:, 0], lower.min(1)
            found = []
            for oid, _, olabel, ov in others:
                for lo in range(0, len(ids), STRIP):
                    s, at = _scores(v[lo:lo + STRIP], ov), slice(lo, lo + STRIP)
                    inside = (s <= top[at, None]) & (s >= floor[at, None]) & (labels[at, None] != olabel) & (ids[at, None] != oid)
                    a, b = np.nonzero(inside)
                    score = s[a, b]
                    # upper limits fall from slot to slot: the last one that is not below the score
                    slot = (upper[a + lo] >= score[:, None]).sum(1) - 1
                    first = _first((a + lo) * positives + slot, score, oid[b], negatives)
                    found.append((a[first] + lo, slot[first], score[first], oid[b[first]]))
            if found:
                a, slot, score, other = (np.concatenate([f[i] for f in found]) for i in range(4))
                first = _first(a * positives + slot, score, other, negatives)
                out.append((keys[a[first]], slot[first], score[first], other[first]))
        return _columns(out, ["key", "slot", "score", "other"])

    blocks_of = _pack(queries.join(ends, "key"), blocks, positives)
    slots = _meet(tiles, blocks_of, groups, blocks, hard, "key long, slot long, score long, other long")
    slots = written(_ranked(slots, ["key", "slot"], negatives).drop("place"), "slots")

    # an anchor has at most ``positives`` windows and ``positives * negatives`` rows in its slots
    window = limit.select("key", F.col("slot").alias("own"), "lo", F.col("other").alias("positive_id"),
                          F.col("score").alias("positive_score"), F.col("place").alias("nth"))
    down = window.join(slots, "key").filter("slot >= own and score >= lo")
    w = Window.partitionBy("key", "nth").orderBy(F.col("score").desc(), F.col("other"))
    answer = down.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= negatives)
    return answer.join(queries.select("key", F.col("id").alias("anchor_id")), "key").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
