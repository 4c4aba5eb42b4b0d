"""Best-fit packing of documents into sequences by length patterns.

Only lengths matter for the plan, and a piece has at most ``capacity``
tokens, so the whole corpus is a histogram of ``capacity`` counts. Patterns
of one to three lengths that fill a sequence exactly are enumerated, their
repeat counts are fitted to the histogram by non-negative least squares and
rounded, and what is left over is packed best-fit decreasing, on counts
again. The plan is a few thousand (pattern, repeats) rows at any corpus
size; each piece then finds its place from its rank among the pieces of its
length, which needs no ordering of the whole table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm.encode import shared_encoder
from skyframe.llm.texts import slices
from skyframe.session import scratch_path


def patterns(hist: np.ndarray, capacity: int, grid: int = 32) -> np.ndarray:
    """Rows of three lengths (0: none) that sum to ``capacity`` and all occur in ``hist``.

    All singles and pairs; triples whose smallest length is a multiple of
    ``grid`` or one of the ``grid`` most frequent lengths.
    """
    have = np.flatnonzero(hist)
    have = have[have > 0]
    there = np.zeros(capacity + 1, bool)
    there[have] = True
    out = []
    if there[capacity]:
        out.append(np.array([[capacity, 0, 0]]))
    low = have[have <= capacity // 2]
    pair = low[there[capacity - low]]
    out.append(np.stack([capacity - pair, pair, 0 * pair], 1))
    often = have[np.argsort(-hist[have], kind="stable")[:grid]]
    small = np.union1d(have[have % grid == 0], often)
    for c in small[small <= capacity // 3].tolist():
        b = have[(have >= c) & (have <= (capacity - c) // 2)]
        b = b[there[capacity - c - b]]
        out.append(np.stack([capacity - c - b, b, np.full_like(b, c)], 1))
    return np.concatenate(out).astype(np.int64)


def fit(rows: np.ndarray, hist: np.ndarray, steps: int = 300) -> np.ndarray:
    """Repeats x >= 0 of the patterns that minimise the squared miss of the histogram (accelerated projected gradient)."""
    used = rows > 0

    def apply(x):
        return np.bincount(rows[used], weights=np.broadcast_to(x[:, None], rows.shape)[used], minlength=len(hist))

    def back(r):
        return (r[rows] * used).sum(1)

    v = np.ones(len(rows))
    for _ in range(20):  # largest eigenvalue of A'A
        v = back(apply(v))
        v /= np.linalg.norm(v)
    step = 1.0 / (1.05 * np.linalg.norm(back(apply(v))) + 1e-9)
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(y - step * back(apply(y) - hist), 0.0)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: (lengths, number of sequences)."""
    open_: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    any_ = np.zeros(capacity + 1, bool)
    for length in range(capacity, 0, -1):
        count = int(left[length])
        while count:
            there = any_[length:]
            free = length + int(there.argmax()) if there.any() else 0
            if free:
                shape, n = open_[free].pop()
                any_[free] = bool(open_[free])
            else:
                free, shape, n = capacity, (), -(-count // (capacity // length))
            each = free // length
            full = min(n, count // each)
            rest = count - full * each if full < n else 0
            for k, m in ((each, full), (rest, 1 if rest else 0)):
                if m:
                    space = free - k * length
                    open_[space].append((shape + (length,) * k, m))
                    any_[space] = True
            count -= full * each + rest
            if shape and n - full - (1 if rest else 0) > 0:
                open_[free].append((shape, n - full - (1 if rest else 0)))
                any_[free] = True
    return [g for groups in open_ for g in groups]


def plan(hist: np.ndarray, capacity: int, rounds: int = 4) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, repeats) that hold every piece of the histogram exactly once."""
    left = hist.astype(np.int64).copy()
    left[0] = 0
    out: list[tuple[tuple[int, ...], int]] = []
    for _ in range(rounds):
        rows = patterns(left, capacity)
        if not len(rows):
            break
        x = np.rint(fit(rows, left)).astype(np.int64)
        took = 0
        for i in np.argsort(-x, kind="stable"):
            if x[i] <= 0:
                break
            lengths, times = np.unique(rows[i][rows[i] > 0], return_counts=True)
            n = int(min(x[i], (left[lengths] // times).min()))
            if n > 0:
                left[lengths] -= n * times
                out.append((tuple(int(v) for v in rows[i] if v), n))
                took += n
        if not took:
            break
    return out + best_fit(left, capacity)


def _slots(shapes: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[str, np.ndarray]:
    """For each place of each pattern: its length, first rank, first sequence and offset, sorted by length and rank."""
    taken = np.zeros(capacity + 1, np.int64)
    rows, first = [], 0
    for lengths, n in shapes:
        at = 0
        for length in lengths:
            rows.append((length, int(taken[length]), first, at))
            taken[length] += n
            at += length
        first += n
    a = np.array(rows, np.int64).reshape(-1, 4)
    a = a[np.lexsort((a[:, 1], a[:, 0]))]
    return {"length": a[:, 0], "rank": a[:, 1], "sequence": a[:, 2], "offset": a[:, 3]}


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """One row per piece, with its rank among the pieces of its length in the same task."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()), T.StructField("task", T.IntegerType()),
        T.StructField("task_rank", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer)
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                ends, ids = encoder.encode(part.column("text"))
                n = part.num_rows
                ends = ends + np.arange(n + 1)
                flat = np.full(int(ends[-1]), end_id, "<u4")
                inner = np.ones(len(flat), bool)
                inner[ends[1:] - 1] = False
                flat[inner] = ids
                size = np.diff(ends)
                pieces = -(-size // capacity)
                row = np.repeat(np.arange(n), pieces)
                no = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = size - (pieces - 1) * capacity  # the first piece takes what is over
                length = np.where(no == 0, head[row], capacity)
                start = np.where(no == 0, 0, head[row] + (no - 1) * capacity)
                at = ends[:-1][row] + start
                crc = [zlib.crc32(flat[a:b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                order = np.argsort(length, kind="stable")
                same = length[order]
                group = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]]))
                sizes = np.diff(np.append(group, len(same)))
                rank = np.empty(len(same), np.int64)
                rank[order] = seen[same] + np.arange(len(same)) - np.repeat(group, sizes)
                seen[same[group]] += sizes
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(row)), pa.array(no.astype(np.int32)), pa.array(start),
                    pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(row), task, np.int32)),
                    pa.array(rank)], names=schema.names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    A document is its ids and then ``end_id``; only one longer than
    ``capacity`` is cut, into pieces of ``capacity`` tokens of which the first
    may be shorter. The histogram (at most ``capacity`` rows) is all that
    reaches the driver.

    A null or empty text is the end id alone; a null id stays null; rows that
    repeat an id are packed each on its own; an empty table gives an empty
    result; other columns are neither read nor kept.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    cut = cut_pieces(docs, tokenizer, capacity, end_id, id_col, text_col)
    cut.write.parquet(path)
    pieces = spark.read.schema(cut.schema).parquet(path)

    by_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    hist = np.zeros(capacity + 1, np.int64)
    for length, n in by_task.groupBy("length").agg(F.sum("n")).collect():
        hist[length] = n
    slots = _slots(plan(hist, capacity), capacity)
    key = slots["length"] << 48 | slots["rank"]

    # rank of a piece among all of its length: those of earlier tasks, then those before it in its task
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("task_rank")).alias("rank"))
    schema = T.StructType([*ranked.schema.fields[:5], T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            at = np.searchsorted(key, length << 48 | rank, side="right") - 1
            sequence = slots["sequence"][at] + rank - slots["rank"][at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(slots["offset"][at])], names=schema.names)

    return ranked.mapInArrow(place, schema)
