"""Repeated passages: suffix automata of reference shards, matching statistics, span removal.

A window of ``k`` words is removed when it also starts in a document with a
smaller id. Automata over all text would have to meet all documents, so the
shards are made of what can match at all:

1. Anchors. The anchor of a window is the smallest of the hashes of the
   eight-word strings in it; equal windows have equal anchors, and a text has
   few of them. Within a task, runs of windows that other texts of the task
   hold too are streamed, by ascending id, through an automaton of the runs
   before them; what it matches is decided there, so copies that lie together
   send nothing on. The anchors of all other windows are dealt to buckets by
   hash, packed, and a bucket answers with the smallest id that holds the
   anchor, if two documents do.
2. Shards. That id names the shard, so all documents with an anchor send
   the runs of windows around it to one place.
3. Streaming. In a shard the runs are streamed by ascending id through the
   suffix automaton of the runs before them. Where the matching statistic is
   ``k`` or more, the window is covered; runs not covered extend the
   automaton. Documents of one id are streamed before any of them is added.
   A passage that many tasks hold would crowd its shard. Windows of a crowded
   shard that no second document sends are taken out (a bitmap of repeated
   window hashes), its documents are dealt to groups of bounded size, each
   group streams them through an automaton of its own and sends on only what
   it did not cover, until the shards are small.
4. The union of a document's covered spans is removed.

Hashes only route; whether words repeat is decided in the automata, by
64-bit word hashes. A shard sees a passage once from each group or task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm.bitmaps import bits_for, flag_members
from skyframe.llm.texts import buffers, column_hash, mix, ragged, slices, spans_hash, window_positions, windows_hash, words
from skyframe.session import scratch_path, written

ANCHOR = 8
_NO_ID = np.iinfo(np.int64).max  # a null id comes after every other
_FLUSH = 8 << 20  # text bytes a task looks at together
_LOOK = 1 << 20  # and at a time while it hashes words
#: A shard is dealt 4 MB of text, at most some 5 MB of word hashes; with more than this it is merged in groups first.
CROWDED_BYTES = 8 << 20


class Automaton:
    """Suffix automaton of several word strings."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.size = [0]

    def add(self, string: list[int]) -> None:
        nxt, link, size = self.next, self.link, self.size
        last = 0
        for c in string:
            q = nxt[last].get(c)
            if q is not None:  # the string so far is known: move on, or split its state
                if size[q] == size[last] + 1:
                    last = q
                    continue
                last = self._split(last, c, q)
                continue
            cur = len(nxt)
            nxt.append({})
            size.append(size[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                link[cur] = q if size[q] == size[p] + 1 else self._split(p, c, q)
            last = cur

    def _split(self, p: int, c: int, q: int) -> int:
        nxt, link, size = self.next, self.link, self.size
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        size.append(size[p] + 1)
        link.append(link[q])
        link[q] = clone
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def matches(self, string: list[int], k: int) -> list[bool]:
        """For each window of ``k`` words, whether the automaton holds it (its matching statistic reaches k)."""
        nxt, link, size = self.next, self.link, self.size
        state = length = 0
        out = []
        for c in string:
            q = nxt[state].get(c)
            while q is None and state:
                state = link[state]
                length = size[state]
                q = nxt[state].get(c)
            if q is None:
                length = 0
            else:
                state = q
                length += 1
            out.append(length >= k)
        return out[k - 1:]


def _runs(flags: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 of the runs of set flags; a run also ends where ``breaks`` says that a new one begins."""
    if not len(flags):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = flags & np.concatenate([[True], ~flags[:-1] | breaks[1:]])
    end = flags & np.concatenate([~flags[1:] | breaks[1:], [True]])
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def stream(runs: list[tuple[int, object, int, list[int]]], k: int, rest: list | None = None) -> dict[object, list[tuple[int, int]]]:
    """Covered spans (first word, number of words) by key, for runs (id, key, first word, word hashes).

    The parts of the runs that are not covered are appended to ``rest``.
    """
    automaton, out = Automaton(), {}
    runs = sorted(runs, key=lambda r: r[0])
    at = 0
    while at < len(runs):
        same = at
        fresh = []
        while same < len(runs) and runs[same][0] == runs[at][0]:
            pid, key, start, string = runs[same]
            hit = np.array(automaton.matches(string, k), bool)
            none = np.zeros(len(hit), bool)
            for a, b in zip(*_runs(hit, none)):
                out.setdefault(key, []).append((start + int(a), int(b - a) + k - 1))
            fresh += [(pid, key, start + int(a), string[a:b + k - 1]) for a, b in zip(*_runs(~hit, none))]
            same += 1
        for part in fresh:
            automaton.add(part[3])
        if rest is not None:
            rest += fresh
        at = same
    return out


def _text_keys(word: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each text's words in their order; with the id it names a row."""
    count = np.diff(first)
    place = mix((np.arange(len(word)) - np.repeat(first[:-1], count)).astype(np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word * (2 * place + np.uint64(1)))])
    return mix(total[first[1:]] - total[first[:-1]] + count.astype(np.uint64)).view(np.int64)


class _Texts:
    """Word hashes, windows and anchors of many texts; their bytes are looked at in small parts."""

    def __init__(self, column: pa.Array, k: int):
        hashes, firsts, base = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], 0
        for part in slices(pa.RecordBatch.from_arrays([column], names=["text"]), "text", _LOOK):
            buf, off = buffers(part.column("text"))
            starts, ends, first = words(buf, off)
            hashes.append(spans_hash(buf, starts, ends))
            firsts.append(first[1:] + base)
            base += len(starts)
        self.word, self.first = np.concatenate(hashes), np.concatenate(firsts)
        self.at, self.text = window_positions(self.first, k)
        self.k = k
        self.key = _text_keys(self.word, self.first)

    def windows(self) -> np.ndarray:
        return windows_hash(self.word, self.k)[self.at]

    def anchors(self) -> np.ndarray:
        """The anchor of each window."""
        g = windows_hash(self.word, ANCHOR)
        best = g[self.at]
        for j in range(1, self.k - ANCHOR + 1):
            best = np.minimum(best, g[self.at + j])
        return best

    def run(self, a: int, b: int) -> tuple[int, list[int]]:
        """First word within its text, and the word hashes, of windows a to b - 1."""
        start = int(self.at[a])
        return start - int(self.first[self.text[a]]), self.word[start:int(self.at[b - 1]) + self.k].tolist()


def _bytes_of(spans: list[tuple[int, int]]) -> bytes:
    return np.array(spans, "<i4").tobytes()


def _place(anchors: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return ((anchors >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64), (anchors & np.uint64(0xFFFFFFFF)).astype("<u4")


_SPAN = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("pid", T.LongType()),
                      T.StructField("key", T.LongType()), T.StructField("spans", T.BinaryType())])


def _look(docs: DataFrame, k: int, buckets: int) -> DataFrame:
    """Covered spans found within a task (pid, key, spans) and packed anchors of other windows (ids, counts, lows), by bucket."""
    schema = T.StructType([*_SPAN.fields, *(T.StructField(c, T.BinaryType()) for c in ("ids", "counts", "lows"))])

    def flush(column: pa.Array, pid: np.ndarray):
        t = _Texts(column, k)
        if not len(t.at):
            return
        ids = pid[t.text]
        h = t.windows()
        o = np.argsort(h)
        head = np.flatnonzero(np.concatenate([[True], h[o][1:] != h[o][:-1]]))
        owner = ids[o]
        differs = np.minimum.reduceat(owner, head) != np.maximum.reduceat(owner, head)
        shared = np.empty(len(h), bool)
        shared[o] = np.repeat(differs, np.diff(np.append(head, len(h))))
        new_text = np.concatenate([[True], t.text[1:] != t.text[:-1]])
        runs = []
        for a, b in zip(*_runs(shared, new_text)):
            start, string = t.run(a, b)
            runs.append((int(ids[a]), (int(ids[a]), int(t.text[a])), start, string))
        found = stream(runs, k)
        open_ = np.ones(len(h), bool)
        window0 = np.searchsorted(t.text, np.arange(len(pid)))
        for (_, text), spans in found.items():
            for start, n in spans:
                open_[window0[text] + start:window0[text] + start + n - k + 1] = False
        if found:
            keys = list(found)
            yield pa.RecordBatch.from_arrays([
                pa.array((column_hash(np.array([i for i, _ in keys], np.int64)) % buckets).astype(np.int32)),
                pa.array([i for i, _ in keys], pa.int64()),
                pa.array([int(t.key[x]) for _, x in keys], pa.int64()),
                pa.array([_bytes_of(found[x]) for x in keys], pa.binary()),
                *[pa.nulls(len(keys), pa.binary()) for _ in range(3)]], names=schema.names)
        anchor, owner = t.anchors()[open_], ids[open_]
        if not len(anchor):
            return
        bucket, low = _place(anchor, buckets)
        o = np.lexsort((low, owner, bucket))
        bucket, low, owner = bucket[o], low[o], owner[o]
        one = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])])
        bucket, low, owner = bucket[one], low[one], owner[one]
        head = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])]))
        count = np.diff(np.append(head, len(low))).astype("<u4")
        of = bucket[head]
        cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])).tolist()
        edge = np.append(head, len(low))
        m = len(cut) - 1
        yield pa.RecordBatch.from_arrays([
            pa.array(of[cut[:-1]].astype(np.int32)), *[pa.nulls(m, pa.int64()) for _ in range(2)], pa.nulls(m, pa.binary()),
            pa.array([owner[head[a:b]].astype("<i8").tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
            pa.array([count[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
            pa.array([low[edge[a]:edge[b]].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                held.append(part)
                size += part.column("text").nbytes
                if size > _FLUSH:
                    t = pa.Table.from_batches(held).combine_chunks()
                    yield from flush(_one(t, "text"), np.asarray(_one(t, "pid")))
                    held, size = [], 0
        if held:
            t = pa.Table.from_batches(held).combine_chunks()
            yield from flush(_one(t, "text"), np.asarray(_one(t, "pid")))

    return docs.mapInArrow(run, schema)


def _one(table: pa.Table, column: str) -> pa.Array:
    c = table.column(column)
    return pa.concat_arrays(c.chunks) if c.num_chunks != 1 else c.chunk(0)


def _owners(looked: DataFrame, parts: int) -> DataFrame:
    """Spans as they came, and for anchors of two documents or more the smallest id, packed by the part of the document."""
    schema = T.StructType([*_SPAN.fields, T.StructField("part", T.IntegerType()),
                           *(T.StructField(c, T.BinaryType()) for c in ("ids", "counts", "lows", "owners"))])

    def meet(table: pa.Table) -> pa.Table:
        spans = table.filter(pc.is_valid(table.column("spans")))
        packed = table.filter(pc.is_valid(table.column("lows")))
        bucket = table.column("bucket")[0].as_py()
        rows = []
        if packed.num_rows:
            count = [np.frombuffer(x, "<u4") for x in packed.column("counts").to_pylist()]
            owner = np.concatenate([np.repeat(np.frombuffer(x, "<i8"), c)
                                    for x, c in zip(packed.column("ids").to_pylist(), count)])
            low = np.concatenate([np.frombuffer(x, "<u4") for x in packed.column("lows").to_pylist()])
            o = np.lexsort((owner, low))
            low, owner = low[o], owner[o]
            one = np.concatenate([[True], (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])])
            low, owner = low[one], owner[one]
            head = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
            length = np.diff(np.append(head, len(low)))
            least = np.repeat(owner[head], length)
            keep = np.repeat(length > 1, length)
            low, owner, least = low[keep], owner[keep], least[keep]
            part = column_hash(owner) % parts
            o = np.lexsort((low, owner, part))
            low, owner, least, part = low[o], owner[o], least[o], part[o]
            head = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(low) else np.zeros(0, np.int64)
            n = np.diff(np.append(head, len(low))).astype("<u4")
            of = part[head]
            cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])).tolist() if len(head) else [0]
            edge = np.append(head, len(low))
            rows = [(int(of[a]), owner[head[a:b]].astype("<i8").tobytes(), n[a:b].tobytes(),
                     low[edge[a]:edge[b]].tobytes(), least[edge[a]:edge[b]].astype("<i8").tobytes())
                    for a, b in zip(cut[:-1], cut[1:])]
        m, s = len(rows), spans.num_rows
        cols = list(zip(*rows)) if rows else [[]] * 5
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        arrays = [pa.array([bucket] * (s + m), pa.int32())]
        arrays += [pa.concat_arrays([_one(spans, c).cast(t) if s else pa.nulls(0, t), pa.nulls(m, t)])
                   for c, t in (("pid", pa.int64()), ("key", pa.int64()), ("spans", pa.binary()))]
        arrays += [pa.concat_arrays([pa.nulls(s, t), pa.array(list(c), t)]) for c, t in zip(cols, kinds)]
        return pa.table(arrays, names=schema.names)

    return looked.groupBy("bucket").applyInArrow(meet, schema)


def _route(docs: DataFrame, marks: DataFrame, k: int, buckets: int, parts: int, shards: int) -> DataFrame:
    """shard, pid, key, start, words: the runs of windows whose anchor another document holds, sent to the anchor's owner."""
    schema = "shard int, pid long, key long, start int, words binary"

    def route(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            ids, places, least = [], [], []
            for b, i, c, low, o in zip(*(right.column(x).to_pylist() for x in ("bucket", "ids", "counts", "lows", "owners"))):
                ids.append(np.repeat(np.frombuffer(i, "<i8"), np.frombuffer(c, "<u4")))
                places.append(np.int64(b) << 32 | np.frombuffer(low, "<u4").astype(np.int64))
                least.append(np.frombuffer(o, "<i8"))
            ids, places, least = np.concatenate(ids), np.concatenate(places), np.concatenate(least)
            o = np.lexsort((places, ids))
            ids, places, least = ids[o], places[o], least[o]
            pid = np.asarray(_one(left, "pid"))
            lo, hi = np.searchsorted(ids, pid), np.searchsorted(ids, pid, side="right")
            t = _Texts(_one(left, "text"), k)
            bucket, low = _place(t.anchors(), buckets) if len(t.at) else (np.zeros(0, np.int64), np.zeros(0, "<u4"))
            wanted = bucket << 32 | low.astype(np.int64)
            edge = np.searchsorted(t.text, np.arange(len(pid) + 1))
            for i in range(len(pid)):
                a, b = int(edge[i]), int(edge[i + 1])
                own = places[lo[i]:hi[i]]
                if a == b or not len(own):
                    continue
                at = np.minimum(np.searchsorted(own, wanted[a:b]), len(own) - 1)
                hit = own[at] == wanted[a:b]
                shard = (mix(least[lo[i]:hi[i]][at].view(np.uint64)) % np.uint64(shards)).astype(np.int64)
                breaks = np.concatenate([[True], shard[1:] != shard[:-1]])
                for x, y in zip(*_runs(hit, breaks)):
                    first = int(t.at[a + x])
                    string = t.word[first:int(t.at[a + y - 1]) + k]
                    out.append((int(shard[x]), int(pid[i]), int(t.key[i]), first - int(t.first[i]), string.tobytes()))
        cols = list(zip(*out)) if out else [[]] * 5
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        return pa.table([pa.array(list(c), x) for c, x in zip(cols, kinds)], names=["shard", "pid", "key", "start", "words"])

    texts = flag_members(docs, _ids(marks), ["pid"], "__wanted").filter("__wanted").select(
        "pid", "text", F.pmod(F.hash("pid"), F.lit(parts)).cast("int").alias("part"))
    return texts.groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(route, schema)


def _ids(marks: DataFrame) -> DataFrame:
    """The ids packed in the marks, each once: those of a part meet in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(0, np.int64)
        for batch in batches:
            packed = [np.frombuffer(x, "<i8") for x in batch.column("ids").to_pylist()]
            found = np.unique(np.concatenate([found, *packed]))
        yield pa.RecordBatch.from_arrays([pa.array(found)], names=["pid"])

    return marks.select("part", "ids").repartition("part").mapInArrow(run, "pid long")


def _match(routed: DataFrame, k: int) -> DataFrame:
    """pid, key, spans: what the automaton of each shard covers."""

    def match(table: pa.Table) -> pa.Table:
        runs = [(p, (p, key), s, np.frombuffer(w, np.uint64).tolist()) for p, key, s, w in zip(*(
            table.column(c).to_pylist() for c in ("pid", "key", "start", "words")))]
        found = stream(runs, k)
        return pa.table([pa.array([p for p, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64()),
                         pa.array([_bytes_of(v) for v in found.values()], pa.binary())], names=["pid", "key", "spans"])

    return routed.groupBy("shard").applyInArrow(match, "pid long, key long, spans binary")


def _windows_of(runs: DataFrame, k: int) -> DataFrame:
    """One row for each window of ``runs`` (shard, salt, pid, key, start, words), with its hash w."""
    of_run = ["shard", "salt", "pid", "key"]
    schema = "shard int, salt int, pid long, key long, start int, w long, words binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = [np.frombuffer(x, np.uint64) for x in batch.column("words").to_pylist()]
            first = np.concatenate([[0], np.cumsum([len(x) for x in strings], dtype=np.int64)]).astype(np.int64)
            every, owner = window_positions(first, k)
            if not len(every):
                continue
            word = np.concatenate(strings)
            w = windows_hash(word, k)[every].view(np.int64)
            begin = np.asarray(batch.column("start")).astype(np.int64)
            for lo in range(0, len(every), 1 << 17):
                at, of = every[lo:lo + (1 << 17)], owner[lo:lo + (1 << 17)]
                cells = word[at[:, None] + np.arange(k)].tobytes()
                packed = pa.Array.from_buffers(pa.binary(8 * k), len(at), [None, pa.py_buffer(cells)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(pa.array(of)) for c in of_run],
                     pa.array((begin[of] + at - first[of]).astype(np.int32)), pa.array(w[lo:lo + (1 << 17)]), packed],
                    names=[*of_run, "start", "w", "words"])

    return runs.select(*of_run, "start", "words").mapInArrow(run, schema)


def _merge(windows: DataFrame, k: int) -> DataFrame:
    """What the automaton of each group covers (pid, key, spans), and the runs it does not cover (start, words)."""
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    names = ["shard", "pid", "key", "start", "words", "spans"]

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        pid, key, start = (np.asarray(_one(table, c)) for c in ("pid", "key", "start"))
        o = np.lexsort((start, key, pid))
        word = np.frombuffer(b"".join(_one(table, "words").to_pylist()), np.uint64).reshape(-1, k)[o]
        pid, key, start = pid[o], key[o], start[o]
        new = np.concatenate([[True], (pid[1:] != pid[:-1]) | (key[1:] != key[:-1]) | (start[1:] != start[:-1] + 1)])
        edge = np.append(np.flatnonzero(new), len(pid))
        runs = [(int(pid[a]), (int(pid[a]), int(key[a])), int(start[a]), word[a].tolist() + word[a + 1:b, -1].tolist())
                for a, b in zip(edge[:-1], edge[1:])]
        rest: list[tuple] = []
        rows = [(shard, p, x, None, None, _bytes_of(v)) for (p, x), v in stream(runs, k, rest).items()]
        rows += [(shard, p, x, s, np.array(string, np.uint64).tobytes(), None) for p, (_, x), s, string in rest]
        return pa.table([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=names)

    return windows.groupBy("shard", "salt").applyInArrow(
        merge, "shard int, pid long, key long, start int, words binary, spans binary")


def _thinned(routed: DataFrame, k: int) -> tuple[DataFrame, list[DataFrame]]:
    """Runs of shards that are no longer crowded, and the spans decided on the way.

    Of the copies of a passage each group of a shard sends on one, so a level
    divides them by the size of a group. It ends when no shard is crowded, or
    when a shard's documents share too little for a further level to help.
    """
    spans: list[DataFrame] = []
    while True:
        sizes = routed.groupBy("shard").agg(F.sum(F.length("words")).alias("bytes"))
        crowded = written(sizes.filter(F.col("bytes") > CROWDED_BYTES).select(
            "shard", "bytes", F.ceil(F.col("bytes") / CROWDED_BYTES).alias("groups")), "crowded")
        before = crowded.agg(F.sum("bytes")).first()[0]
        if before is None:
            return routed, spans
        many = routed.join(crowded, "shard").select(
            *routed.columns, F.pmod(F.hash("pid"), F.col("groups")).cast("int").alias("salt"))
        windows = written(_windows_of(many, k), "windows")
        repeated = written(windows.groupBy("w").agg(F.min("pid").alias("least"), F.max("pid").alias("most")).filter(
            "least < most").select("w"), "repeated")
        merged = written(_merge(flag_members(windows, repeated, ["w"], "__again", bits_for(repeated.count())).filter(
            "__again"), k), "merged")
        spans.append(merged.filter("spans is not null").select("pid", "key", "spans"))
        rest = merged.filter("words is not null").select(*routed.columns)
        after = rest.agg(F.coalesce(F.sum(F.length("words")), F.lit(0))).first()[0]
        routed = routed.join(crowded, "shard", "left_anti").unionByName(rest)
        if 2 * after > before:
            return routed, spans


def covered_spans(docs: DataFrame, k: int) -> DataFrame:
    """pid, key, spans of documents ``docs`` (pid, text); key tells apart texts that share an id."""
    spark = docs.sparkSession
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chars = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    buckets = parts = max(floor, chars // (16 << 20) + 1)
    shards = max(floor, chars // (4 << 20) + 1)
    looked = _owners(_look(docs, k, buckets), parts)
    path = scratch_path(spark, "anchors")
    looked.write.parquet(path)
    looked = spark.read.schema(looked.schema).parquet(path)
    near = looked.filter("spans is not null").select("pid", "key", "spans")
    marks = looked.filter("lows is not null").select("bucket", "part", "ids", "counts", "lows", "owners")
    routed, merged = _thinned(written(_route(docs, marks, k, buckets, parts, shards), "routed"), k)
    for spans in merged:
        near = near.unionByName(spans)
    return near.unionByName(_match(routed, k))


def remove_repeats(docs: DataFrame, k: int = 13, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = True) -> DataFrame:
    """``id_col``, n_words, n_removed, spans, kept_sha256 and, if wanted, kept_text: one row for each row of ``docs``.

    ``spans`` holds the removed spans as first word and number of words.
    kept_text is the words left, joined by one space.

    Ids are whole numbers. Null and empty texts have no words; a null id
    comes after every other id, and null ids are equal; rows that repeat an
    id do not remove each other's words and are each judged on their own
    text; an empty table gives an empty result; other columns are neither
    read nor kept.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("pid"), F.col(text_col).alias("text"))
    spans = covered_spans(base, k)
    path = scratch_path(spark, "spans")
    spans.write.parquet(path)
    spans = spark.read.schema(spans.schema).parquet(path)
    per_doc = spans.groupBy("pid").agg(F.collect_list(F.struct("key", "spans")).alias("found"))
    flagged = flag_members(base, spans, ["pid"], "__hit", bits_for(spans.count()))
    clean = flagged.filter("not __hit").select("pid", "text", F.lit(None).cast(per_doc.schema["found"].dataType).alias("found"))
    hit = flagged.filter("__hit").select("pid", "text").join(per_doc, "pid", "left").select("pid", "text", "found")
    out = _cut(clean, k, with_text).unionByName(_cut(hit, k, with_text))
    return out.select(F.when(F.col("pid") != _NO_ID, F.col("pid")).cast(id_type).alias(id_col),
                      *[c for c in out.columns if c != "pid"])


def _cut(rows: DataFrame, k: int, with_text: bool) -> DataFrame:
    fields = [T.StructField("pid", T.LongType()), T.StructField("n_words", T.LongType()),
              T.StructField("n_removed", T.LongType()),
              T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()),
                                                               T.StructField("length", T.IntegerType())]))),
              T.StructField("kept_sha256", T.StringType())]
    schema = T.StructType(fields + [T.StructField("kept_text", T.StringType())] * with_text)
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _LOOK):
                buf, off = buffers(part.column("text"))
                starts, ends, first = words(buf, off)
                n = part.num_rows
                gone = np.zeros(len(starts) + 1, np.int64)
                if part.column("found").null_count < n:
                    keys = _text_keys(spans_hash(buf, starts, ends), first).tolist()
                    for i, found in enumerate(part.column("found").to_pylist()):
                        for x in found or ():
                            if x["key"] == keys[i]:
                                s = np.frombuffer(x["spans"], "<i4").reshape(-1, 2).astype(np.int64)
                                np.add.at(gone, first[i] + s[:, 0], 1)
                                np.add.at(gone, first[i] + s[:, 0] + s[:, 1], -1)
                gone = np.cumsum(gone[:-1]) > 0
                text = np.repeat(np.arange(n), np.diff(first))
                a, b = _runs(gone, np.concatenate([[True], text[1:] != text[:-1]]) if len(text) else gone)
                spans = [[] for _ in range(n)]
                for x, y in zip(a.tolist(), b.tolist()):
                    i = int(text[x])
                    spans[i].append({"start": x - int(first[i]), "length": y - x})
                size = (ends - starts)[~gone]
                joined = np.full(int(size.sum()) + len(size), 32, np.uint8)
                place = np.cumsum(size + 1) - (size + 1)
                joined[ragged(place, size)] = buf[ragged(starts[~gone], size)]
                kept = np.concatenate([[0], np.cumsum(np.bincount(text[~gone], minlength=n))])
                edge = np.append(place, len(joined))
                pieces = [joined[edge[x]:max(edge[y] - 1, edge[x])].tobytes() for x, y in zip(kept[:-1].tolist(), kept[1:].tolist())]
                cols = [part.column("pid"), pa.array(np.diff(first)), pa.array(np.bincount(text[gone], minlength=n)),
                        pa.array(spans, span_type), pa.array([hashlib.sha256(p).hexdigest() for p in pieces], pa.string())]
                if with_text:
                    cols.append(pa.array([p.decode() for p in pieces], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return rows.mapInArrow(cut, schema)
