"""Language-model scores by prediction by partial matching over bytes.

Training counts every string of ``order`` + 1 bytes (lower-cased text, with
start and end marks) of every training text, pre-aggregated per task and
summed by Spark. Those counts are the deepest level of the context trie;
the shallower levels are its sums. A symbol that a context has not seen
escapes to the next shorter one with method C's estimate (distinct symbols
over symbols plus distinct symbols), and symbols the longer context has seen
are excluded there. As contexts nest, what exclusion leaves at the shorter
context depends on the longer one alone, so it is stored with it and a
position needs one look-up unless it escapes.

The trie is spread, and its order is the same at every size. A probability
depends on the string alone, so it is worked out once for each distinct
string of the input, in buckets by the three bytes before the last: levels 3
and deeper of such a bucket need no string of another one, and the levels
above, whose strings have at most three bytes, are broadcast. The strings
that occur most often, at most ``frequent_strings``, are broadcast with their
log probabilities; the others of a text, each once with its count, go through
a join. As those are counted over all texts, no key of the join has more rows
than the rarest broadcast string.

Unigram counts are treated alike: the most frequent words, at most
``frequent``, are broadcast; every other word of every text goes through a
join on its hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm.texts import buffers, lower, ragged, slices, spans_hash, words
from skyframe.session import scratch_path

START, END, SYMBOLS = 0xFF, 0xFE, 257  # marks that UTF-8 never holds; 256 byte values and the end
_SLICE = 1 << 20
_NEAR = 2  # context bytes up to which a level of the trie is broadcast


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 7 == 2


class Table:
    """Open-addressing hash table from 64-bit keys to their positions, looked up in bulk."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(1.5 * len(keys) + 2))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.index = np.full(1 << bits, -1, np.int32)
        self.keys = np.zeros(1 << bits, np.uint64)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.index[at] < 0
            self.index[at[free]] = todo[free]
            won = self.index[at] == todo
            self.keys[at[won]] = keys[todo[won]]
            todo, at = todo[~won], (at[~won] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where it is absent."""
        at = self._slot(keys)
        out = self.index[at]
        todo = np.flatnonzero((out >= 0) & (self.keys[at] != keys))
        at = at[todo]
        while len(todo):
            at = (at + 1) & self.mask
            out[todo] = self.index[at]
            more = (out[todo] >= 0) & (self.keys[at] != keys[todo])
            todo, at = todo[more], at[more]
        return out


def strings(buf: np.ndarray, off: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``order`` + 1 bytes that end at each byte and at the end mark of each text, and the texts' first positions."""
    n = len(off) - 1
    size = np.diff(off)
    begin = off[:-1] + (order + 1) * np.arange(n)
    seq = np.full(len(buf) + (order + 1) * n, START, np.uint64)
    seq[ragged(begin + order, size)] = buf
    seq[begin + order + size] = END
    key = np.zeros(len(seq) - order if n else 0, np.uint64)
    for j in range(order + 1 if n else 0):
        key |= seq[order - j:len(seq) - j] << np.uint64(8 * j)
    return key[ragged(begin, size + 1)], np.cumsum(size + 1) - (size + 1)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts])
    o = np.argsort(keys)
    keys, counts = keys[o], counts[o]
    if not len(keys):
        return keys, counts
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[head], np.add.reduceat(counts, head)


def gather(docs: DataFrame, order: int, id_col: str, text_col: str, held: int = 800_000) -> DataFrame:
    """kind, key, n, every: strings of ``order`` + 1 bytes (kind 0), word hashes (1) and texts (2) of the training rows.

    Strings are listed for all rows: ``n`` counts the training rows' and ``every`` all of them. Counts are merged
    within a task and handed on when more than ``held`` keys have come together.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list] = [[], []]
        texts = 0

        def flush():
            for kind in (0, 1):
                if kept[kind]:
                    k, c = _merge(kept[kind])
                    kept[kind] = []
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(k), kind, np.int8)), pa.array(k.view(np.int64)), pa.array(c[:, 0]),
                         pa.array(c[:, 1])], names=["kind", "key", "n", "every"])

        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                buf, off = buffers(part.column("text"))
                buf = lower(buf)
                train = ~part.column("held").to_numpy(zero_copy_only=False)
                texts += int(train.sum())
                starts, ends, word = words(buf, off)
                key, own = strings(buf, off, order)[0], np.repeat(train, np.diff(off) + 1)
                known = spans_hash(buf, starts, ends)[np.repeat(train, np.diff(word))]
                for kind, keys, counted in ((0, key[own], 1), (0, key[~own], 0), (1, known, 1)):
                    k, c = np.unique(keys, return_counts=True)
                    kept[kind].append((k, np.stack([c * counted, c], 1).astype(np.int64)))
                    if len(kept[kind]) >= 4:
                        kept[kind] = [_merge(kept[kind])]
                if sum(len(x[0]) for kind in kept for x in kind) > held:
                    yield from flush()
        yield from flush()
        yield pa.RecordBatch.from_arrays(
            [pa.array([2], pa.int8()), *[pa.array([x], pa.int64()) for x in (0, texts, texts)]],
            names=["kind", "key", "n", "every"])

    rows = docs.select(F.col(text_col).alias("text"), held_out(id_col).alias("held"))
    return rows.mapInArrow(count, "kind byte, key long, n long, every long").groupBy("kind", "key").agg(
        F.sum("n").alias("n"), F.sum("every").alias("every"))


@dataclass
class Level:
    """Strings of one length: counts, and per context totals, distinct symbols and what exclusion leaves below."""

    keys: np.ndarray
    first: np.ndarray  # log p if this is the longest seen context
    count: np.ndarray  # log of the count
    contexts: np.ndarray
    escape: np.ndarray  # log p of an escape from the longest seen context
    below: np.ndarray  # log of the denominator at the next shorter context, seen symbols excluded
    below_escape: np.ndarray  # log p of an escape there


class Trie:
    """Pretrained PPM model from the counts of its longest strings.

    ``base`` gives the shortest levels; the keys are then only those of some contexts of the next one.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int, base: Trie | None = None):
        self.order = order
        self.levels: list[Level] = list(base.levels) if base else []
        lower_level = base.last if base else None
        for j in range(len(self.levels), order + 1):
            k = keys & np.uint64((1 << 8 * (j + 1)) - 1)
            k, c = _merge([(k, counts)])
            context, at = np.unique(k >> np.uint64(8), return_inverse=True)
            total = np.bincount(at, weights=c, minlength=len(context))
            distinct = np.bincount(at, minlength=len(context)).astype(float)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.log(distinct / (total + distinct))
                below = below_escape = np.zeros(len(context))
                if lower_level is not None:
                    lk, lc, lcontext, ltotal, ldistinct = lower_level
                    same = lc[np.searchsorted(lk, k & np.uint64((1 << 8 * j) - 1))]
                    parent = np.searchsorted(lcontext, context & np.uint64((1 << 8 * (j - 1)) - 1) if j > 1
                                             else np.zeros(len(context), np.uint64))
                    left = ltotal[parent] - np.bincount(at, weights=same, minlength=len(context))
                    symbols = ldistinct[parent] - distinct
                    below = np.log(left + symbols)
                    # no symbol left below: the escape from there is certain
                    below_escape = np.where(symbols > 0, np.log(symbols / np.maximum(left + symbols, 1)), 0.0)
            self.levels.append(Level(k, np.log(c) - np.log(total + distinct)[at], np.log(c), context, escape, below, below_escape))
            lower_level = k, c, context, total, distinct
        self.last = lower_level
        self.unseen = -np.log(max(SYMBOLS - (len(self.levels[0].keys)), 1))
        own = self.levels[len(base.levels) if base else 0:]
        self.strings = (base.strings if base else []) + [Table(x.keys) for x in own]
        self.contexts = (base.contexts if base else []) + [Table(x.contexts) for x in own]

    def log_p(self, key: np.ndarray) -> np.ndarray:
        """Natural log probability of the last byte of each string after the bytes before it."""
        out = np.zeros(len(key))
        todo = np.arange(len(key))
        longer = np.full(len(key), -1)  # context of the level above, where it was seen
        for j in range(self.order, -1, -1):
            level = self.levels[j]
            k = key[todo] & np.uint64((1 << 8 * (j + 1)) - 1)
            at = self.strings[j].find(k)
            hit = at >= 0
            free = longer < 0
            out[todo[hit & free]] += level.first[at[hit & free]]
            sel = hit & ~free
            if sel.any():
                out[todo[sel]] += level.count[at[sel]] - self.levels[j + 1].below[longer[sel]]
            todo, longer, k, free = todo[~hit], longer[~hit], k[~hit], free[~hit]
            if not len(todo):
                return out
            context = self.contexts[j].find(k >> np.uint64(8))
            seen = context >= 0
            sel = seen & free
            out[todo[sel]] += level.escape[context[sel]]
            sel = seen & ~free
            if sel.any():
                out[todo[sel]] += self.levels[j + 1].below_escape[longer[sel]]
            longer = context
        out[todo] += self.unseen
        return out


def _columns(df: DataFrame, value: str) -> tuple[np.ndarray, np.ndarray]:
    """key and ``value`` of a frame of bounded size, as arrays."""
    got = df.select("key", value).toArrow()
    return got.column("key").to_numpy().view(np.uint64), got.column(value).to_numpy()


def _ending(strings_: DataFrame, order: int) -> DataFrame:
    """Counts of the last ``order`` + 1 bytes of the strings."""
    return strings_.groupBy(F.col("key").bitwiseAND((1 << 8 * (order + 1)) - 1).alias("key")).agg(
        F.sum("n").alias("n"), F.sum("every").alias("every"))


def _frequent(counts: DataFrame, by: str, bound: int) -> int:
    """Least power of two that at most ``bound`` rows reach in the column ``by``."""
    bins = {r["b"]: r["count"] for r in counts.groupBy(F.floor(F.log2(by)).cast("int").alias("b")).count().collect()}
    least, held = 1 << 62, 0
    for b in sorted(bins, reverse=True):
        held += bins[b]
        if held > bound:
            break
        least = 1 << b
    return least


_BASE: dict[str, Trie] = {}


def _string_scores(strings_: DataFrame, order: int, size: int, name: str, per_bucket: int = 500_000) -> DataFrame:
    """key, every, log_p of each of about ``size`` strings, in buckets that hold all strings of a three-byte context."""
    spark = strings_.sparkSession
    near = min(order, _NEAR)
    shared = spark.sparkContext.broadcast((_columns(_ending(strings_.filter("n > 0"), near), "n"), name))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // per_bucket + 1)

    def score(table: pa.Table) -> pa.Table:
        (keys, counts), name = shared.value
        if name not in _BASE:
            _BASE.clear()
            _BASE[name] = Trie(keys, counts.astype(float), near)
        key = table.column("key").to_numpy().view(np.uint64)
        n = table.column("n").to_numpy()
        trie = Trie(key[n > 0], n[n > 0].astype(float), order, _BASE[name])
        return pa.table([table.column("key"), table.column("every"), pa.array(trie.log_p(key))],
                        names=["key", "every", "log_p"])

    context = F.shiftright("key", 8).bitwiseAND((1 << 8 * (_NEAR + 1)) - 1)
    return strings_.select("key", "n", "every", F.pmod(F.xxhash64(context), F.lit(buckets)).alias("bucket")).groupBy(
        "bucket").applyInArrow(score, "key long, every long, log_p double")


_MODEL: dict[str, tuple] = {}


def _model(shared) -> tuple[Table, np.ndarray, Table, np.ndarray, int]:
    """Tables of frequent strings and words with their logs, built once in each worker, and the order."""
    if shared.value[-1] not in _MODEL:
        _MODEL.clear()
        (keys, log_p), (words_, seen), order, name = shared.value
        _MODEL[name] = Table(keys), log_p, Table(words_), np.log10(seen + 1.0), order
    return _MODEL[shared.value[-1]]


def _once(key: np.ndarray, text: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The chosen keys of each text, each once, with the text and how often it occurs there; by text."""
    key, text = key[chosen], text[chosen]
    o = np.lexsort((key, text))
    key, text = key[o], text[o]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    return key[head], text[head], np.diff(np.append(head, len(key)))


def score_texts(docs: DataFrame, order: int = 4, frequent: int = 300_000,
                id_col: str = "doc_id", text_col: str = "text", frequent_strings: int = 4_000_000) -> DataFrame:
    """``id_col``, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs``.

    The model is trained on the rows that are not held out (crc32 of the id
    as text, modulo 7, is not 2). ``score`` is the log10 probability of the
    lower-cased text with its end; ``base_score`` that of its words under
    add-one unigrams. The order does not depend on the input.

    Null and empty texts consist of the end alone; a null id counts as an
    empty one; rows that repeat an id are counted and scored each on its
    own; without training rows every byte has the same probability; an empty
    table gives an empty result; other columns are neither read nor kept.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "lm-counts")
    gather(docs, order, id_col, text_col).write.partitionBy("kind").parquet(path)
    counts = spark.read.schema("key long, n long, every long, kind int").parquet(path)
    totals = {r["kind"]: (r["n"] or 0, r["k"]) for r in counts.groupBy("kind").agg(
        F.sum("n").alias("n"), F.count("key").alias("k")).collect()}
    texts = totals.get(2, (0, 0))[0]
    n_train = totals.get(1, (0, 0))[0] + texts
    distinct = totals.get(1, (0, 0))[1] + (1 if texts else 0)
    log_all = float(np.log10(n_train + distinct + 1))
    end_log, end_known = float(np.log10(texts + 1)), int(texts > 0)

    strings_ = counts.filter("kind = 0").select("key", "n", "every")
    table_path = scratch_path(spark, "lm-strings")
    _string_scores(strings_, order, totals.get(0, (0, 0))[1], path).write.parquet(table_path)
    by_string = spark.read.schema("key long, every long, log_p double").parquet(table_path)
    by_word = counts.filter("kind = 1").select("key", "n")
    least, least_string = _frequent(by_word, "n", frequent), _frequent(by_string, "every", frequent_strings)
    shared = spark.sparkContext.broadcast((
        _columns(by_string.filter(F.col("every") >= least_string), "log_p"),
        _columns(by_word.filter(F.col("n") >= least), "n"), order, path))

    schema = T.StructType([
        T.StructField("uid", T.LongType()), T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()),
        T.StructField("logs", T.DoubleType()), T.StructField("score", T.DoubleType()),
        T.StructField("rare", T.ArrayType(T.LongType())), T.StructField("far", T.ArrayType(T.LongType())),
        T.StructField("times", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, log_p, table, log_count, order = _model(shared)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                n = part.num_rows
                buf, off = buffers(part.column("text"))
                buf = lower(buf)
                key, first = strings(buf, off, order)
                at = held.find(key)
                logs = np.zeros(len(key))
                logs[at >= 0] = log_p[at[at >= 0]]
                score = np.add.reduceat(logs, first)
                far, far_text, times = _once(key, np.repeat(np.arange(n), np.diff(off) + 1), at < 0)
                starts, ends, word = words(buf, off)
                h = spans_hash(buf, starts, ends)
                at = table.find(h)
                hit = at >= 0
                logs = np.zeros(len(h))
                logs[hit] = log_count[at[hit]]
                text = np.repeat(np.arange(n), np.diff(word))
                rare = np.flatnonzero(~hit)
                yield pa.RecordBatch.from_arrays([
                    pa.array(uid + np.arange(n)), part.column("id"), pa.array(np.diff(word) + 1),
                    pa.array(np.bincount(text[hit], minlength=n) + end_known),
                    pa.array(np.bincount(text, weights=logs, minlength=n) + end_log), pa.array(score),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(rare, word).astype(np.int32)),
                                             pa.array(h[rare].view(np.int64))),
                    *[pa.ListArray.from_arrays(pa.array(np.searchsorted(far_text, np.arange(n + 1)).astype(np.int32)),
                                               pa.array(x)) for x in (far.view(np.int64), times)]], names=schema.names)
                uid += n

    path = scratch_path(spark, "lm-scores")
    docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema).write.parquet(path)
    scored = spark.read.schema(schema).parquet(path)
    rest = scored.select("uid", F.explode("rare").alias("key")).join(by_word.filter(F.col("n") < least), "key")
    rest = rest.groupBy("uid").agg(F.sum(F.log10(F.col("n") + 1)).alias("more_logs"), F.count(F.lit(1)).alias("more"))
    deep = scored.select("uid", F.explode(F.arrays_zip("far", "times")).alias("s")).select(
        "uid", F.col("s.far").alias("key"), F.col("s.times").alias("times")).join(
        by_string.filter(F.col("every") < least_string), "key")
    deep = deep.groupBy("uid").agg(F.sum(F.col("times") * F.col("log_p")).alias("more_score"))
    both = scored.drop("rare", "far", "times").join(rest, "uid", "left").join(deep, "uid", "left")
    return both.select(
        F.col("id").alias(id_col), "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(log_all)).alias("base_score"),
        ((F.col("score") + F.coalesce("more_score", F.lit(0.0))) / F.lit(float(np.log(10)))).alias("score")).select(id_col, held_out(id_col).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
