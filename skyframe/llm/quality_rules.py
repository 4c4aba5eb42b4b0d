"""Quality rules on repetition, from suffix arrays.

All texts of a batch form one sequence of words in which a word carries its
text, so suffixes of different texts never agree. Prefix doubling sorts the
suffixes (only those that still share their class are sorted again), the
classes of each round give the longest common prefix of neighbours, and each
LCP interval gives maximal repeated substrings. The union of their spans is
the covered part of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skyframe.llm.texts import buffers, mix, slices, spans_hash, words

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def suffix_array(text: np.ndarray, word: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of all words and the classes of the substrings of 1, 2, 4, ... words.

    ``end`` holds for each word the position after the last word of its text.
    """
    n = len(word)
    key = mix(word ^ mix(text.astype(np.uint64) + np.uint64(1)))
    sa = np.argsort(key)
    ordered = key[sa]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    sizes = np.diff(np.append(first, n))
    rank = np.empty(n, np.int64)
    rank[sa] = np.repeat(first, sizes)
    levels, h = [rank], 1
    active = sa[np.repeat(sizes > 1, sizes)]
    while len(active):
        after = active + h
        second = np.where(after < end[active], rank[np.minimum(after, n - 1)] + 1, 0)
        pair = rank[active] * (n + 1) + second
        o = np.argsort(pair)
        active, pair = active[o], pair[o]
        old = pair // (n + 1)
        head = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
        place = old + np.arange(len(old)) - np.repeat(head, np.diff(np.append(head, len(old))))
        sa[place] = active
        sub = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        sizes = np.diff(np.append(sub, len(pair)))
        rank = rank.copy()
        rank[active] = np.repeat(place[sub], sizes)
        levels.append(rank)
        active = active[np.repeat(sizes > 1, sizes)]
        h *= 2
    return sa, levels


def longest_repeats(text: np.ndarray, word: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each word, the length in words of the longest repeated substring that starts there (0 or 1: not told apart)."""
    n = len(word)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    sa, levels = suffix_array(text, word, end)
    known = levels[min(1, len(levels) - 1)]
    at = np.flatnonzero(known[sa[:-1]] == known[sa[1:]])
    i, j = sa[at], sa[at + 1]
    lcp = np.zeros(len(at), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = i + lcp, j + lcp
        inside = (a < end[i]) & (b < end[j])
        same = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        lcp += same.astype(np.int64) << k
    np.maximum.at(longest, i, lcp)
    np.maximum.at(longest, j, lcp)
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """True for words inside the span of a repeat of ``least`` words or more."""
    n = len(longest)
    step = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(longest >= least)
    np.add.at(step, at, 1)
    np.add.at(step, at + longest[at], -1)
    return np.cumsum(step[:n]) > 0


def _per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[first])


def measure(column: pa.Array, min_repeat: int, with_spans: bool) -> dict[str, pa.Array]:
    """The measures of each text of one batch."""
    buf, off = buffers(column)
    n = len(off) - 1
    starts, ends, first = words(buf, off)
    n_words = np.diff(first)
    text = np.repeat(np.arange(n), n_words)
    end = np.repeat(first[1:], n_words)
    point = (buf & 0xC0) != 0x80
    points = np.concatenate([[0], np.cumsum(point)])
    in_words = np.concatenate([[0], np.cumsum(points[ends] - points[starts])])
    # lines with a word
    cut = np.union1d(np.flatnonzero(buf == 10) + 1, off[:-1])
    stop = np.append(cut[1:], off[-1])
    line_text = np.searchsorted(off, cut, side="right") - 1
    stop = stop - ((stop > cut) & (buf[np.maximum(stop - 1, 0)] == 10) if len(buf) else 0)
    has_word = np.searchsorted(starts, stop) > np.searchsorted(starts, cut)
    cut, stop, line_text = cut[has_word], stop[has_word], line_text[has_word]
    lines = mix(spans_hash(buf, cut, stop) ^ mix(line_text.astype(np.uint64) + np.uint64(1)))
    _, one = np.unique(lines, return_index=True)
    n_lines = np.bincount(line_text, minlength=n)
    distinct = np.bincount(line_text[one], minlength=n)
    longest = longest_repeats(text, spans_hash(buf, starts, ends), end)
    wide = covered(longest, min_repeat)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, text, np.where(longest >= min_repeat, longest, 0))
    out = {"n_words": n_words, "word_chars": np.diff(in_words[first]), "n_symbols": _per_text(_SYMBOL[buf], off),
           "n_dup_lines": n_lines - distinct, "n_repeat_words": _per_text(covered(longest, 3), first),
           "covered_words": _per_text(wide, first), "longest_repeat": top}
    made = {k: pa.array(v.astype(np.int64)) for k, v in out.items()}
    if with_spans:
        edge = np.concatenate([[False], wide, [False]])
        begin = np.concatenate([[False], wide[1:] & (~wide[:-1] | (text[1:] != text[:-1]))]) if len(wide) else wide
        begin[:1] = wide[:1]
        finish = wide & (~edge[2:] | np.append(text[1:] != text[:-1], True)) if len(wide) else wide
        b, f = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        at = np.searchsorted(b, first)
        local = first[:-1][text[b]] if len(b) else b
        made["spans"] = pa.ListArray.from_arrays(
            pa.array(at.astype(np.int32)),
            pa.StructArray.from_arrays([pa.array(b - local), pa.array(f - b)], names=["start", "length"]))
    return made


def _verdict(column: pa.Array, min_words: int = 50, max_repeat_percent: int = 50, min_repeat: int = 10,
             max_covered_percent: int = 30, max_longest: int = 100, spans: bool = False) -> dict[str, pa.Array]:
    m = measure(column, min_repeat, spans)
    n_words, repeat, cover, longest = (np.asarray(m[c]) for c in (
        "n_words", "n_repeat_words", "covered_words", "longest_repeat"))
    failed = (n_words < min_words) | (100 * repeat > max_repeat_percent * n_words)
    kept = ~failed & (100 * cover <= max_covered_percent * n_words) & (longest <= max_longest)
    return m | {"base_failed": pa.array(failed), "kept": pa.array(kept)}


def repetition_rules(docs: DataFrame, min_words: int = 50, max_repeat_percent: int = 50, min_repeat: int = 10,
                     max_covered_percent: int = 30, max_longest: int = 100, id_col: str = "doc_id",
                     text_col: str = "text", spans: bool = False) -> DataFrame:
    """Measures and verdict for each row of ``docs``.

    Base rule: fewer than ``min_words`` words, or more than
    ``max_repeat_percent`` percent of the words in repeated 3-word windows.
    Repetition rule: repeats of ``min_repeat`` words or more cover over
    ``max_covered_percent`` percent of the words, or one of them has over
    ``max_longest`` words. ``kept`` is true when no rule holds. With
    ``spans`` the covered spans follow, as first word and number of words.

    Null and empty texts have no words and fail the base rule; a null id
    stays null; repeated rows are judged each on its own; an empty table
    gives an empty result; other columns are neither read nor kept.
    """
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    more = ["covered_words", "longest_repeat"]
    fields = [T.StructField(id_col, docs.schema[id_col].dataType)]
    fields += [T.StructField(c, T.LongType()) for c in longs]
    fields += [T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")]
    fields += [T.StructField(c, T.LongType()) for c in more]
    if spans:
        fields.append(T.StructField("spans", T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))))
    schema = T.StructType(fields)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                m = _verdict(part.column(text_col), min_words, max_repeat_percent, min_repeat, max_covered_percent,
                             max_longest, spans) | {id_col: part.column(id_col)}
                yield pa.RecordBatch.from_arrays([m[c] for c in schema.names], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(judge, schema)


def keep_by_rules(docs: DataFrame, text_col: str = "text", **rules) -> DataFrame:
    """The rows of ``docs`` that ``repetition_rules`` keeps, with all their columns, judged where they are read."""
    keep = list(docs.columns).index(text_col)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                yield part.filter(_verdict(part.column(keep), **rules)["kept"])

    return docs.mapInArrow(judge, docs.schema)
