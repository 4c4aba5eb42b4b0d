"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding undoes what hides a word: case, look-alike letters of other scripts,
full-width forms, invisible characters and digits or signs that stand for
letters inside a word. At the edge of a word such signs may be punctuation or
numbers, and accents may be spelling: there a word has further forms, of
which one is taken where it matches more of the lexicon. The lexicon (whole words and word stems) and its
weights are learned from labelled texts; phrases that hold a lexicon entry
but occur in clean texts are exceptions and cancel the entries inside them.
The sum of weights is normalised by the length of the text and put through
a fitted logistic curve.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Look-alike letters and the signs that stand for letters inside words.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ғ": "f", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t",
    "υ": "u", "χ": "x", "γ": "y", "ɑ": "a", "ɡ": "g", "ı": "i", "ʟ": "l", "ո": "n", "ս": "u", "օ": "o", "ѡ": "w",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l"}
INVISIBLE = "­​‌‍⁠﻿"

_TABLE = {ord(k): v for k, v in HOMOGLYPHS.items()} | {ord(c): None for c in INVISIBLE} \
    | {0xFF01 + i: chr(0x21 + i) for i in range(94)}
_ODD = re.compile("[" + "".join(map(re.escape, HOMOGLYPHS)) + INVISIBLE + "！-～]")
_SUB = re.compile(r"(?<=[^\W\d_])[" + re.escape("".join(SUBSTITUTES)) + r"]+(?=[^\W\d_])")
_LEAD = re.compile("[" + re.escape("".join(SUBSTITUTES)) + r"]+(?=[^\W\d_])")
_TRAIL = re.compile(r"(?<=[^\W\d_])[" + re.escape("".join(SUBSTITUTES)) + "]+")
_TOKEN = re.compile(r"[\w" + re.escape("".join(SUBSTITUTES)) + "\u0300-\u036f" + INVISIBLE + "！-～]+")
_HAS_SUB = re.compile("[" + re.escape("".join(SUBSTITUTES)) + "]")
_NOT_LETTER = re.compile(r"[\W\d_]+")


def fold(text: str | None) -> str:
    """Folded words between single blanks, with a blank at both ends."""
    t = (text or "").lower()
    if not t.isascii() and _ODD.search(t):
        t = t.translate(_TABLE).lower()
    if _HAS_SUB.search(t):
        t = _SUB.sub(lambda m: "".join(SUBSTITUTES[c] for c in m.group()), t)
    return f" {_NOT_LETTER.sub(' ', t).strip()} "


def second_forms(token: str) -> list[str]:
    """Folded like a text, but without accents and with signs before, after or at both edges of words taken for letters."""
    t = unicodedata.normalize("NFKD", token.lower().translate(_TABLE))
    t = "".join(c for c in t if not unicodedata.combining(c)).lower().translate(_TABLE)
    if not _HAS_SUB.search(t):
        return [fold(t)]
    out = []
    for edges in ((_LEAD,), (_TRAIL,), (_LEAD, _TRAIL)):
        form = t
        for edge in edges:
            form = edge.sub(lambda m: "".join(SUBSTITUTES[c] for c in m.group()), form)
        out.append(fold(form))
    return out


STEMS = range(4, 9)


def features(folded: str) -> set[str]:
    """Whole words as " word ", stems of longer words as " stem"."""
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in STEMS if n < len(w))
    return out


@dataclass
class Lexicon:
    """Entries with weights, exception phrases, and the curve from density to score."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    slope: float = 0.0
    offset: float = -2.0

    def matcher(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            a.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            if phrase not in self.weights:
                a.add_word(phrase, (len(phrase), None))
        if len(a):
            a.make_automaton()
        return a


def unmask(automaton, text: str | None, chosen: dict[str, str] | None = None) -> str:
    """The folded text, its words in another form where that matches more of the lexicon.

    ``chosen`` keeps the forms of short tokens from call to call, for one automaton.
    """
    text, chosen = text or "", {} if chosen is None else chosen
    if not len(automaton) or (text.isascii() and not _HAS_SUB.search(text)):
        return fold(text)

    def choose(match: re.Match) -> str:
        token = match.group()
        if token.isascii() and not _HAS_SUB.search(token):
            return token
        if token in chosen:
            return chosen[token]
        best, out = max(second_forms(token), key=lambda f: _matched(automaton, f)), token
        if _matched(automaton, best) > 0.0 and _matched(automaton, best) > _matched(automaton, fold(token)):
            out = best
        if len(token) <= 40:
            if len(chosen) >= 100_000:
                chosen.clear()
            chosen[token] = out
        return out

    return fold(_TOKEN.sub(choose, text))


def density(automaton, folded: str) -> float:
    """Sum of the weights of matched words over the root of the number of words.

    A word counts once, with its strongest entry; a word inside an exception phrase does not count.
    """
    return _matched(automaton, folded) / max(folded.count(" ") - 1, 1) ** 0.5


def _matched(automaton, folded: str) -> float:
    """Sum of the weights of matched words."""
    if not len(automaton):
        return 0.0
    best: dict[int, float] = {}
    shields: list[tuple[int, int]] = []
    for end, (size, weight) in automaton.iter(folded):
        begin = end - size + 1
        if weight is None:
            shields.append((begin, end))
        elif weight > best.get(begin, 0.0):
            best[begin] = weight
    if not best:
        return 0.0
    return sum(w for at, w in best.items() if not any(a <= at < b for a, b in shields))


def _id_crc(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(0))


def held_out(id_col: str = "doc_id") -> Column:
    return _id_crc(id_col) % 4 == 2


def _sample(docs: DataFrame, labels: DataFrame, bound: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """id, text, label of about ``bound`` training rows per class, chosen by a hash of the id (all, if there are fewer)."""
    marked = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(
        F.col(id_col).alias("id")).agg(F.max(F.col(label_col)).cast("int").alias("label"))
    share = {r["label"]: min(1.0, bound / r["count"]) for r in marked.groupBy("label").count().collect()}
    pick = F.pmod(F.xxhash64("id", F.lit(29)), F.lit(1 << 30)) / float(1 << 30)
    chosen = marked.filter(pick < F.when(F.col("label") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0)))
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")


def _counts(rows: DataFrame, entries: frozenset[str] | None = None) -> DataFrame:
    """feature, n: texts that hold it. With ``entries``, word pairs that hold one of them instead."""
    schema = "feature string, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c: Counter[str] = Counter()
            for text in batch.column("text").to_pylist():
                folded = fold(text)
                if entries is not None:
                    words = folded.split()
                    hit = [not entries.isdisjoint(features(f" {w} ")) for w in words]
                    c.update({f" {words[i]} {words[i + 1]} " for i in range(len(words) - 1) if hit[i] or hit[i + 1]})
                else:
                    c.update(features(folded))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())],
                                             names=["feature", "n"])

    return rows.select("text").mapInArrow(count, schema).groupBy("feature").agg(F.sum("n").alias("n"))


def _against(one: DataFrame, other: DataFrame, n_one: int, n_other: int) -> DataFrame:
    """feature, n, other, odds, chance: counts in both classes of the features of ``one``.

    ``odds`` are the smoothed log odds; ``chance`` is the log of Chernoff's bound on the probability that so large a
    share of the feature's texts, or a larger one, falls into the first class when it says nothing of the class.
    """
    both = one.join(other.select("feature", F.col("n").alias("other")), "feature", "left").select(
        "feature", "n", F.coalesce("other", F.lit(0)).alias("other"))
    share = n_one / (n_one + n_other)
    part = F.col("n") / (F.col("n") + F.col("other"))
    rest = F.when(F.col("other") > 0, F.col("other") * F.log((1 - part) / F.lit(1 - share))).otherwise(F.lit(0.0))
    chance = F.when(part > share, -(F.col("n") * F.log(part / F.lit(share)) + rest)).otherwise(F.lit(0.0))
    odds = F.log((F.col("n") + 0.5) / F.lit(n_one + 1.0)) - F.log((F.col("other") + 0.5) / F.lit(n_other + 1.0))
    return both.select("*", odds.alias("odds"), chance.alias("chance"))


def learn(docs: DataFrame, labels: DataFrame, bound: int = 20_000, least: int = 5,
          log_odds: float = 3.0, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Lexicon:
    """Lexicon from about ``bound`` training rows of each class.

    Entries occur in ``least`` toxic texts, have smoothed log odds of ``log_odds`` against the clean texts, and are
    too rare among those for chance: of all features tested less than one would be expected to pass. Exceptions
    occur in ``least`` clean texts. A stem whose own shorter stem is an entry is
    left out. Without labels of both classes the lexicon is empty and every
    score the same.
    """
    sample = _sample(docs, labels, bound, id_col, text_col, label_col).persist()
    try:
        sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
        n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
        if not n_toxic or not n_clean:
            return Lexicon()
        toxic, clean = sample.filter("label = 1"), sample.filter("label = 0")
        tested = _counts(toxic).filter(F.col("n") >= least).persist()
        try:
            limit = -float(np.log(max(tested.count(), 1)))
            passed = _against(tested, _counts(clean), n_toxic, n_clean).filter(
                (F.col("odds") >= log_odds) & (F.col("chance") <= limit)).collect()
        finally:
            tested.unpersist()
        odds = {r["feature"]: r["odds"] for r in passed}
        lexicon: dict[str, float] = {}
        for f in sorted(odds, key=lambda f: (len(f.rstrip()), -len(f), f)):
            w = f.strip()
            if not any(f" {w[:n]}" in lexicon for n in STEMS if n < len(w)):
                lexicon[f] = odds[f]
        entries = frozenset(lexicon)
        exceptions = _against(_counts(clean, entries).filter(F.col("n") >= least), _counts(toxic, entries),
                              n_clean, n_toxic).filter("odds > 0").collect()
        out = Lexicon(lexicon, sorted(r["feature"] for r in exceptions))
        # the curve is fitted to counts per 0.01 of density and class
        bins = _densities(sample.select("id", "text", "label"), out, ["label"]).groupBy(
            F.round("density", 2).alias("x"), "label").count().collect()
        x, y, w = (np.array([r[c] for r in bins], float) for c in ("x", "label", "count"))
        out.offset, out.slope = _logistic(x, y, w)
        return out
    finally:
        sample.unpersist()


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Offset and slope of a weighted logistic regression, by Newton steps with a ridge on the slope."""
    a, beta = np.stack([np.ones_like(x), x], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        pull = np.array([0.0, ridge * beta[1]])
        grad = a.T @ (w * (y - p)) - pull
        hess = (a * (w * p * (1 - p))[:, None]).T @ a + np.diag([1e-6, ridge])
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(beta[1], 0.0))


def _densities(rows: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField("density", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, chosen = lexicon.matcher(), {}
        for batch in batches:
            d = [density(automaton, unmask(automaton, t, chosen)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(d, pa.float64())],
                                             names=schema.names)

    return rows.mapInArrow(run, schema)


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``id_col``, held_out, score, predicted for each row of ``docs``.

    A null or empty text has density 0; a null id counts as not held out;
    repeated rows are scored each on its own; an empty table gives an empty
    result; other columns are neither read nor kept.
    """
    d = _densities(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), lexicon, ["id"])
    value = 1 / (1 + F.exp(-(F.lit(lexicon.offset) + F.lit(lexicon.slope) * F.col("density"))))
    return d.select(F.col("id").alias(id_col), "density", value.alias("score")).select(
        id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
