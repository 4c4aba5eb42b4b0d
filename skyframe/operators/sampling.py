"""Seeded, repeatable sampling and splitting (survey H1-H6, G2).

Random order is a seeded hash of a row key: ``md5(key_text || seed)``.
The same text gives the same order in any engine, so samples can be
re-derived and checked. As the hash is uniform, its first digits cut the
order into even bins: counts per bin (combined map-side) give every bin's
rank range.

* A cut at a rank needs only the key of that row, found in its one bin:
  sizes, splits and folds are filters with literals and move no rows.
* A rank of every row adds the row's place in its bin to the bin's offset;
  bins are small, whatever a group holds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.plans import ordered

HASH = "_h"
#: Rows of a bin that a cut may bring to the driver; a fuller bin is cut again by its next digits.
CUT_ROWS = 20_000
_DIGITS = 3


def seeded_hash(key_cols, seed: int) -> Column:
    """Hex md5 of the ``|``-joined key text followed by ``|seed``."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed))))


def _cut_key(h: DataFrame, key_cols, bins: list, rank: int) -> tuple[tuple, int, int]:
    """(key of the row at ``rank``, rows before that key, rows with it) from sorted (prefix, count) of the hash."""
    before, prefix = 0, ""
    while True:
        for p, n in bins:
            if before + n >= rank:
                break
            before += n
        prefix = p
        inside = h.filter(F.substring(HASH, 1, len(prefix)) == prefix)
        if n <= CUT_ROWS or len(prefix) >= 32:
            break
        bins = _bins(inside, len(prefix) + _DIGITS)
    keys = [HASH, *key_cols]
    per_key = inside.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    for r in per_key.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).collect():        # at most CUT_ROWS rows
        if before + r["n"] >= rank:
            return tuple(r[k] for k in keys), before, r["n"]
        before += r["n"]
    raise AssertionError("rank beyond the table")


def _bins(h: DataFrame, digits: int) -> list:
    """Sorted (prefix, count): at most 16 ** _DIGITS rows for one parent prefix."""
    return sorted(tuple(r) for r in h.groupBy(F.substring(HASH, 1, digits).alias("p")).count().collect())


def segments(df: DataFrame, key_cols, seed: int, ends, label: str = "segment") -> DataFrame:
    """Rows labelled 0, 1, ... by where their rank in the seeded order falls:
    segment i holds the ranks after ``ends(n)[i - 1]`` up to ``ends(n)[i]``,
    the last label the rest. Nothing is shuffled but rows whose key lies on
    a cut and occurs more than once (these are ranked among themselves)."""
    key_cols = list(key_cols)
    h = df.withColumn(HASH, seeded_hash(key_cols, seed))
    narrow = h.select(HASH, *key_cols)
    bins = _bins(narrow, _DIGITS)
    n = sum(c for _, c in bins)
    keys, types = [HASH, *key_cols], T.StructType([h.schema[k] for k in [HASH, *key_cols]])
    out, split, found = F.lit(0), [], {}
    cuts = list(ends(n))
    for rank in cuts:
        if rank <= 0:
            out = out + 1
        elif rank < n:
            key, before, same = found.setdefault(rank, _cut_key(narrow, key_cols, bins, rank))
            out = out + F.when(ordered.lex_less(keys, key, types) | ordered.lex_equal(keys, key, types), 0).otherwise(1)
            if before + same > rank:
                split.append((key, before))
    plain = h.withColumn(label, out)
    if not split:
        return plain.drop(HASH)
    on_cut = F.lit(False)
    for key, _ in split:
        on_cut = on_cut | ordered.lex_equal(keys, key, types)
    parts = [plain.filter(~on_cut).select(*df.columns, label)]
    for key, before in dict(split).items():
        r = ordered.with_rank(h.filter(ordered.lex_equal(keys, key, types)), keys, rank_col="_r", size_col=None)
        inner = sum((F.when(F.col("_r") + before > rank, 1).otherwise(0) for rank in cuts), F.lit(0))
        parts.append(r.withColumn(label, inner).select(*df.columns, label))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def hash_rank(df: DataFrame, key_cols, seed: int, group=(), rank: str = "row_num", size: str | None = "group_size",
              keep: Column | None = None) -> DataFrame:
    """Rank of each row in the seeded order of its group, and the group's
    size. Offsets are counted per bin of the hash and joined on (group,
    bin); the place in a bin is a window over that bin. Only rows for which
    ``keep`` (over the bin's columns ``_off`` = rows before the bin, and
    ``size``) may hold are shuffled further."""
    group, size_ = list(group), size or "_size"
    h = df.withColumn(HASH, seeded_hash(key_cols, seed))
    digits = max(2, math.ceil(math.log(max(h.count(), 1) / 500 + 1, 16)))
    h = h.withColumn("_p", F.substring(HASH, 1, digits))
    per = h.groupBy(*group, "_p").agg(F.count(F.lit(1)).alias("_bin_n")).withColumn("_q", F.substring("_p", 1, 2))
    wide = Window.partitionBy(*group)
    top = per.groupBy(*group, "_q").agg(F.sum("_bin_n").alias("_bin_m"))                       # at most 256 rows per group
    upto = wide.orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)
    top = top.select(*[F.col(g).alias(f"_t{i}") for i, g in enumerate(group)], F.col("_q").alias("_tq"),
                     F.coalesce(F.sum("_bin_m").over(upto), F.lit(0)).alias("_top"), F.sum("_bin_m").over(wide).alias(size_))
    same = [F.col(g).eqNullSafe(F.col(f"_t{i}")) for i, g in enumerate(group)] + [F.col("_q") == F.col("_tq")]
    inside = Window.partitionBy(*group, "_q").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offs = per.withColumn("_in", F.coalesce(F.sum("_bin_n").over(inside), F.lit(0))).join(top, same).select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_p").alias("_gp"),
        (F.col("_top") + F.col("_in")).alias("_off"), size_)
    if keep is not None:
        offs = offs.filter(keep)
    cond = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)] + [F.col("_p") == F.col("_gp")]
    w = Window.partitionBy(*group, "_p").orderBy(HASH, *[F.col(k).asc_nulls_first() for k in key_cols])
    out = h.join(offs, cond).withColumn(rank, F.row_number().over(w) + F.col("_off"))
    return out.select(*df.columns, rank, *([size] if size else []))


# H1 (+ D1, D2)
def stratified_sample(df: DataFrame, keys, key_cols, fraction: float = 1.0, seed: int = 42) -> DataFrame:
    """``ceil(n_g * fraction)`` rows of every group, in seeded order. Bins
    that start beyond a group's share are not shuffled."""
    take = F.ceil(F.col("group_size") * F.lit(float(fraction)))
    r = hash_rank(df, key_cols, seed, group=keys, keep=F.col("_off") < take)
    return r.filter(F.col("row_num") <= take)


# H2
def sample_n(df: DataFrame, key_cols, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """``int(fraction * N)`` rows in seeded order."""
    s = segments(df, key_cols, seed, lambda n: [math.floor(n * fraction)], "_s")
    return s.filter("_s = 0").drop("_s")


_CHUNK = 100_000


def _draws(sizes: DataFrame, seed: int) -> DataFrame:
    """(_dg, _dr, _dn): how often rank ``_dr`` of group ``_dg`` is drawn by
    ``extra`` seeded draws with replacement. Draws are made in chunks, so a
    group with very many of them is spread over tasks."""
    chunks = sizes.select("g", "n", "extra", F.explode(F.sequence(
        F.lit(0), F.floor((F.col("extra") - 1) / _CHUNK).cast("long"))).alias("c")).repartition("g", "c")
    first = F.col("c") * _CHUNK + 1
    each = chunks.select("g", "n", F.explode(F.sequence(first, F.least(first + (_CHUNK - 1), F.col("extra")))).alias("j"))
    text = F.concat_ws("|", F.lit(str(seed)), F.col("g").cast("string"), F.col("j").cast("string"))
    rank = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long") % F.col("n") + 1
    return each.select("g", rank.alias("r")).groupBy(F.col("g").alias("_dg"), F.col("r").alias("_dr")).agg(
        F.count(F.lit(1)).alias("_dn"))


# H3
def resample_groups(df: DataFrame, group: str, multipliers: dict, key_cols, seed: int = 42,
                    cap: float = 2.0) -> DataFrame:
    """Group ``g`` gets ``max(1, min(int(n*m), cap*n))`` rows: down-sampled
    without replacement (first rows of the seeded order); up-sampled by
    keeping every row and drawing the missing ones with replacement (each
    draw is a seeded rank). Groups without a multiplier keep every row.
    ``copy`` numbers the copies of a row."""
    named = F.col(group).isin(list(multipliers))
    rest = df.filter(~F.coalesce(named, F.lit(False))).withColumn("copy", F.lit(1))
    m = F.lit(None).cast("double")
    for name, mult in multipliers.items():
        m = F.when(F.col(group) == name, F.lit(float(mult))).otherwise(m)
    new = F.greatest(F.lit(1), F.least(F.floor(F.col("_n") * m).cast("long"), (F.col("_n") * cap).cast("long")))
    r = hash_rank(df.filter(named), key_cols, seed, [group], "_r", "_n").withColumn("_new", new)
    sizes = df.filter(named).groupBy(F.col(group)).agg(F.count(F.lit(1)).alias("_n")).withColumn("_new", new).filter(
        "_new > _n").select(F.col(group).alias("g"), F.col("_n").alias("n"), (F.col("_new") - F.col("_n")).alias("extra"))
    drawn = r.join(_draws(sizes, seed), (F.col(group) == F.col("_dg")) & (F.col("_r") == F.col("_dr")), "left")
    copies = F.when(F.col("_new") >= F.col("_n"), 1 + F.coalesce(F.col("_dn"), F.lit(0))).otherwise(
        F.when(F.col("_r") <= F.col("_new"), 1).otherwise(0)).cast("int")
    out = drawn.withColumn("_copies", copies).filter("_copies > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return out.select(*df.columns, "copy").unionByName(rest)


# H4
def split_3way(df: DataFrame, key_cols, test_size: float = 0.2, val_size: float = 0.2, seed: int = 42,
               label: str = "split") -> DataFrame:
    """Labels ``test`` (first ``ceil(test*N)`` of the seeded order),
    ``validation`` (next ``ceil(val/(1-test) * (N - n_test))``), ``train``."""
    def ends(n):
        _, n_val, n_test = split_sizes(n, test_size, val_size)
        return [n_test, n_test + n_val]

    names = F.array(F.lit("test"), F.lit("validation"), F.lit("train"))
    return segments(df, key_cols, seed, ends, "_s").withColumn(label, F.get(names, F.col("_s"))).drop("_s")


# H5
def combine_train_val(split_df: DataFrame, label: str = "split") -> DataFrame:
    return split_df.filter(F.col(label).isin("train", "validation"))


# H6
def kfold(df: DataFrame, key_cols, k: int = 10, seed: int = 42, label: str = "fold") -> DataFrame:
    """Contiguous folds over the seeded order; the first ``N % k`` folds
    hold one extra row (the usual k-fold sizes)."""
    def ends(n):
        return [n // k * i + min(i, n % k) for i in range(1, k)]

    return segments(df, key_cols, seed, ends, label)


# G2
def shuffle_rows(df: DataFrame, key_cols, seed: int = 42) -> DataFrame:
    """Rows in seeded order (only when a file order is needed)."""
    return df.withColumn(HASH, seeded_hash(key_cols, seed)).orderBy(HASH, *key_cols).drop(HASH)


def split_sizes(n: int, test_size: float = 0.2, val_size: float = 0.2) -> tuple[int, int, int]:
    n_test = math.ceil(n * test_size)
    n_val = math.ceil((n - n_test) * (val_size / (1 - test_size)))
    return n - n_test - n_val, n_val, n_test
