"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the output over its
share of the input. Each document inverts the Poisson distribution of that
mean at a uniform number hashed from its id and a seed, is repeated that
often, and gets a hashed key by which the copies are shuffled globally. All
of it depends only on ids, so a lost task gives the same copies again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.session import written

#: So many sources, the largest, have their rates broadcast; rows of the others go through a join.
BROADCAST_SOURCES = 10_000
#: Up to this rate a source carries its distribution, so an array has at most 191 numbers.
TABLE_RATE = 64


def _hashed(text: Column, digits: int) -> Column:
    """The first hex digits of the MD5 sum as a whole number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def repetition_rates(docs: DataFrame, temperature: float = 0.5, epochs: float = 1.0,
                     weights: dict[str, float] | None = None, source_col: str = "source",
                     text_col: str = "text") -> DataFrame:
    """source, n_chars, rate, cdf: one row per source (null is a source of its own).

    The target share is the weight given for the source, or else its
    characters to the power ``temperature``; shares are scaled to sum to 1
    and the output to ``epochs`` times the input's characters. An empty text
    counts as one character. ``cdf`` holds the Poisson distribution function
    from 0 to a value whose tail is below the resolution of the uniform number;
    it is null for rates above ``TABLE_RATE``, where each row adds the terms up.
    """
    size = F.greatest(F.coalesce(F.length(F.col(text_col)), F.lit(0)), F.lit(1)).cast("long")
    by = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size).alias("n_chars"))
    weight = F.pow(F.col("n_chars").cast("double"), F.lit(float(temperature)))
    if weights:
        given = F.create_map(*[F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))])
        weight = F.coalesce(F.element_at(given, F.coalesce(F.col("source").cast("string"), F.lit(""))), F.lit(0.0))
    by = by.select("*", weight.alias("w"))
    by = written(by, "sources")
    sum_w, sum_c = by.agg(F.sum("w"), F.sum("n_chars")).first()
    rate = F.col("w") / F.lit(sum_w) * F.lit(sum_c * float(epochs)) / F.col("n_chars") if sum_w else F.lit(0.0)
    by = by.select("source", "n_chars", rate.alias("rate"))
    step = F.aggregate(
        F.sequence(F.lit(1), _last(F.col("rate"))),
        F.struct((-F.col("rate")).alias("lp"), F.exp(-F.col("rate")).alias("s"), F.array(F.exp(-F.col("rate"))).alias("c")),
        lambda a, k: _term(F.col("rate"), a, k, lambda s: F.concat(a["c"], F.array(s)).alias("c")))["c"]
    return by.select("*", F.when(F.col("rate") <= 0, F.array(F.lit(1.0))).when(F.col("rate") <= TABLE_RATE, step).alias("cdf"))


def _last(rate: Column) -> Column:
    """A value whose tail is below the resolution of the uniform number."""
    return F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")


def _term(rate: Column, a: Column, k: Column, more) -> Column:
    """The state after the term of k: log p(k) = log p(k - 1) + log(rate / k), so large rates do not underflow."""
    lp = a["lp"] + F.log(rate / k)
    s = a["s"] + F.exp(lp)
    return F.struct(lp.alias("lp"), s.alias("s"), more(s))


def _inverted(rate: Column, uniform: Column) -> Column:
    """How many values of the distribution function are at most ``uniform``; the work is that of the copies made."""
    return F.aggregate(
        F.sequence(F.lit(1), _last(rate)),
        F.struct((-rate).alias("lp"), F.exp(-rate).alias("s"), (F.exp(-rate) <= uniform).cast("int").alias("n")),
        lambda a, k: _term(rate, a, k, lambda s: (a["n"] + (s <= uniform).cast("int")).alias("n")))["n"]


def _with_rates(docs: DataFrame, rates: DataFrame, source_col: str) -> DataFrame:
    """Rows with their source's rate. The largest sources are broadcast, so a joined one has few of all characters."""
    same = F.col(source_col).eqNullSafe(F.col("__mix_source"))
    if rates.count() <= BROADCAST_SOURCES:
        return docs.join(F.broadcast(rates), same)
    large = written(rates.orderBy(F.col("__mix_chars").desc(), "__mix_source").limit(BROADCAST_SOURCES), "large-sources")
    small = docs.join(F.broadcast(large), same, "left_anti").join(rates, same)
    return docs.join(F.broadcast(large), same).unionByName(small)


def replicate(docs: DataFrame, seed: int = 7, temperature: float = 0.5, epochs: float = 1.0,
              weights: dict[str, float] | None = None, id_col: str = "doc_id", source_col: str = "source",
              text_col: str = "text", copy_col: str = "copy", key_col: str = "shuffle_key") -> DataFrame:
    """Each row of ``docs`` as often as its Poisson number says, in globally shuffled order.

    All columns of ``docs`` are kept; ``copy_col`` counts a row's copies from
    1 and ``key_col`` is the hashed key the output is partitioned and sorted
    by. Columns of ``docs`` with these two names are replaced.

    A null source is a source of its own, a null text counts as empty, a
    null id hashes like an empty one; rows that repeat an id are repeated
    alike; a source without weight gives no copies; an empty table gives an
    empty result.
    """
    rates = repetition_rates(docs, temperature, epochs, weights, source_col, text_col).select(
        *[F.col(c).alias(f"__mix_{n}") for c, n in (("source", "source"), ("n_chars", "chars"), ("rate", "rate"), ("cdf", "cdf"))])
    names = [c for c in docs.columns if c.lower() not in (copy_col.lower(), key_col.lower())]
    rows = _with_rates(docs.select(*names), rates, source_col)
    ident = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    uniform = _hashed(ident, 13) / F.lit(float(1 << 52))
    rows = rows.select("*", ident.alias("__mix_id"), uniform.alias("__mix_u"))
    times = rows.select(*names, "__mix_id", F.when(
        F.col("__mix_cdf").isNotNull(), F.size(F.filter("__mix_cdf", lambda c: c <= F.col("__mix_u")))).otherwise(
        _inverted(F.col("__mix_rate"), F.col("__mix_u"))).alias("__mix_n"))
    copies = times.filter("__mix_n > 0").select(
        *names, "__mix_id", F.explode(F.sequence(F.lit(1), F.col("__mix_n"))).alias(copy_col))
    keyed = copies.select(*names, copy_col, _hashed(F.concat("__mix_id", F.lit(":"), F.col(copy_col).cast("string")),
                                                    15).alias(key_col))
    return keyed.repartition(key_col).sortWithinPartitions(key_col)
