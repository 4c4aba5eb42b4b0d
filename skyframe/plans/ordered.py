"""Operators that need a total order over a whole table (survey §4.3).

A plain ``Window.orderBy`` without a partition key moves every row into
one task. The helpers here keep the work distributed:

* ``range_buckets`` labels each row with an ordered bucket number. The
  bucket bounds come from a bounded sample of the full ordering key (order
  columns + tie-break columns, so even one hot order value is split) and
  are held as one literal: a row's bucket is a plain expression of its key,
  found by binary search, the same in every branch, retry and recomputation.
  No copy of the table is written and nothing has to be dropped afterwards.
* Per-bucket summaries (row counts, last non-null value) read only the
  columns they need, are combined map-side and form a table of at most
  ``num_buckets`` rows; running sums over it are cheap and it is broadcast
  back (its size is the bucket count we chose, a proven bound).
* The final window is partitioned by bucket: one shuffle of the rows.

``drop_tail`` needs only the last ``n`` rows: a top-n sort (bounded by n)
gives the boundary key and the rest is a filter with literals.

The input of these operators must give the same rows whenever it is
computed (no unseeded random columns). They read it several times (bounds,
summaries, rows), so callers write an input that is dear to compute once
(``session.written``) and hand in the table.
"""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bucket"
#: Sampled keys per bucket: the bounds of a bucket are then off by a few percent.
SAMPLE_PER_BUCKET = 60
_CELLS = 16


def _default_buckets(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return isinstance(t, (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType,
                          T.BooleanType, T.BinaryType))


def total_order(df: DataFrame, order, tie=None) -> list[str]:
    """Order columns followed by tie-break columns (default: every other
    orderable column, which makes rows that still tie identical)."""
    order = list(order)
    if tie is None:
        tie = [f.name for f in df.schema.fields if f.name not in order and _orderable(f.dataType)]
    return order + [c for c in tie if c not in order]


def _key(names) -> Column:
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(names)])


def _literal_key(values, types) -> Column:
    return F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(values, types))])


def _plain(name: str, t: T.DataType) -> Column:
    """A key column in a form that JSON carries exactly and that orders alike; always nullable."""
    c = F.col(name)
    if isinstance(t, T.TimestampNTZType):
        c = F.unix_micros(c.cast("timestamp"))
    elif isinstance(t, T.TimestampType):
        c = F.unix_micros(c)
    elif isinstance(t, T.DateType):
        c = F.unix_date(c)
    return F.when(F.col(name).isNotNull(), c)


def _plain_key(df: DataFrame, keys) -> Column:
    return F.struct(*[_plain(k, df.schema[k].dataType).alias(f"k{i}") for i, k in enumerate(keys)])


def range_bounds(df: DataFrame, keys, num_buckets: int) -> list[str]:
    """At most ``num_buckets - 1`` ascending keys (as JSON) that cut the
    table into parts of about equal size, from a sample bounded by the
    bucket count."""
    narrow = df.select(_plain_key(df, keys).alias("k"))
    rows, wanted = narrow.count(), num_buckets * SAMPLE_PER_BUCKET
    sample = narrow if rows <= wanted else narrow.sample(False, min(1.0, wanted / rows), 17)
    got = [r[0] for r in sample.orderBy(F.col("k").asc_nulls_first()).select(F.to_json("k")).collect()]
    cuts = [got[i * len(got) // num_buckets] for i in range(1, num_buckets)] if got else []
    return [c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1]]


def range_buckets(df: DataFrame, keys, num_buckets: int | None = None) -> DataFrame:
    """Rows labelled with an ordered bucket id (see module doc): how many
    bounds are not above the row's key, by binary search in steps of
    halving powers of two. The bounds are one constant-folded literal, so
    their number does not blow up the plan."""
    nb = num_buckets or _default_buckets(df)
    bounds = range_bounds(df, keys, nb)
    if not bounds:
        return df.withColumn(BUCKET, F.lit(0))
    n, key = len(bounds), _plain_key(df, keys)
    kind = T.ArrayType(df.select(key.alias("k")).schema["k"].dataType)
    table = F.from_json(F.lit("[" + ",".join(bounds) + "]"), kind)

    # the key is part of the state, so that its expressions are evaluated once a row
    def step(acc, size):
        at = acc["at"]
        over = (at + size <= n) & (F.get(table, at + size - 1) <= acc["k"])
        return F.struct(acc["k"].alias("k"), F.when(over, at + size).otherwise(at).alias("at"))

    steps = [1 << i for i in reversed(range(n.bit_length()))]
    found = F.aggregate(F.array(*map(F.lit, steps)), F.struct(key.alias("k"), F.lit(0).alias("at")), step,
                        lambda acc: acc["at"])
    return df.withColumn(BUCKET, _by_cell(df, keys[0], bounds, found))


def _by_cell(df: DataFrame, name: str, bounds: list[str], found: Column) -> Column:
    """``found``, looked up by the first key column where that decides: its
    range is cut into even cells, and a cell without a bound lies in one bucket."""
    t = df.schema[name].dataType
    values = [json.loads(b).get("k0") for b in bounds]
    known = [v for v in values if v is not None]
    if not known or not isinstance(t, (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return found
    low, high = known[0], known[-1]
    width = max((high - low) // (_CELLS * len(bounds)), 1)
    held = [0] * ((high - low) // width + 1)
    for v in known:
        held[(v - low) // width] += 1
    before = list(accumulate(held, initial=len(values) - len(known)))
    bucket = [b if h == 0 else None for b, h in zip(before, held)]
    v = _plain(name, t).cast("long")
    cell = F.call_function("div", v - F.lit(low).cast("long"), F.lit(width).cast("long")).cast("int")
    inside = F.get(F.from_json(F.lit(json.dumps(bucket)), "array<int>"), cell)
    return F.when(v < low, F.lit(before[0])).when(v > high, F.lit(len(bounds))).otherwise(F.coalesce(
        F.when(v.isNotNull(), inside), found))


def lex_less(keys, values, schema: T.StructType) -> Column:
    """Row key < given literal key, ascending with nulls first. The first
    column decides most rows; the others are compared only where it ties."""
    types = [schema[k].dataType for k in keys]
    first, edge = F.col(keys[0]), F.lit(values[0]).cast(types[0])
    less = F.lit(False) if values[0] is None else F.coalesce(first < edge, F.lit(True))
    if len(keys) == 1:
        return less
    return less | (first.eqNullSafe(edge) & (_key(keys[1:]) < _literal_key(values[1:], types[1:])))


def lex_equal(keys, values, schema: T.StructType) -> Column:
    out = F.lit(True)
    for k, v in zip(keys, values):
        out = out & F.col(k).eqNullSafe(F.lit(v).cast(schema[k].dataType))
    return out


def drop_tail(df: DataFrame, n: int, order, tie=None) -> DataFrame:
    """Remove the last ``n`` rows of the total order when the table has
    more than ``n`` rows (published rule), otherwise keep everything.

    The order is (order, tie, every other orderable column). A bounded
    top-n finds the key of the ``n``-th last row; rows before it stay, by a
    filter with literals. The other columns are only looked at when rows on
    both sides of the cut share (order, tie). Rows that share the whole key
    are equal in every orderable column; as many copies of them stay as are
    not in the tail.
    """
    short = total_order(df, order, tie or ())
    for keys in (short, total_order(df, short, None)):
        desc = [F.col(k).desc_nulls_last() for k in keys]
        top = [tuple(r) for r in df.select(*keys).orderBy(*desc).limit(n + 1).collect()]     # at most n + 1 rows
        if len(top) <= n:
            return df
        edge = top[n - 1]
        if top[n] != edge:
            return df.filter(lex_less(keys, edge, df.schema))
    before = df.filter(lex_less(keys, edge, df.schema))
    equal = df.filter(lex_equal(keys, edge, df.schema))
    spare = equal.count() - sum(r == edge for r in top[:n])
    return before.unionByName(equal.limit(spare))


def number_rows(df: DataFrame, order, tie=None, name: str = "row_num", small: int = 100_000) -> DataFrame:
    """``df`` numbered from 1 in the total order. The rows are written once;
    up to ``small`` of them (their number is known then) are numbered by a
    plain window, more by the distributed rank."""
    from skyframe.session import written
    keys = total_order(df, order, tie)
    df = written(df, "to-number")
    if df.count() > small:
        return with_rank(df, order, tie=tie, rank_col=name, size_col=None)
    w = Window.orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    return df.withColumn(name, F.row_number().over(w))


def forward_fill(df: DataFrame, cols, order, tie=None, num_buckets: int | None = None, keep_bucket: bool = False) -> DataFrame:
    """D3: each listed column takes the last non-null value from the start
    of the total order up to the current row (leading nulls stay null).
    With ``keep_bucket`` the rows come with their bucket (``BUCKET``), by
    which they are partitioned."""
    keys = total_order(df, order, tie)
    x = range_buckets(df, keys, num_buckets)
    okey = F.struct(*[F.col(k) for k in keys])
    per_bucket = x.groupBy(BUCKET).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), okey)).alias(f"_last_{c}") for c in cols])
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(
        BUCKET, *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}") for c in cols])
    w = (Window.partitionBy(BUCKET).orderBy(*[F.col(k).asc_nulls_first() for k in keys])
         .rowsBetween(Window.unboundedPreceding, 0))
    # the carried values are joined on behind the window, so they are not shuffled
    out = x.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols}).join(F.broadcast(carry), BUCKET)
    out = out.withColumns({c: F.coalesce(c, f"_carry_{c}") for c in cols})
    return out.select(*df.columns, *([BUCKET] if keep_bucket else []))


def _edge_sums(x: DataFrame, group, sums: dict[str, Column]) -> DataFrame:
    """Per (group, bucket) at the ends of buckets: sums of the group in
    earlier buckets (``_before_*``) and in all (``_total_*``).

    Only the first group of a bucket can have rows in earlier buckets and
    only its last group can continue in later ones, so at most two rows per
    bucket are kept; group columns are renamed ``_g<i>``, the bucket ``_gb``."""
    per = x.groupBy(BUCKET, *group).agg(*[c.alias(f"_s_{n}") for n, c in sums.items()])
    if group:
        here = Window.partitionBy(BUCKET)
        up, down = ([f(F.col(g)) for g in group] for f in (lambda c: c.asc_nulls_first(), lambda c: c.desc_nulls_last()))
        per = (per.withColumn("_a", F.row_number().over(here.orderBy(*up)))
               .withColumn("_z", F.row_number().over(here.orderBy(*down))).filter("_a = 1 OR _z = 1"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return per.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col(BUCKET).alias("_gb"),
        *[F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums],
        *[F.sum(f"_s_{n}").over(whole).alias(f"_total_{n}") for n in sums])


def _with_edges(x: DataFrame, edges: DataFrame, group) -> DataFrame:
    cond = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)] + [F.col(BUCKET) == F.col("_gb")]
    return x.join(F.broadcast(edges), cond, "left")


def with_rank(df: DataFrame, order, group=(), tie=None, num_buckets: int | None = None,
              rank_col: str = "row_num", size_col: str | None = "group_size") -> DataFrame:
    """Exact ``row_number() OVER (PARTITION BY group ORDER BY order, tie)``
    and ``count(*) OVER (PARTITION BY group)`` without putting a whole
    group (or the whole table) into one task.

    Buckets cut (group, order, tie), so a hot group spans several of them.
    Inside a bucket the row number and the group's count come from windows;
    groups that cross a bucket boundary get their offsets and total sizes
    from a broadcast table of at most two rows per bucket.
    """
    group = list(group)
    keys = total_order(df, group + list(order), tie)
    x = range_buckets(df, keys, num_buckets)
    edges = _edge_sums(x, group, {"n": F.count(F.lit(1))})
    joined = _with_edges(x, edges, group)
    in_bucket = Window.partitionBy(*group, BUCKET)
    w = in_bucket.orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    cols = {rank_col: F.row_number().over(w) + F.coalesce(F.col("_before_n"), F.lit(0))}
    if size_col:
        cols[size_col] = F.coalesce(F.col("_total_n"), F.count(F.lit(1)).over(in_bucket))
    return joined.withColumns(cols).select(*df.columns, *cols.keys())


def running_sums(df: DataFrame, order: str, cols, num_buckets: int | None = None, group=()) -> DataFrame:
    """``cum_<c>`` = sum of ``c`` over the rows of the same group with
    ``order`` <= this row's (order values unique inside a group) and
    ``total_<c>`` = its sum over the group, bucket-wise."""
    group = list(group)
    x = range_buckets(df, group + [order], num_buckets)
    out = _with_edges(x, _edge_sums(x, group, {c: F.sum(c) for c in cols}), group)
    here = Window.partitionBy(*group, BUCKET)
    upto = here.orderBy(F.col(order).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    return out.select(
        *df.columns,
        *[(F.sum(c).over(upto) + F.coalesce(F.col(f"_before_{c}"), F.lit(0))).alias(f"cum_{c}") for c in cols],
        *[F.coalesce(F.col(f"_total_{c}"), F.sum(c).over(here)).alias(f"total_{c}") for c in cols])
