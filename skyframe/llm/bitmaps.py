"""Membership in a set of keys by a broadcast bitmap of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.session import written

#: 4 MB in rows of 4 KB: enough for two million keys at one stray flag in sixteen.
BITS = 1 << 25
#: 128 MB, the most that is broadcast; beyond 64 million keys more stray rows are flagged, none is missed.
MOST_BITS = 1 << 30


def bits_for(n: int) -> int:
    """A power of two with sixteen bits a key, between ``BITS`` and ``MOST_BITS``."""
    return min(MOST_BITS, max(BITS, 1 << max(16 * n - 1, 1).bit_length()))


def flag_members(rows: DataFrame, members: DataFrame, key: list[str], name: str, bits: int = BITS) -> DataFrame:
    """``rows`` with a boolean column: true for every row whose key is in ``members``, and for few others.

    Keys are hashed to ``bits`` bits, so a key that shares its bit with a
    member is flagged too; callers check flagged rows. Neither table is shuffled.
    """
    bit = F.pmod(F.xxhash64(*key), F.lit(bits)) + 1
    bitmap = members.select(bit.alias("__b")).groupBy(F.expr("bitmap_bucket_number(__b)").alias("__part")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(__b))").alias("__bits"))
    placed = rows.select("*", bit.alias("__b")).select(
        *rows.columns, F.expr("bitmap_bucket_number(__b)").alias("__part"), F.expr("bitmap_bit_position(__b)").alias("__pos"))
    byte = F.conv(F.hex(F.expr("substring(__bits, cast(__pos div 8 as int) + 1, 1)")), 16, 10).cast("int")
    flag = F.coalesce(byte.bitwiseAND(F.expr("shiftleft(1, cast(__pos % 8 as int))")) != 0, F.lit(False))
    return placed.join(F.broadcast(bitmap), "__part", "left").select(*rows.columns, flag.alias(name))


def keep_rows(docs: DataFrame, fate: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows that ``fate`` (row, kept, copies) drops, and with one of several copies of a row.

    A bitmap tells at the scan which rows are dropped or repeated, so only
    those few, not the texts that simply stay, are shuffled.
    """
    names = docs.columns
    touched = written(fate.filter("not kept or copies > 1").select(
        F.col("row").alias("__row"), F.col("kept").alias("__kept")), "touched")
    keyed = docs.select("*", F.xxhash64(F.col(id_col), F.col(text_col)).alias("__row"))
    flagged = flag_members(keyed, touched, ["__row"], "__hit")
    plain = flagged.filter("not __hit").select(*names)
    maybe = flagged.filter("__hit").join(touched, "__row", "left")
    stay = maybe.filter("__kept is null").select(*names)
    orderable = [c for c in names if not isinstance(docs.schema[c].dataType, (T.MapType, T.VariantType))]
    one = maybe.filter("__kept").groupBy("__row").agg(
        F.min_by(F.struct(*names), F.struct(*orderable)).alias("__one")).select("__one.*")
    return plain.unionByName(stay).unionByName(one)
