"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

DataFrame functions only. The first pass counts rows by normalised length
(map-side first). The second hashes the first characters of rows whose length
occurs twice or more and counts rows by length and prefix; the third takes
the full hash of rows whose length and prefix do. A bitmap of bounded size
holds a bit for each key that survives a step, so the next pass can tell at
the scan, with no shuffle of texts, which rows go on. A bit that two keys
share only costs one more hash. Only narrow
rows (id, length, hash) are shuffled, and the join that brings a group's
decision back to its rows has a real exchange on either side, so adaptive
execution can split a group of copies of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.llm.bitmaps import bits_for, flag_members, keep_rows
from skyframe.session import written

PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """The text without characters of ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def _several(rows: DataFrame, key: list[str]) -> DataFrame:
    """The keys that occur twice or more."""
    return written(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key), "several")


def _refined(rows: DataFrame) -> DataFrame:
    """``rows`` (with norm) with norm_len, prefix_hash and survives: whether a row's length and then its prefix repeat."""
    sized = rows.select("*", F.length("norm").alias("norm_len"))
    lengths = _several(sized, ["norm_len"])
    prefix = F.xxhash64(F.substring("norm", 1, PREFIX_CHARS))
    hashed = flag_members(sized, lengths, ["norm_len"], "by_length", bits_for(lengths.count())).select(
        "*", F.when(F.col("by_length"), prefix).alias("prefix_hash"))
    key = ["norm_len", "prefix_hash"]
    both = _several(hashed.filter("by_length"), key)
    return flag_members(hashed, both, key, "with_prefix", bits_for(both.count())).select(
        *rows.columns, *key, (F.col("by_length") & F.col("with_prefix")).alias("survives"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest: bool = False) -> DataFrame:
    """``id_col``, keep_id, group_size, kept: one row for each row of ``docs``.

    Texts are equal when equal without white space. Of equal texts the row
    with the most code points in its original text stays, then the one with
    the smallest id. With ``digest`` the full hash is taken for every row and
    returned as text_sha256 (lower-case hex).

    Null and empty texts are equal to each other. A null id comes before any
    other. Rows that repeat an id are one document: they count in group_size
    and are kept or dropped alike. An empty table gives an empty result.
    Other columns are neither read nor kept.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select(
        "id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"),
        normalised(F.col("text")).alias("norm"))
    full = F.unhex(F.sha2("norm", 256))
    hashed = written(_refined(base).select(
        "id", "n_chars", "norm_len", "prefix_hash", "survives",
        (full if digest else F.when(F.col("survives"), full)).alias("full_hash")), "exact-hashes")

    twins = hashed.filter("survives")
    groups = twins.groupBy("norm_len", "prefix_hash", "full_hash").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct((-F.col("n_chars")).alias("order"), F.col("id").alias("keep_id"))).alias("best")).select(
        "full_hash", "group_size", F.col("best.keep_id").alias("keep_id"))
    more = [F.lower(F.hex("full_hash")).alias("text_sha256")] if digest else []
    alone = hashed.filter("not survives").select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), *more)
    decided = twins.join(groups, "full_hash").select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), *more)
    return alone.unionByName(decided)


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all columns.

    The row with the most code points stays, then the smallest id (null ids
    first), then the smallest row by hash. Rows that repeat an id and a text
    are one. An empty table stays empty. Other columns may have any name but
    those that begin with two underscores.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.length(text), F.lit(0)).alias("n_chars"), F.xxhash64(id_col, text_col).alias("row"),
        normalised(text).alias("norm"))
    twins = written(_refined(rows).filter("survives").select(
        "id", "row", "n_chars", F.unhex(F.sha2("norm", 256)).alias("full_hash")), "exact-rows")
    best = twins.groupBy("full_hash").agg(F.min(F.struct((-F.col("n_chars")).alias("order"), "id", "row")).alias("b")).select(
        "full_hash", F.col("b.row").alias("best"))
    fate = twins.groupBy("full_hash", "row").agg(F.count(F.lit(1)).alias("copies")).join(best, "full_hash")
    return keep_rows(docs, fate.select("row", (F.col("row") == F.col("best")).alias("kept"), "copies"), id_col, text_col)
