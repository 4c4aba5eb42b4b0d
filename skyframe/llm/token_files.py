"""Token ids in ORC files: stripes, integer run lengths, row indexes, Bloom filters.

Documents are range-partitioned and sorted by id, encoded in an Arrow
function and written with Spark's ORC writer, one file per range. A row
holds the id, the number of tokens, the tokens before it in its file and
the ids themselves. Readers split files by stripe; a filter on the id is
checked against the statistics of files, stripes and row groups and against
the Bloom filters before anything is decoded, and reading only the counts
leaves the ids on disk.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm.encode import shared_encoder
from skyframe.llm.texts import slices

ORC_OPTIONS = {
    "orc.compress": "ZSTD",
    "orc.stripe.size": str(16 << 20),
    "orc.create.index": "true",
    "orc.row.index.stride": "2000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, files: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id`` and write the files in ascending id order.

    Columns: doc_id, file (order of the ranges), n_tokens (with the end id),
    before (tokens of the same file before it), ids. ``files`` is the number
    of ranges; by default the session's shuffle partitions.

    A null or empty text holds the end id alone; a null id sorts first; rows
    that repeat an id stay next to each other, ordered by text; an empty
    table writes files without rows. Other columns are neither read nor kept.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("file", T.IntegerType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("before", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer)
        file, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                ends, ids = encoder.encode(part.column("text"))
                n = part.num_rows
                ends = ends + np.arange(n + 1)
                all_ids = np.full(int(ends[-1]), end_id, np.int32)
                inner = np.ones(int(ends[-1]), bool)
                inner[ends[1:] - 1] = False
                all_ids[inner] = ids
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(np.full(n, file, np.int32)), pa.array(np.diff(ends)),
                    pa.array(done + ends[:-1]), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(all_ids)),
                ], names=schema.names)
                done += int(ends[-1])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    files = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, schema).write.options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids: the files' rows; ``start`` counts the tokens of all documents before.

    The tokens before each file come from the counts alone, in a table of one
    row per file, which is small enough to broadcast.
    """
    rows = spark.read.orc(path)
    sizes = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    sizes = sizes.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("base"))
    return rows.join(F.broadcast(sizes), "file").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids")


def look_up(spark: SparkSession, path: str, doc_ids: list) -> DataFrame:
    """Rows of the given ids; statistics and Bloom filters skip stripes and row groups without them."""
    return spark.read.orc(path).filter(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "ids")


def with_crc(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of the little-endian unsigned 32-bit ids."""
    schema = T.StructType([rows.schema["doc_id"], T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            off = np.asarray(lists.offsets)
            ids = np.ascontiguousarray(np.asarray(lists.values), dtype="<u4")
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crc, pa.int64())],
                names=schema.names)

    return rows.mapInArrow(digest, schema)
