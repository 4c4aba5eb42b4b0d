"""Token counts: batch encoding in an Arrow function that returns lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skyframe.llm.encode import shared_encoder
from skyframe.llm.texts import buffers, regrouped


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text", batch_bytes: int = 8 << 20) -> DataFrame:
    """``id_col``, n_bytes, n_tokens, over_limit: one row for each row of ``docs``.

    The texts of a task are regrouped into batches of about ``batch_bytes``,
    whatever the row counts of the batches they come in; a longer text is cut at places where no token can cross (see ``encode``)
    and its counts are added up. Only the lengths leave the function.

    A null or empty text has 0 bytes and 0 tokens; a null id stays null;
    repeated rows are counted each on its own; an empty table gives an empty
    result. Other columns, whatever their names, are neither read nor kept.
    ``tokenizer`` is the path of a ``.json`` (tokenizers) or ``.model``
    (sentencepiece) file on every executor.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("over_limit", T.BooleanType())])

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer)
        for part in regrouped(batches, text_col, batch_bytes):
            _, off = buffers(part.column(text_col))
            ends, _ = encoder.encode(part.column(text_col), want_ids=False)
            tokens = np.diff(ends)
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array(np.diff(off)), pa.array(tokens), pa.array(tokens > limit)],
                names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(lengths, schema)
