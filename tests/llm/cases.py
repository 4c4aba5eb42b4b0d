"""Small inputs and plain versions of the operators for the tests."""

from __future__ import annotations

import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

#: Columns of documents and others whose names operators use for their own output.
CLASH = ["n_words", "kept", "n_tokens", "score", "piece", "copy", "shuffle_key", "component_id", "id", "n", "node",
         "label", "text_sha256", "group_size", "pid", "spans", "density", "start", "length", "key", "b", "part"]


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def documents(spark, texts, ids=None, sources=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", (sources or ["s"])[k % len(sources or ["s"])], None if t is None else len(t))
            for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, DOCS)


def odd_texts():
    """Null, empty, blank, short, repeated, very long and non-Latin texts."""
    filler = " ".join(f"w{i * 7919 % 1009}" for i in range(4000))
    return [None, "", " \n\t", "a", "A", "a b c d", "a b c d e", "x " * 300, "x " * 300, filler, filler + " end",
            "日本語 です " * 40, "é è × ß, ok. don't" * 30, "<|endoftext|> a<|endoftext|>", "\x00 \x01 z", "l\nl\n\nl\n"]


def clashing(df):
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(7) for c in CLASH})
