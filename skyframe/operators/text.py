"""Conversation history and retrieval (survey N1-N4).

Per-session ordering uses the distributed rank of ``plans.ordered`` (a
session's turns are never gathered whole into one task); the only
collected lists are bounded by ``n``. Retrieval multiplies passages with
blocks of query vectors where they are read and takes a bounded top-k per
query: no join, and the (query, passage) scores never leave the map task
beyond k per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from skyframe.plans import ordered


# N1
def explode_events(events: DataFrame) -> DataFrame:
    """One row per conversational message of history events
    (``session_id``, ``eventId``, ``eventTimestamp``, ``payload`` array of
    ``conversational{role, content{text}}``); payloads without one and empty
    texts give no row."""
    m = events.select("session_id", "eventId", "eventTimestamp", F.posexplode("payload").alias("part", "p"))
    return m.select("session_id", "eventId", F.col("eventTimestamp").alias("timestamp"), "part",
                    F.col("p.conversational.role").alias("role"), F.col("p.conversational.content.text").alias("text")
                    ).filter(F.length("text") > 0)


def flatten_history(df: DataFrame, session: str = "conv_id", time: str = "turn", role: str = "role",
                    text: str = "text", max_events: int | None = None) -> DataFrame:
    """Messages with text, oldest first with their position; all of them
    unless a page size is given (then the oldest ``max_events`` per session)."""
    x = df.filter(F.length(F.col(text)) > 0).select(session, time, role, text)
    r = ordered.with_rank(x, [time], group=[session], tie=[role, text], rank_col="position", size_col=None)
    return r if max_events is None else r.filter(F.col("position") <= max_events)


# N2
def recent_context(df: DataFrame, session: str = "conv_id", time: str = "turn", role: str = "role",
                   text: str = "text", n: int = 20) -> DataFrame:
    """``role: text`` lines (role in lower case) of the last ``n`` messages
    of each session, oldest first, joined by newlines."""
    x = df.filter(F.length(F.col(text)) > 0).select(session, time, F.lower(role).alias(role), text)
    x = x.withColumn("_neg", -F.col(time))
    r = ordered.with_rank(x, ["_neg"], group=[session], tie=[role, text], rank_col="_back", size_col=None)
    last = r.filter(F.col("_back") <= n)
    lines = last.groupBy(session).agg(
        F.sort_array(F.collect_list(F.struct(F.col(time), F.concat(F.col(role), F.lit(": "), F.col(text)).alias("l"))))
        .alias("_m"))
    return lines.select(session, F.array_join(F.transform("_m", lambda s: s["l"]), "\n").alias("context"),
                        F.size("_m").alias("messages"))


# N3
def history_counts(df: DataFrame, session: str = "conv_id", role: str = "role") -> DataFrame:
    return df.groupBy(session).agg(F.count(F.lit(1)).alias("events"),
                                   F.count_if(F.col(role) == "user").alias("user_messages"),
                                   F.count_if(F.col(role) == "assistant").alias("assistant_messages"))


def centroids(df: DataFrame, key: str = "label", vec: str = "embedding") -> DataFrame:
    """(query, q): the mean vector of each key, as a table of query vectors."""
    long = df.select(key, F.posexplode(vec).alias("i", "v")).groupBy(key, "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    return long.groupBy(F.col(key).alias("query")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda x: x["m"]).alias("q"))


# N4
#: Queries of a block, and passages that meet a block in one task.
QUERY_BLOCK, PASSAGE_GROUP = 4096, 1 << 16
_STRIP = 256


def top_passages(corpus: DataFrame, queries: DataFrame, k: int = 3, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """Best ``k`` passages per query by dot product; ``queries`` is a table
    (query, q).

    Queries are dealt to blocks and passages to groups by hash; a group and
    a block meet in one task, which multiplies their vectors and hands on at
    most ``k`` rows per query. Neither the driver nor the plan holds the
    queries, and the corpus is scanned once. Equal scores are ordered by
    passage id."""
    parts = int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    passages = corpus.filter(F.col(vec).isNotNull()).select(F.col(key).alias("_p"), F.col(vec).cast("array<double>").alias("_v"))
    asked = queries.select("query", F.col("q").cast("array<double>").alias("_v"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    groups = max(parts, -(-passages.count() // PASSAGE_GROUP))

    def dealt(c, n):
        return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")

    left = asked.withColumn("_b", dealt("query", blocks)).withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = passages.withColumn("_g", dealt("_p", groups)).withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    schema = T.StructType([queries.schema["query"], T.StructField(key, corpus.schema[key].dataType),
                           T.StructField("score", T.DoubleType())])
    arrow = [to_arrow_type(f.dataType) for f in schema.fields]

    def vectors(table):
        return np.asarray(table.column("_v").combine_chunks().flatten(), float).reshape(table.num_rows, -1)

    def best(ask, has):
        out = []
        if ask.num_rows and has.num_rows:
            x, names, keys = vectors(has), ask.column("query").to_pylist(), has.column("_p").to_pylist()
            y = vectors(ask)
            for lo in range(0, len(names), _STRIP):
                # sums in the vectors' order, the same for every grouping
                s = np.einsum("ij,kj->ki", x, y[lo:lo + _STRIP])
                for q, row in enumerate(s):
                    cut = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf
                    top = sorted((-float(row[i]), keys[i]) for i in np.flatnonzero(row >= cut))[:k]
                    out += [(names[lo + q], p, -d) for d, p in top]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(arrow)], names=schema.names)

    found = left.groupBy("_g", "_b").cogroup(right.groupBy("_g", "_b")).applyInArrow(best, schema)
    w = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col(key))
    return found.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")
