"""The registered queries of the subpackage, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from skyframe.llm import bottomk_join
from skyframe.llm.exact_dedup import exact_groups
from skyframe.llm.hard_negatives import mine
from skyframe.llm.lm_scoring import score_texts
from skyframe.llm.mixing import replicate
from skyframe.llm.ngram_join import near_classes
from skyframe.llm.packing import pack
from skyframe.llm.prefix_trie import prefix_trie
from skyframe.llm.quality_rules import repetition_rules
from skyframe.llm.registry import ORACLE, QUERIES, documents, query
from skyframe.llm.substring_dedup import remove_repeats
from skyframe.llm.token_counts import count_tokens
from skyframe.llm.token_files import read_token_files, with_crc, write_token_files
from skyframe.llm.toxicity import learn, score
from skyframe.session import scratch_path

__all__ = ["ORACLE", "QUERIES"]


def byte_bpe() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op5_token_counts")
def op5_token_counts(spark, sf_dir):
    return count_tokens(documents(spark, sf_dir), byte_bpe(), limit=1024)


def _windows(k: int) -> str:
    return " || ' ' || ".join(["w"] + [f"lead(w, {j}) OVER o" for j in range(1, k)])


OP1_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
a AS (SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM t),
p AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM a),
g AS (SELECT doc_id, i, {_windows(3)} AS w3, {_windows(10)} AS w10
      FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s3 AS (SELECT doc_id, i FROM g WHERE w3 IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, w3) > 1),
s10 AS (SELECT doc_id, i, w10 FROM g WHERE w10 IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, w10) > 1),
r3 AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS j FROM s3) GROUP BY 1),
r10 AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 10)) AS j FROM s10) GROUP BY 1),
pair AS (SELECT x.doc_id, x.i, y.i - x.i AS d FROM s10 x JOIN s10 y ON x.doc_id = y.doc_id AND x.w10 = y.w10 AND x.i < y.i),
run AS (SELECT doc_id, d, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS k FROM pair),
top AS (SELECT doc_id, max(n) + 9 AS n FROM (SELECT doc_id, count(*) AS n FROM run GROUP BY doc_id, d, k) GROUP BY 1),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY 1),
m AS (SELECT a.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r3.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(r10.n, 0) AS BIGINT) AS covered_words, CAST(coalesce(top.n, 0) AS BIGINT) AS longest_repeat
      FROM a LEFT JOIN dup USING (doc_id) LEFT JOIN r3 USING (doc_id) LEFT JOIN r10 USING (doc_id) LEFT JOIN top USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND 100 * covered_words <= 30 * n_words AND longest_repeat <= 100 AS kept FROM b
"""


@query("op1_quality_rules", OP1_SQL)
def op1_quality_rules(spark, sf_dir):
    return repetition_rules(documents(spark, sf_dir), min_words=50, max_repeat_percent=50, min_repeat=10,
                            max_covered_percent=30, max_longest=100)


OP6_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents),
k AS (SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
             first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""


@query("op6_exact_dedup", OP6_SQL)
def op6_exact_dedup(spark, sf_dir):
    return exact_groups(documents(spark, sf_dir), digest=True)


OP10_SQL = """
WITH s AS (SELECT source, sum(greatest(length(coalesce(text, '')), 1)) AS c FROM documents GROUP BY source),
r AS (SELECT source, sqrt(c) / sum(sqrt(c)) OVER () * sum(c) OVER () / c AS rate FROM s),
k AS (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k FROM r),
f AS (SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf FROM k),
u AS (SELECT doc_id, source, CAST('0x' || substr(md5('7:' || doc_id), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM documents),
n AS (SELECT u.doc_id, u.source, count(*) AS n FROM u JOIN f ON u.source IS NOT DISTINCT FROM f.source AND f.cdf <= u.u
      GROUP BY u.doc_id, u.source),
c AS (SELECT doc_id, source, unnest(range(1, n + 1)) AS copy FROM n)
SELECT doc_id, source, CAST(copy AS INTEGER) AS copy,
       CAST('0x' || substr(md5('7:' || doc_id || ':' || copy), 1, 15) AS BIGINT) AS shuffle_key FROM c
"""


@query("op10_mixing", OP10_SQL)
def op10_mixing(spark, sf_dir):
    return replicate(documents(spark, sf_dir), seed=7, temperature=0.5, epochs=1.0).select(
        "doc_id", "source", "copy", "shuffle_key")


@query("op3_token_files")
def op3_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path, byte_bpe(), end_id=2)
    return with_crc(read_token_files(spark, path))


@query("op4_packing")
def op4_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir), byte_bpe(), capacity=2048, end_id=0)


@query("op9_toxicity")
def op9_toxicity(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, learn(docs, labels, bound=20_000), threshold=0.3)


@query("op7_lm_scoring")
def op7_lm_scoring(spark, sf_dir):
    return score_texts(documents(spark, sf_dir), order=5)


@query("op2_ngram_join")
def op2_ngram_join(spark, sf_dir):
    return near_classes(documents(spark, sf_dir), k=5, percent=75)


@query("op8_substring_dedup")
def op8_substring_dedup(spark, sf_dir):
    return remove_repeats(documents(spark, sf_dir), k=13, with_text=False).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


@query("op11_prefix_trie")
def op11_prefix_trie(spark, sf_dir):
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), family=20, most=4)


@query("op12_bottomk_join")
def op12_bottomk_join(spark, sf_dir):
    return bottomk_join.near_classes(documents(spark, sf_dir), k=5, percent=85)


OP13_SQL = """
WITH r AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same,
             CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.id % 50 = 0 AND a.id <> b.id),
pos AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM p WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score,
       score AS negative_score
FROM pos JOIN p USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= 3
"""


@query("op13_hard_negatives", OP13_SQL)
def op13_hard_negatives(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows, F.col("id") % 50 == 0, label=moved, positives=5, negatives=3, low=50, high=95, scale=256)
