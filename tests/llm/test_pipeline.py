"""The pipeline's stages over a small table: what goes, what stays, what is packed."""

from collections import Counter

import corpus_pipeline
from skyframe.llm.quality_rules import repetition_rules
from tests.conftest import SF_SMALL
from tests.llm.test_operators import plain_classes


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        before, docs = docs, stage(spark, docs, SF_SMALL)
        assert docs.schema.names == before.schema.names
        rows = docs.collect()
        left[name] = rows
        docs = spark.createDataFrame(rows, before.schema)
    whole = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    kept = {r["doc_id"] for r in repetition_rules(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).filter("kept").collect()}
    assert {r["doc_id"] for r in left["quality rules"]} == kept
    best = {}
    for i in sorted(kept):
        norm = "".join(whole[i].split(" "))
        norm = "".join(c for c in norm if c not in "\t\n\x0b\x0c\r")
        if norm not in best or len(whole[i]) > len(whole[best[norm]]):
            best[norm] = i
    assert {r["doc_id"] for r in left["exact dedup"]} == set(best.values())
    ids = sorted(best.values())
    assert {r["doc_id"] for r in left["n-gram Jaccard join"]} == {c for _, _, c in plain_classes([whole[i] for i in ids], ids)}
    mixed = Counter(r["doc_id"] for r in left["mixing"])
    assert set(mixed) <= {r["doc_id"] for r in left["n-gram Jaccard join"]}
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF_SMALL).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == mixed


def test_run_equals_stages(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = out.collect()
    fill = Counter()
    for r in rows:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 2048 and len(rows) > 0
