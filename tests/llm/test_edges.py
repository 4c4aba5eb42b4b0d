"""Null and repeated ids, empty tables and clashing columns in the stages, token files, mixing and packing."""

from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyframe.llm import mixing, packing, token_files
from skyframe.llm.quality_rules import keep_by_rules
from skyframe.session import scratch_path
from tests.llm.cases import clashing, documents, odd_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i}" for i in range(80))
OTHER = " ".join(f"v{i}" for i in range(80))


def _encoded(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def test_rules_keep_rows_not_ids(spark):
    docs = clashing(documents(spark, [LONG, "short", LONG, None, LONG], [4, 4, None, None, 4]))
    left = keep_by_rules(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left.collect()) == [(0, LONG), (4, LONG), (4, LONG)]
    assert keep_by_rules(clashing(documents(spark, []))).collect() == []


def test_token_files_with_null_and_repeated_ids(spark):
    texts, ids = [LONG, None, "a b", "", OTHER, "a b"], [7, None, 7, None, 3, 7]
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(documents(spark, texts, ids).repartition(3), path, PATH, files=2)
    rows = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r["start"])
    want = [_encoded(t) + [2] for t in ("", "", OTHER, "a b", "a b", LONG)]
    assert [r["ids"] for r in rows] == want and [r["doc_id"] for r in rows] == [None, None, 3, 7, 7, 7]
    assert [r["start"] for r in rows] == [sum(map(len, want[:k])) for k in range(len(want))]


def test_pack_rows_with_null_and_repeated_ids(spark):
    texts = [LONG, None, LONG, "", "a b", OTHER * 30]
    docs = clashing(documents(spark, texts, [1, None, 1, 1, None, None]))
    rows = packing.pack(docs, PATH, capacity=256, end_id=0).collect()
    want = Counter()
    for i, t in zip([1, None, 1, 1, None, None], texts):
        want[i] += len(_encoded(t)) + 1
    got, fill = Counter(), {}
    for r in rows:
        got[r["doc_id"]] += r["length"]
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == want
    for places in fill.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 256


def test_replicate_rows_with_null_ids_and_sources(spark):
    docs = documents(spark, odd_texts(), [None] * 8 + [3] * 8, sources=["s", None, "t"])
    out = mixing.replicate(docs, epochs=3.0).select(*docs.columns)
    left = Counter(map(tuple, out.collect()))
    assert left and set(left) <= set(map(tuple, docs.collect()))
    # the draw belongs to the row and the seed, not to its partition
    assert Counter(map(tuple, mixing.replicate(docs.repartition(5), epochs=3.0).select(*docs.columns).collect())) == left
    assert mixing.replicate(documents(spark, [])).collect() == []


@pytest.mark.parametrize("rows", [0, 6])
def test_pipeline_over_odd_tables(spark, rows):
    folder = scratch_path(spark, "odd")
    docs = documents(spark, [LONG, LONG, OTHER, None, "", OTHER][:rows], [5, 5, None, None, 5, 5][:rows])
    clashing(docs).write.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.run(spark, folder).collect()
    texts = {(r["doc_id"], r["length"]) for r in out}
    # one row of each text is left before mixing; null and empty texts fail the rules
    assert texts <= {(i, len(_encoded(t)) + 1) for i in (5, None) for t in (LONG, OTHER)}
    assert rows or not out
