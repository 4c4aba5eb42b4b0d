"""Words, hashes and chunked encoding against the plain library calls."""

import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyframe.llm import encode, texts
from tests.llm.cases import WORD, odd_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _mixed(n=1500):
    rnd = random.Random(1)
    alphabet = list("ab '\n.,é×日 s1!<|>\t")
    return odd_texts() + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


def test_words_are_those_of_the_pattern():
    col = pa.array(_mixed())
    buf, off = texts.buffers(col)
    starts, ends, first = texts.words(buf, off)
    for i, t in enumerate(col.to_pylist()):
        got = [buf[a:b].tobytes().decode() for a, b in zip(starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]])]
        assert got == WORD.findall(t or "")


def test_span_hash_depends_on_content_only():
    buf, off = texts.buffers(pa.array(["one two one", "two  one\tthree"]))
    starts, ends, _ = texts.words(buf, off)
    h = texts.spans_hash(buf, starts, ends)
    word = [buf[a:b].tobytes() for a, b in zip(starts, ends)]
    assert len(set(h.tolist())) == len(set(word)) == 3
    assert all((h[i] == h[j]) == (word[i] == word[j]) for i in range(len(word)) for j in range(len(word)))


@pytest.mark.parametrize("part", [64, 1 << 20])
def test_chunks_encode_like_whole_texts(monkeypatch, part):
    monkeypatch.setattr(encode, "SLICE_BYTES", part)
    col = pa.array(_mixed())
    ends, ids = encode.Encoder(PATH, cached=500).encode(col)
    plain = Tokenizer.from_file(PATH)
    for i, t in enumerate(col.to_pylist()):
        assert ids[ends[i]:ends[i + 1]].tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_other_tokenizers_take_whole_texts():
    import sentencepiece
    col = pa.array(["Hello world", None, "a  b"])
    for name in ("word_bpe_49k.json", "piece_bpe_32k.model"):
        path = public_tokenizers.path(name)
        ends, _ = encode.Encoder(path).encode(col, want_ids=False)
        if name.endswith(".model"):
            p = sentencepiece.SentencePieceProcessor(model_file=path)
            want = [len(p.encode(t or "")) for t in col.to_pylist()]
        else:
            p = Tokenizer.from_file(path)
            want = [len(p.encode(t or "", add_special_tokens=False).ids) for t in col.to_pylist()]
        assert np.diff(ends).tolist() == want


def test_slices_cover_a_batch_once():
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(["x" * (i * 3) for i in range(50)])], names=["i", "text"])
    got = [p.column("i").to_pylist() for p in texts.slices(batch, "text", 200)]
    assert [i for g in got for i in g] == list(range(50)) and len(got) > 5


def test_regrouped_joins_small_batches_and_cuts_large_ones():
    rows = ["é" * (i % 9) for i in range(200)] + [None, "x" * 500, ""]
    table = pa.table({"id": list(range(len(rows))), "text": rows})
    got = list(texts.regrouped(iter(table.to_batches(max_chunksize=3)), "text", 100))
    assert [t for b in got for t in b.column("text").to_pylist()] == rows
    assert [i for b in got for i in b.column("id").to_pylist()] == list(range(len(rows)))
    size = [int(texts.buffers(b.column("text"))[1][-1]) for b in got]
    assert all(n <= 100 or b.num_rows == 1 for n, b in zip(size, got))
    assert all(a + b > 100 for a, b in zip(size, size[1:]))
    assert [b.num_rows for b in texts.regrouped(iter(table.to_batches()), "text", 1 << 20)] == [len(rows)]
    assert list(texts.regrouped(iter([]), "text", 10)) == []


def test_column_hash_is_that_of_a_long_column(spark):
    ids = [0, 1, -1, 7, 1 << 20, (1 << 40) + 3, 2 ** 63 - 1, -2 ** 63, *range(0, 64000, 640)]
    rows = spark.createDataFrame([(i,) for i in ids], "id long").selectExpr("id", "hash(id) AS h").collect()
    assert texts.column_hash(np.array([r["id"] for r in rows], np.int64)).tolist() == [r["h"] for r in rows]
