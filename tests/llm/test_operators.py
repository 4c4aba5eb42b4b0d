"""Each operator against a plain version, with the odd cases of its contract."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyframe.llm import components as CC
from skyframe.llm import lm_scoring, mixing, ngram_join, packing, quality_rules, substring_dedup, token_files, toxicity
from skyframe.llm.exact_dedup import drop_exact, exact_groups
from skyframe.llm.token_counts import count_tokens
from skyframe.session import scratch_path
from tests.llm.cases import DOCS, WORD, clashing, documents, lower, odd_texts, words

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENS = Tokenizer.from_file(PATH)


def ids_of(text):
    return TOKENS.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def odd(spark):
    """Odd texts, a repeated row and a row whose columns are all null, with clashing extra columns."""
    texts = odd_texts()
    df = documents(spark, texts + [texts[9]], ids=list(range(len(texts))) + [9])
    null = spark.createDataFrame([(None,) * 5], DOCS)
    return clashing(df.unionByName(null))


def empty(spark):
    return spark.createDataFrame([], DOCS)


OPERATORS = {
    "rules": lambda d: quality_rules.repetition_rules(d, spans=True),
    "near": ngram_join.near_classes,
    "pack": lambda d: packing.pack(d, PATH, capacity=64),
    "count": lambda d: count_tokens(d, PATH),
    "exact": lambda d: exact_groups(d, digest=True),
    "lm": lm_scoring.score_texts,
    "repeats": substring_dedup.remove_repeats,
    "mixing": mixing.replicate,
    "toxicity": lambda d: toxicity.score(d, toxicity.Lexicon({" bad ": 3.0}, [], 1.0, -2.0)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table_gives_empty_result(spark, name):
    out = OPERATORS[name](empty(spark))
    assert out.count() == 0 and out.columns[0] == "doc_id"


@pytest.mark.parametrize("name", [n for n in OPERATORS if n not in ("mixing", "pack")])
def test_odd_rows_give_one_row_each(spark, name):
    df = odd(spark)
    out = OPERATORS[name](df)
    assert sorted(map(str, (r[0] for r in out.select("doc_id").collect()))) == sorted(
        map(str, (r[0] for r in df.select("doc_id").collect())))
    assert len(out.columns) == len({c.lower() for c in out.columns})


# 1 ------------------------------------------------------------------------------------------------------------------

def plain_rules(text, least):
    w = words(text)
    n, seen, dup = len(w), set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)

    def cover(k):
        c = Counter(tuple(w[i:i + k]) for i in range(n - k + 1))
        on = set()
        for i in range(n - k + 1):
            if c[tuple(w[i:i + k])] > 1:
                on.update(range(i, i + k))
        return len(on)

    longest, k = 0, least
    while k < n and max(Counter(tuple(w[i:i + k]) for i in range(n - k + 1)).values()) > 1:
        longest, k = k, k + 1
    return n, sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, cover(3), cover(least), longest


def test_quality_rules(spark):
    rnd = random.Random(2)
    texts = [t for t in odd_texts() if t is None or len(t) < 3000] + [
        "".join(rnd.choice(["a ", "b ", "é\n", "c# ", "\n", "a\n"]) for _ in range(rnd.randint(0, 90))) for _ in range(150)]
    df = documents(spark, texts)
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]
    got = {r["doc_id"]: r for r in quality_rules.repetition_rules(df, min_repeat=4, max_longest=20, spans=True).collect()}
    for i, t in enumerate(texts):
        want = plain_rules(t, 4)
        assert tuple(got[i][c] for c in cols) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert got[i]["base_failed"] == failed
        assert got[i]["kept"] == (not failed and 100 * want[5] <= 30 * want[0] and want[6] <= 20)
        assert sum(s["length"] for s in got[i]["spans"]) == want[5]
    kept = quality_rules.keep_by_rules(clashing(df), min_repeat=4, max_longest=20)
    assert {r["doc_id"] for r in kept.collect()} == {i for i in got if got[i]["kept"]}
    assert kept.columns == clashing(df).columns


# 2 ------------------------------------------------------------------------------------------------------------------

def plain_classes(texts, ids, k=5, percent=75):
    sets = []
    for t in texts:
        w = words(lower(t))
        sets.append(frozenset([tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [tuple(w)] * bool(w)))
    parent = list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        both = Counter(j for g in s for j in holders[g])
        for j, c in both.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                parent[find(i)] = find(j)
        for g in s:
            holders[g].append(i)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return {(d, len(s), least[find(i)]) for i, (d, s) in enumerate(zip(ids, sets))}


def near_texts():
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(25):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 6, 20, 80, 200]))]
        for _ in range(rnd.choice([1, 2, 5, 25])):
            p = rnd.choice([0, 0.005, 0.02, 0.04, 0.06])
            rows.append(" ".join(rnd.choice(vocabulary) if rnd.random() < p else x for x in base))
    common = [rnd.choice(vocabulary) for _ in range(60)]
    rows += [" ".join(common + [rnd.choice(vocabulary) for _ in range(rnd.choice([2, 8, 12, 20, 60]))]) for _ in range(60)]
    rows += ["", None, "  ", "One two", "one TWO", "a b c d", "a b c d e", "a a a a a a a"] * 2
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_sets,bucket", [(2000, 1_000_000), (3, 40)])
def test_near_classes(spark, shard_sets, bucket):
    """Also with tiny shards and buckets: split blocks, shingles that go past the buckets."""
    texts = near_texts()
    ids = list(range(100, 100 + len(texts)))
    got = ngram_join.near_classes(documents(spark, texts, ids).repartition(5), shard_sets=shard_sets, bucket_shingles=bucket)
    assert {tuple(r) for r in got.collect()} == plain_classes(texts, ids)


def test_drop_near_keeps_one_of_each_class(spark):
    texts = near_texts()
    kept = ngram_join.drop_near(clashing(documents(spark, texts)))
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in plain_classes(texts, range(len(texts)))}
    assert kept.columns == clashing(documents(spark, texts)).columns


def test_divide_skip_equals_counting():
    rnd = random.Random(4)
    for _ in range(200):
        lists = [sorted(rnd.sample(range(30), rnd.randint(1, 25))) for _ in range(rnd.randint(1, 20))]
        lists += [lists[0]] * rnd.randint(0, 5)
        need = rnd.randint(1, 12)
        count = Counter(v for p in lists for v in p)
        assert sorted(ngram_join.divide_skip(lists, need)) == sorted(v for v, c in count.items() if c >= need)


def test_components(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [
        (rnd.randint(200, 400), rnd.randint(200, 400)) for _ in range(120)] + [(7, 7)]
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    want = {(a, find(a)) for e in edges if e[0] != e[1] for a in e}
    got = CC.components(spark, spark.createDataFrame(edges, "u long, v long"))
    assert {tuple(r) for r in got.collect()} == want


# 3 ------------------------------------------------------------------------------------------------------------------

def test_token_files(spark):
    texts = odd_texts()
    path = scratch_path(spark, "test-tokens")
    token_files.write_token_files(clashing(documents(spark, texts)).repartition(4), path, PATH, files=3)
    back = token_files.read_token_files(spark, path)
    at = 0
    for r in token_files.with_crc(back).orderBy("doc_id").collect():
        ids = ids_of(texts[r["doc_id"]]) + [2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)
    assert {r["doc_id"]: r["ids"] for r in token_files.look_up(spark, path, [5, 9]).collect()} == {
        i: ids_of(texts[i]) + [2] for i in (5, 9)}
    from pyarrow import orc
    names = [f for f in __import__("os").listdir(path.replace("file:", "")) if f.endswith(".orc")]
    first = orc.ORCFile(f"{path.replace('file:', '')}/{sorted(names)[0]}")
    assert first.nstripes >= 1 and first.row_index_stride == 2000
    token_files.write_token_files(empty(spark), path + "-empty", PATH, files=2)
    assert token_files.read_token_files(spark, path + "-empty").count() == 0


# 4 ------------------------------------------------------------------------------------------------------------------

def test_packing(spark):
    rnd = random.Random(6)
    texts = odd_texts() + [" ".join(rnd.choice(["tin", "can", "dog", "house."]) for _ in range(rnd.randint(0, 90)))
                           for _ in range(200)]
    ids = list(range(len(texts))) + [3]
    texts.append(texts[3])
    got = packing.pack(clashing(documents(spark, texts, ids)).repartition(4), PATH, capacity=64).collect()
    pieces = defaultdict(list)
    for r in got:
        all_ids = ids_of(texts[r["doc_id"]]) + [0]
        assert r["ids_crc32"] == crc(all_ids[r["start"]:r["start"] + r["length"]])
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    for i, p in pieces.items():
        n, copies = len(ids_of(texts[i])) + 1, ids.count(i)
        head = n % 64 or 64
        lengths = [head] + [64] * ((n - head) // 64)
        assert sorted(p) == sorted((k, sum(lengths[:k]), length) for k, length in enumerate(lengths) for _ in range(copies))
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        s.sort()
        assert all(o == sum(x[1] for x in s[:k]) for k, (o, _) in enumerate(s)) and sum(x[1] for x in s) <= 64
    least = -(-sum(r["length"] for r in got) // 64)
    assert len(sequences) <= least + 2
    assert sorted(pieces) == sorted(set(ids))


def test_plan_packs_every_piece_once():
    rnd = np.random.default_rng(7)
    for scale in (1, 50, 100_000):
        hist = (rnd.random(129) ** 3 * scale).astype(np.int64) + rnd.integers(0, 2, 129)
        hist[0] = 0
        shapes = packing.plan(hist, 128)
        packed = np.zeros_like(hist)
        for lengths, n in shapes:
            assert sum(lengths) <= 128 and n > 0
            for x in lengths:
                packed[x] += n
        assert (packed == hist).all()
        total = int((hist * np.arange(129)).sum())
        assert sum(n for _, n in shapes) <= math.ceil(total / 128) * 1.1 + 3
        assert len(shapes) < 5000


# 5 ------------------------------------------------------------------------------------------------------------------

def test_token_counts(spark):
    texts = odd_texts()
    for r in count_tokens(clashing(documents(spark, texts)), PATH, limit=100, batch_bytes=500).collect():
        t = texts[r["doc_id"]] or ""
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (
            len(t.encode()), len(ids_of(t)), len(ids_of(t)) > 100)


# 6 ------------------------------------------------------------------------------------------------------------------

def test_exact_dedup(spark):
    texts = odd_texts() + ["a\tb c d", "ab cd", "abcd ", "q" * 100 + "1", "q" * 100 + "2", "a b  c d"]
    norm = ["".join(words(t)) for t in texts]
    got = {r["doc_id"]: r for r in exact_groups(clashing(documents(spark, texts)), digest=True).collect()}
    for i, t in enumerate(texts):
        group = [j for j in range(len(texts)) if norm[j] == norm[i]]
        best = min(group, key=lambda j: (-len(texts[j] or ""), j))
        assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (best, len(group), best == i)
        assert got[i]["text_sha256"] == hashlib.sha256(norm[i].encode()).hexdigest()
    left = drop_exact(clashing(documents(spark, texts)))
    assert {r["doc_id"] for r in left.collect()} == {r["keep_id"] for r in got.values()}
    assert "Python" not in left._jdf.queryExecution().executedPlan().toString()


# 7 ------------------------------------------------------------------------------------------------------------------

def plain_lm(texts, ids, order):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in ids}
    trie, uni = [defaultdict(Counter) for _ in range(order + 1)], Counter()

    def symbols(t):
        return [0xFF] * order + list(lower(t).encode()) + [0xFE]

    for i, t in zip(ids, texts):
        if not held[i]:
            s = symbols(t)
            for p in range(order, len(s)):
                for j in range(order + 1):
                    trie[j][tuple(s[p - j:p])][s[p]] += 1
            uni.update(words(lower(t)) + ["\0end"])
    n, v = sum(uni.values()), len(uni)

    def log_p(s, p):
        out, gone = 0.0, set()
        for j in range(order, -1, -1):
            c = trie[j].get(tuple(s[p - j:p]))
            if c:
                left = {x: k for x, k in c.items() if x not in gone}
                total = sum(left.values()) + len(left)
                if s[p] in left:
                    return out + math.log10(left[s[p]] / total)
                if left:
                    out += math.log10(len(left) / total)
                gone |= set(c)
        return out - math.log10(257 - len(trie[0][()]))

    for i, t in zip(ids, texts):
        s, w = symbols(t), words(lower(t)) + ["\0end"]
        yield i, (held[i], len(w), sum(uni[x] > 0 for x in w), n,
                  sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w), sum(log_p(s, p) for p in range(order, len(s))))


@pytest.mark.parametrize("frequent", [500_000, 20])
def test_lm_scoring(spark, frequent):
    rnd = random.Random(8)
    texts = [t for t in odd_texts() if t is None or len(t) < 2000] + [
        " ".join(rnd.choice(["The", "tin", "ten", "cat", "sat", "é"]) for _ in range(rnd.randint(0, 30))) for _ in range(40)]
    want = dict(plain_lm(texts, range(len(texts)), 3))
    got = lm_scoring.score_texts(clashing(documents(spark, texts)), order=3, frequent=frequent).collect()
    for r in got:
        w = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert math.isclose(r["base_score"], w[4], abs_tol=1e-6) and math.isclose(r["score"], w[5], abs_tol=1e-6)


@pytest.mark.parametrize("frequent_strings", [0, 40, 4_000_000])
def test_lm_keeps_its_order_when_strings_are_joined(spark, frequent_strings):
    rnd = random.Random(12)
    texts = [t for t in odd_texts() if t is None or len(t) < 2000] + [
        " ".join(rnd.choice(["The", "tin", "ten", "cat", "sat", "é", f"w{i}"]) for _ in range(rnd.randint(0, 30)))
        for i in range(40)] + ["never seen zq zq zq"] * 9
    for order in (2, 3, 5):
        want = dict(plain_lm(texts, range(len(texts)), order))
        got = lm_scoring.score_texts(clashing(documents(spark, texts)), order=order, frequent_strings=frequent_strings)
        for r in got.collect():
            assert math.isclose(r["score"], want[r["doc_id"]][5], abs_tol=1e-6)


def test_lm_keeps_its_order_beyond_four_million_strings(spark):
    rnd = np.random.default_rng(13)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8)
    texts = [rnd.choice(letters, 60_000).tobytes().decode() for _ in range(100)]
    got = {r["doc_id"]: r for r in lm_scoring.score_texts(documents(spark, texts), order=5).collect()}
    # nearly every string of a training text is its context's only one: a byte costs log10(2) then, far more at order 4
    assert all(r["held_out"] or -r["score"] < 0.4 * 60_000 for r in got.values()) and len(got) == 100


# 8 ------------------------------------------------------------------------------------------------------------------

def plain_repeats(texts, ids, k=13):
    last = 2 ** 63 - 1
    first, listed = {}, []
    for d, t in zip(ids, texts):
        w, d = words(t), last if d is None else d
        listed.append((d, w))
        for i in range(len(w) - k + 1):
            g = tuple(w[i:i + k])
            first[g] = min(first.get(g, last), d)
    for d, w in listed:
        gone = set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i:i + k])] < d:
                gone.update(range(i, i + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        yield (d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)


@pytest.mark.parametrize("parts,crowded", [(1, None), (6, None), (40, 1_000), (290, 4_000)])
def test_substring_dedup(spark, monkeypatch, parts, crowded):
    """With small shards the copies are merged in groups, level by level; the result is the same."""
    if crowded:
        monkeypatch.setattr(substring_dedup, "CROWDED_BYTES", crowded)
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]

    def some(n):
        return [rnd.choice(vocabulary) for _ in range(n)]

    passages = [some(rnd.choice([10, 12, 13, 14, 20, 60])) for _ in range(30)]
    texts = []
    for _ in range(250):
        w = []
        for _ in range(rnd.choice([0, 1, 2, 4])):
            p, a = rnd.choice(passages), rnd.randint(0, 4)
            w += some(rnd.choice([0, 3, 20])) + p[a:len(p) - rnd.choice([0, 0, 1, 3])]
        texts.append(" ".join(w + some(rnd.choice([0, 5, 30]))))
    texts += [rnd.choice(texts) for _ in range(40)] + odd_texts()
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    ids += [5, 5, None, None]  # ids that repeat with other texts, and rows without one
    texts += [texts[3], texts[9], texts[11], texts[12]]
    got = substring_dedup.remove_repeats(clashing(documents(spark, texts, ids)).repartition(parts)).collect()
    last = 2 ** 63 - 1
    assert sorted((last if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"], r["kept_text"])
                  for r in got) == sorted(plain_repeats(texts, ids))
    assert all(sum(s["length"] for s in r["spans"]) == r["n_removed"] for r in got)


def test_a_passage_of_many_tasks_is_merged_in_levels(spark, monkeypatch):
    rnd = random.Random(12)
    passage = [f"p{i}" for i in range(40)]
    strings = []
    for i in range(400):  # the same passage between other words in each document
        strings.append((i, [rnd.getrandbits(62) for _ in range(3)] + [hash(w) & (1 << 62) - 1 for w in passage] + [rnd.getrandbits(62) for _ in range(3)]))
    rows = [(0, i, i, 5, bytearray(np.array(x, np.uint64).tobytes())) for i, x in strings]
    routed = spark.createDataFrame(rows, "shard int, pid long, key long, start int, words binary")
    monkeypatch.setattr(substring_dedup, "CROWDED_BYTES", 3_700)
    left, spans = substring_dedup._thinned(routed, 13)
    assert len(spans) >= 2 and left.count() <= 10
    covered = {}
    for s in [*spans, substring_dedup._match(left, 13)]:
        for r in s.collect():
            covered.setdefault(r["pid"], []).extend(np.frombuffer(r["spans"], "<i4").reshape(-1, 2).tolist())
    assert {p: sorted(v) for p, v in covered.items()} == {i: [[8, 40]] for i in range(1, 400)}


def test_automaton_finds_exactly_the_substrings():
    rnd = random.Random(10)
    for _ in range(30):
        a, known = substring_dedup.Automaton(), set()
        for _ in range(6):
            s = [rnd.randint(0, 2) for _ in range(rnd.randint(0, 25))]
            a.add(s)
            known |= {tuple(s[i:i + 4]) for i in range(len(s) - 3)}
            q = [rnd.randint(0, 2) for _ in range(30)]
            assert a.matches(q, 4) == [tuple(q[i:i + 4]) in known for i in range(27)]


# 9 ------------------------------------------------------------------------------------------------------------------

def test_fold():
    assert toxicity.fold("L0SER idi0t") == " loser idiot "
    assert toxicity.fold("ѕсum, tr@sh ｍｏｒｏｎ") == " scum trash moron "
    assert toxicity.fold(None) == toxicity.fold(" .,") == "  "
    assert toxicity.fold("2024 $$$") == "  "  # signs that stand alone are no letters


def test_density_skips_exceptions_and_takes_the_strongest_entry():
    lexicon = toxicity.Lexicon({" kill ": 2.0, " kil": 1.0}, [" kill time "])
    a = lexicon.matcher()
    assert toxicity.density(a, toxicity.fold("kill him")) == 2.0 / 2 ** 0.5
    assert toxicity.density(a, toxicity.fold("kill time")) == 0.0
    assert toxicity.density(a, toxicity.fold("killing")) == 1.0
    assert toxicity.density(toxicity.Lexicon().matcher(), toxicity.fold("kill")) == 0.0


def test_toxicity_on_held_out_labels(spark):
    rnd = random.Random(11)
    neutral = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    bad = ["loser", "idiot", "scum", "vermin"]
    hide = {"loser": "l0ser", "idiot": "idi0t", "scum": "ѕcum", "vermin": "verm1n"}
    texts, toxic = [], []
    for _ in range(900):
        w = [rnd.choice(neutral) for _ in range(rnd.randint(3, 120))]
        t = rnd.random() < 0.2
        for _ in range(rnd.randint(1, 3) if t else 0):
            x = rnd.choice(bad)
            w.insert(rnd.randint(0, len(w)), hide[x] if rnd.random() < 0.3 else x)
        texts.append(" ".join(w))
        toxic.append(int(t))
    df = documents(spark, texts)
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(toxic)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    lexicon = toxicity.learn(clashing(df), labels)
    out = {r["doc_id"]: r for r in toxicity.score(df, lexicon).collect()}
    test = [i for i in out if out[i]["held_out"]]
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in out) and len(test) > 100
    wrong = sum(out[i]["predicted"] != toxic[i] for i in test)
    assert wrong <= 0.02 * len(test)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out.values())
    # the score of a text does not depend on what is known of it
    assert toxicity.learn(df, labels.limit(0)).weights == {}


def test_toxicity_finds_words_masked_at_their_edges_or_by_accents(spark):
    lexicon = toxicity.Lexicon({" idiot ": 3.0, " scum ": 3.0, " ass ": 3.0, " loser ": 3.0, " vermi": 3.0}, [], 1.0, -2.0)
    a = lexicon.matcher()
    for text in ("1diot", "$cum", "a55", "1d10t!", "ídiöt", "i\u0301diot", "scum!", "loser!", "loser1", "ｌoserｓ loser!"):
        assert toxicity.density(a, toxicity.unmask(a, f"so {text}, yes")) > 0, text
    for text in ("2024 $$$", "a1", "$5", "covid19", "", None, "55 a"):
        assert toxicity.density(a, toxicity.unmask(a, text)) == 0, text
    assert toxicity.unmask(a, "loser! 1diot") == " loser idiot "
    assert toxicity.unmask(a, "café 5th great!") == toxicity.fold("café 5th great!")
    out = toxicity.score(documents(spark, ["a $cum b", "a sum b"]), lexicon).orderBy("doc_id").collect()
    assert out[0]["score"] > out[1]["score"]


def test_toxicity_learns_terms_of_less_than_one_toxic_text_in_a_hundred(spark):
    rnd = random.Random(14)
    neutral = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    toxic = [1] * 2400 + [0] * 2400
    texts = [" ".join([rnd.choice(neutral) for _ in range(4)] + (["vermin" if i % 150 == 0 else "idiot"] if t else []))
             for i, t in enumerate(toxic)]
    texts[2400:2415] = ["idiot proof"] * 15  # an exception that fewer than one clean text in a hundred holds
    df = documents(spark, texts)
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    lexicon = toxicity.learn(df, labels)
    assert any("verm" in e for e in lexicon.weights) and any("idio" in e for e in lexicon.weights)
    assert not any("word" in e for e in lexicon.weights)
    assert " idiot proof " in lexicon.exceptions


# 10 -----------------------------------------------------------------------------------------------------------------

def test_mixing(spark):
    texts = ["x" * (i % 50) for i in range(600)]
    df = clashing(documents(spark, texts, sources=["hot", "hot", "hot", "a", "b", None]))
    out = mixing.replicate(df, seed=3, temperature=0.5, epochs=2.0)
    again = mixing.replicate(df.repartition(7), seed=3, temperature=0.5, epochs=2.0)
    key = ["doc_id", "copy", "shuffle_key"]
    assert out.select(*key).exceptAll(again.select(*key)).count() == 0
    rates = {r["source"]: r for r in mixing.repetition_rates(df, 0.5, 2.0).collect()}
    total, weight = sum(r["n_chars"] for r in rates.values()), sum(r["n_chars"] ** 0.5 for r in rates.values())
    got = Counter(r["doc_id"] for r in out.collect())
    for i in range(600):
        r = rates[["hot", "hot", "hot", "a", "b", None][i % 6]]
        assert math.isclose(r["rate"], r["n_chars"] ** 0.5 / weight * total * 2 / r["n_chars"], rel_tol=1e-12)
        u = int(hashlib.md5(f"3:{i}".encode()).hexdigest()[:13], 16) / 2 ** 52
        n, p, s = 0, math.exp(-r["rate"]), math.exp(-r["rate"])
        while s <= u:
            n += 1
            p *= r["rate"] / n
            s += p
        assert got[i] == n
    assert sorted(r["copy"] for r in out.filter("doc_id = 3").collect()) == list(range(1, got[3] + 1))
    # every partition is sorted by the hashed key, which does not follow the input
    for part in out.select("shuffle_key").rdd.glom().collect():
        assert [r[0] for r in part] == sorted(r[0] for r in part)


def test_mixing_weights_and_large_rates(spark):
    df = documents(spark, ["abc"] * 200 + ["d" * 400], sources=["a"] * 200 + ["b"])
    n = Counter(r["source"] for r in mixing.replicate(df, weights={"b": 1.0}, epochs=1000.0).collect())
    assert set(n) == {"b"} and 800 < n["b"] < 4000


def test_mixing_large_rates_and_many_sources_match_the_plain_inversion(spark, monkeypatch):
    texts = [("t" * (1 + i % 5)) for i in range(60)] + ["u" * 9000]
    df = documents(spark, texts, sources=[None, "a", "b", "c", "d", "e"])
    whole = Counter(r["doc_id"] for r in mixing.replicate(df, epochs=10.0).collect())
    rates = {r["source"]: r for r in mixing.repetition_rates(df, 0.5, 10.0).collect()}
    assert any(r["cdf"] is None for r in rates.values()) and any(r["cdf"] for r in rates.values())
    for i in range(len(texts)):
        rate = rates[[None, "a", "b", "c", "d", "e"][i % 6]]["rate"]
        u = int(hashlib.md5(f"7:{i}".encode()).hexdigest()[:13], 16) / 2 ** 52
        n, lp, s = 0, -rate, math.exp(-rate)
        while s <= u:
            n += 1
            lp += math.log(rate / n)
            s += math.exp(lp)
        assert whole[i] == n
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 2)
    assert Counter(r["doc_id"] for r in mixing.replicate(df, epochs=10.0).collect()) == whole
