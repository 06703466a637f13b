"""T7-T10 against a plain-Python byte-level BPE."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle_check import compare, duck
from pyspark.sql import functions as F

from wordmill.operators import subword as bpe
from wordmill.plans import subwords
from wordmill.sources import adapters
from wordmill.sources import files as io


def py_pretokens(text):
    import regex
    return regex.findall(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+", text)


def py_learn(texts, n):
    freq = {}
    for t in texts:
        for p in py_pretokens(t):
            k = tuple(p.encode("utf-8"))
            freq[k] = freq.get(k, 0) + 1
    merges = []
    for r in range(n):
        pairs = {}
        for k, c in freq.items():
            for a, b in zip(k, k[1:]):
                pairs[(a, b)] = pairs.get((a, b), 0) + c
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        if pairs[best] < 2:
            break
        merges.append(best)
        new = 256 + r
        nf = {}
        for k, c in freq.items():
            out, i = [], 0
            while i < len(k):
                if i + 1 < len(k) and (k[i], k[i + 1]) == best:
                    out.append(new)
                    i += 2
                else:
                    out.append(k[i])
                    i += 1
            nf[tuple(out)] = nf.get(tuple(out), 0) + c
        freq = nf
    return merges


TEXTS = ["the cat sat on the mat with the hat", "aaaa aaaa bbb the thethe", "héllo wörld 123 45!!\n\nok",
         "it's the end... isn't it? the the the"]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")


def test_pretokens_match_regex_module(spark, corpus):
    got = {r.doc_id: list(r.p) for r in corpus.select("doc_id", bpe.pretokens("text").alias("p")).collect()}
    assert all(got[i] == py_pretokens(t) for i, t in enumerate(TEXTS))


def py_encode(text, ranks):
    """Plain BPE: the lowest-ranked pair merges, leftmost first, until none is left."""
    out = []
    for p in py_pretokens(text):
        k = list(p.encode("utf-8"))
        while (best := min(((ranks[x], i) for i, x in enumerate(zip(k, k[1:])) if x in ranks), default=None)):
            k[best[1]:best[1] + 2] = [256 + best[0]]
        out += k
    return out


@pytest.mark.parametrize("n", [1, 12, 40])
def test_learned_merges_match_python(corpus, n):
    assert bpe.learn_merges(corpus, "text", n, checkpoint_every=4) == py_learn(TEXTS, n)


@pytest.mark.parametrize("frontier", [1, 5, 60])
def test_learning_with_a_short_frontier_and_many_ties(spark, monkeypatch, frontier):
    monkeypatch.setattr(bpe, "FRONTIER", frontier)
    monkeypatch.setattr(bpe, "ROUND_PAIRS", min(4, frontier))
    rng = random.Random(frontier)
    texts = ["".join(rng.choice("abc  ") for _ in range(120)) for _ in range(6)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert bpe.learn_merges(docs, "text", 60, checkpoint_every=7) == py_learn(texts, 60)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab"), min_size=1, max_size=9), min_size=1, max_size=8))
def test_a_round_takes_what_recounting_would_take(words):
    n = np.arange(1, len(words) + 1) ** 2
    sym = np.array([x for w in words for x in (-1, *w.encode())], np.int32)
    keys, own = bpe._pairs(sym, n)
    counts = {}
    for k, c in zip(keys.tolist(), own.tolist()):
        counts[k] = counts.get(k, 0) + c
    taken = bpe._next_merges(counts, (0, 0, 0), 50, 1)
    for r, pair in enumerate(taken):
        keys, own = bpe._pairs(sym, n)
        counts = {}
        for k, c in zip(keys.tolist(), own.tolist()):
            counts[k] = counts.get(k, 0) + c
        assert pair == min(((-c, k >> 32, k & 0xFFFFFFFF) for k, c in counts.items()))[1:]
        sym = bpe._apply(sym, [(*pair, 256 + r)])


def test_thirty_merges_are_those_of_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duck(sf)
    assert compare(spark, con, sf, "t10", lambda s, d: subwords.t10_learn_merges(s, d, 30), subwords.learned_sql(30))[0]
    merges = subwords.learned(spark, sf, 30)
    query = lambda s, d: subwords.ids_row(bpe.encode(adapters.corpus(s, d), merges))
    assert compare(spark, con, sf, "t7", query, subwords.coded_sql(30))[0]


def test_published_vocabulary_gives_the_library_s_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model = subwords.published()
    assert len(model.merges) == 50_000 and model.special == {"<|endoftext|>": 50256}
    docs = adapters.corpus(spark, "/root/testdata/sf0.001")
    texts = {r.doc_id: r.text for r in docs.collect()} | {-1 - i: t for i, t in enumerate(TEXTS)}
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(-1 - i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"))
    got = {r.doc_id: list(r.ids) for r in bpe.encode(both, model).collect()}
    assert got == {i: theirs.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    marked = both.withColumn("text", F.concat("text", F.lit("<|endoftext|>a")))
    got = {r.doc_id: list(r.ids) for r in bpe.encode(marked, model, special="allow").collect()}
    assert got == {i: theirs.encode(t + "<|endoftext|>a", add_special_tokens=False).ids for i, t in texts.items()}


def test_learning_stops_below_the_least_count(corpus):
    assert bpe.learn_merges(corpus, "text", 1000) == py_learn(TEXTS, 1000)


def test_encode_decode_round_trip_and_special(spark, corpus):
    merges = py_learn(TEXTS, 40)
    ranks = {m: r for r, m in enumerate(merges)}
    assert {r.doc_id: list(r.ids) for r in bpe.encode(corpus, merges).collect()} == {
        i: py_encode(t, ranks) for i, t in enumerate(TEXTS)}
    assert {r.doc_id: r.text for r in bpe.decode(bpe.encode(corpus, merges), merges).collect()} == dict(enumerate(TEXTS))
    sp = corpus.withColumn("text", F.concat("text", F.lit("<|endoftext|>"), F.lit("x"), F.lit("<|endoftext|>")))
    got = {r.doc_id: list(r.ids) for r in bpe.encode(sp, merges, special="allow").collect()}
    assert got == {i: [*py_encode(t, ranks), 50256, *py_encode("x", ranks), 50256] for i, t in enumerate(TEXTS)}
    with pytest.raises(Exception, match="special token"):
        bpe.encode(sp, merges, special="raise").collect()
    as_text = bpe.encode(sp, merges, special="as_text")
    assert all(50256 not in r.ids for r in as_text.collect())
    with pytest.raises(Exception, match="unknown id"):
        bpe.decode(spark.createDataFrame([(1, [99999])], "doc_id long, ids array<bigint>"), merges).collect()


def test_a_list_of_50000_merges(corpus):
    rng = random.Random(1)
    merges = dict.fromkeys(py_learn(TEXTS, 30))  # a list without repeats, in order
    while len(merges) < 50_000:
        merges.setdefault((rng.randrange(256 + len(merges)), rng.randrange(256)))
    model = bpe.Model.learned(list(merges))
    assert len(model.merges) == 50_000 and model.special["<|endoftext|>"] == 50256
    ranks = {m: r for r, m in enumerate(merges)}
    got = {r.doc_id: list(r.ids) for r in bpe.encode(corpus, model).collect()}
    assert got == {i: py_encode(t, ranks) for i, t in enumerate(TEXTS)}


def test_special_id_may_not_be_an_ordinary_one():
    with pytest.raises(ValueError, match="special ids"):
        bpe.Model.learned([(97, 98)], {"<|endoftext|>": 256})


def test_model_from_files(spark, corpus):
    model = bpe.Model.learned(py_learn(TEXTS, 20))
    path = io.scratch_path(spark, "t-model")
    io.write_model_files(spark, model, path)
    back = bpe.Model.from_tables(io.read_vocab_json(spark, f"{path}/vocab"), io.read_merge_list(spark, f"{path}/merges"))
    assert back == model


def test_special_tokens_give_the_digest_of_learned_ids(spark, tmp_path):
    import hashlib
    spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    merges = py_learn(TEXTS, subwords.SPECIAL_MERGES)
    ranks = {m: r for r, m in enumerate(merges)}
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    got = {r.doc_id: (r.n_special, r.ids_md5, r.text_md5) for r in subwords.t9_special_tokens(spark, str(tmp_path)).collect()}
    assert got == {i: (1, md5(" ".join(map(str, [*py_encode(t, ranks), 50256, *py_encode(t, ranks)]))), md5(f"{t}<|endoftext|>{t}"))
                   for i, t in enumerate(TEXTS)}


def test_coding_works_slice_by_slice_and_forgets(spark, corpus, monkeypatch):
    merges = py_learn(TEXTS, 40)
    docs = corpus.unionByName(spark.createDataFrame([(9, ""), (10, None)], "doc_id long, text string")).coalesce(1)
    whole = {r.doc_id: list(r.ids) for r in bpe.encode(docs, merges).collect()}
    seen = []
    monkeypatch.setattr(bpe, "SLICE_VALUES", 3)
    monkeypatch.setattr(bpe, "CACHE_BYTES", 500)
    enc = bpe.encode(docs, merges)
    assert {r.doc_id: list(r.ids) for r in enc.collect()} == whole
    assert {r.doc_id: r.text for r in bpe.decode(enc, merges).collect()} == dict(enumerate(TEXTS)) | {9: "", 10: ""}
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array([[1, 2], [3, 4], None, [5] * 9, []])], ["id", "ids"])
    for part, flat, lens in bpe._slices(iter([batch])):
        seen.append((part.num_rows, len(flat), lens.tolist()))
    assert seen == [(1, 2, [2]), (2, 2, [2, 0]), (1, 9, [9]), (1, 0, [0])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-1, 6), max_size=40), st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), max_size=6, unique=True))
def test_merges_in_one_pass_are_merges_one_by_one(symbols, pairs):
    sym = np.array([-1, *symbols], np.int32)
    made = [(a, b, 7 + k) for k, (a, b) in enumerate(pairs)]
    one = sym.tolist()
    for a, b, new in made:
        out, i = [], 0
        while i < len(one):
            if one[i:i + 2] == [a, b]:
                out.append(new)
                i += 2
            else:
                out.append(one[i])
                i += 1
        one = out
    assert bpe._apply(sym, made).tolist() == one
