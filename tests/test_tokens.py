"""T1-T6, T11-T12 against hand-written token lists."""

import pytest
from pyspark.sql import functions as F

from wordmill.functions import exchange, joins
from wordmill.functions.text import word_tokens
from wordmill.operators import tokens as tok
from wordmill.plans import classification

CASES = {
    "a---b": ["a", "--", "-b"], "a----b": ["a", "--", "--", "b"], "re-use": ["re-use"],
    '"Hi," he said--no.': ['"', "Hi", ",", '"', "he", "said", "--", "no", "."],
    "x\ty\n\nz  w\r\n": ["x", "y", "z", "w"], "": [], "   ": [],
    "ab---": ["ab", "--", "-"], "a-.": ["a-", "."],
    "it's -- ok-- -x- --": ["it", "'", "s", "--", "ok", "--", "-x-", "--"],
    "x y z\u001cq": ["x", "y", "z", "q"], "I HAD always thought": ["I", "HAD", "always", "thought"],
}


def test_word_split_edge_cases(spark):
    df = spark.createDataFrame([(t,) for t in CASES], "text string")
    assert {r.text: list(r.t) for r in df.select("text", word_tokens("text").alias("t")).collect()} == CASES


STORY = 'The cat--"Tom"--sat. The dog, too!'
STORY_VOCAB = ["!", '"', ",", "--", ".", "The", "Tom", "cat", "dog", "sat", "too"]
STORY_IDS = [5, 7, 3, 1, 6, 1, 3, 9, 4, 5, 8, 2, 10, 0]


@pytest.fixture(scope="module")
def story(spark):
    return spark.createDataFrame([(1, STORY), (2, "")], "doc_id long, text string")


def test_vocabulary_known_values(story):
    rows = tok.build_vocab(tok.explode_tokens(story, "doc_id")).orderBy("token_id").collect()
    assert [r.token for r in rows] == STORY_VOCAB and [r.token_id for r in rows] == list(range(11))
    assert [r.n for r in rows] == [1, 2, 1, 2, 1, 2, 1, 1, 1, 1, 1]


@pytest.mark.parametrize("limit", [joins.BROADCAST_MAX_BYTES, None])
def test_encode_decode_round_trip(story, limit, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", limit)
    vocab = tok.build_vocab(tok.explode_tokens(story, "doc_id"))
    enc = tok.encode_texts(story, vocab)
    assert {r.doc_id: list(r.ids) for r in enc.collect()} == {1: STORY_IDS, 2: []}
    dec = {r.doc_id: r.decoded for r in tok.decode_ids(enc, vocab).collect()}
    assert dec == {1: 'The cat --" Tom" -- sat. The dog, too!', 2: ""}


def test_two_id_columns(spark):
    rows = spark.createDataFrame([(1, 100001, "a b"), (2, 1, "b")], "conv_id long, turn long, text string")
    vocab = tok.build_vocab(tok.explode_tokens(rows, ["conv_id", "turn"]))
    enc = tok.encode_texts(rows, vocab, id_col=["conv_id", "turn"])
    assert {(r.conv_id, r.turn): list(r.ids) for r in enc.collect()} == {(1, 100001): [0, 1], (2, 1): [1]}


@pytest.mark.parametrize("name", ["t5_encode", "t6_decode"])
def test_registered_queries_down_both_sides(spark, name, monkeypatch):
    sf = "/root/testdata/sf0.001"
    small = sorted(classification.QUERIES[name](spark, sf).collect())
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", None)
    assert sorted(classification.QUERIES[name](spark, sf).collect()) == small


def test_encoding_moves_no_text(story):
    vocab = tok.build_vocab(tok.explode_tokens(story, "doc_id"))
    plan = tok.encode_texts(story, vocab)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("small", [True, False])
def test_repeated_ids_and_rows_stay_apart(spark, small, monkeypatch):
    monkeypatch.setattr(exchange, "BLOCK_VALUES", 4)
    texts = [(1, "a b c"), (1, "d e"), (1, "d e"), (None, "c a"), (None, None), (2, ""), (3, "b " * 9)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    vocab = tok.build_vocab(tok.explode_tokens(docs, "doc_id"))
    enc = tok.encode_texts(docs, vocab, small=small)
    want = sorted(str((i, ["abcde".index(w) for w in (t or "").split()])) for i, t in texts)
    assert sorted(str((r.doc_id, list(r.ids))) for r in enc.collect()) == want
    dec = tok.decode_ids(enc, vocab, small=small)
    assert sorted(str(tuple(r)) for r in dec.collect()) == sorted(str((i, " ".join((t or "").split()))) for i, t in texts)
    part = vocab.where("token < 'c'")
    for policy, known in (("null", None), ("skip", "skip"), ("unk", -1)):
        got = tok.encode_texts(docs, part, oov=policy, unk_id=-1, small=small).collect()
        assert sorted(str((r.doc_id, list(r.ids))) for r in got) == sorted(str((i, [
            "ab".index(w) if w in "ab" else known for w in (t or "").split() if w in "ab" or known != "skip"])) for i, t in texts)
    with pytest.raises(Exception, match="unknown token: [cde]"):
        tok.encode_texts(docs, part, small=small).collect()
    with pytest.raises(Exception, match="unknown id: [234]"):
        tok.decode_ids(enc, part, small=small).collect()


def test_unknown_token_policies(spark):
    vocab = spark.createDataFrame([("a", 0, 1), ("b", 1, 1)], "token string, token_id long, n long")
    docs = spark.createDataFrame([(1, "a c b")], "doc_id long, text string")
    long = tok.explode_tokens(docs, "doc_id")
    skip = tok.encode_tokens(long, vocab, "doc_id", oov="skip").orderBy("pos").collect()
    assert [r.token_id for r in skip] == [0, 1]
    unk = tok.encode_tokens(long, vocab, "doc_id", oov="unk", unk_id=99).orderBy("pos").collect()
    assert [r.token_id for r in unk] == [0, 99, 1]
    with pytest.raises(Exception):
        tok.encode_tokens(long, vocab, "doc_id", oov="error").collect()


def test_frequencies_and_longest(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b"), (3, "")], "doc_id long, text string")
    freq = {r.token: r.n for r in tok.token_frequencies(tok.explode_tokens(docs, "doc_id")).collect()}
    assert freq == {"a": 2, "b": 2}
    t = tok.tokenize_words(docs)
    assert t.agg(tok.longest_length(t, "tokens")).first()[0] == 3


def test_salted_lookup_matches_plain_join(spark):
    from wordmill.functions.joins import salted_lookup
    facts = spark.range(0, 5000).select(F.col("id").alias("row"),
                                        F.when(F.col("id") % 3 == 0, "hot").otherwise(
                                            F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"))
    dim = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.length("k"))
    a = salted_lookup(facts, dim, "k", ["row"], freq_col="n", hot_fraction=0.05, salts=8,
                      broadcast_max_bytes=None).select("row", "v").orderBy("row").collect()
    b = facts.join(dim, "k", "left").select("row", "v").orderBy("row").collect()
    assert a == b


def test_direct_lookups_bring_in_few_values_at_once(spark, monkeypatch):
    import pyarrow as pa
    from wordmill.functions import exchange
    monkeypatch.setattr(exchange, "DIRECT_VALUES", 4)
    dim = spark.createDataFrame([(k, k * 10) for k in range(6)], "k long, v long")
    rows = [(1, [0, 1, 2]), (2, [3]), (3, None), (4, [5] * 9), (5, []), (6, [9])]
    df = spark.createDataFrame(rows, "doc_id long, a array<bigint>").coalesce(1)

    def at_once(values, at, lens):
        return pa.array([len(at)] * len(lens), pa.int64())
    got = exchange.lookup_arrays(df, ["doc_id"], "a", dim, "k", "v", "n", small=True, combine=at_once, out_type="bigint")
    assert {r.doc_id: r.n for r in got.collect()} == {1: 4, 2: 4, 3: 4, 4: 9, 5: 1, 6: 1}
    got = exchange.lookup_arrays(df, ["doc_id"], "a", dim, "k", "v", "vs", small=True)
    assert {r.doc_id: r.vs for r in got.collect()} == {i: [x * 10 if x < 6 else None for x in a or []] for i, a in rows}
