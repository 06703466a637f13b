"""Back-off over orders, vocabulary sketches and stream-static encoding against plain Python."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wordmill.operators import ngram as ng
from wordmill.operators import tokens as tok
from wordmill.sources import files as io
from wordmill.streaming import ingest as st

TRAIN = [[1, 2, 3, 1, 2, 4], [2, 3, 1], [5], [], None, [1, 2, 3, 1, 2, 3]]
VAL = [[1, 2, 3], [2, 9, 1, 2, 3, 5], [4], [], None, [9, 9]]


def grams(rows, order):
    out = Counter()
    for ids in rows:
        for i, x in enumerate(ids or []):
            for k in range(min(i, order - 1) + 1):
                out[tuple(ids[i - k:i]), x] += 1
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_orders_and_backoff_equal_plain_python(spark, order):
    train = spark.createDataFrame([(t,) for t in TRAIN], "ids array<bigint>").repartition(2)
    val = spark.createDataFrame([(t,) for t in VAL], "ids array<bigint>").repartition(2)
    counts = ng.fit_orders(train, "ids", order)
    want = grams(TRAIN, order)
    assert {(tuple(r.ctx), r.next): r.n for r in counts.collect()} == dict(want)
    totals = Counter()
    for (ctx, _), n in want.items():
        totals[ctx] += n

    def score(ctx, x):
        if not ctx:
            return (want[(), x] + 1) / (totals[()] + 7)
        return want[ctx, x] / totals[ctx] if want[ctx, x] else 0.4 * score(ctx[1:], x)
    losses = [-math.log(score(tuple(v[max(0, i - order + 1):i]), v[i])) for v in VAL for i in range(1, len(v or []))]
    got = ng.backoff_loss(counts, val, "ids", 7, order).first()
    assert got.n_pairs == len(losses) and got.loss == pytest.approx(sum(losses) / len(losses))


@pytest.mark.parametrize("order, parts", [(1, 3), (3, 2)])
def test_backoff_in_parts_stores_no_counts(spark, monkeypatch, order, parts):
    train = spark.createDataFrame([(t,) for t in TRAIN], "ids array<bigint>").repartition(2)
    val = spark.createDataFrame([(t,) for t in VAL], "ids array<bigint>").repartition(2)
    want = ng.backoff_loss(ng.fit_orders(train, "ids", order), val, "ids", 7, order).first()
    kept, freed, cut = [], [], ng.cut_lineage
    monkeypatch.setattr(ng, "cut_lineage", lambda df: kept.append(cut(df)) or kept[-1])
    monkeypatch.setattr(ng, "free_unused", lambda session: freed.append(session))
    apart = ng.fit_orders(train, "ids", order, apart=True)
    assert [sorted(map(str, t.collect())) for t in apart] == [
        sorted(map(str, ng.fit_orders(train, "ids", order).where(F.size("ctx") == k).collect())) for k in range(order)]
    for counts in (apart, ng.fit_orders(train, "ids", order)):
        got = ng.backoff_loss(counts, val, "ids", 7, order, parts=parts).first()
        assert got.n_pairs == want.n_pairs and got.loss == pytest.approx(want.loss)
    assert len(freed) == 2 * parts * (order - 1)
    assert all("n" not in df.columns for df in kept)  # only pairs of the validation part
    none = ng.backoff_loss(apart, val.limit(0), "ids", 7, order, parts=parts).first()
    assert none.n_pairs is None and none.loss is None


def test_packed_rows_come_back(spark, monkeypatch):
    from wordmill.functions import exchange
    monkeypatch.setattr(exchange, "PACKED_BYTES", 400)
    rows = [(i if i % 7 else None, None if i % 5 == 0 else [j if j % 3 else None for j in range(i)]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, ids array<bigint>").repartition(3)
    packed = exchange.cut_packed(df)
    assert sorted(map(str, packed.collect())) == sorted(map(str, df.collect())) and packed.dtypes == df.dtypes
    assert exchange.cut_packed(df.limit(0)).count() == 0


def test_sketches_of_parts_unite(spark):
    rows = spark.range(6000).select((F.col("id") % 3).alias("source"), (F.col("id") % 2500).cast("string").alias("token"))
    sketches = tok.vocab_sketches(rows, ["source"])
    assert sketches.count() == 3
    estimate = tok.united_vocab_size(sketches).first().estimate
    assert abs(estimate - 2500) <= 2500 * 3 * 1.04 / 128
    assert tok.united_vocab_size(sketches.where("source = 0")).first().estimate < 2600


@pytest.mark.parametrize("files", [0, 3])
def test_streamed_ids_equal_batch_ids(spark, files):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b", "b c zz", "", None, "c c a"] * 4)], "doc_id long, text string")
    vocab = tok.build_vocab(tok.explode_tokens(docs.where("doc_id <> 1 and text not like '%zz%'"), "doc_id"))
    src, sink, ck = (io.scratch_path(spark, x) for x in ("t-docs", "t-sink", "t-ck"))
    rows = docs.limit(docs.count() if files else 0)
    rows.repartition(max(1, files)).write.parquet(src)

    def run():
        stream = st.stream_files(spark, src, docs.schema, max_files_per_trigger=1)
        out = st.ingest_batches(stream, lambda b: tok.encode_texts(b, vocab, oov="unk", unk_id=99), sink, ck)
        return sorted((r.doc_id, list(r.ids)) for r in out.collect())
    want = sorted((r.doc_id, list(r.ids)) for r in tok.encode_texts(rows, vocab, oov="unk", unk_id=99).collect())
    assert run() == want and run() == want
    assert not files or any(99 in ids for _, ids in want)
