"""Plans and sides that only large data would take."""

import os
import re

import pytest
from pyspark.sql import functions as F

from wordmill.functions import exchange, joins
from wordmill.operators import ngram as ng
from wordmill.operators import sequences as seq
from wordmill.operators import vectors as vec
from wordmill.plans import models, streams, training_data

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["q5_batches", "q7_schedule", "q8_exposure", "q9_eval_points"])
def test_batch_ledgers_build_no_vocabulary(spark, name, monkeypatch):
    def never(*a, **kw):
        raise AssertionError("a vocabulary is built")
    monkeypatch.setattr(training_data.tok, "build_vocab", never)
    monkeypatch.setattr(training_data.tok, "encode_texts", never)
    assert training_data.QUERIES[name](spark, SF).count() > 0


COUNTS = [([i % 3], (i * i) % 17, 1 + i % 4) for i in range(60)]


def counts_of(spark):
    rows = spark.createDataFrame(COUNTS, "ctx array<bigint>, next long, n long")
    return rows.groupBy("ctx", "next").agg(F.sum("n").alias("n"))


@pytest.mark.parametrize("top_k, temperature", [(None, 1.0), (4, 0.7), (1, 1.0), (3, 0.0)])
def test_running_weights_do_not_depend_on_the_span(spark, monkeypatch, top_k, temperature):
    counts = counts_of(spark)

    def rows():
        return sorted((tuple(r.ctx), r.bucket, r.next, round(r.lo, 9), round(r.hi, 9), r.nb, tuple(r.next_ctx), r.next_nb)
                      for r in ng.candidates(counts, top_k, temperature).collect())
    whole = rows()
    monkeypatch.setattr(ng, "SPAN_IDS", 3)
    assert rows() == whole
    hi = {}
    for ctx, _, nxt, lo, up, *_ in sorted(whole, key=lambda r: (r[0], r[2], r[1])):
        if hi.get(ctx, (None, 0.0))[0] != nxt:
            assert lo == pytest.approx(hi.get(ctx, (None, 0.0))[1], abs=1e-8)
        hi[ctx] = (nxt, up)
    assert all(up == 2.0 for _, up in hi.values())


def test_no_context_meets_in_one_window(spark):
    found = re.findall(r"Window \[.*?\], \[([^\]]*)\]", plan(ng.candidates(counts_of(spark), 4, 0.7)))
    assert found and all("_wm_span" in keys for keys in found if "ctx" in keys)


@pytest.mark.parametrize("small", [True, False])
def test_pooling_equals_plain_means(spark, small):
    table = spark.createDataFrame([(i, [float(i), float(i * i)]) for i in range(5)], "vec_id long, embedding array<float>")
    ids = [(1, [1, 1, 4, 9]), (1, [2]), (2, []), (3, None), (4, [7, 8]), (5, [0, 1, 2, 3, 4] * 7000)]
    df = spark.createDataFrame(ids, "doc_id long, ids array<bigint>").repartition(3)
    want = []
    for i, row in ids:
        own = [x for x in row or [] if x < 5]
        want.append((i, [sum(own) / len(own), sum(x * x for x in own) / len(own)] if own else None))
    got = [(r.doc_id, r.pooled) for r in vec.pool_arrays(df, "doc_id", "ids", table, small=small).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_next_tokens_of_short_arrays(spark):
    df = spark.createDataFrame([(1, [5, 6, 7]), (2, [8]), (3, []), (4, None)], "doc_id long, ids array<bigint>")
    got = sorted(map(tuple, seq.next_tokens(df, "doc_id").collect()))
    assert got == [(1, 0, 5, 6), (1, 1, 6, 7), (1, 2, 7, None), (2, 0, 8, None)]
    assert "Window" not in plan(seq.next_tokens(df, "doc_id"))


def test_exact_classifier_rows(spark):
    rows = models.l2_bayes(spark, SF).collect()
    assert {r.split for r in rows} >= {"train"} and all(0 <= r.accuracy <= 1 and r.loss >= 0 for r in rows)


@pytest.mark.parametrize("block_values, owner_keys, owner_bytes", [(1 << 20, 1 << 12, 32 << 20), (7, 1, 32 << 20), (7, 1, 40)])
def test_exchange_by_owners_equals_plain_look_up(spark, monkeypatch, block_values, owner_keys, owner_bytes):
    monkeypatch.setattr(exchange, "OWNER_KEYS", owner_keys)
    monkeypatch.setattr(exchange, "OWNER_BYTES", owner_bytes)
    rows = [(i % 5, None if i % 11 == 0 else [None if j % 13 == 0 else (i * j) % 40 for j in range(i % 9)]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a array<long>").repartition(3)
    for kind, of in (("string", lambda k: f"w{k}"), ("long", lambda k: -k), ("array<float>", lambda k: [float(k), 0.5])):
        dim = spark.createDataFrame([(k, of(k)) for k in range(30)] + [(None, of(77))], f"k long, v {kind}")
        found = exchange.lookup_arrays(df, ["id"], "a", dim, "k", "v", "o", small=False, block_values=block_values)
        assert "Generate" not in plan(found)  # no element is a row
        want = sorted(str((i, [of(k) if k is not None and k < 30 else None for k in a or []])) for i, a in rows)
        assert sorted(str((r.id, r.o)) for r in found.collect()) == want
        words = df.select("id", F.transform("a", lambda x: F.concat(F.lit("ß"), x.cast("string"))).alias("a"))
        keys = dim.select(F.concat(F.lit("ß"), F.col("k").cast("string")).alias("k"), "v")
        found = exchange.lookup_arrays(words, ["id"], "a", keys, "k", "v", "o", small=False, block_values=block_values)
        assert sorted(str((r.id, r.o)) for r in found.collect()) == want
    empty = exchange.lookup_arrays(df, ["id"], "a", dim.limit(0), "k", "v", "o", small=False, block_values=block_values)
    assert sorted(str((r.id, r.o)) for r in empty.collect()) == sorted(str((i, [None] * len(a or []))) for i, a in rows)
    assert exchange.lookup_arrays(df.limit(0), ["id"], "a", dim, "k", "v", "o", small=False).collect() == []


def test_vectors_of_floats_are_not_widened(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(vec, "lookup_arrays", lambda *a, **kw: seen.append(a[3].dtypes[1][1]))
    ids = spark.createDataFrame([(1, [0])], "doc_id long, ids array<long>")
    for kind in ("float", "double", "int"):
        vec.pool_arrays(ids, "doc_id", "ids", spark.createDataFrame([], f"vec_id long, embedding array<{kind}>"))
    assert seen == ["array<float>", "array<double>", "array<double>"]


def test_greedy_walks_take_the_contexts_that_prompts_reach(spark, monkeypatch):
    chain = spark.range(400).select(F.array("id").alias("ctx"), ((F.col("id") + 1) % 400).alias("next"), F.lit(1).cast("long").alias("n"))
    starts = spark.createDataFrame([([7],), ([7],), (None,)], "ctx array<long>")
    for limit in (1 << 20, None):
        assert ng._greedy_steps(chain, starts, 2, 5, limit).count() == 5
    prompts = spark.createDataFrame([(1, [7]), (2, [900]), (3, None), (4, [398])], "doc_id long, ids array<long>")
    want = {1: list(range(8, 28)), 2: list(range(20)), 3: [], 4: [399, *range(19)]}
    asked, fits = [], joins.fits_broadcast
    monkeypatch.setattr(joins, "fits_broadcast", lambda d, most: asked.append(most) or fits(d, most))
    for levels in (12, 30):  # before and after the walks have ended
        monkeypatch.setattr(ng, "GREEDY_LEVELS", levels)
        out = ng.greedy_continue(prompts, "doc_id", "ids", chain, 20)
        assert {r.doc_id: list(r.generated) for r in out.collect()} == want
    # the tables of all joins together, and the continuations, fit the limit
    assert asked.count(joins.BROADCAST_MAX_BYTES) == 2 and max(set(asked) - {joins.BROADCAST_MAX_BYTES}) * 11 <= joins.BROADCAST_MAX_BYTES


def test_batches_of_the_stream_are_many_files(spark, monkeypatch):
    seen, plain = [], streams.st.stream_files

    def stream(session, path, schema, **kw):
        seen.append((sum(n.endswith(".parquet") for n in os.listdir(path.removeprefix("file:"))), kw["max_files_per_trigger"]))
        return plain(session, path, schema, **kw)
    monkeypatch.setattr(streams.st, "stream_files", stream)
    monkeypatch.setattr(streams, "ST1_BATCHES", 2)
    assert streams.st1_encode(spark, SF).count() == 200
    width = spark.sparkContext.defaultParallelism
    assert seen == [(2 * width, width)]
