"""L5-L8 and Q7-Q9 against plain-Python restatements."""

import hashlib
import math

from pyspark.sql import functions as F

from wordmill.operators import ledger as led
from wordmill.operators import ngram as ng

SEQS = [[1, 2, 3, 1, 2, 4], [2, 3, 1, 2, 3], [5, 1, 2], [9]]


def _ids(spark):
    return spark.createDataFrame([(i, s) for i, s in enumerate(SEQS)], "doc_id long, ids array<bigint>")


def py_counts():
    c = {}
    for s in SEQS:
        for a, b in zip(s, s[1:]):
            c[(a, b)] = c.get((a, b), 0) + 1
    return c


def test_fit_and_loss(spark):
    df = _ids(spark)
    counts = ng.fit(df, "ids")
    got = {(r.ctx[0], r.next): r.n for r in counts.collect()}
    assert got == py_counts()
    val = spark.createDataFrame([(0, [1, 2, 7])], "doc_id long, ids array<bigint>")
    out = ng.loss(counts, val, "ids", 10).first()
    c = py_counts()
    ctx_n = {}
    for (a, _), n in c.items():
        ctx_n[a] = ctx_n.get(a, 0) + n
    expect = (-math.log((c[(1, 2)] + 1) / (ctx_n[1] + 10)) - math.log((0 + 1) / (ctx_n[2] + 10))) / 2
    assert out.n_pairs == 2 and abs(out.loss - expect) < 1e-12


def py_greedy(start, steps):
    c = py_counts()
    best = {}
    for (a, b), n in c.items():
        if a not in best or (n, -b) > (c[(a, best[a])], -best[a]):
            best[a] = b
    uni = {}
    for (a, b), n in c.items():
        uni[b] = uni.get(b, 0) + n
    fb = max(uni, key=lambda b: (uni[b], -b))
    out, cur = [], start
    for _ in range(steps):
        cur = best.get(cur, fb)
        out.append(cur)
    return out


def test_greedy_continue(spark):
    df = _ids(spark)
    counts = ng.fit(df, "ids")
    got = {r.doc_id: list(r.generated) for r in
           ng.greedy_continue(df, "doc_id", "ids", counts, 7).collect()}
    assert got == {i: py_greedy(s[-1], 7) for i, s in enumerate(SEQS)}


def test_greedy_continue_longer_orders_and_stop(spark):
    df = _ids(spark)
    for order, steps in ((1, 3), (2, 1), (2, 33), (3, 9)):
        counts = ng.fit(df, "ids", order)
        table = {}
        for r in counts.collect():
            key = tuple(r.ctx)
            table[key] = max(table.get(key, (0, 0)), (r.n, -r.next))
        uni = {}
        for r in counts.collect():
            uni[r.next] = uni.get(r.next, 0) + r.n
        common = max(uni, key=lambda x: (uni[x], -x))
        got = {r.doc_id: list(r.generated) for r in ng.greedy_continue(df, "doc_id", "ids", counts, steps, order).collect()}
        for i, s in enumerate(SEQS):
            walk = list(s)
            for _ in range(steps):
                key = tuple(walk[-(order - 1):]) if order > 1 else ()
                walk.append(-table[key][1] if key in table else common)
            assert got[i] == walk[len(s):], (order, steps, i)
    counts = ng.fit(df, "ids")
    cut = {r.doc_id: list(r.generated) for r in ng.greedy_continue(df, "doc_id", "ids", counts, 6, eos_id=3).collect()}
    for i, s in enumerate(SEQS):
        full = py_greedy(s[-1], 6)
        assert cut[i] == (full[:full.index(3)] if 3 in full else full)


def test_hot_start_context_is_not_joined_plainly(spark, monkeypatch):
    """90 % of the prompts end in one context: beyond the broadcast limit its walks are salted."""
    from wordmill.functions import joins
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", None)
    counts = ng.fit(_ids(spark), "ids")
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 > 0, F.array(F.lit(2)))
                                    .otherwise(F.array(F.col("id") % 7)).cast("array<bigint>").alias("ids"))
    out = ng.greedy_continue(rows, "doc_id", "ids", counts, 4)
    assert "_wm_salt" in out._jdf.queryExecution().executedPlan().toString()
    got = {r.doc_id: list(r.generated) for r in out.collect()}
    assert len(got) == 1000 and all(got[i] == py_greedy(2, 4) for i in range(1000) if i % 10)


def test_sample_continue_stops_at_eos_and_greedy_at_zero_temperature(spark):
    df = _ids(spark)
    counts = ng.fit(df, "ids")
    zero = {r.doc_id: list(r.generated) for r in
            ng.sample_continue(df, "doc_id", "ids", counts, 5, temperature=0.0).collect()}
    assert zero == {i: py_greedy(s[-1], 5) for i, s in enumerate(SEQS)}
    eos = {r.doc_id: list(r.generated) for r in
           ng.sample_continue(df, "doc_id", "ids", counts, 6, temperature=0.0, eos_id=3).collect()}
    for i, s in enumerate(SEQS):
        full = py_greedy(s[-1], 6)
        assert eos[i] == (full[:full.index(3)] if 3 in full else full)
    drawn = ng.sample_continue(df, "doc_id", "ids", counts, 8, top_k=2, temperature=1.0, seed=5)
    assert drawn.count() == len(SEQS)


def test_schedule_and_ledger(spark):
    rows = spark.createDataFrame([(i, 3) for i in range(19)], "id long, n_tok int")
    sch = led.epoch_schedule(rows, "id", num_epochs=2, batch_size=4, seed=1)
    got = sch.collect()
    assert len(got) == 2 * 16
    assert sorted({r.step for r in got}) == list(range(8))
    e0 = sorted((r.batch_id, r.id) for r in got if r.epoch == 0)
    order = sorted(range(19), key=lambda i: (hashlib.md5(f"1:0:{i}".encode()).hexdigest(), 0, i))
    assert [i for _, i in e0] == [i for b in range(4) for i in sorted(order[b * 4:(b + 1) * 4])]
    ledger = led.exposure_ledger(sch, "n_tok").orderBy("step").collect()
    assert [r.examples_seen for r in ledger] == [4 * (k + 1) for k in range(8)]
    assert [r.tokens_seen for r in ledger] == [12 * (k + 1) for k in range(8)]
    pts = led.eval_points(led.exposure_ledger(sch), 3).orderBy("step").collect()
    assert [r.step for r in pts] == [0, 3, 6]


def test_corpus_ids_shuffle_no_tokens_and_join_the_rows_of_an_id(spark, tmp_path, monkeypatch):
    from wordmill.operators import tokens as tok
    from wordmill.plans import corpus

    def never(*a, **kw):
        raise AssertionError("single tokens are shuffled")
    monkeypatch.setattr(tok, "encode_tokens", never)
    texts = [(1, "a b c d e f g h i jk"), (2, "b b b, b"), (2, "c d. e f g"), (3, None), (4, ""), (None, "a c")]
    for rows, folder in ((texts[:2] + texts[3:5], "own"), (texts, "shared")):
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/{folder}/documents.parquet")
        ids, vocab = corpus.corpus_ids(spark, f"{tmp_path}/{folder}")
        word = {r.token_id: r.token for r in vocab.collect()}
        got = sorted((r.doc_id or 0, " ".join(word[i] for i in r.train_ids), " ".join(word[i] for i in r.val_ids))
                     for r in ids.collect())
        assert all(len(r.full_ids) == len(r.train_ids) + len(r.val_ids) for r in ids.collect())
        if folder == "own":
            assert got == [(1, "a b c d e f g h i", "jk"), (2, "b b b ,", "b"), (3, "", ""), (4, "", "")]
        else:
            both = "b c b d . b , e f", "b g"
            assert got[1:] == [(1, "a b c d e f g h i", "jk"), (2, *both), (2, *both), (3, "", ""), (4, "", "")]
            assert got[0] == (0, "", "")


def test_counts_travel_as_plain_ids(spark):
    for counts in (ng.fit(_ids(spark), "ids"), ng.fit_orders(_ids(spark), "ids", 3)):
        plan = counts._jdf.queryExecution().executedPlan().toString()
        dealt = [x for x in plan.splitlines() if "hashpartitioning" in x]
        assert dealt and not any("hashpartitioning(ctx" in x for x in dealt)


def test_a_step_of_sampling_reads_one_row_for_many_buckets(spark, monkeypatch):
    counts = spark.createDataFrame([([1], i, 1 + i % 3) for i in range(2, 200)] + [([i], 1, 2) for i in range(2, 200)],
                                   "ctx array<bigint>, next long, n long")
    prompts = spark.createDataFrame([(i, [1 + i % 5]) for i in range(40)], "doc_id long, ids array<bigint>")
    kept, cut = [], ng.cut_lineage

    def noted(df):
        if "drawn" in df.columns:
            kept.append(df)
        return cut(df)
    monkeypatch.setattr(ng, "cut_lineage", noted)
    runs = []
    for chunk in (32, 1):  # one bucket a row is the plain form
        monkeypatch.setattr(ng, "CHUNK_BUCKETS", chunk)
        runs.append(sorted((r.doc_id, tuple(r.generated)) for r in ng.sample_continue(prompts, "doc_id", "ids", counts, 6).collect()))
    assert runs[0] == runs[1] and all(len(g) == 6 for _, g in runs[0])
    assert len(kept) == 2 and kept[0].count() * 8 < kept[1].count()


def test_sampling_in_parts_draws_the_same(spark, monkeypatch):
    rows = [[i % 7, (i * i) % 11, i % 3, (i * 5) % 13, 3, i % 2, 3] for i in range(40)] + [[99], [], None]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, ids array<bigint>").repartition(3)
    freed, kept, cut = [], [], ng.cut_lineage
    monkeypatch.setattr(ng, "free_unused", lambda session: freed.append(session))
    monkeypatch.setattr(ng, "cut_lineage", lambda d: kept.append(cut(d)) or kept[-1])
    for order, top_k, heat, eos in ((2, 3, 1.4, None), (3, None, 0.8, 3)):
        counts = ng.fit(df, "ids", order)
        runs = []
        for parts in (1, 2):
            kept.clear(), freed.clear()
            out = ng.sample_continue(df, "doc_id", "ids", counts, 6, order, top_k, heat, eos, parts=parts)
            runs.append(sorted((r.doc_id, tuple(r.generated)) for r in out.collect()))
            assert len(freed) == (0 if parts == 1 else 2 * parts + 1)
        assert runs[0] == runs[1] and len(runs[0]) == len(rows)
        whole = counts.count()
        assert all(d.count() < whole for d in kept if d.columns == ["ctx", "next", "n"])
