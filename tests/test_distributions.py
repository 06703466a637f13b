"""M1-M8 against numpy restatements."""

import hashlib
import math

import numpy as np

from wordmill.operators import distributions as dist
from wordmill.operators import evaluation as ev


def _logits(spark, rows):
    return spark.createDataFrame(
        [(r, c, float(v), t) for r, (vals, t) in enumerate(rows) for c, v in enumerate(vals)],
        "row_id long, class_id int, logit double, target int")


def test_top_k_keeps_ties_and_argmax(spark):
    df = _logits(spark, [([2, 5, 2, -1, 5], 0)])
    kept = dist.top_k(df, 3, mode="drop").collect()
    assert sorted(r.class_id for r in kept) == [0, 1, 2, 4]
    masked = {r.class_id: r.logit for r in dist.top_k(df, 3).collect()}
    assert masked[3] == float("-inf")
    assert dist.argmax(df).first().pred == 1


def test_softmax_and_cross_entropy(spark):
    rows = [([1.0, 2.0, 3.0], 2), ([0.5, -1.0, 4.0], 0), ([1.0, 1.0, 1.0], -100)]
    df = _logits(spark, rows)
    sm = dist.softmax(df).collect()
    for r in range(3):
        vals = np.array(rows[r][0])
        p = np.exp(vals - vals.max()) / np.exp(vals - vals.max()).sum()
        got = sorted((x.class_id, x.prob) for x in sm if x.row_id == r)
        assert np.allclose([g[1] for g in got], p)
    ce = {r.row_id: r.loss for r in dist.cross_entropy(df).collect()}
    assert set(ce) == {0, 1}  # the ignore_index row is excluded
    for r in (0, 1):
        vals, t = np.array(rows[r][0]), rows[r][1]
        expect = math.log(np.exp(vals).sum()) - vals[t]
        assert abs(ce[r] - expect) < 1e-12


def _u(seed, row, step):
    return int(hashlib.md5(f"{seed}:{row}:{step}".encode()).hexdigest()[:8], 16) / 4294967296.0


def test_sample_matches_python(spark):
    rng = np.random.default_rng(0)
    rows = [(list(rng.normal(size=8)), 0) for _ in range(200)]
    df = _logits(spark, rows)
    got = {r.row_id: r.sampled for r in dist.sample(df, 7, 3, top_k_=4, temperature=0.8).collect()}
    for r, (vals, _) in enumerate(rows):
        v = np.array(vals)
        kth = np.sort(v)[::-1][3]
        keep = [c for c in range(8) if v[c] >= kth]
        w = np.exp((v[keep] - v[keep].max()) / 0.8)
        p = w / w.sum()
        u = _u(7, r, 3)
        cum, pick = 0.0, keep[-1]
        for c, pc in zip(keep, p):
            cum += pc
            if cum >= u:
                pick = c
                break
        assert got[r] == pick


def test_loader_loss_mean_of_batch_means_and_accuracy(spark):
    losses = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 10.0)], "batch_id long, loss double")
    assert ev.loader_loss(losses).first().loss == (2.0 + 10.0) / 2
    assert ev.loader_loss(losses, num_batches=1).first().loss == 2.0
    empty = losses.where("false")
    assert math.isnan(ev.loader_loss(empty).first().loss)
    preds = spark.createDataFrame([(0, 1, 1), (0, 0, 1), (1, 1, 1)], "batch_id long, pred int, target int")
    assert abs(ev.accuracy(preds).first().accuracy - 2 / 3) < 1e-12
    assert ev.accuracy(preds.where("false")).first().accuracy == 0.0
    rep = {r.split: (r.loss, r.accuracy) for r in ev.report(
        losses.withColumn("split", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("train")),
        preds.withColumn("split", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("train")),
        ["train", "test"]).collect()}
    assert rep["train"][0] == 6.0 and math.isnan(rep["test"][0]) and rep["test"][1] == 0.0


def test_loss_curve_positions(spark):
    pts = spark.createDataFrame([(0,), (5,), (10,)], "step long")
    pos = sorted(r.epoch_pos for r in ev.loss_curve(pts, 4, 5).collect())
    assert pos == [0.0, 2.0, 4.0]
    one = ev.loss_curve(pts.where("step = 0"), 4, 5).first().epoch_pos
    assert one == 0.0
