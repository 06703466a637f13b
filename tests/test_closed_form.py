"""Learners from sufficient statistics against numpy and plain counting."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordmill.operators import closed_form as cf


def test_least_squares_equals_numpy(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(200, 5)), rng.integers(0, 3, 200)
    rows = [(list(map(float, a)), int(b)) for a, b in zip(x, y)]
    odd = [([1.0] * 5, None), ([1.0] * 5, 7), (None, 1), ([], 0)]
    df = spark.createDataFrame(rows + odd, "e array<double>, label int").repartition(3)
    got = cf.least_squares_head(df, "e", "label", 3, ridge=0.5)
    one = np.hstack([np.ones((200, 1)), x])
    want = np.linalg.solve(one.T @ one + 0.5 * np.eye(6), one.T @ np.eye(3)[y])
    assert np.allclose(got, want)
    out = spark.createDataFrame(rows, "e array<double>, label int").select("label", cf.head_scores(got, "e").alias("s"))
    scored = out.select("s", "label", cf.best_class("s").alias("pred"), cf.log_loss("s", "label").alias("loss")).collect()
    scores = one @ want
    assert np.allclose([r.s for r in scored], scores) and [r.pred for r in scored] == scores.argmax(1).tolist()
    assert np.allclose([r.loss for r in scored], [math.log(np.exp(s).sum()) - s[b] for s, b in zip(scores, y)])
    with pytest.raises(ValueError, match="no row"):
        cf.least_squares_head(df.limit(0), "e", "label", 3)


@pytest.mark.parametrize("small", [True, False])
def test_token_bayes_equals_counting(spark, small):
    texts = [("a a b", 0), ("b c", 1), ("a", 0), ("a", 0), ("c c d d", 1), ("", 1), (None, 0), ("q q q", None)]
    train = spark.createDataFrame(texts, "text string, label int").select(F.split("text", " ").alias("tokens"), "label")
    train = train.withColumn("tokens", F.filter("tokens", lambda t: t != "")).repartition(2)
    model = cf.token_bayes(train, "tokens", "label", 2)
    counts = [collections.Counter(w for t, y in texts if y == c for w in (t or "").split()) for c in (0, 1)]
    size = len(set(counts[0]) | set(counts[1]))
    docs = [sum(y == c for _, y in texts) for c in (0, 1)]
    asked = ["a b z", "c d", "", "q"] * 2
    df = spark.createDataFrame(list(enumerate(asked)), "id long, text string").select("id", F.filter(
        F.split("text", " "), lambda t: t != "").alias("tokens"))
    got = {r.id: r.scores for r in cf.bayes_scores(df, ["id"], "tokens", model, small=small).collect()}
    for i, text in enumerate(asked):
        want = [math.log(docs[c] / sum(docs)) + sum(
            math.log((counts[c][w] + 1) / (sum(counts[c].values()) + size)) for w in text.split()
            if w in counts[0] or w in counts[1]) for c in (0, 1)]
        assert np.allclose(got[i], want)
