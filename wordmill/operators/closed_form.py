"""L2-L4 by sufficient statistics: learners whose result follows from sums over the rows.

* Linear head on frozen features: ridge least squares on class indicators. Every task adds up its part of the
  Gram matrix and of the class sums in one pass; their size follows the feature dimension alone, and the
  driver solves the system.
* Text classifier: multinomial Bayes. Occurrences per (token, class) are counted before the shuffle, the token
  weights stay a table, and texts are scored by dictionary exchange, without shuffling them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.functions.exchange import lookup_arrays
from wordmill.session import cut_lineage

#: Features of one class of head: the sums have (features + 1) * (features + 1 + classes) numbers.
MAX_FEATURES = 4096


def least_squares_head(train: DataFrame, features_col: str, label_col: str, n_classes: int, ridge: float = 1.0) -> np.ndarray:
    """L3: weights [1 + features, class], the first row the intercepts, for labels 0 .. n_classes - 1.

    Rows with a null or another label, or without features, teach nothing. All arrays must have one length.
    """
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column(0).to_pylist(), np.float64)
                if x.shape[1] > MAX_FEATURES:
                    raise ValueError(f"more than {MAX_FEATURES} features")
                x = np.hstack([np.ones((len(x), 1)), x])
                y = np.eye(n_classes)[batch.column(1).to_numpy(zero_copy_only=False)]
                own = x.T @ np.hstack([x, y])
                total = own if total is None else total + own
        if total is not None:
            for i, row in enumerate(total):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), i)), pa.array(np.arange(len(row))), pa.array(row)],
                                                 ["i", "j", "v"])
    label = F.col(label_col).cast("int")
    rows = train.where(label.between(0, n_classes - 1) & (F.size(features_col) > 0)).select(
        F.col(features_col).cast("array<double>"), label.alias("label"))
    sums = rows.mapInArrow(add_up, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    if not len(sums):
        raise ValueError("no row to learn from")
    size = int(sums["i"].max()) + 1
    total = np.zeros((size, size + n_classes))
    total[sums["i"], sums["j"]] = sums["v"]
    return np.linalg.solve(total[:, :size] + ridge * np.eye(size), total[:, size:])


def head_scores(weights: np.ndarray, features_col: str) -> Column:
    """The class scores of a feature array, as an array."""
    def score(w):
        products = F.zip_with(F.col(features_col).cast("array<double>"), F.lit(w[1:].tolist()), lambda x, y: x * y)
        return F.aggregate(products, F.lit(float(w[0])), lambda a, x: a + x)
    return F.array(*[score(weights[:, c]) for c in range(weights.shape[1])])


def token_bayes(train: DataFrame, tokens_col: str, label_col: str, n_classes: int,
                alpha: float = 1.0) -> tuple[DataFrame, list[float]]:
    """L2: (<token, n, logs>, log priors): log-likelihood of each token of the training texts under each class.

    Add-``alpha`` smoothing over the training vocabulary. A class without a row has prior -inf.
    """
    label = F.col(label_col).cast("int")
    rows = train.where(label.between(0, n_classes - 1)).select(label.alias("label"), F.col(tokens_col).alias("tokens"))
    per_class = [F.count_if(F.col("label") == c).alias(f"n{c}") for c in range(n_classes)]
    table = cut_lineage(rows.select("label", F.explode("tokens").alias("token")).groupBy("token").agg(*per_class))
    names = [f"n{c}" for c in range(n_classes)]
    sums = table.agg(F.count("*").alias("size"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
    docs = rows.agg(*per_class).first()
    every = sum(docs[n] for n in names)
    priors = [float(np.log(docs[n] / every)) if docs[n] else float("-inf") for n in names]
    logs = [F.log((F.col(n) + alpha) / F.lit(sums[n] + alpha * sums["size"])) for n in names]
    return table.select("token", sum(F.col(n) for n in names).alias("n"), F.array(*logs).alias("logs")), priors


def bayes_scores(df: DataFrame, keep: Sequence[str], tokens_col: str, model: tuple[DataFrame, list[float]],
                 out_col: str = "scores", small: bool | None = None) -> DataFrame:
    """L4 core: <keep..., scores>: log prior plus the tokens' log-likelihoods of each class; unknown tokens add nothing."""
    table, priors = model
    found = lookup_arrays(df, keep, tokens_col, table, "token", "logs", "_wm_logs", small)
    known = F.filter("_wm_logs", lambda x: x.isNotNull())
    zero = F.lit(priors).cast("array<double>")
    total = F.aggregate(known, zero, lambda a, x: F.zip_with(a, x, lambda p, q: p + q))
    return found.select(*keep, total.alias(out_col))


def best_class(scores: str) -> Column:
    """The class of the highest score, the first of equal ones."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def log_loss(scores: str, label_col: str) -> Column:
    """-log of the label's share in softmax(scores)."""
    top = F.array_max(scores)
    total = F.aggregate(F.col(scores), F.lit(0.0), lambda a, x: a + F.exp(x - top))
    return F.log(total) + top - F.element_at(scores, F.col(label_col).cast("int") + 1)


def quality(df: DataFrame, group_cols: Sequence[str], scores: str, label_col: str) -> DataFrame:
    """Rows, mean log loss and accuracy."""
    return df.groupBy(*group_cols).agg(
        F.count("*").alias("n_rows"), F.round(F.avg(log_loss(scores, label_col)), 6).alias("loss"),
        F.round(F.avg((best_class(scores) == F.col(label_col)).cast("double")), 6).alias("accuracy"))
