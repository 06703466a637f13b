"""Loader loss (mean of batch means), accuracy, per-split report, loss curve.

Inputs are per-example tables that already carry a ``batch_id`` (from
``ledger.make_batches``): losses ``<..., batch_id, loss>`` and predictions
``<..., batch_id, pred, target>``. Results are tiny per-split aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _g(group_cols: str | Sequence[str] | None) -> list[str]:
    if group_cols is None:
        return []
    return [group_cols] if isinstance(group_cols, str) else list(group_cols)


def loader_loss(losses: DataFrame, num_batches: int | None = None,
                group_cols: str | Sequence[str] | None = None, batch_col: str = "batch_id",
                loss_col: str = "loss", out_col: str = "loss") -> DataFrame:
    """M7: mean over the first ``min(num_batches, batches)`` batches of each batch's mean.

    A group with no batches does not appear; ``report`` turns that into NaN.
    """
    g = _g(group_cols)
    x = losses if num_batches is None else losses.where(F.col(batch_col) < num_batches)
    per_batch = x.groupBy(*g, batch_col).agg(F.avg(loss_col).alias("_wm_b"))
    if not g:
        return per_batch.agg(F.coalesce(F.avg("_wm_b"), F.lit(float("nan"))).alias(out_col))
    return per_batch.groupBy(*g).agg(F.avg("_wm_b").alias(out_col))


def accuracy(preds: DataFrame, num_batches: int | None = None,
             group_cols: str | Sequence[str] | None = None, batch_col: str = "batch_id",
             pred_col: str = "pred", target_col: str = "target",
             out_col: str = "accuracy") -> DataFrame:
    """M8: correct / total over the first ``num_batches`` batches (0 when no rows)."""
    g = _g(group_cols)
    x = preds if num_batches is None else preds.where(F.col(batch_col) < num_batches)
    acc = F.try_divide(F.count_if(F.col(pred_col) == F.col(target_col)), F.count(F.lit(1)))
    if not g:
        return x.agg(F.coalesce(acc, F.lit(0.0)).alias(out_col))
    return x.groupBy(*g).agg(F.coalesce(acc, F.lit(0.0)).alias(out_col))


def split_report(rows: DataFrame, num_batches: int | None = None, split_col: str = "split",
                 batch_col: str = "batch_id", loss_col: str = "loss", pred_col: str = "pred",
                 target_col: str = "target") -> DataFrame:
    """M7 + M8 (+M9) in one pass: <split, loss_first, loss_all, loss_rows, acc_first, acc_all>.

    loss_rows is the global mean, over rows rather than batches.
    One aggregate per batch, one per split: the first ``num_batches`` batches and all of them are
    conditional sums over the same rows.
    """
    per_batch = rows.groupBy(split_col, batch_col).agg(
        F.avg(loss_col).alias("_wm_l"), F.sum(loss_col).alias("_wm_s"), F.count(loss_col).alias("_wm_r"),
        F.count(F.lit(1)).alias("_wm_n"), F.count_if(F.col(pred_col) == F.col(target_col)).alias("_wm_c"))
    early = F.lit(True) if num_batches is None else F.col(batch_col) < num_batches
    return per_batch.groupBy(split_col).agg(
        F.avg(F.when(early, F.col("_wm_l"))).alias("loss_first"), F.avg("_wm_l").alias("loss_all"),
        F.try_divide(F.sum("_wm_s"), F.sum("_wm_r")).alias("loss_rows"),
        F.coalesce(F.try_divide(F.sum(F.when(early, F.col("_wm_c"))), F.sum(F.when(early, F.col("_wm_n")))),
                   F.lit(0.0)).alias("acc_first"),
        F.try_divide(F.sum("_wm_c"), F.sum("_wm_n")).alias("acc_all"))


def report(losses: DataFrame, preds: DataFrame, splits: Sequence[str], split_col: str = "split",
           num_batches: int | None = None, batch_col: str = "batch_id") -> DataFrame:
    """M9: one row per split with loader loss and accuracy (NaN / 0 for empty splits)."""
    spark = losses.sparkSession
    names = spark.createDataFrame([(s,) for s in splits], f"{split_col} string")
    loss = loader_loss(losses, num_batches, split_col, batch_col)
    acc = accuracy(preds, num_batches, split_col, batch_col)
    return (names.join(loss, split_col, "left").join(acc, split_col, "left")
                 .select(split_col, F.coalesce("loss", F.lit(float("nan"))).alias("loss"),
                         F.coalesce("accuracy", F.lit(0.0)).alias("accuracy")))


def loss_curve(points: DataFrame, num_epochs: int, eval_freq: int,
               step_col: str = "step", out_col: str = "epoch_pos") -> DataFrame:
    """Epoch position evenly spaced 0..num_epochs over the ordered eval points.

    Eval points are steps ``0, f, 2f, ...`` so the i-th one is ``step div f``;
    with n points the position is ``i * num_epochs / (n - 1)`` (0 when n = 1).
    """
    n = points.agg(F.count(F.lit(1)).alias("_wm_n"))  # one row
    i = F.floor(F.col(step_col) / F.lit(eval_freq))
    pos = F.when(F.col("_wm_n") <= 1, F.lit(0.0)).otherwise(
        i * F.lit(float(num_epochs)) / (F.col("_wm_n") - 1))
    return points.crossJoin(F.broadcast(n)).withColumn(out_col, pos).drop("_wm_n")
