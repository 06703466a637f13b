"""Q5, Q7-Q9: batch assignment, multi-epoch schedules, exposure ledgers, eval points.

A schedule row says which example is visited at which (epoch, step). The
per-epoch reshuffle is a hash order seeded with ``seed:epoch``, so it is the
same for any partitioning. Ledgers are per-step aggregates with running
totals from ``functions.prefix`` (no single-task window over the steps).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.functions.prefix import running_sums
from wordmill.operators.indexing import hash_index, sorted_index


def _ids(id_cols: str | Sequence[str]) -> list[str]:
    return [id_cols] if isinstance(id_cols, str) else list(id_cols)


def make_batches(df: DataFrame, id_cols: str | Sequence[str], batch_size: int,
                 shuffle: bool = False, drop_last: bool = False, seed: int = 123,
                 batch_col: str = "batch_id", index_col: str = "idx") -> DataFrame:
    """Q5: consecutive groups of ``batch_size`` in id order (or seeded shuffled order)."""
    ids = _ids(id_cols)
    if shuffle:
        x = hash_index(df, ids, seed=seed, index_col=index_col, total_col="_wm_n")
    else:
        x = sorted_index(df, ids, index_col=index_col, total_col="_wm_n")
    x = x.withColumn(batch_col, F.floor(F.col(index_col) / F.lit(batch_size)).cast("bigint"))
    if drop_last:
        x = x.where(F.col(batch_col) < F.floor(F.col("_wm_n") / F.lit(batch_size)))
    return x.drop("_wm_n")


def epoch_schedule(df: DataFrame, id_cols: str | Sequence[str], num_epochs: int,
                   batch_size: int, seed: int = 123, drop_last: bool = True,
                   shuffle: bool = True) -> DataFrame:
    """Q7: every epoch visits each kept batch once, reshuffled per epoch.

    Adds ``epoch``, ``batch_id``, ``step = epoch * batches_per_epoch + batch_id``.
    """
    ids = _ids(id_cols)
    spark = df.sparkSession
    epochs = spark.range(num_epochs).select(F.col("id").cast("int").alias("epoch"))
    x = df.crossJoin(F.broadcast(epochs))  # num_epochs rows: bounded by the parameter
    if shuffle:
        x = hash_index(x, ["epoch", *ids], seed=seed, index_col="_wm_i",
                       group_cols=["epoch"], total_col="_wm_n")
    else:
        base = sorted_index(df, ids, index_col="_wm_i", total_col="_wm_n")
        x = base.crossJoin(F.broadcast(epochs))
    b = F.lit(batch_size)
    per_epoch = F.floor(F.col("_wm_n") / b) if drop_last else F.ceil(F.col("_wm_n") / b)
    x = (x.withColumn("batch_id", F.floor(F.col("_wm_i") / b).cast("bigint"))
          .withColumn("batches_per_epoch", per_epoch.cast("bigint")))
    x = x.where(F.col("batch_id") < F.col("batches_per_epoch"))
    return (x.withColumn("step", F.col("epoch") * F.col("batches_per_epoch") + F.col("batch_id"))
             .drop("_wm_i", "_wm_n"))


def exposure_ledger(schedule: DataFrame, tokens_col: str | None = None) -> DataFrame:
    """Q8: per step rows and tokens, with running ``examples_seen`` / ``tokens_seen``.

    ``tokens_col`` is the per-row token count (rows x columns of the batch).
    """
    aggs = [F.count(F.lit(1)).alias("examples")]
    if tokens_col:
        aggs.append(F.sum(tokens_col).cast("bigint").alias("tokens"))
    steps = schedule.groupBy("epoch", "step").agg(*aggs)
    vals = ["examples"] + (["tokens"] if tokens_col else [])
    outs = ["examples_seen"] + (["tokens_seen"] if tokens_col else [])
    return running_sums(steps, "step", vals, outs)


def eval_points(ledger: DataFrame, eval_freq: int) -> DataFrame:
    """Q9: steps with ``step % eval_freq == 0`` (step 0 included)."""
    return ledger.where(F.pmod(F.col("step"), F.lit(eval_freq)) == 0)
