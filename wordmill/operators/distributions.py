"""M1-M6: class-distribution maths over long-form logits <row_id, class_id, logit>.

Per-row statistics use windows partitioned by the row id, so one row's
classes (bounded by the class count) are the largest group that meets in a
task. Sampling uses the hash uniform of ``functions.order``: reproducible and
partition-independent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordmill.functions.order import hash_uniform

NEG_INF = float("-inf")


def _ids(id_cols: str | Sequence[str]) -> list[str]:
    return [id_cols] if isinstance(id_cols, str) else list(id_cols)


def argmax(df: DataFrame, row_cols: str | Sequence[str] = "row_id", class_col: str = "class_id",
           logit_col: str = "logit", out_col: str = "pred") -> DataFrame:
    """M1: best class per row; ties go to the lowest class id."""
    best = F.max_by(F.col(class_col), F.struct(F.col(logit_col), -F.col(class_col)))
    return df.groupBy(*_ids(row_cols)).agg(best.alias(out_col))


def softmax(df: DataFrame, row_cols: str | Sequence[str] = "row_id", logit_col: str = "logit",
            out_col: str = "prob") -> DataFrame:
    """M2: ``exp(x - max) / sum(exp(x - max))`` per row (-inf logits give 0)."""
    w = Window.partitionBy(*_ids(row_cols))
    e = F.exp(F.col(logit_col) - F.max(logit_col).over(w))
    return df.withColumn("_wm_e", e).withColumn(
        out_col, F.col("_wm_e") / F.sum("_wm_e").over(w)).drop("_wm_e")


def top_k(df: DataFrame, k: int, row_cols: str | Sequence[str] = "row_id",
          logit_col: str = "logit", mode: str = "mask") -> DataFrame:
    """M3: logits below the k-th largest are dropped; ties with it are kept.

    ``mode='mask'`` sets them to -inf (the reference's behaviour), 'drop'
    removes the rows.
    """
    w = Window.partitionBy(*_ids(row_cols)).orderBy(F.col(logit_col).desc())
    ranked = df.withColumn("_wm_rank", F.rank().over(w))
    if mode == "drop":
        return ranked.where(F.col("_wm_rank") <= k).drop("_wm_rank")
    return ranked.withColumn(logit_col, F.when(F.col("_wm_rank") <= k, F.col(logit_col))
                             .otherwise(F.lit(NEG_INF))).drop("_wm_rank")


def with_temperature(df: DataFrame, temperature: float, logit_col: str = "logit") -> DataFrame:
    """M4: divide logits by ``temperature`` (> 0); 0 leaves them (argmax path)."""
    if temperature and temperature > 0:
        return df.withColumn(logit_col, F.col(logit_col) / F.lit(float(temperature)))
    return df


def sample(df: DataFrame, seed: int, step: int | str = 0, row_cols: str | Sequence[str] = "row_id",
           class_col: str = "class_id", logit_col: str = "logit", top_k_: int | None = None,
           temperature: float = 1.0, out_col: str = "sampled") -> DataFrame:
    """M5 (+M3, M4): draw one class per row by inverse CDF over class order.

    ``u = hash_uniform(seed, row, step)``; the first class whose running
    probability reaches ``u`` wins, else the last class (the running sum can
    end just below 1). ``temperature`` 0 is argmax.
    """
    rows = _ids(row_cols)
    x = df if top_k_ is None else top_k(df, top_k_, rows, logit_col, mode="drop")
    if not temperature or temperature <= 0:
        return argmax(x, rows, class_col, logit_col, out_col)
    x = softmax(with_temperature(x, temperature, logit_col), rows, logit_col, "_wm_p")
    w = Window.partitionBy(*rows).orderBy(class_col).rowsBetween(Window.unboundedPreceding, 0)
    step_col = F.col(step) if isinstance(step, str) and step in df.columns else F.lit(step)
    x = (x.withColumn("_wm_cum", F.sum("_wm_p").over(w))
          .withColumn("_wm_u", hash_uniform(seed, *rows, step_col)))
    hit = F.when(F.col("_wm_cum") >= F.col("_wm_u"), F.col(class_col))
    return x.groupBy(*rows).agg(F.coalesce(F.min(hit), F.max(class_col)).alias(out_col))


def row_scores(df: DataFrame, row_cols: str | Sequence[str] = "row_id", class_col: str = "class_id",
               logit_col: str = "logit", target_col: str = "target", ignore_index: int = -100) -> DataFrame:
    """M1 + M6 in one aggregate: <row..., target, pred, loss>; the loss of an ignored target is NULL."""
    rows = _ids(row_cols)
    x = df.withColumn("_wm_m", F.max(logit_col).over(Window.partitionBy(*rows)))
    agg = x.groupBy(*rows, target_col).agg(
        F.max_by(F.col(class_col), F.struct(F.col(logit_col), -F.col(class_col))).alias("pred"),
        F.max("_wm_m").alias("_wm_m"), F.sum(F.exp(F.col(logit_col) - F.col("_wm_m"))).alias("_wm_s"),
        F.max(F.when(F.col(class_col) == F.col(target_col), F.col(logit_col))).alias("_wm_t"))
    loss = F.log("_wm_s") + F.col("_wm_m") - F.col("_wm_t")
    return agg.select(*rows, target_col, "pred",
                      F.when(F.col(target_col) != F.lit(ignore_index), loss).alias("loss"))


def cross_entropy(df: DataFrame, row_cols: str | Sequence[str] = "row_id",
                  class_col: str = "class_id", logit_col: str = "logit",
                  target_col: str = "target", ignore_index: int = -100,
                  out_col: str = "loss") -> DataFrame:
    """M6: per-row ``logsumexp(x) - x[target]``; rows whose target is ``ignore_index``
    are dropped (excluded from sums and counts)."""
    rows = _ids(row_cols)
    x = df.where(F.col(target_col) != F.lit(ignore_index))
    x = x.withColumn("_wm_m", F.max(logit_col).over(Window.partitionBy(*rows)))
    # grouping on (rows, target) reuses the window's partitioning: no extra shuffle
    agg = x.groupBy(*rows, target_col).agg(
        F.max("_wm_m").alias("_wm_m"),
        F.sum(F.exp(F.col(logit_col) - F.col("_wm_m"))).alias("_wm_s"),
        F.max(F.when(F.col(class_col) == F.col(target_col), F.col(logit_col))).alias("_wm_t"))
    loss = F.log("_wm_s") + F.col("_wm_m") - F.col("_wm_t")
    return agg.select(*rows, target_col, loss.alias(out_col))
