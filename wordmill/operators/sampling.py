"""Balancing, seeded shuffles, splits, batch arithmetic.

All randomness is the seeded md5 order of ``wordmill.functions.order``; all
positions come from ``indexing`` (no single-partition windows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.operators.indexing import hash_index, hash_index_with_sizes, sorted_index

SPLIT_TOL = 1e-9


def balance(df: DataFrame, label_col: str, id_cols: str | Sequence[str], seed: int = 123,
            classes: Sequence | None = None) -> DataFrame:
    """Undersample every class to the size of the smallest one.

    ``classes`` given: rows with other labels are dropped, and a listed class
    with no rows makes the result empty (its size is 0). Otherwise the classes
    are the non-null labels present. Within a class the kept rows are the
    first ones in seeded hash order; the smallest class is kept whole.
    """
    src = df.where(F.col(label_col).isNotNull())
    if classes is not None:
        src = src.where(F.col(label_col).isin(list(classes)))
    ranked, counts = hash_index_with_sizes(src, id_cols, seed=seed, index_col="_wm_cls_idx",
                                           group_cols=[label_col])
    sizes = counts.withColumnRenamed("_wm_n", "_wm_cls_n")  # one row per class
    if classes is not None:
        wanted = df.sparkSession.createDataFrame(
            [(c,) for c in classes], df.select(label_col).schema)
        sizes = wanted.join(sizes, label_col, "left").fillna(0, ["_wm_cls_n"])
    # One row: the smallest class size (classes are few; the min is a scalar).
    smallest = sizes.agg(F.coalesce(F.min("_wm_cls_n"), F.lit(0)).alias("_wm_min"))
    return (ranked.crossJoin(F.broadcast(smallest))
                  .where(F.col("_wm_cls_idx") < F.col("_wm_min"))
                  .drop("_wm_cls_idx", "_wm_min"))


def shuffle_index(df: DataFrame, id_cols: str | Sequence[str], seed: int = 123,
                  index_col: str = "idx") -> DataFrame:
    """D3: seeded full shuffle renumbered 0..n-1 (``sample(frac=1).reset_index``)."""
    return hash_index(df, id_cols, seed=seed, index_col=index_col)


def random_split(df: DataFrame, id_cols: str | Sequence[str], train_frac: float = 0.7,
                 val_frac: float = 0.1, test_frac: float = 0.2, seed: int = 123,
                 split_col: str = "split", index_col: str = "idx") -> DataFrame:
    """Shuffled 3-way split with bounds ``int(n*tr)`` and ``int(n*(tr+va))``.

    The bounds use binary doubles exactly as Python does (``0.7 + 0.1`` is
    0.7999999999999999, so n=1000 gives 799).
    """
    if abs(train_frac + val_frac + test_frac - 1.0) > SPLIT_TOL:
        raise ValueError("Fractions must sum to 1.0")
    idx = hash_index(df, id_cols, seed=seed, index_col=index_col, total_col="_wm_n")
    n = F.col("_wm_n").cast("double")
    train_end = F.floor(n * F.lit(float(train_frac)))
    val_end = F.floor(n * F.lit(float(train_frac + val_frac)))
    split = (F.when(F.col(index_col) < train_end, "train")
              .when(F.col(index_col) < val_end, "validation")
              .otherwise("test"))
    return idx.withColumn(split_col, split).drop("_wm_n")


def ordered_split(df: DataFrame, order_cols: str | Sequence[str], train_frac: float = 0.85,
                  test_frac: float = 0.1, split_col: str = "split",
                  index_col: str = "idx") -> DataFrame:
    """Split in source order: ``int(.85n)`` train, next ``int(.1n)`` test, rest validation."""
    idx = sorted_index(df, order_cols, index_col=index_col, total_col="_wm_n")
    n = F.col("_wm_n").cast("double")
    train_n = F.floor(n * F.lit(float(train_frac)))
    test_n = F.floor(n * F.lit(float(test_frac)))
    split = (F.when(F.col(index_col) < train_n, "train")
              .when(F.col(index_col) < train_n + test_n, "test")
              .otherwise("validation"))
    return idx.withColumn(split_col, split).drop("_wm_n")


def assign_batches(df: DataFrame, index_col: str, batch_size: int, drop_last: bool = False,
                   batch_col: str = "batch_id", total_col: str | None = None) -> DataFrame:
    """Q5/D7 core: ``batch_id = idx div batch_size``; ``drop_last`` removes a short tail.

    ``total_col`` (rows in the table or group) is needed only for ``drop_last``.
    """
    out = df.withColumn(batch_col, F.floor(F.col(index_col) / F.lit(batch_size)).cast("bigint"))
    if drop_last:
        if total_col is None:
            raise ValueError("drop_last needs the row total")
        full = F.floor(F.col(total_col) / F.lit(batch_size))
        out = out.where(F.col(batch_col) < full)
    return out


def num_batches(n_rows: F.Column, batch_size: int, drop_last: bool) -> F.Column:
    """``floor`` or ``ceil(rows / batch_size)`` by ``drop_last``."""
    if drop_last:
        return F.floor(n_rows / F.lit(batch_size)).cast("bigint")
    return F.ceil(n_rows / F.lit(batch_size)).cast("bigint")


def first_batches(df: DataFrame, batch_col: str, num: int | None) -> DataFrame:
    """Keep the first ``min(num, batches)`` batches (all when ``num`` is None)."""
    if num is None:
        return df
    return df.where(F.col(batch_col) < F.lit(num))


def char_split(df: DataFrame, text_col: str, ratio: float = 0.9,
               head_col: str = "train_text", tail_col: str = "val_text") -> DataFrame:
    """P10: ``text[:int(r*len)]`` and ``text[int(r*len):]`` in code points."""
    k = F.floor(F.length(text_col).cast("double") * F.lit(float(ratio))).cast("int")
    return (df.withColumn(head_col, F.substring(F.col(text_col), F.lit(1), k))
              .withColumn(tail_col, F.substring(F.col(text_col), k + 1, F.length(text_col))))
