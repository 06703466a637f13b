"""Q1-Q6, Q10, Q11: windows, shifted targets, padding, batch collation.

Sequences are ARRAY<BIGINT> per row; every operator is a native array
expression (``slice``, ``array_repeat``, ``transform``), so it stays inside
whole-stage codegen. The pad id is a parameter, an int or a column: with word
ids it must lie outside the vocabulary (the vocabulary size, say). Group-level values (batch max length, train-split max
length) come from small aggregates joined back, never from a global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAD_ID = 50256
IGNORE_INDEX = -100


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sliding_windows(df: DataFrame, ids_col: str, max_length: int, stride: int,
                    start_col: str = "start", input_col: str = "input_ids",
                    target_col: str = "target_ids") -> DataFrame:
    """Q1+Q2: windows at ``i in range(0, L - max_length, stride)``; target shifted by one.

    A row with ``L <= max_length`` yields no window; short tails are dropped.
    """
    n = F.size(ids_col)
    starts = F.sequence(F.lit(0), n - F.lit(max_length) - 1, F.lit(stride))
    w = df.where(n > F.lit(max_length)).withColumn(start_col, F.explode(starts))
    return (w.withColumn(input_col, F.slice(ids_col, F.col(start_col) + 1, F.lit(max_length)))
             .withColumn(target_col, F.slice(ids_col, F.col(start_col) + 2, F.lit(max_length))))


def next_token_long(df: DataFrame, id_cols: str | Sequence[str], pos_col: str = "pos",
                    token_col: str = "token_id", next_col: str = "next_id") -> DataFrame:
    """Q2 (long form): the following token of the same row (NULL at the end)."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    w = Window.partitionBy(*ids).orderBy(pos_col)
    return df.withColumn(next_col, F.lead(token_col).over(w))


def next_tokens(df: DataFrame, id_cols: str | Sequence[str], ids_col: str = "ids", pos_col: str = "pos",
                token_col: str = "token_id", next_col: str = "next_id") -> DataFrame:
    """Q2: <id..., pos, token, next token> of id arrays by an array shift (NULL at the end); nothing is shuffled."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    shifted = F.concat(F.slice(ids_col, F.lit(2), F.size(ids_col)), F.array(F.lit(None).cast("bigint")))
    pairs = F.zip_with(ids_col, F.slice(shifted, F.lit(1), F.size(ids_col)), lambda t, n: F.struct(t.alias("t"), n.alias("n")))
    return df.select(*ids, F.posexplode(pairs).alias(pos_col, "_wm_t")).select(
        *ids, pos_col, F.col("_wm_t.t").alias(token_col), F.col("_wm_t.n").alias(next_col))


def _pad(pad_id: Column | int) -> Column:
    return (F.lit(pad_id) if isinstance(pad_id, int) else pad_id).cast("bigint")


def pad_truncate(ids: Column | str, max_length: Column | int, pad_id: Column | int = PAD_ID) -> Column:
    """Q3: cut to ``max_length`` then right-pad with ``pad_id`` to exactly that length."""
    m = F.lit(max_length) if isinstance(max_length, int) else max_length
    cut = F.slice(_c(ids), F.lit(1), m)
    return F.concat(cut, F.array_repeat(_pad(pad_id), F.greatest(m - F.size(cut), F.lit(0))))


def pad_to_longest(df: DataFrame, ids_col: str, max_length: int | None = None,
                   pad_id: Column | int = PAD_ID, out_col: str = "padded",
                   length_col: str = "max_length") -> DataFrame:
    """Q3 over a table: ``max_length`` None means the table's longest row (nothing cut)."""
    if max_length is not None:
        return (df.withColumn(length_col, F.lit(max_length))
                  .withColumn(out_col, pad_truncate(ids_col, max_length, pad_id)))
    longest = df.agg(F.coalesce(F.max(F.size(ids_col)), F.lit(0)).alias(length_col))
    out = df.crossJoin(F.broadcast(longest))  # one row
    return out.withColumn(out_col, pad_truncate(ids_col, F.col(length_col), pad_id))


def pad_to_split_longest(df: DataFrame, ids_col: str, split_col: str = "split",
                         reference_split: str = "train", pad_id: Column | int = PAD_ID,
                         out_col: str = "padded", length_col: str = "max_length") -> DataFrame:
    """Q4: every split is cut/padded to the longest row of ``reference_split``."""
    longest = (df.where(F.col(split_col) == reference_split)
                 .agg(F.coalesce(F.max(F.size(ids_col)), F.lit(0)).alias(length_col)))
    out = df.crossJoin(F.broadcast(longest))  # one row
    return out.withColumn(out_col, pad_truncate(ids_col, F.col(length_col), pad_id))


def collate(df: DataFrame, ids_col: str, batch_col: str = "batch_id", pad_id: Column | int = PAD_ID,
            ignore_index: int = IGNORE_INDEX, allowed_max_length: int | None = None,
            input_col: str = "input_ids", target_col: str = "target_ids") -> DataFrame:
    """Q6: instruction-tuning collation per batch.

    Batch length ``m = max(len + 1)``; each row gets one pad appended and is
    padded to ``m``; inputs are ``p[:-1]``, targets ``p[1:]``; in the target
    the first pad is kept and every later pad becomes ``ignore_index``; then
    both are cut to ``allowed_max_length``. A real ``pad_id`` inside the row
    takes the "first pad" slot, as in the reference.
    """
    m = F.max(F.size(ids_col) + 1).over(Window.partitionBy(batch_col))  # batch = bounded group
    with_m = df.withColumn("_wm_m", m)
    padded = F.concat(F.col(ids_col), F.array_repeat(_pad(pad_id), F.col("_wm_m") - F.size(ids_col)))
    out = (with_m.withColumn("_wm_p", padded)
                 .withColumn(input_col, F.slice("_wm_p", F.lit(1), F.col("_wm_m") - 1))
                 .withColumn("_wm_t", F.slice("_wm_p", F.lit(2), F.col("_wm_m") - 1))
                 .withColumn("_wm_first", F.array_position(F.col("_wm_t"), _pad(pad_id))))
    masked = F.transform("_wm_t", lambda x, i: F.when(
        (x == _pad(pad_id)) & (F.col("_wm_first") > 0) & (i + 1 > F.col("_wm_first")),
        F.lit(ignore_index).cast("bigint")).otherwise(x))
    out = out.withColumn(target_col, masked)
    if allowed_max_length is not None:
        out = (out.withColumn(input_col, F.slice(input_col, F.lit(1), F.lit(allowed_max_length)))
                  .withColumn(target_col, F.slice(target_col, F.lit(1), F.lit(allowed_max_length))))
    return out.drop("_wm_m", "_wm_p", "_wm_t", "_wm_first")


def last_n(ids: Column | str, n: int) -> Column:
    """Q10: keep only the last ``n`` ids."""
    a = _c(ids)
    return F.slice(a, F.greatest(F.size(a) - F.lit(n) + 1, F.lit(1)), F.lit(n))


def classifier_input(ids: Column | str, max_length: Column | int | None,
                     context_length: int | None = None, pad_id: Column | int = PAD_ID) -> Column:
    """Q11: cut to ``min(max_length, context_length)`` then pad to ``max_length``.

    ``max_length`` None: no cap and no pad (only the context cut, if any).
    """
    a = _c(ids)
    if max_length is None:
        return a if context_length is None else F.slice(a, F.lit(1), F.lit(context_length))
    m = F.lit(max_length) if isinstance(max_length, int) else max_length
    cap = m if context_length is None else F.least(m, F.lit(context_length))
    cut = F.slice(a, F.lit(1), cap)
    return F.concat(cut, F.array_repeat(_pad(pad_id), F.greatest(m - F.size(cut), F.lit(0))))
