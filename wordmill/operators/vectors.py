"""V1-V2: row-wise vector standardisation and pooled token embeddings.

V1 is pure array higher-order functions. V2 pre-aggregates token occurrences
to (row, token, count), joins the embedding table once per distinct pair, and
pools with Spark ML's weighted ``Summarizer.mean`` - JVM-side, without
exploding every vector into one row per dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.functions.exchange import lookup_arrays
from wordmill.functions.joins import salted_lookup

LN_EPS = 1e-5
#: Token vectors added up at once.
POOL_TOKENS = 1 << 14
#: Ids of a block; a vector goes to a block once, so larger blocks send fewer.
POOL_BLOCK_VALUES = 1 << 21


def layer_norm(df: DataFrame, arr_col: str, out_col: str = "normed", eps: float = LN_EPS,
               scale: float = 1.0, shift: float = 0.0) -> DataFrame:
    """V1: ``(x - mean) / sqrt(var_pop + eps) * scale + shift`` within each array.

    Mean and population variance come from one Welford pass (``aggregate``
    with a struct accumulator). The resulting struct column is referenced
    twice by the element-wise ``transform``, so Catalyst keeps it as its own
    projection instead of re-inlining the pass into every element.
    """
    d = F.col(arr_col).cast("array<double>")
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def step(acc, v):
        n1 = acc["n"] + 1.0
        delta = v - acc["mean"]
        mean1 = acc["mean"] + delta / n1
        return F.struct(n1.alias("n"), mean1.alias("mean"),
                        (acc["m2"] + delta * (v - mean1)).alias("m2"))

    def finish(acc):
        return F.struct(acc["mean"].alias("mu"),
                        F.sqrt(acc["m2"] / acc["n"] + F.lit(eps)).alias("sd"))

    x = df.withColumn("_wm_s", F.aggregate(d, zero, step, finish))
    normed = F.transform(d, lambda v: (v - F.col("_wm_s.mu")) / F.col("_wm_s.sd") * F.lit(scale)
                         + F.lit(shift))
    return x.withColumn(out_col, normed).drop("_wm_s")


def _mean_vectors(values: pa.Array, at: pa.Array, lens: np.ndarray) -> pa.Array:
    """Mean of each row's vectors, elements without one left out; null where none is left."""
    known = values.is_valid().to_numpy(zero_copy_only=False)
    at = at.fill_null(-1).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lens)), lens)
    has = np.zeros(len(at), bool)
    has[at >= 0] = known[at[at >= 0]]
    at, row = (np.cumsum(known) - 1)[at[has]], row[has]
    count = np.bincount(row, minlength=len(lens))
    if not len(at):
        return pa.array([None] * len(lens), pa.list_(pa.float64()))
    matrix = values.drop_null().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(int(known.sum()), -1)
    sums = np.zeros((len(lens), matrix.shape[1]))
    for k in range(0, len(at), POOL_TOKENS):  # rows come in order
        own, first = np.unique(row[k:k + POOL_TOKENS], return_index=True)
        sums[own] += np.add.reduceat(matrix[at[k:k + POOL_TOKENS]], first, 0)
    return pa.array([(s / n).tolist() if n else None for s, n in zip(sums, count.tolist())], pa.list_(pa.float64()))


def pool_arrays(df: DataFrame, id_cols: str | Sequence[str], ids_col: str, table: DataFrame, key_col: str = "vec_id",
                vec_col: str = "embedding", out_col: str = "pooled", small: bool | None = None) -> DataFrame:
    """V2: <id..., pooled>: mean embedding of each row's ids, ids without a vector left out (NULL if all are).

    A sparse-dense product by blocks of rows: beyond the broadcast limit a vector goes to a block once, however
    often the block's rows use it, and rows stay where they are (``functions.exchange``).
    """
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    vec = F.col(vec_col)
    if table.schema[vec_col].dataType.simpleString() != "array<float>":  # floats travel as they are, and are added up as doubles
        vec = vec.cast("array<double>")
    vectors = table.select(F.col(key_col).alias("_wm_key"), vec.alias("_wm_vec"))
    return lookup_arrays(df, ids, ids_col, vectors, "_wm_key", "_wm_vec", out_col, small=small, combine=_mean_vectors,
                         out_type="array<double>", block_values=POOL_BLOCK_VALUES)


def pooled_embeddings(token_ids: DataFrame, table: DataFrame, row_col: str = "doc_id",
                      token_col: str = "token_id", key_col: str = "vec_id",
                      vec_col: str = "embedding", out_col: str = "pooled",
                      rows: DataFrame | None = None) -> DataFrame:
    """V2: mean embedding of each row's tokens (tokens without a vector are skipped).

    ``rows`` holds every row id; a row without any embedded token gets a NULL vector.
    """
    counts = token_ids.groupBy(row_col, token_col).agg(F.count(F.lit(1)).cast("double").alias("_wm_w"))
    # only a token of the table can be joined; how many rows have it tells the hot ones
    freq = (counts.join(table.select(F.col(key_col).alias(token_col)), token_col, "left_semi")
            .groupBy(token_col).agg(F.count(F.lit(1)).alias("_wm_rows")))
    vecs = table.select(F.col(key_col).alias(token_col), F.col(vec_col).alias("_wm_a")).join(freq, token_col)
    joined = salted_lookup(counts, vecs, token_col, salt_cols=[row_col], freq_col="_wm_rows", how="inner")
    pooled = joined.groupBy(row_col).agg(
        Summarizer.mean(array_to_vector("_wm_a"), F.col("_wm_w")).alias("_wm_m"))
    pooled = pooled.select(row_col, vector_to_array("_wm_m").alias(out_col))
    return pooled if rows is None else rows.select(row_col).join(pooled, row_col, "left")
