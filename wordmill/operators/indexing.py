"""Global 0-based row index without a single-partition window.

``row_number().over(Window.orderBy(k))`` pulls every row into one task. Two
partition-parallel replacements:

* ``hash_index`` - order by a seeded md5 key. The first ``digits`` hex chars of
  the key are an order-preserving, uniform bucket (16**digits of them, from the shuffle width). Rows
  are ranked inside (group, bucket); the per-bucket sizes form a small table
  whose running totals are the offsets. Shuffle once on (group, bucket); the
  offsets table holds at most ``groups * 16**digits`` rows.
* ``sorted_index`` - order by arbitrary columns (tokens, ids). Range-partition
  and sort like ``orderBy``, materialise to the reliable checkpoint folder so
  that partition contents are fixed, then add per-partition offsets to the
  position inside the partition.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.functions.order import hash_key
from wordmill.session import cut_lineage

_B, _K, _RN, _N, _OFF = "_wm_bucket", "_wm_key", "_wm_rn", "_wm_n", "_wm_off"


def _cols(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def hash_order_key(seed: int | str, id_cols: str | Sequence[str]) -> Column:
    return hash_key(seed, *_cols(id_cols))


def bucket_digits(df: DataFrame) -> int:
    """Hex digits that make at least four buckets for each shuffle partition (3 at least)."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(3, math.ceil(math.log(4 * width, 16)))


def hash_index_with_sizes(df: DataFrame, id_cols: str | Sequence[str], seed: int | str = 123,
                          index_col: str = "idx", group_cols: str | Sequence[str] | None = None,
                          total_col: str | None = None, digits: int | None = None):
    """``hash_index`` plus the per-group row counts ``<group..., _wm_n>``.

    The counts come from the same small per-bucket aggregate as the offsets,
    so a caller that needs group sizes does not read the indexed rows again.
    """
    ids, groups = _cols(id_cols), _cols(group_cols)
    digits = digits or bucket_digits(df)
    keyed = (df.withColumn(_K, hash_order_key(seed, ids))
               .withColumn(_B, F.substring(F.col(_K), 1, digits)))
    w = Window.partitionBy(*groups, _B).orderBy(_K, *ids)
    ranked = keyed.withColumn(_RN, F.row_number().over(w) - 1)
    # Sizes per (group, bucket): a partial count over the id columns only.
    sizes = keyed.groupBy(*groups, _B).agg(F.count(F.lit(1)).alias(_N))
    before = Window.partitionBy(*groups).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn(_OFF, F.coalesce(F.sum(_N).over(before), F.lit(0)))
    keep = [*groups, _B, _OFF]
    if total_col:
        offsets = offsets.withColumn(total_col, F.sum(_N).over(Window.partitionBy(*groups)))
        keep.append(total_col)
    offsets = offsets.select(*keep)
    if not groups:
        # At most 16**digits rows: a proven bound, so broadcast is safe.
        offsets = F.broadcast(offsets)
    out = ranked.join(offsets, [*groups, _B])
    out = out.withColumn(index_col, (F.col(_OFF) + F.col(_RN)).cast("bigint")).drop(
        _K, _B, _RN, _OFF)
    group_sizes = (sizes.groupBy(*groups).agg(F.sum(_N).alias(_N)) if groups
                   else sizes.agg(F.sum(_N).alias(_N)))
    return out, group_sizes


def hash_index(df: DataFrame, id_cols: str | Sequence[str], seed: int | str = 123,
               index_col: str = "idx", group_cols: str | Sequence[str] | None = None,
               total_col: str | None = None, digits: int | None = None) -> DataFrame:
    """Index rows 0..n-1 (per group) in seeded hash order ``md5(seed:id)``, id."""
    return hash_index_with_sizes(df, id_cols, seed, index_col, group_cols, total_col, digits)[0]


def sorted_index(df: DataFrame, order_cols: str | Sequence[str], index_col: str = "idx",
                 total_col: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Index rows 0..n-1 in the ascending order of ``order_cols`` (ties must not occur
    across distinct rows that matter; give a unique key)."""
    order = _cols(order_cols)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    fixed = cut_lineage(ranged)
    pid, mid = "_wm_pid", "_wm_mid"
    pos = fixed.withColumn(pid, F.spark_partition_id()).withColumn(
        mid, F.monotonically_increasing_id())
    # monotonically_increasing_id = (partition id << 33) + position in partition
    pos = pos.withColumn(_RN, F.col(mid) - F.shiftleft(F.col(pid).cast("bigint"), 33))
    sizes = pos.groupBy(pid).agg(F.count(F.lit(1)).alias(_N))
    before = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn(_OFF, F.coalesce(F.sum(_N).over(before), F.lit(0)))
    keep = [pid, _OFF]
    if total_col:
        offsets = offsets.withColumn(total_col, F.sum(_N).over(Window.partitionBy()))
        keep.append(total_col)
    # One row per partition: bounded by the partition count.
    out = pos.join(F.broadcast(offsets.select(*keep)), pid)
    return out.withColumn(index_col, (F.col(_OFF) + F.col(_RN)).cast("bigint")).drop(
        pid, mid, _RN, _OFF)
