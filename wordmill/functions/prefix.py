"""Running totals over an integer order column without a single-task window.

Rows are cut into ranges of ``width`` consecutive order values. Inside a range
a partitioned window gives the running sum; the per-range totals (one row per
range) are prefix-summed and added as offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_sums(df: DataFrame, order_col: str, value_cols: Sequence[str],
                 out_cols: Sequence[str] | None = None, width: int = 65536) -> DataFrame:
    """Add ``out_cols[i] = sum(value_cols[i]) over rows with order <= this row's``."""
    outs = list(out_cols or [f"cum_{v}" for v in value_cols])
    b = "_wm_range"
    x = df.withColumn(b, F.floor(F.col(order_col) / F.lit(width)))
    inside = Window.partitionBy(b).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    for v, o in zip(value_cols, outs):
        x = x.withColumn(o, F.sum(v).over(inside))
    totals = x.groupBy(b).agg(*[F.sum(v).alias(f"_wm_t{i}") for i, v in enumerate(value_cols)])
    before = Window.orderBy(b).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    for i in range(len(value_cols)):
        totals = totals.withColumn(f"_wm_o{i}", F.coalesce(F.sum(f"_wm_t{i}").over(before), F.lit(0)))
    offs = totals.select(b, *[f"_wm_o{i}" for i in range(len(value_cols))])
    x = x.join(offs, b)
    for i, o in enumerate(outs):
        x = x.withColumn(o, F.col(o) + F.col(f"_wm_o{i}"))
    return x.drop(b, *[f"_wm_o{i}" for i in range(len(value_cols))])
