"""Skew-safe lookup join of a large fact stream to a keyed dimension.

Token streams are Zipfian: a handful of keys ("the", ".", ",") can hold a
large share of all rows, and a plain shuffle join sends each key to one task.
Keys whose frequency reaches ``hot_fraction`` of the total are *hot*. There
are at most ``1 / hot_fraction`` of them, so that set has a proven size bound
and is broadcast to flag fact rows. A hot key is spread over as many salts as
its share of the total asks for (its rows over the rows of an even shuffle partition);
its dimension row is replicated once per salt. The join then runs on (key, salt),
so no task holds much more than an even share, while cold keys keep salt 0.

A dimension of at most ``BROADCAST_MAX_BYTES`` (its rows are counted and measured,
which is cheap on a materialised model table) is broadcast instead: a broadcast
hash join has no skew problem and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SALT, _HOT = "_wm_salt", "_wm_hot"

#: A hash relation takes a few times the bytes of its rows; this stays well inside an executor.
BROADCAST_MAX_BYTES = 64 << 20
ROW_OVERHEAD = 32


def hot_keys(dim: DataFrame, key: str, freq_col: str, hot_fraction: float = 1e-4) -> DataFrame:
    """Keys with ``freq >= hot_fraction * sum(freq)``; at most ``1/hot_fraction`` rows."""
    return _hot(dim, key, freq_col, hot_fraction).select(key)


def _hot(dim: DataFrame, key: str, freq_col: str, hot_fraction: float) -> DataFrame:
    """The hot keys with ``_wm_hot``, their share of all occurrences."""
    total = dim.agg(F.sum(freq_col).alias("_wm_total"))
    share = F.col(freq_col).cast("double") / F.col("_wm_total")
    return (dim.select(key, freq_col).crossJoin(F.broadcast(total))
               .select(key, share.alias(_HOT)).where(F.col(_HOT) >= F.lit(hot_fraction)))


def _width(col: Column, kind: T.DataType) -> Column:
    """Bytes of a value, about."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)):
            each = F.transform(col, lambda x: _width(x, kind.elementType) + F.lit(8))
            return F.coalesce(F.aggregate(each, F.lit(0), lambda a, x: (a + x).cast("int")), F.lit(0))
        return F.greatest(F.size(col), F.lit(0)) * F.lit(8)
    if isinstance(kind, T.StructType):
        return sum((_width(col[f.name], f.dataType) for f in kind.fields), F.lit(0))
    return F.lit(8)


def fits_broadcast(dim: DataFrame, max_bytes: int | None) -> bool:
    """True when the rows of ``dim`` have at most ``max_bytes`` (counted and measured in place)."""
    if not max_bytes:
        return False
    return measured(dim)[1] <= max_bytes


def measured(dim: DataFrame) -> tuple[int, int]:
    """Rows of ``dim`` and their bytes, about."""
    row = sum((_width(F.col(f.name), f.dataType) for f in dim.schema.fields), F.lit(ROW_OVERHEAD))
    found = dim.agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("bigint")).alias("b")).first()
    return found["n"], found["b"] or 0


def salted_lookup(facts: DataFrame, dim: DataFrame, key: str, salt_cols: Sequence[str],
                  freq_col: str | None = None, hot_fraction: float | None = None, salts: int | None = None,
                  how: str = "left", broadcast_max_bytes: int | None = -1,
                  small: bool | None = None) -> DataFrame:
    """``facts JOIN dim USING (key)`` with hot keys split over several tasks.

    ``dim`` must be unique on ``key``. ``small`` is the answer of ``fits_broadcast`` when the
    caller has it already; ``broadcast_max_bytes`` -1 is the module's limit, None never
    broadcasts. ``hot_fraction`` and ``salts`` follow the shuffle width unless given. Without
    ``freq_col`` it is a plain join (AQE may still broadcast it after measuring the real size).
    """
    limit = BROADCAST_MAX_BYTES if broadcast_max_bytes == -1 else broadcast_max_bytes
    if small if small is not None else fits_broadcast(dim, limit):
        return facts.join(F.broadcast(dim), key, how)
    if freq_col is None or salts == 1:
        return facts.join(dim, key, how)
    width = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = _hot(dim, key, freq_col, hot_fraction or min(1e-2, 1.0 / (4 * width)))
    n_salts = F.lit(salts) if salts else F.ceil(F.col(_HOT) * F.lit(4 * width))
    hot = hot.select(key, F.greatest(n_salts, F.lit(2)).cast("int").alias(_HOT))
    flagged = facts.join(F.broadcast(hot), key, "left")
    salt = F.when(F.col(_HOT).isNotNull(), F.pmod(F.xxhash64(*salt_cols), F.col(_HOT))).otherwise(F.lit(0))
    facts_s = flagged.withColumn(_SALT, salt.cast("int")).drop(_HOT)
    dim_f = dim.join(F.broadcast(hot), key, "left")
    fan = F.when(F.col(_HOT).isNotNull(), F.sequence(F.lit(0), F.col(_HOT) - 1)).otherwise(F.array(F.lit(0)))
    dim_s = dim_f.withColumn(_SALT, F.explode(fan)).drop(_HOT)
    return facts_s.join(dim_s, [key, _SALT], how).drop(_SALT)
