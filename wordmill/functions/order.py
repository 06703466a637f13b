"""Deterministic, partitioning-independent order and randomness.

A seeded shuffle is an order by ``md5('<seed>:<id>')`` with the id as the tie
breaker. Unlike ``rand(seed)`` it gives the same order whatever the
partitioning, the number of executors or the retry history, and DuckDB
computes the same key (``md5(concat(seed, ':', id))``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2^32 written out: in Spark SQL `2^32` is XOR, not a power.
TWO_POW_32 = 4294967296.0


def _as_cols(cols: str | Column | Sequence[str | Column]) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def hash_key(seed: int | str | Column, *parts: str | Column) -> Column:
    """``md5('<seed>:<part1>:<part2>...')`` as a 32-char lowercase hex string."""
    pieces: list[Column] = [seed if isinstance(seed, Column) else F.lit(str(seed))]
    for p in _as_cols(list(parts)):
        pieces += [F.lit(":"), p.cast("string")]
    return F.md5(F.concat(*pieces))


def hash_uniform(seed: int | str | Column, *parts: str | Column) -> Column:
    """A uniform double in [0, 1) from the first 32 bits of ``hash_key``."""
    top = F.conv(F.substring(hash_key(seed, *parts), 1, 8), 16, 10).cast("bigint")
    return top.cast("double") / F.lit(TWO_POW_32)
