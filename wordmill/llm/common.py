"""Helpers shared by the operators: bounded Arrow slices, vectorised words and shingles, id joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.session import cut_lineage, load_table

#: Ids of one join side are broadcast up to this count (16 MB of longs), else both sides are shuffled.
BROADCAST_IDS = 1_000_000
#: Text bytes worked on at once inside a task; a single longer text is a slice of its own.
SLICE_BYTES = 1 << 20

__all__ = ["BROADCAST_IDS", "SLICE_BYTES", "cut_lineage", "free_names", "keep_ids", "keep_rows", "load_table", "lower_az", "native",
           "owners_of", "row_key", "slices", "text_bytes", "word_spans", "word_hashes"]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_az(col: Column) -> Column:
    """``col`` with A-Z lower-cased and every other character as it is; null is empty."""
    return F.translate(F.coalesce(col.cast("string"), F.lit("")), _UPPER, _LOWER)


def native(docs: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns, so that other columns can't clash with an operator's own."""
    return docs.select(*[docs[c] for c in cols])


def free_names(docs: DataFrame, *wanted: str) -> list[str]:
    """Column names like the ``wanted`` ones that ``docs`` doesn't have, in whatever case."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def owners_of(spark: SparkSession) -> int:
    """How many hash ranges an exchange uses: the cluster's own shuffle width."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keep_ids(docs: DataFrame, ids: DataFrame, how: str, limit: int = BROADCAST_IDS) -> DataFrame:
    """``docs`` with (left_semi) or without (left_anti) the rows whose doc_id is in ``ids(doc_id)``.

    A null doc_id is a value like any other. ``ids`` must be materialised: it is counted. Up to
    ``limit`` ids it is broadcast and the texts stay where they are; beyond that both sides are
    shuffled on doc_id.
    """
    few = ids.limit(limit + 1).count() <= limit
    other = ids.select(F.col("doc_id").cast("long").alias("_id"))
    same = docs["doc_id"].cast("long").eqNullSafe(other["_id"])
    return docs.join(F.broadcast(other) if few else other, same, how)


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """_id, _d1, _d2 of a row: its doc_id and 128 bits of its text."""
    text = text.cast("string")
    return [doc_id.cast("long").alias("_id"), F.xxhash64(text).alias("_d1"), F.xxhash64(F.lit(1), text).alias("_d2")]


def keep_rows(docs: DataFrame, rows: DataFrame, how: str, limit: int = BROADCAST_IDS // 2) -> DataFrame:
    """``docs`` with (left_semi) or without (left_anti) the rows of ``rows(_id, _d1, _d2)``, see ``row_key``.

    As ``keep_ids``, but rows that share a doc_id, null or not, are told apart by their texts.
    """
    few = rows.limit(limit + 1).count() <= limit
    other = rows.select("_id", "_d1", "_d2")
    mine = row_key(docs["doc_id"], docs["text"])
    same = mine[0].eqNullSafe(other["_id"]) & (mine[1] == other["_d1"]) & (mine[2] == other["_d2"])
    return docs.join(F.broadcast(other) if few else other, same, how)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have at most ``limit`` bytes together (one row at least)."""
    lens = pc.binary_length(batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()))
    size = np.cumsum(pc.fill_null(lens, 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, before + limit, "right")))
        yield batch.slice(start, end - start)
        start = end


def text_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of a text column, null as empty."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()).to_pylist()
    return [x or b"" for x in values]


def word_spans(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of bytes for which the 256-entry table ``is_word`` is set."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = is_word[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


_MULT = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run: a polynomial in the position inside the word, then mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    with np.errstate(over="ignore"):
        power = np.full(int(lens.max()), _MULT, np.uint64)
        power[0] = 1
        power = np.cumprod(power, dtype=np.uint64)
        first = np.cumsum(lens) - lens
        inside = np.arange(int(lens.sum())) - np.repeat(first, lens)
        bytes_ = data[np.repeat(starts, lens) + inside].astype(np.uint64) + np.uint64(1)
        sums = np.add.reduceat(bytes_ * power[inside], first)
        return _mix(sums + lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
