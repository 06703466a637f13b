"""Dictionary exchange: look up every element of an array column without shuffling texts or elements.

A lookup table of measured size within the broadcast limit goes to every task, which maps whole Arrow batches.
Beyond it, a task cuts its rows into blocks of at most ``BLOCK_VALUES`` elements (a longer array is a block of its
own) and keeps each block as row columns plus indices into the block's distinct elements. Those elements, in the order
of their hash, are asked of *owners*, each a range of the hashes with the table's rows in it: one compressed message for a block
and an owner, and one back. An element is asked once by a block, so no key is hot, and there are so many owners that
each has about ``OWNER_BYTES`` to hold and answer. The block is put together from its stored indices. Rows are told apart by their
place in the block, so ids may repeat, and arrays keep their order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.functions import joins
from wordmill.session import cut_lineage

#: Elements of the arrays of one block, about.
BLOCK_VALUES = 1 << 20
#: Elements whose values a task brings in at once where the table is at hand.
DIRECT_VALUES = 1 << 20
#: Bytes of the table, or of questions and answers, of one owner, about.
OWNER_BYTES = 32 << 20
#: Bytes of rows that are packed together, about.
PACKED_BYTES = 8 << 20
#: Questions that make an owner worth while.
OWNER_KEYS = 1 << 12


def _arrays(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All elements in a row, and the number of each array's (a null array has none)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lens = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten(), lens


def _rebuilt(flat: pa.Array, lens: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lens)].astype(np.int32)), flat)


def _cuts(lens: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Runs of rows with at most ``limit`` elements (one row at least)."""
    upto, out, at = np.cumsum(lens), [], 0
    while at < len(lens):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + limit, "right")))
        out.append((at, end))
        at = end
    return out


def _packed(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def cut_packed(df: DataFrame) -> DataFrame:
    """``df``, materialised like ``cut_lineage`` does, but as compressed blocks of rows, which are unpacked where they are read.

    Long arrays of ids take about half the disk of a checkpoint of their rows.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * PACKED_BYTES // max(1, batch.nbytes))
            for a in range(0, batch.num_rows, step):
                yield pa.RecordBatch.from_arrays([pa.array([_packed(batch.slice(a, step))], pa.binary())], ["rows"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                yield _unpacked(data.as_py())
    return cut_lineage(df.mapInArrow(pack, "rows binary")).mapInArrow(unpack, df.schema)


def _one(values: pa.Array) -> bytes:
    return _packed(pa.RecordBatch.from_arrays([values], ["v"]))


def _joined(column: pa.ChunkedArray) -> pa.Array:
    """The values of packed messages, one after the other."""
    return pa.concat_arrays([_unpacked(m).column(0) for m in column.to_pylist()])


def _hashes(keys: pa.Array) -> np.ndarray:
    """32 bits for each key, the same in every process."""
    if pa.types.is_integer(keys.type):
        values = keys.cast(pa.int64()).to_numpy(zero_copy_only=False)
    else:
        values = keys.cast(pa.string()).to_numpy(zero_copy_only=False)
    return pd.util.hash_array(values, categorize=False) >> np.uint64(32)


def _owners(hashes: np.ndarray, n: int) -> np.ndarray:
    return (hashes * np.uint64(n) >> np.uint64(32)).astype(np.int32)


def lookup_arrays(df: DataFrame, keep: Sequence[str], array_col: str, dim: DataFrame, key: str, value: str, out_col: str,
                  small: bool | None = None, missing: str | None = None,
                  combine: Callable[[pa.Array, pa.Array, np.ndarray], pa.Array] | None = None,
                  out_type: str | None = None, block_values: int | None = None) -> DataFrame:
    """<keep..., out_col>: each element of ``array_col`` replaced by ``dim.value`` of ``dim.key``, null where it has none.

    ``dim`` must be unique on ``key``. A null
    array gives an empty one. ``combine`` makes a row's result, of ``out_type``, from (values of the distinct
    elements, indices into them of all elements in a row, elements of each array) in place of the array. With ``missing`` an element without a value raises that message. ``small`` is the answer of ``joins.fits_broadcast`` when the caller has it,
    ``block_values`` the most elements of a block in place of ``BLOCK_VALUES``.
    """
    src = df.select(*keep, F.col(array_col).alias("_wm_array"))
    kinds = {f.name: f.dataType.simpleString() for f in dim.schema}
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[:-1])
    schema = f"{kept}`{out_col}` {out_type or f'array<{kinds[value]}>'}"
    join = combine or (lambda values, at, lens: _rebuilt(values.take(at), lens))

    def check(asked: pa.Array, found: pa.Array) -> None:
        if missing is not None and found.null_count:
            raise ValueError(f"{missing}{asked.filter(found.is_null())[0].as_py()}")

    if small if small is not None else joins.fits_broadcast(dim, joins.BROADCAST_MAX_BYTES):
        table = dim.select(key, value).toArrow().combine_chunks()
        held = df.sparkSession.sparkContext.broadcast((table[key].combine_chunks(), table[value].combine_chunks()))

        def direct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, values = held.value
            for batch in batches:
                for a, b in _cuts(_arrays(batch.column(batch.num_columns - 1))[1], DIRECT_VALUES):
                    rows = batch.slice(a, b - a)
                    flat, lens = _arrays(rows.column(rows.num_columns - 1))
                    coded = flat.dictionary_encode()
                    found = values.take(pc.index_in(coded.dictionary, value_set=keys, skip_nulls=True))
                    check(coded.dictionary, found)
                    out = join(found, coded.indices, lens)
                    yield pa.RecordBatch.from_arrays([*rows.columns[:-1], out], [*rows.schema.names[:-1], out_col])
        return src.mapInArrow(direct, schema)

    limit = block_values or BLOCK_VALUES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            lens = _arrays(batch.column(batch.num_columns - 1))[1]
            for a, b in _cuts(lens, limit):
                rows = batch.slice(a, b - a)
                flat, own = _arrays(rows.column(rows.num_columns - 1))
                coded = flat.dictionary_encode()
                order = np.argsort(_hashes(coded.dictionary), kind="stable")
                place = np.empty(len(order), np.int32)
                place[order] = np.arange(len(order), dtype=np.int32)
                keys = coded.dictionary.take(pa.array(order))
                stored = pa.RecordBatch.from_arrays([*rows.columns[:-1], _rebuilt(pa.array(place).take(coded.indices), own)],
                                                    rows.schema.names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | n]), pa.array([_packed(stored)], pa.binary()), pa.array([_one(keys)], pa.binary()),
                     pa.array([len(keys)]), pa.array([keys.nbytes])], ["block", "rows", "keys", "n_keys", "key_bytes"])
                n += 1

    blocks = cut_lineage(src.mapInArrow(cut, "block long, rows binary, keys binary, n_keys long, key_bytes long"))
    asked = blocks.agg(F.coalesce(F.sum("n_keys"), F.lit(0)).alias("n"), F.coalesce(F.sum("key_bytes"), F.lit(0)).alias("b")).first()
    dim_rows, dim_bytes = joins.measured(dim.select(key, value))
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(dim_bytes, asked["b"] + asked["n"] * (dim_bytes // max(1, dim_rows)))
    owners = max(1, min(4 * width, asked["n"] // OWNER_KEYS), most // OWNER_BYTES)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys = _unpacked(data.as_py()).column(0)
                ends = np.searchsorted(_owners(_hashes(keys), owners), np.arange(owners + 1))
                has = np.flatnonzero(np.diff(ends)) if len(keys) else np.zeros(1, np.int64)  # without an element, nothing of the first
                yield pa.RecordBatch.from_arrays(
                    [pa.array(has.astype(np.int32)), pa.array([block] * len(has), pa.int64()), pa.array(np.diff(ends)[has].astype(np.int32)),
                     pa.array([_one(keys.slice(ends[o], ends[o + 1] - ends[o])) for o in has], pa.binary())],
                    ["owner", "block", "n", "data"])

    def owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_owners(_hashes(batch.column(0)), owners)), *batch.columns], ["owner", "key", "value"])

    def answer(questions: pa.Table, table: pa.Table) -> pa.Table:
        known, values, out, upto = table["key"].combine_chunks(), table["value"].combine_chunks(), [], 0
        if questions.num_rows:
            keys = _joined(questions["data"])
            at = pc.index_in(keys.cast(known.type), value_set=known)
            for n in questions["n"].to_pylist():
                found = values.take(at.slice(upto, n))
                check(keys.slice(upto, n), found)
                out.append(_one(found))
                upto += n
        return pa.table([questions["block"], questions["owner"], pa.array(out, pa.binary())], ["block", "owner", "data"])

    def put_together(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        values = _joined(answers.sort_by("owner")["data"])
        rows = _unpacked(blocks["rows"][0].as_py())
        flat, lens = _arrays(rows.column(rows.num_columns - 1))
        out = join(values, flat, lens)
        return pa.table([*rows.columns[:-1], out], [*rows.schema.names[:-1], out_col])

    questions = blocks.select("block", "keys").mapInArrow(ask, "owner int, block long, n int, data binary")
    table = dim.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(value).alias("value")).mapInArrow(
        owned, f"owner int, key {kinds[key]}, value {kinds[value]}")
    answers = questions.groupBy("owner").cogroup(table.groupBy("owner")).applyInArrow(answer, "block long, owner int, data binary")
    return (blocks.select("block", "rows").groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(put_together, schema))
