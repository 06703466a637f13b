"""Target-distribution importance resampling: hashed n-gram weights, Gumbel noise, a distributed radix sort.

1. Every scan task counts its hashed runs of 1 to ``width`` words in one array; arrays are cut into
   (bucket, count) rows and added up. Two tables of ``buckets`` counts, of the documents and of the target,
   give each bucket's gain: the scaled log of their smoothed ratio.
2. A second scan scores each document: the floored mean of its features' gains plus noise drawn from its
   doc_id. The largest scores of noise-shifted log weights are a sample without replacement.
3. Ranks come from a least-significant-digit radix sort of the composite key (falling score, rising doc_id):
   rows stand in chunks of consecutive positions; each pass counts its digit per chunk, prefix sums over
   (digit, chunk) give where every chunk's rows of a digit begin, and a stable counting sort inside the
   chunk gives each row its next position. No chunk holds more than ``chunk`` rows, however alike the keys.

Broadcast: the gains, one integer per bucket, and the digits' totals (2**``digit_bits`` at most).

Defined results: null and empty texts have no feature, weight 0 and, with fewer than ``min_words`` words, no
rank. A null doc_id draws its noise as an empty doc_id and sorts after all others. Repeated rows are drawn
each for itself; rows that agree in score and doc_id come in the order of their features' number. Without a
target every gain follows from the counts of the documents alone. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wordmill.llm.common import cut_lineage, native, slices, text_bytes, word_spans

#: Bytes of the contract's words after A-Z are lower-cased.
IS_WORD = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
#: Longer words are hashed one by one.
LONG_WORD = 64
_POLY = 0xEDB88320
_ROW = "doc_id long, n_words long, n_features long, weight long, score long"


def _crc_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(_POLY), x >> 1).astype(np.uint32)
    return x


_TABLE = _crc_table()


def _extend(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of what each ``state`` (a CRC-32) stands for followed by ``data[start:end]``."""
    out = ~state
    lens = ends - starts
    order = np.argsort(-lens, kind="stable")
    out, at, left = out[order], starts[order], lens[order]
    for j in range(int(min(left[0], LONG_WORD)) if len(left) else 0):
        n = int(np.searchsorted(-left, -j, "left"))  # words longer than j come first
        head = out[:n]
        out[:n] = _TABLE[(head ^ data[at[:n] + j]) & np.uint32(255)] ^ (head >> np.uint32(8))
    crc = np.empty_like(out)
    crc[order] = ~out
    for i in np.flatnonzero(lens > LONG_WORD):
        crc[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes(), int(state[i]))
    return crc


def features(texts: list[bytes], width: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, index of its text, number of words of each text); order does not matter."""
    data = np.frombuffer(b"\0".join(t.lower() for t in texts) + b"\0", np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(size + 1) - size - 1
    starts, ends = word_spans(data, IS_WORD)
    of = np.searchsorted(first, starts, "right") - 1
    state = np.zeros(len(starts), np.uint32)
    found, owners = [], []
    for n in range(width):
        # the run that began n words before word i, or earlier texts' runs cut off
        if n:
            same = np.flatnonzero(of[n:] == of[:-n]) + n if len(of) > n else np.zeros(0, np.int64)
            before = np.zeros(len(starts), np.uint32)
            before[same] = state[same - 1]
            spaced = _TABLE[(~before ^ np.uint32(32)) & np.uint32(255)] ^ (~before >> np.uint32(8))
            state = np.zeros(len(starts), np.uint32)
            state[same] = _extend(~spaced[same], data, starts[same], ends[same])
        else:
            same = np.arange(len(starts))
            state = _extend(state, data, starts, ends)
        found.append((state[same] % np.uint32(buckets)).astype(np.int64))
        owners.append(of[same])
    return np.concatenate(found), np.concatenate(owners), np.bincount(of, minlength=len(texts))


def _counter(width: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                counts += np.bincount(features(text_bytes(part, "text"), width, buckets)[0], minlength=buckets)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, width: int, buckets: int) -> np.ndarray:
    """Features per bucket of all rows of ``texts(text)``."""
    rows = (native(texts, "text").select(F.col("text").cast("string"))
            .mapInArrow(_counter(width, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():  # one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the add-one smoothed target share over the source share) of each bucket."""
    n, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """floor of 1000 standard Gumbel draws' worth of noise that follows from the doc_id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gains: np.ndarray, width: int, seed: int) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row of ``docs(doc_id, text)``."""
    table = docs.sparkSession.sparkContext.broadcast(gains)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch, "text"):
                found, of, words = features(text_bytes(part, "text"), width, len(table.value))
                n = np.bincount(of, minlength=part.num_rows)
                total = np.zeros(part.num_rows, np.int64)
                np.add.at(total, of, table.value[found])
                weight = np.where(n, total // np.maximum(n, 1), 0)
                drawn = np.array([noise(i, seed) for i in part.column(0).to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, (words, n, weight, weight + drawn))],
                                                 ["doc_id", "n_words", "n_features", "weight", "score"])
    rows = native(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, _ROW)


def _digit(column: pa.Array, low: int, bits: int) -> np.ndarray:
    """``bits`` bits from bit ``low`` on of a long column read as unsigned numbers."""
    key = column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return (key >> np.uint64(low) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _digit_counts(low: int, bits: int, chunk: int):
    """Rows per (chunk, digit) of a task's rows (key, pos)."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            at = batch.column(1).to_numpy(zero_copy_only=False) // chunk
            both, n = np.unique(at << bits | _digit(batch.column(0), low, bits), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(both >> bits), pa.array(both & (1 << bits) - 1), pa.array(n)],
                                             ["chunk", "digit", "n"])
    return run


def _counting_sort(key: str, low: int, bits: int):
    """New positions of one chunk's rows: stable by digit, from where the chunk's rows of the digit begin."""
    def run(rows: pa.Table, begins: pa.Table) -> pa.Table:
        rows = rows.take(pa.array(np.argsort(rows["pos"].to_numpy(), kind="stable")))
        digit = _digit(rows[key], low, bits)
        order = np.argsort(digit, kind="stable")
        count = np.bincount(digit, minlength=1 << bits)
        nth = np.arange(len(order)) - np.repeat(np.cumsum(count) - count, count)
        begin = np.zeros(1 << bits, np.int64)
        begin[begins["digit"].to_numpy()] = begins["begin"].to_numpy()
        pos = np.empty(len(order), np.int64)
        pos[order] = begin[digit[order]] + nth
        names = [c for c in rows.column_names if c not in ("pos", "_chunk")]
        return rows.select(names).append_column("pos", pa.array(pos))
    return run


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with a column pos that counts from 0 in any order, fixed by a checkpoint."""
    start = cut_lineage(rows.withColumn("_part", F.spark_partition_id())
                        .withColumn("_row", F.monotonically_increasing_id()))
    sizes = start.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shift = sizes.select("_part", (before - F.col("_first")).alias("_shift"))  # a row per scan task
    return (start.join(F.broadcast(shift), "_part")
            .withColumn("pos", (F.col("_row") + F.col("_shift")).cast("long")).drop("_part", "_row", "_shift"))


def radix_sort(rows: DataFrame, keys: list[tuple[str, int]], digit_bits: int = 11, chunk: int = 1 << 14) -> DataFrame:
    """``rows`` with a column pos: 0, 1, 2 ... in ascending order of the composite key, equal keys in any order.

    ``keys`` names long columns without nulls, the least significant first, each with the number of its
    low bits that matter; those bits are read as an unsigned number.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", pos long"
    state = _numbered(rows)
    for key, all_bits in keys:
        for low in range(0, all_bits, digit_bits):
            bits = min(digit_bits, all_bits - low)
            of_digit = W.partitionBy("digit").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
            seen = cut_lineage(state.select(key, "pos")
                               .mapInArrow(_digit_counts(low, bits, chunk), "chunk long, digit long, n long")
                               .groupBy("chunk", "digit").agg(F.sum("n").alias("n"))
                               .withColumn("inside", F.coalesce(F.sum("n").over(of_digit), F.lit(0))))
            smaller = W.orderBy("digit").rowsBetween(W.unboundedPreceding, -1)  # a row per digit value
            base = (seen.groupBy("digit").agg(F.sum("n").alias("all"))
                    .select("digit", F.coalesce(F.sum("all").over(smaller), F.lit(0)).alias("base")))
            places = (seen.join(F.broadcast(base), "digit")
                      .select("chunk", "digit", (F.col("base") + F.col("inside")).cast("long").alias("begin")))
            chunks = state.withColumn("_chunk", F.floor(F.col("pos") / F.lit(chunk)).cast("long"))
            state = cut_lineage(chunks.groupBy("_chunk").cogroup(places.groupBy("chunk"))
                                .applyInArrow(_counting_sort(key, low, bits), schema))
    return state


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, width: int = 2,
             buckets: int = 10_000, seed: int = 7) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs(doc_id, text)``; rank is null if not drawn.

    Of the N documents with ``min_words`` words, floor(``percent`` * N / 100) are drawn; the likelier a document's
    features are in ``target(text)``, the likelier it is drawn.
    """
    gains = bucket_gains(bucket_counts(docs, width, buckets), bucket_counts(target, width, buckets))
    scored = cut_lineage(weigh(docs, gains, width, seed))
    result = ["doc_id", "n_features", "weight", "score"]
    enough = F.col("n_words") >= min_words
    b = scored.where(enough).agg(
        F.count("*").alias("n"), F.max("score").alias("top"), F.min("score").alias("low"), F.min("doc_id").alias("first"),
        F.max("doc_id").alias("last"), F.count_if(F.isnull("doc_id")).alias("nulls"), F.max("n_features").alias("most")).first()
    rest = scored.where(~enough).select(*result, F.lit(None).cast("long").alias("rank"))
    if not b["n"]:
        return rest
    first, last = b["first"] or 0, b["last"] or 0
    if last - first < 1 << 63:
        by_id, id_bits = F.col("doc_id") - F.lit(first), (last - first).bit_length()
    else:  # with the sign bit turned, longs come in the order of unsigned numbers
        by_id, id_bits = F.col("doc_id").bitwiseXOR(F.lit(-1 << 63)), 64
    keyed = scored.where(enough).select(*result, F.coalesce(by_id, F.lit(0)).alias("_id_key"),
                                        F.isnull("doc_id").cast("long").alias("_id_null"),
                                        (F.lit(b["top"]) - F.col("score")).alias("_fall"))
    keys = [("_id_key", id_bits), ("_id_null", min(b["nulls"], 1)), ("_fall", (b["top"] - b["low"]).bit_length())]
    if not keyed.groupBy("doc_id").count().where("count > 1").isEmpty():
        keys.insert(0, ("n_features", b["most"].bit_length()))
    rank = F.col("pos") + 1
    return (radix_sort(keyed, keys)
            .select(*result, F.when(rank <= percent * b["n"] // 100, rank).alias("rank")).unionByName(rest))
