"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Each scan task (a *sender*) fingerprints its texts, sorts the distinct 64-bit fingerprints and
   sends every *owner* (a range of the fingerprint space) the gaps, Golomb-Rice coded. A group of
   copies is one fingerprint per sender, however many rows it has.
2. An owner decodes its lists, finds fingerprints that two senders share and answers each sender
   with a bitmap over the sender's own list.
3. Rows whose bit is set, or whose fingerprint repeats inside the sender, are *suspects*. Only their
   texts are shuffled; grouping by the text itself compares bytes, after partial aggregation.

Defined results: a null text is an empty text. Of equal texts the row with the largest doc_id stays;
of repeated rows of that doc_id one stays. A null doc_id is smaller than any other. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import BROADCAST_IDS, cut_lineage, free_names, keep_ids, lower_az, native, owners_of, text_bytes

_SENT = ("sender int, owner int, n int, shift int, first long, quotients binary, remainders binary,"
         " doc_ids array<long>, digests binary, counts array<int>")
_SENT_ARROW = pa.schema([("sender", pa.int32()), ("owner", pa.int32()), ("n", pa.int32()), ("shift", pa.int32()),
                         ("first", pa.int64()), ("quotients", pa.binary()), ("remainders", pa.binary()),
                         ("doc_ids", pa.list_(pa.int64())), ("digests", pa.binary()),
                         ("counts", pa.list_(pa.int32()))])


def golomb_encode(sorted_values: np.ndarray) -> tuple[int, int, bytes, bytes]:
    """(shift, first value, unary quotients, ``shift``-bit remainders) of ascending distinct uint64 values."""
    if len(sorted_values) == 0:
        return 0, 0, b"", b""
    gaps = np.diff(sorted_values)
    mean = float(gaps.mean()) if len(gaps) else 1.0
    shift = max(0, int(np.floor(np.log2(max(mean * 0.6931, 1.0)))))
    quotients = (gaps >> np.uint64(shift)).astype(np.int64)
    ends = np.cumsum(quotients + 1)
    unary = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    unary[ends - 1] = 1
    bits = (gaps[:, None] >> np.arange(shift, dtype=np.uint64)) & np.uint64(1)
    return (shift, int(sorted_values[:1].view(np.int64)[0]), np.packbits(unary).tobytes(),
            np.packbits(bits.astype(np.uint8).ravel()).tobytes())


def golomb_decode(n: int, shift: int, first: int, unary: bytes, remainders: bytes) -> np.ndarray:
    """The values that ``golomb_encode`` was given."""
    if n == 0:
        return np.zeros(0, np.uint64)
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n - 1]
    quotients = (np.diff(ones, prepend=-1) - 1).astype(np.uint64)
    bits = np.unpackbits(np.frombuffer(remainders, np.uint8))[:(n - 1) * shift].reshape(n - 1, shift)
    low = (bits.astype(np.uint64) << np.arange(shift, dtype=np.uint64)).sum(1, dtype=np.uint64)
    start = np.array([first], np.int64).view(np.uint64)
    return np.cumsum(np.concatenate([start, (quotients << np.uint64(shift)) + low]), dtype=np.uint64)


def _owner(prints: np.ndarray, owners: int) -> np.ndarray:
    return ((prints >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)


def _sender(owners: int):
    def run(batches):
        prints, ids, digests = [], [], []
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for doc_id, text in zip(doc_ids, text_bytes(batch, "text"), strict=True):
                norm = text.lower()
                prints.append(xxhash.xxh64_intdigest(norm))
                digests.append(hashlib.sha256(norm).digest())
                ids.append(doc_id)
        if not prints:
            return
        all_prints = np.array(prints, np.uint64)
        order = np.argsort(all_prints, kind="stable")
        distinct, at, counts = np.unique(all_prints[order], return_index=True, return_counts=True)
        owner = _owner(distinct, owners)
        for o in np.unique(owner):
            lo, hi = np.searchsorted(owner, [o, o + np.uint64(1)])
            shift, first, unary, rest = golomb_encode(distinct[lo:hi])
            mine = order[at[lo]:at[hi - 1] + counts[hi - 1]]
            yield pa.RecordBatch.from_pylist([{
                "sender": TaskContext.get().partitionId(), "owner": int(o), "n": int(hi - lo), "shift": shift,
                "first": first, "quotients": unary, "remainders": rest, "doc_ids": [ids[i] for i in mine],
                "digests": b"".join(digests[i] for i in mine), "counts": counts[lo:hi].tolist()}], _SENT_ARROW)
    return run


def _answer(lists: pd.DataFrame) -> pd.DataFrame:
    decoded = [golomb_decode(r.n, r.shift, r.first, r.quotients, r.remainders) for r in lists.itertuples()]
    values, counts = np.unique(np.concatenate(decoded), return_counts=True)
    shared = values[counts > 1]
    return pd.DataFrame({"sender": lists["sender"], "owner": lists["owner"],
                         "bitmap": [np.packbits(np.isin(d, shared)).tobytes() for d in decoded]})


def _marked(batches):
    for batch in batches:
        rows = batch.to_pylist()
        ids, digests, suspect = [], [], []
        for r in rows:
            bits = np.unpackbits(np.frombuffer(r["bitmap"], np.uint8))[:r["n"]].astype(bool)
            counts = np.array(r["counts"])
            suspect.extend(np.repeat(bits | (counts > 1), counts).tolist())
            ids.extend(r["doc_ids"])
            digests.extend(r["digests"][i:i + 32] for i in range(0, len(r["digests"]), 32))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.binary()),
                                          pa.array(suspect, pa.bool_())], ["doc_id", "digest", "suspect"])


def marks(docs: DataFrame, owners: int | None = None) -> DataFrame:
    """One narrow row per document: doc_id, SHA-256 digest of the normalised text, suspect."""
    narrow = native(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sent = cut_lineage(narrow.mapInArrow(_sender(owners or owners_of(docs.sparkSession)), _SENT))
    answers = (sent.select("sender", "owner", "n", "shift", "first", "quotients", "remainders")
               .groupBy("owner").applyInPandas(_answer, "sender int, owner int, bitmap binary"))
    return cut_lineage(sent.select("sender", "owner", "n", "doc_ids", "digests", "counts")
                       .join(answers, ["sender", "owner"]).mapInArrow(_marked, "doc_id long, digest binary, suspect boolean"))


def exact_duplicates(docs: DataFrame, owners: int | None = None, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs(doc_id, text)``."""
    marked = marks(docs, owners)
    suspects = cut_lineage(marked.where("suspect").select("doc_id").distinct())
    texts = keep_ids(native(docs, "doc_id", "text"), suspects, "left_semi", broadcast_ids)
    classes = (texts.select(F.col("doc_id").cast("long"), lower_az(F.col("text")).alias("norm"))
               .groupBy("norm").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
               .select(F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("digest"), "keep_id", "group_size"))
    alone = marked.where("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "digest")
    # repeated rows of one doc_id are alike in all that is returned: counted, then numbered
    rows = (marked.where("suspect").groupBy("doc_id", "digest").count()
            .select("doc_id", "digest", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"))).alias("nth")))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)
    grouped = rows.join(classes, "digest").select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest")
    return alone.unionByName(grouped).select("doc_id", "keep_id", "group_size", "kept",
                                             F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    result = cut_lineage(exact_duplicates(docs).select("doc_id", "kept", "text_sha256"))
    rest = keep_ids(docs, cut_lineage(result.where("not kept").select("doc_id").distinct()), "left_anti")
    # a doc_id with rows of both kinds is told apart by its texts
    mixed = cut_lineage(result.groupBy("doc_id").agg(F.max("kept").alias("some"), F.min("kept").alias("all"))
                        .where("some and not all").select("doc_id"))
    if mixed.isEmpty():
        return rest
    name, other_id, other_digest = free_names(docs, "_digest", "_id", "_sha")
    both = keep_ids(docs, mixed, "left_semi")
    both = both.select("*", F.sha2(lower_az(both["text"]).cast("binary"), 256).alias(name))
    stay = result.where("kept").select(F.col("doc_id").alias(other_id), F.col("text_sha256").alias(other_digest))
    both = (both.join(stay, F.col("doc_id").eqNullSafe(F.col(other_id)) & (F.col(name) == F.col(other_digest)), "left_semi")
            .dropDuplicates(["doc_id", name]).drop(name))
    return rest.unionByName(both)
