"""Language-model scores by cross-entropy difference.

Tokens are the lower-cased (A-Z) runs of letters, digits and non-ASCII characters, and the runs of other
characters that aren't white space; the vocabulary, shared by both models, is the set of tokens that the corpus has
``min_count`` times or more, and one for all others, which is scored without what stands before it. The background model learns from all documents, the target model from the target documents. Background
counts are scaled to the target's number of tokens, so that both models match in size and get the same
smoothing: each order interpolates with the next lower one by a Dirichlet prior of weight ``prior``.
The score of a document is the mean of its per-token loss differences, target minus background, in
nats: the lower, the more like the target. No row is scored by its own text: its counts are taken out of the models that
learned from it, so that rare words of its own speak neither for nor against it.

The models are a table that grows with the corpus, and no part of it meets in one place:

1. A scan task cuts its texts into *blocks* of ``BLOCK_BYTES``. Of each block it sends the distinct n-grams, as sorted
   64-bit hashes with their counts, to *owners*, each a range of the hashes. A frequent n-gram is one
   entry a block, however often it occurs.
2. An owner adds up what its blocks sent, and answers each with the sums of all blocks, in the order of the block's own
   list. There are so many owners that each has ``OWNER_BYTES`` of text to answer for.
3. The documents are read again; a block meets its answers as numbers of its own vocabulary, puts the sums to its
   n-grams and scores its documents. The driver sees five totals.

Defined results: null and empty texts have no token and score 0. Without a target token every score is 0.
Repeated rows count as often as they occur. A null doc_id is never a target. An empty table gives an empty
result. Other columns are not read. Two n-grams are told apart by 63 bits of hash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import (BROADCAST_IDS, _mix, cut_lineage, native, owners_of, slices, text_bytes,
                                 word_hashes)

#: Text bytes of a block (a single longer text is a block of its own).
BLOCK_BYTES = 8 << 20
#: Text bytes of the corpus for each owner.
OWNER_BYTES = 16 << 20

_START, _MULT, _GRAM = np.uint64(0x5851F42D4C957F2D), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_WORD = np.uint64(1)  # the lowest bit of a key: set for single tokens alone

#: What a byte belongs to: 0 white space, 1 a word, 2 anything else.
_KIND = np.full(256, 2, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*b"0123456789", *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1

_LIST = "block string, owner int, n int, data binary"
_LIST_ARROW = pa.schema([("block", pa.string()), ("owner", pa.int32()), ("n", pa.int32()), ("data", pa.binary())])
_BLOCK = _LIST + ", words binary, doc_ids array<long>, flags array<boolean>, sizes array<long>"
_BLOCK_ARROW = pa.schema([*_LIST_ARROW, ("words", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
                          ("flags", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64()))])
_TOTALS = ("n_vocabulary", "n_tokens", "n_target", "n_rare", "n_rare_target")
_SCORES = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, number of tokens of each text)."""
    data = np.frombuffer(b" ".join(texts).lower(), np.uint8)
    kind = _KIND[data]
    edges = np.flatnonzero(np.diff(kind, prepend=0, append=0))
    is_token = kind[edges[:-1]] != 0
    starts, ends = edges[:-1][is_token], edges[1:][is_token]
    after = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return word_hashes(data, starts, ends), np.diff(np.searchsorted(starts, np.r_[0, after]))


def _keys(words: np.ndarray, sizes: np.ndarray, order: int) -> np.ndarray:
    """The keys of each token: the token, then for each order from 2 what stands before it and the n-gram."""
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out, context = [_mix(words) | _WORD], np.full(len(words), _START)
    for k in range(1, order):
        before = np.where(place >= k, np.roll(words, k), _START)
        context = _mix(context * _MULT + before)
        out += [context & ~_WORD, _mix((context + _GRAM) * _MULT + words) & ~_WORD]
    return np.stack(out)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of non-negative integers as compressed byte planes, as many as the largest value needs."""
    widths = [max(1, -(-int(x.max(initial=0)).bit_length() // 8)) for x in columns]
    planes = [x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :w].T.tobytes() for x, w in zip(columns, widths)]
    return bytes(widths) + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int, columns: int) -> list[np.ndarray]:
    """The columns of ``n`` values that ``_pack`` was given."""
    if n == 0:
        return [np.zeros(0, np.uint64)] * columns
    widths, out, at = data[:columns], [], 0
    planes = np.frombuffer(pa.decompress(data[columns:], n * sum(widths), codec="zstd", asbytes=True), np.uint8)
    for w in widths:
        values = np.zeros((n, 8), np.uint8)
        values[:, :w] = planes[at:at + n * w].reshape(w, n).T
        out.append(values.view("<u8").ravel())
        at += n * w
    return out


def _distinct(kinds: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(the distinct keys in ascending order, for each kind where its keys are among them)."""
    found = [np.unique(kind, return_inverse=True) for kind in kinds]
    keys = np.unique(np.concatenate([own for own, _ in found]))
    return keys, [np.searchsorted(keys, own).astype(np.int32)[at] for own, at in found]


def _blocks(batches):
    """(name, rows, token hashes, tokens of each row) of a task's blocks; the name tells blocks of other tokens apart."""
    n_blocks = 0
    for batch in batches:
        for part in slices(batch, "text", BLOCK_BYTES):
            words, sizes = _tokens(text_bytes(part, "text"))
            digest = zlib.crc32(sizes.tobytes(), zlib.crc32(words.tobytes()))
            yield f"{TaskContext.get().partitionId()}-{n_blocks}-{digest:08x}", part, words, sizes
            n_blocks += 1


def _sender(owners: int, order: int):
    def run(batches):
        for block, part, words, sizes in _blocks(batches):
            flags = np.repeat(part.column(2).to_numpy(zero_copy_only=False), sizes)
            keys, at = _distinct(_keys(words, sizes, order))
            count = sum(np.bincount(x, minlength=len(keys)) for x in at)
            target = sum(np.bincount(x[flags], minlength=len(keys)) for x in at)
            owner = (((keys >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)).astype(np.int64)
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            rows = []
            for lo, hi in zip(first, [*first[1:], len(keys)]):
                gaps = np.diff(keys[lo:hi], prepend=keys[lo])
                rows.append({"block": block, "owner": int(owner[lo]), "n": int(hi - lo),
                             "data": keys[lo].tobytes() + _pack(gaps, count[lo:hi], target[lo:hi])})
            yield from pa.Table.from_pylist(rows, _LIST_ARROW).to_batches(256)
    return run


def _texts(batches):
    """The blocks as numbers of their own vocabularies, frequent tokens first."""
    for block, part, words, sizes in _blocks(batches):
        vocabulary, local, count = np.unique(words, return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        yield pa.RecordBatch.from_pylist([{
            "block": block, "n": len(words), "data": _pack(rank[local]), "words": vocabulary[order].tobytes(),
            "doc_ids": part.column(0).to_pylist(), "flags": part.column(2).to_pylist(), "sizes": sizes.tolist()}], _BLOCK_ARROW)


def _answer(lists: pa.Table, min_count: int) -> pa.Table:
    """Each block's list with the sums of all blocks in place of its own."""
    size = lists["n"].to_pylist()
    keys, sums = [], []
    for n, data in zip(size, lists["data"].to_pylist()):
        gaps, *counts = _unpack(data[8:], n, 3)
        keys.append(np.cumsum(gaps, dtype=np.uint64) + np.frombuffer(data[:8], "<u8"))
        sums.append(np.stack(counts))
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    count, target = (np.bincount(at, x, len(distinct)).astype(np.int64) for x in np.concatenate(sums, 1))
    ends = np.cumsum(size, dtype=np.int64)
    answers = [_pack(count[at[hi - n:hi]], target[at[hi - n:hi]]) for n, hi in zip(size, ends)]
    out = lists.set_column(lists.schema.get_field_index("data"), "data", pa.array(answers, pa.binary()))
    is_word = distinct & _WORD != 0
    rare = is_word & (count < min_count)
    for name, total in zip(_TOTALS, ((is_word & ~rare).sum(), *(x[w].sum() for w in (is_word, rare) for x in (count, target)))):
        out = out.append_column(name, pa.array([int(total)] + [0] * (out.num_rows - 1), pa.int64()))
    return out


def _scorer(order: int, prior: float, min_count: int, n_vocabulary: int, n_tokens: int, n_target: int, n_rare: int,
            n_rare_target: int):
    def run(rows: pa.Table) -> pa.Table:
        own = rows.filter(pc.is_valid(rows["words"])).to_pylist()
        if len(own) != 1:
            raise RuntimeError("a block was read more or less than once: the documents differ between two reads")
        sizes, flags = np.array(own[0]["sizes"], np.int64), np.array(own[0]["flags"], bool)
        words = np.frombuffer(own[0]["words"], np.uint64)[_unpack(own[0]["data"], own[0]["n"], 1)[0].astype(np.int64)]
        lists = rows.filter(pc.is_null(rows["words"])).sort_by("owner")
        sums = [_unpack(d, n, 2) for n, d in zip(lists["n"].to_pylist(), lists["data"].to_pylist())]
        keys, at = _distinct(_keys(words, sizes, order))
        if len(keys) != sum(len(x) for x, _ in sums):
            raise RuntimeError("a block has other n-grams than it sent: the documents differ between two reads")
        doc, flag = np.repeat(np.arange(len(sizes)), sizes), np.repeat(flags, sizes)
        mine = []  # how often the token's own row has the key
        for x in at:
            _, pair, times = np.unique(doc * max(1, len(keys)) + x, return_inverse=True, return_counts=True)
            mine.append(times[pair].astype(np.int32))
        all_target = np.repeat(n_target - sizes * flags, sizes)
        all_tokens = np.repeat(n_tokens - sizes, sizes)
        everywhere = np.concatenate([np.zeros(0), *(x[0] for x in sums)])
        rare = everywhere[at[0]] < min_count
        mine[0] = np.where(rare, np.bincount(doc, rare, len(sizes))[doc], mine[0])
        ends, means = np.cumsum(sizes), []
        for which, scale, n_unknown in ((1, 1.0, n_rare_target), (0, all_target / np.maximum(all_tokens, 1), n_rare)):
            sent = np.concatenate([np.zeros(0), *(x[which] for x in sums)]) if which else everywhere
            count = [sent[x] for x in at]
            count[0] = np.where(rare, n_unknown, count[0])
            count = [(x - (m * flag if which else m)) * scale for x, m in zip(count, mine)]
            p = (count[0] + 1) / (all_target * (all_tokens > 0) + n_vocabulary + 1)
            for k in range(1, len(count), 2):
                p = np.where(rare, p, (count[k + 1] + prior * p) / (count[k] + prior))
            total = np.r_[0.0, np.cumsum(-np.log(p))]
            means.append((total[ends] - total[ends - sizes]) / np.maximum(sizes, 1))
        return pa.table([pa.array(own[0]["doc_ids"], pa.int64()), pa.array(sizes), *map(pa.array, means),
                         pa.array(means[0] - means[1])],
                        ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])
    return run


def score(docs: DataFrame, target_ids: DataFrame, prior: float = 1000.0, order: int = 2, min_count: int = 5) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score of every row of ``docs(doc_id, text)``.

    ``order`` is the length of the longest n-grams. ``docs`` must give the same rows in the same order on each read, as
    files, tables and checkpoints do; if it doesn't, the job fails.
    """
    ids = cut_lineage(native(target_ids, "doc_id").select(F.col("doc_id").cast("long").alias("_id"))
                      .where("_id is not null").distinct())
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    ids = ids.withColumn("_hit", F.lit(True))
    rows = native(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    n_bytes = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    owners = max(owners_of(docs.sparkSession), -(-n_bytes // OWNER_BYTES))
    rows = rows.join(F.broadcast(ids) if few else ids, rows["doc_id"] == ids["_id"], "left")
    rows = rows.select("doc_id", "text", F.coalesce("_hit", F.lit(False)).alias("hit"))
    if not few:
        rows = cut_lineage(rows)  # a shuffle may order rows anew when it is repeated
    answers = cut_lineage(rows.mapInArrow(_sender(owners, order), _LIST).groupBy("owner").applyInArrow(
        lambda t: _answer(t, min_count), _LIST + "".join(f", {name} long" for name in _TOTALS)))
    totals = answers.agg(*[F.sum(name).alias(name) for name in _TOTALS]).first()
    score_block = _scorer(order, prior, min_count, *(totals[name] or 0 for name in _TOTALS))
    met = rows.mapInArrow(_texts, _BLOCK).unionByName(answers.drop(*_TOTALS), allowMissingColumns=True)
    return met.groupBy("block").applyInArrow(lambda t: score_block(t), _SCORES)
