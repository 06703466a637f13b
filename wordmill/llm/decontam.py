"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Texts are lower-cased and cut into words of letters and digits; a text is its set of ``width``-word
shingles (a shorter text is one shingle). An item is in a document when at least ``threshold`` of the
item's distinct shingles occur in it.

A MinHash sketch of a long document seldom keeps any of the few shingles of a short item. So the
items are put into size partitions by shingle count, and each partition fixes its own bottom-k
MinHash sketch: with at most ``u`` shingles an item may miss ``floor((1 - threshold) * u)`` of them, so
a sketch one longer always has a hit: no pair at or above the threshold is lost. All shingle hashes of a
document are looked up in the sketch index; the few pairs it finds are verified by counting the
item's shingles exactly, on the shingle texts rather than their hashes.

The items are a stated query set, met in blocks of bounded bytes, each one pass over the documents.

Defined results: null and empty texts, and texts without words, match nothing. A null doc_id or
item_id is carried along. Repeated rows repeat. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import cut_lineage, keep_rows, native, row_key, slices, text_bytes, word_hashes, word_spans

#: Bytes that are part of a word: ASCII letters and digits, and all of a non-ASCII character.
_WORD = np.array([chr(b).isalnum() and b < 128 or b >= 128 for b in range(256)], np.int8)
_NOT_WORD = bytes(b if _WORD[b] else 32 for b in range(256))
_BIT = np.uint64(0xFFFFF)


def _words(text: bytes) -> list[bytes]:
    return text.translate(_NOT_WORD).split()


def _norm(text: bytes) -> bytes:
    """Lower case for every script; ``ignore`` can't drop anything of a valid string."""
    return text.lower() if text.isascii() else text.decode("utf-8", "ignore").lower().encode()


def shingle_set(text: bytes, width: int) -> set[bytes]:
    words = _words(_norm(text))
    if not words:
        return set()
    return {b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))}


def _shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` word hashes (of all of them when there are fewer)."""
    n = min(width, len(words))
    out = np.zeros(max(0, len(words) - n + 1) if n else 0, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[k:len(words) - n + k + 1]
        return (out ^ (out >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def hashes_of(text: bytes, width: int) -> np.ndarray:
    data = np.frombuffer(_norm(text), np.uint8)
    return _shingle_hashes(word_hashes(data, *word_spans(data, _WORD)), width)


def sketch_length(size: int, threshold: float) -> int:
    """Bottom-k length of the size partition (powers of two) that ``size`` shingles fall into."""
    upper = 1 << max(0, math.ceil(math.log2(max(size, 1))))
    return min(size, math.floor((1 - threshold) * upper + 1e-9) + 1)


class _Block:
    """A block of items: their shingle sets and the index from sketch hash to items."""

    def __init__(self, items: list[tuple], width: int, threshold: float):
        self.width, self.threshold = width, threshold
        self.items = [(item_id, shingle_set(text, width)) for item_id, text in items]
        index = defaultdict(list)
        for at, (_, text) in enumerate(items):
            mins = np.unique(hashes_of(text, width))  # ascending: the bottom of the hash order comes first
            for h in mins[:sketch_length(len(mins), threshold)].tolist():
                index[h].append(at)
        self.index = dict(index)
        self.sketch = np.array(sorted(index), np.uint64)
        self.low = np.zeros(1 << 20, bool)
        self.low[(self.sketch & _BIT).astype(np.int64)] = True

    def found(self, texts: list[bytes]):
        """(row, item position, shared shingles) of the verified pairs in a slice of documents."""
        norm = [_norm(t) for t in texts]
        data = np.frombuffer(b" ".join(norm), np.uint8)
        starts, ends = word_spans(data, _WORD)
        words = word_hashes(data, starts, ends)
        ends_of = np.cumsum([len(t) + 1 for t in norm])
        first = np.searchsorted(starts, np.r_[0, ends_of[:-1]])
        last = np.r_[first[1:], len(starts)]
        hashes = _shingle_hashes(words, self.width)
        near = np.flatnonzero(self.low[(hashes & _BIT).astype(np.int64)]) if len(words) >= self.width else np.zeros(0, int)
        near = near[np.isin(hashes[near], self.sketch)]
        row = np.searchsorted(first, near, "right") - 1
        inside = near + self.width <= last[row]  # a shingle may not run into the next document
        pairs = {(int(r), at) for r, p in zip(row[inside], near[inside]) for at in self.index[int(hashes[p])]}
        for r in np.flatnonzero((last > first) & (last - first < self.width)).tolist():  # texts of one short shingle
            h = int(_shingle_hashes(words[first[r]:last[r]], self.width)[0])
            pairs.update((r, at) for at in self.index.get(h, ()))
        sets = {}
        for r, at in sorted(pairs):
            if r not in sets:
                sets[r] = shingle_set(texts[r], self.width)
            wanted = self.items[at][1]
            shared = len(wanted & sets[r])
            if shared >= self.threshold * len(wanted) - 1e-9:
                yield r, at, shared


def _blocks(items: DataFrame, limit: int):
    block, held = [], 0
    for row in items.toLocalIterator():
        text = (row["text"] or "").encode()
        if block and held + len(text) > limit:
            yield block
            block, held = [], 0
        block.append((row["item_id"], text))
        held += len(text)
    if block:
        yield block


def contained_items(docs: DataFrame, items: DataFrame, width: int = 5, threshold: float = 0.8,
                    block_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, item_id, n_shingles, n_shared, containment of every item found in a document."""
    return _contained(docs, items, width, threshold, block_bytes).select(
        F.col("_id").alias("doc_id"), "item_id", "n_shingles", "n_shared", "containment")


def _contained(docs: DataFrame, items: DataFrame, width: int, threshold: float, block_bytes: int) -> DataFrame:
    """As ``contained_items``, with the row's key (see ``row_key``)."""
    narrow = native(docs, "doc_id", "text").select(*row_key(docs["doc_id"], docs["text"]), F.col("text").cast("string"))
    items = native(items, "item_id", "text").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    schema = "_id long, _d1 long, _d2 long, item_id long, n_shingles long, n_shared long, containment double"
    sc = docs.sparkSession.sparkContext
    out = None
    for block in itertools.chain(_blocks(items, block_bytes), [None]):
        if block is None and out is not None:
            break
        held = sc.broadcast(block or [])  # without an item, a block of none gives no row

        def run(batches, held=held):
            found = _Block(held.value, width, threshold)
            for batch in batches:
                for part in slices(batch, "text"):
                    keys, rows = list(zip(*(part.column(k).to_pylist() for k in range(3)))), []
                    for r, at, shared in found.found(text_bytes(part, "text")):
                        item_id, wanted = found.items[at]
                        rows.append((*keys[r], item_id, len(wanted), shared, shared / len(wanted)))
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows), [*[pa.int64()] * 6, pa.float64()])],
                            ["_id", "_d1", "_d2", "item_id", "n_shingles", "n_shared", "containment"])
        found = narrow.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns; what shares a doc_id, null or not,
    with a row that holds one stays."""
    hit = _contained(docs, items, width, threshold, 8 << 20).select("_id", "_d1", "_d2").distinct()
    return keep_rows(docs, cut_lineage(hit), "left_anti")
