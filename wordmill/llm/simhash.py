"""SimHash near-duplicates: bit-sliced distances inside exact-match buckets, then components.

Fingerprints link at ``radius`` or fewer differing bits. The 64 bits are cut into ``radius + 2``
segments; two linked fingerprints agree on at least two of them, so every pair of segments makes a
bucket key and no link is lost. A bucket with more than ``block`` distinct fingerprints is cut into
pieces that meet pairwise, so that no task holds more than two pieces of one bucket. Inside a task
the fingerprints are stored vertically (one long bit vector per bit plane); all distances at one
offset are counted at once by carry-save adders, and an offset is abandoned once every lane exceeds
the radius. A task returns a spanning forest of its links, never all pairs; alternating stars join
the forests into components.

Defined results: a null text is empty; a text without words has fingerprint zero. Exact copies share
one fingerprint. Rows whose doc_ids are all null have a null component_id. Repeated rows repeat.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import cut_lineage, free_names, keep_rows, native, owners_of, row_key, text_bytes

BLOCK = 4096


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the ``width``-word shingles of a text, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b - 1], seed) for a, b in zip(starts, ends[width - 1:])] or [digest(joined, seed)]
    n, ones = len(hashes), np.zeros(64, np.int64)
    values = np.array(hashes, "<u8").view(np.uint8).reshape(n, 8)
    for at in range(0, n, 255):  # a byte holds the counts of 255 shingles
        bits = np.unpackbits(values[at:at + 255], axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""
    return _keyed(docs, width, seed).select(F.col("_id").alias("doc_id"), "fp")


def _keyed(docs: DataFrame, width: int, seed: int) -> DataFrame:
    """fp and the key of every row (see ``row_key``)."""
    def run(batches):
        for batch in batches:
            prints = [_signed(fingerprint(t, width, seed)) for t in text_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(prints, pa.int64())], ["_id", "_d1", "_d2", "fp"])
    narrow = native(docs, "doc_id", "text").select(*row_key(docs["doc_id"], docs["text"]), F.col("text").cast("string"))
    return narrow.mapInArrow(run, "_id long, _d1 long, _d2 long, fp long")


class _Forest:
    """Union-find; the smallest member stands for its set."""

    def __init__(self):
        self.up = {}

    def root(self, x):
        while (p := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(p, p)
            x = p
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def sliced_links(values: np.ndarray, bucket: np.ndarray, radius: int):
    """Index pairs (i, j) in one bucket whose values differ in at most ``radius`` bits.

    ``values`` (uint64) are ordered by ``bucket``. Lane i of offset s compares value i with value
    i + s; the planes and the carry-save counters are integers with one bit a lane.
    """
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    lens = np.diff(np.r_[edges, len(bucket)])
    levels = max(1, (radius + 1).bit_length())
    for size in sorted({int(x).bit_length() for x in lens if x > 1}):  # buckets of like length together
        runs = [(a, n) for a, n in zip(edges.tolist(), lens.tolist()) if n > 1 and n.bit_length() == size]
        index = np.concatenate([np.arange(a, a + n) for a, n in runs])
        own, key = values[index], bucket[index]
        bits = np.unpackbits(own.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        planes = [int.from_bytes(np.packbits(bits[:, b], bitorder="little").tobytes(), "little") for b in range(64)]
        for offset in range(1, max(n for _, n in runs)):
            same = np.packbits(key[offset:] == key[:-offset], bitorder="little")
            alive = int.from_bytes(same.tobytes(), "little")
            counters = [0] * levels
            for plane in planes:
                carry = (plane ^ (plane >> offset)) & alive
                for level in range(levels):
                    counters[level], carry = counters[level] ^ carry, counters[level] & carry
                alive &= ~carry & ~_at_least(counters, radius + 1)
                if not alive:
                    break
            if alive:
                raw = np.frombuffer(alive.to_bytes((len(index) + 7) // 8, "little"), np.uint8)
                for i in np.flatnonzero(np.unpackbits(raw, bitorder="little")).tolist():
                    yield int(index[i]), int(index[i + offset])


def _at_least(counters: list[int], bound: int) -> int:
    """Lanes whose counter equals ``bound`` or more (they are struck out as soon as they reach it)."""
    out = -1
    for level, bits in enumerate(counters):
        if bound >> level & 1:
            out &= bits
    return out


def _linker(radius: int):
    def run(batches):
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        key = table.column("key").combine_chunks().to_numpy(zero_copy_only=False)
        fps = table.column("fp").combine_chunks().to_numpy(zero_copy_only=False)
        order = np.lexsort((fps, key))
        key, fps = key[order], fps[order]
        forest = _Forest()
        for i, j in sliced_links(fps.view(np.uint64), key, radius):
            forest.join(int(fps[i]), int(fps[j]))
        if forest.up:
            a = list(forest.up)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array([forest.root(x) for x in a], pa.int64())],
                                             ["a", "b"])
    return run


def _segment_keys(fp: Column, radius: int) -> Column:
    """One struct <table, bits> per pair of the ``radius + 2`` segments of the 64 bits."""
    n = radius + 2
    cuts = [64 * k // n for k in range(n + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(cuts)]
    pairs = [_signed(x | y) for x, y in itertools.combinations(masks, 2)]
    return F.array(*[F.xxhash64(F.lit(t), fp.bitwiseAND(F.lit(m).cast("long"))) for t, m in enumerate(pairs)])


def links(prints: DataFrame, radius: int, block: int = BLOCK, parts: int | None = None) -> DataFrame:
    """Edges (a, b) of a spanning forest of the link graph over distinct ``prints(fp)``."""
    keyed = prints.select("fp", F.explode(_segment_keys(F.col("fp"), radius)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # two pieces of a bucket meet in the task of (smaller piece, larger piece)
    pieces = F.ceil(F.col("n") / F.lit(block)).cast("int")
    mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("pieces")).cast("int")
    met = F.explode(F.transform(F.sequence(F.lit(0), F.col("pieces") - 1),
                                lambda o: F.xxhash64("key", F.least("mine", o), F.greatest("mine", o))))
    spread = (keyed.join(sizes, "key").withColumn("pieces", pieces).withColumn("mine", mine)
              .select("fp", F.when(F.col("pieces") == 1, F.array("key")).alias("one"), "key", "pieces", "mine"))
    single = spread.where("pieces = 1").select("fp", "key")
    split = spread.where("pieces > 1").select("fp", met.alias("key"))
    n = parts or owners_of(prints.sparkSession)
    return single.unionByName(split).repartition(n, "key").mapInArrow(_linker(radius), "a long, b long")


def _state(edges: DataFrame) -> tuple:
    """Count and hash sum of an edge set: alike only when a round changed nothing."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node in ``edges(a, b)``; root is the smallest node of its component.

    Alternating large-star and small-star steps; each step aggregates before it shuffles, and each
    round is cut with checkpoint(). Raises if ``max_rounds`` don't suffice (2 ** 60 nodes in a path).
    """
    edges = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where("a <> b").distinct())
    state = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct())
        after = cut_lineage(small)
        before, state = state, _state(after)
        if state == before:
            return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = after
    raise RuntimeError("the components did not settle")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2, seed: int = 42, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (hex), component_id, fp of every row of ``docs(doc_id, text)``."""
    marked = cut_lineage(fingerprints(docs, width, seed))
    return marked.join(_firsts(marked, F.col("doc_id"), radius, block), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id"))


def _firsts(marked: DataFrame, own: Column, radius: int, block: int) -> DataFrame:
    """fp, first (the smallest ``own`` of its component) of every fingerprint in ``marked``."""
    classes = cut_lineage(marked.groupBy("fp").agg(F.min(own).alias("own")))
    roots = components(links(classes.select("fp"), radius, block))
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = named.groupBy("root").agg(F.min("own").alias("first"))
    return cut_lineage(named.select("fp", "root").join(firsts, "root").select("fp", "first"))


def drop_near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each component: of the smallest doc_id (null comes last), and of rows with that
    doc_id the one of smallest text hash, once."""
    marked = cut_lineage(_keyed(docs, width, 42))
    own = F.struct(F.col("_id").isNull().alias("none"), "_id", "_d1", "_d2")
    rows = marked.join(_firsts(marked, own, radius, BLOCK), "fp").select("_id", "_d1", "_d2", (own == F.col("first")).alias("stays"))
    found = cut_lineage(rows.groupBy("_id", "_d1", "_d2", "stays").agg(F.count("*").alias("n")).where("not stays or n > 1"))
    rest = keep_rows(docs, found, "left_anti")
    twins = found.where("stays")
    if twins.isEmpty():
        return rest
    both = keep_rows(docs, twins, "left_semi")
    names = free_names(docs, "_twin0", "_twin1", "_twin2")
    key = [c.alias(n) for n, c in zip(names, row_key(both["doc_id"], both["text"]), strict=True)]
    once = both.select("*", *key).dropDuplicates(names).drop(*names)
    return rest.unionByName(once)
