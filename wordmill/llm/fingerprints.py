"""Document fingerprints: digests of improbable features in chained Bloom filters.

A feature is a window of ``WINDOW`` bytes. Its rank is how rare its entropy is: the corpus counts the
entropies of all its windows in ``BINS`` + 1 classes, and the rarest class ranks first. In each run of
``RUN`` consecutive windows the first one of the lowest rank scores a point; windows of ``POINTS`` points
or more are selected. A selected feature sets ``PROBES`` bits of the document's last Bloom filter; a filter
takes ``PER_FILTER`` features, then the next one of the chain begins.

Two filters compare by the bits they share beyond chance, as a part of the most they could; two chains by
the mean over the shorter one's filters, each with its best counterpart and weighted by its bits.

Only the table of entropy classes is broadcast. Each text's successor in the order of doc_id is found by
one range partitioning of the texts, where the first row of a range also goes to the end of the range before.

Defined results: a null text is an empty text; it has no filter, is like another empty one (1) and unlike
all others (0). A text shorter than a window is one feature. Equal texts have equal fingerprints under one
table. A null doc_id comes after all others. Rows of one doc_id come in the order of their texts' signed XXH64 (seed 42).
A single row is its own successor. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import SLICE_BYTES, native, owners_of, slices, text_bytes, word_hashes

WINDOW = 8
RUN = 16
POINTS = 2
BINS = 1000
#: Windows below this class (long runs of few bytes) tell nothing and rank last.
DULL = 100
FILTER_BITS = 2048
PER_FILTER = 160
PROBES = 5
#: Filters compared at once, and characters of texts fingerprinted at once (a longer text alone).
_BLOCK, _SLICE = 256, SLICE_BYTES // 4

#: c * log2(c) in units of 2**-20, so that sums are exact
_PLOGP = np.array([0] + [round(c * np.log2(c) * (1 << 20)) for c in range(1, WINDOW + 1)], np.int64)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, and each text's start and length; long enough for one window."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer(b"".join(texts) + bytes(WINDOW), np.uint8), np.cumsum(size) - size, size


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """Class 0..BINS of the entropy of the window that starts at each byte but the last WINDOW - 1."""
    n = len(data)
    back, ahead = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for lag in range(1, WINDOW):  # equal bytes among the WINDOW - 1 before and after each byte
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        back[lag:] += same
        ahead[:-lag] += same
    step = np.diff(_PLOGP)
    first = int(_PLOGP[np.bincount(data[:WINDOW], minlength=256)].sum())
    change = step[back[WINDOW:]] - step[ahead[:n - WINDOW]]
    total = np.cumsum(np.concatenate([[first], change]))
    top = int(_PLOGP[WINDOW])  # entropy = (log2 WINDOW) - total / WINDOW
    return (BINS * (top - total) // top).astype(np.int64)


def _windows(starts: np.ndarray, size: np.ndarray, length: int) -> np.ndarray:
    """For each of ``length`` bytes, whether a window of its text starts there."""
    step = np.zeros(length + 1, np.int64)
    np.add.at(step, starts, (size >= WINDOW).astype(np.int64))
    np.add.at(step, starts + np.maximum(size - WINDOW + 1, 0), -(size >= WINDOW).astype(np.int64))
    return np.cumsum(step[:-1]) > 0


def _count_classes(batches: Iterator[pa.RecordBatch]):
    counts = np.zeros(BINS + 1, np.int64)
    for batch in batches:
        for part in slices(batch, "text", _SLICE):
            data, starts, size = _joined(text_bytes(part, "text"))
            classes = entropy_classes(data)
            counts += np.bincount(classes[_windows(starts, size, len(classes))], minlength=BINS + 1)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS + 1)), pa.array(counts)], ["class", "n"])


def rarity_ranks(docs: DataFrame) -> np.ndarray:
    """Rank of each entropy class over all windows of ``docs(text)``: the rarest first, dull ones last."""
    rows = (native(docs, "text").select(F.col("text").cast("string")).mapInArrow(_count_classes, "class long, n long")
            .groupBy("class").agg(F.sum("n").alias("n")))
    counts = np.zeros(BINS + 1, np.int64)
    for r in rows.collect():  # BINS + 1 rows at most
        counts[r["class"]] = r["n"]
    order = np.lexsort((np.arange(BINS + 1), counts, np.arange(BINS + 1) < DULL))
    ranks = np.empty(BINS + 1, np.int64)
    ranks[order] = np.arange(BINS + 1)
    return ranks


def selected(data: np.ndarray, starts: np.ndarray, size: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Ascending places of the windows of POINTS points or more.

    Of a text without such a window it is the first of most points, of one shorter than a run every window.
    """
    key = ranks[entropy_classes(data)] << 40 | np.arange(len(data) - WINDOW + 1)
    windows = np.maximum(size - WINDOW + 1, 0)
    runs = np.maximum(windows - RUN + 1, 0)
    low, span = key, 1
    while span < RUN:  # lowest key of the 2 * span windows from each place on
        low = np.minimum(low[:-span], low[span:]) if len(low) > span else low
        span *= 2
    step = np.zeros(len(data) + 1, np.int64)
    np.add.at(step, starts, (runs > 0).astype(np.int64))
    np.add.at(step, starts + runs, -(runs > 0).astype(np.int64))
    points = np.zeros(len(data), np.int64)
    if len(low) and (runs > 0).any():
        at = low[np.flatnonzero(step[:len(low)].cumsum() > 0)] & ((1 << 40) - 1)
        points = np.bincount(at, minlength=len(data))
    chosen = points >= POINTS
    for i in np.flatnonzero(windows > 0):
        s, e = starts[i], starts[i] + windows[i]
        if not runs[i]:
            chosen[s:e] = True
        elif not chosen[s:e].any():
            chosen[s + np.argmax(points[s:e])] = True
    return np.flatnonzero(chosen)


def filters_of(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """The chained filters of each text: an array of bytes, one row a filter."""
    data, starts, size = _joined(texts)
    at = selected(data, starts, size, ranks)
    short = np.flatnonzero((size > 0) & (size < WINDOW))
    begin, length = np.concatenate([at, starts[short]]), np.concatenate([np.full(len(at), WINDOW), size[short]])
    of = np.searchsorted(starts, begin, "right") - 1  # of texts that start at one byte, only the last is not empty
    marks = word_hashes(data, begin, begin + length)
    order = np.lexsort((begin, marks, of))
    again = np.zeros(len(order), bool)
    again[order[1:]] = (of[order[1:]] == of[order[:-1]]) & (marks[order[1:]] == marks[order[:-1]])
    keep = np.flatnonzero(~again)
    keep = keep[np.argsort(begin[keep], kind="stable")]  # distinct features of each text in their order
    of, marks = of[keep], marks[keep]
    count = np.bincount(of, minlength=len(texts))
    chain = -(-count // PER_FILTER)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    row = np.repeat(np.cumsum(chain) - chain, count) + nth // PER_FILTER
    bits = np.zeros((int(chain.sum()), FILTER_BITS), np.uint8)
    for j in range(PROBES):
        bits[row, (marks >> np.uint64(11 * j) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = 1
    packed, ends = np.packbits(bits, axis=1), np.cumsum(chain)
    return [packed[e - c:e] for e, c in zip(ends, chain, strict=True)]


def written(filters: np.ndarray) -> str:
    """The fingerprint as text: the number of filters and their deflated bytes."""
    return f"{len(filters)}:" + (base64.b64encode(zlib.compress(filters.tobytes(), 1)).decode() if len(filters) else "")


def read(fingerprint: str) -> np.ndarray:
    """The filters of a fingerprint."""
    n, body = fingerprint.split(":", 1)
    raw = zlib.decompress(base64.b64decode(body)) if int(n) else b""
    return np.frombuffer(raw, np.uint8).reshape(int(n), FILTER_BITS // 8)


def _toward(a: np.ndarray, b: np.ndarray) -> float:
    """Mean over the filters of ``a``, weighted by bits, of the best normalised overlap with one of ``b``."""
    total, weight = 0.0, 0
    for lo in range(0, len(a), _BLOCK):
        mine = np.unpackbits(a[lo:lo + _BLOCK], axis=1).astype(np.float32)
        size = mine.sum(1)
        best = np.zeros(len(mine))
        for at in range(0, len(b), _BLOCK):
            other = np.unpackbits(b[at:at + _BLOCK], axis=1).astype(np.float32)
            theirs = other.sum(1)
            chance = np.outer(size, theirs) / FILTER_BITS
            most = np.minimum.outer(size, theirs)
            best = np.maximum(best, np.clip((mine @ other.T - chance) / np.maximum(most - chance, 1e-9), 0, 1).max(1))
        total += float((best * size).sum())
        weight += int(size.sum())
    return total / weight


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: how far the shorter chain's filters are found in the other; chains of one length both ways."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if a.shape == b.shape and np.array_equal(a, b):
        return 1.0
    if len(a) == len(b):
        return (_toward(a, b) + _toward(b, a)) / 2
    return _toward(a, b) if len(a) < len(b) else _toward(b, a)


def edited(text: str, successor: str) -> str:
    """``text`` with its last half replaced by as many first characters of ``successor``, or all it has."""
    half = len(text) // 2
    return text[:len(text) - half] + successor[:half]


_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
           " near_edited double, near_next double")
_NAMES = [c.split()[0] for c in _RESULT.split(", ")]


def _compared(rows: list[tuple[int | None, str, str]], ranks: np.ndarray) -> pa.RecordBatch:
    """Results of (doc_id, text, successor's text)."""
    changed = [edited(text, after) for _, text, after in rows]
    # a successor's filters are mostly those of the next row
    texts = [text for _, text, _ in rows]
    distinct = {t: None for t in (*texts, *changed, *(after for _, _, after in rows))}
    prints = dict(zip(distinct, filters_of([t.encode() for t in distinct], ranks), strict=True))
    strings = {t: written(prints[t]) for t in {*texts, *changed}}
    columns = [pa.array([i for i, _, _ in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
               pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
               pa.array([strings[t] for t in texts]), pa.array([strings[t] for t in changed]),
               pa.array([likeness(prints[t], prints[c]) for t, c in zip(texts, changed, strict=True)], pa.float64()),
               pa.array([likeness(prints[t], prints[after]) for _, t, after in rows], pa.float64())]
    return pa.RecordBatch.from_arrays(columns, _NAMES)


def _walk(ranks):
    """Results of a sorted range of (doc_id, text, extra); an extra row only ends it."""
    def run(batches: Iterator[pa.RecordBatch]):
        last, rows, held = None, [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, text, extra in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if last is not None:
                        rows.append((*last, text))
                        held += len(text)
                    last = None if extra else (doc_id, text)
                    if held > _SLICE:
                        yield _compared(rows, ranks.value)
                        rows, held = [], 0
        if rows:
            yield _compared(rows, ranks.value)
    return run


def _at_or_before(heads: Column, group: int) -> Column:
    """How many of the ascending ``heads``, in arrays of ``group``, are not above the row's key."""
    firsts = F.transform(heads, lambda g: g[0])
    full = F.size(F.filter(firsts, lambda h: h <= F.col("_key"))) - 1
    return full * group + F.size(F.filter(F.get(heads, full), lambda h: h <= F.col("_key")))


def _in_ranges(rows: DataFrame) -> DataFrame:
    """``rows(doc_id, text)`` by falling doc_id in sorted partitions, each followed by the next one's first row (extra).

    The ranges come from the keys alone, so texts are shuffled once.
    """
    # falling doc_ids as rising numbers, without overflow; nulls last
    key = F.struct(F.isnull("doc_id").cast("int").alias("n"), F.bitwise_not(F.coalesce("doc_id", F.lit(0))).alias("i"),
                   F.xxhash64("text").alias("h"))
    keys = rows.select(key.alias("_key"))
    parts = owners_of(rows.sparkSession)
    heads = sorted(tuple(r["head"]) for r in keys.repartitionByRange(parts, "_key")
                   .select(F.spark_partition_id().alias("part"), "_key")
                   .groupBy("part").agg(F.min("_key").alias("head")).collect())  # one of a partition
    group = max(1, round(len(heads) ** 0.5))
    nested = [[dict(zip("nih", h, strict=True)) for h in heads[k:k + group]] for k in range(0, len(heads), group)]
    table = F.from_json(F.lit(json.dumps(nested)), "array<array<struct<n: int, i: bigint, h: bigint>>>")
    place = (_at_or_before(table, group) - 1).alias("part")
    placed = rows.select("doc_id", "text", key.alias("_key")).select("doc_id", "text", "_key", place)
    is_head = F.col("_key") == F.get(F.get(table, F.floor(F.col("part") / group).cast("int")), F.col("part") % group)
    own = F.struct(F.col("part"), F.lit(False).alias("extra"))
    before = F.struct(F.pmod(F.col("part") - 1, F.lit(max(1, len(heads)))).alias("part"), F.lit(True).alias("extra"))
    return (placed.select("doc_id", "text", "_key", F.explode(F.when(is_head, F.array(own, before)).otherwise(F.array(own)))
                          .alias("to")).select("doc_id", "text", "_key", "to.part", "to.extra")
            .repartitionById(max(1, len(heads)), F.col("part")).sortWithinPartitions("extra", "_key", "text")
            .select("doc_id", "text", "extra"))


def fingerprints(docs: DataFrame, ranks: np.ndarray | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    One row per row of ``docs(doc_id, text)``: its fingerprint and that of its edited text, and how alike its
    own is to the edited one and to that of its successor by falling doc_id (the last one's is the first).
    ``ranks`` comes from ``rarity_ranks``, by default of ``docs``.
    """
    table = docs.sparkSession.sparkContext.broadcast(rarity_ranks(docs) if ranks is None else ranks)
    rows = native(docs, "doc_id", "text").select(F.col("doc_id").cast("long"),
                                                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return _in_ranges(rows).mapInArrow(_walk(table), _RESULT)
