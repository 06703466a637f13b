"""Byte-level BPE with a supplied vocabulary, by a pair occurrence index, and decoding.

The distinct pre-tokens of a partition are laid out as one linked array of symbols. An index maps
each mergeable pair to all its positions. Active ranks are taken in ascending order from a heap; a
rank's merge is applied to all its positions at once, and only the lists of the neighbouring pairs
that this creates are updated. The words of a text then look up their codes.

Memory is bounded: at most ``MAX_WORDS`` distinct pre-tokens are held, after which their table
starts anew, so nothing depends on the partition's size.

Defined results: a null text is empty and has no ids. Strings of the vocabulary's added tokens are
those tokens. Repeated rows repeat. Ids that the vocabulary doesn't have decode to nothing; bytes that aren't UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import native, slices, text_bytes

MAX_WORDS = 200_000
#: New pre-tokens that are merged together.
NEW_WORDS = 50_000
#: Looked-up pre-tokens that wait for their codes.
MAX_WAITING = 2_000_000
#: Fixed value: the published byte-level pre-token pattern.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    names = {b: chr(b) for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in names):
        names[b] = chr(256 + k)
    return [names[b] for b in range(256)]


def load_model(path: str) -> dict:
    """What encoding and decoding need of a tokenizer file (read once, on the driver)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    byte_of = {c: b for b, c in enumerate(alphabet)}
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    pieces = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()} | {i: t.encode() for t, i in added.items()}
    return {"base": [vocab[c] for c in alphabet], "added": added, "pieces": pieces,
            "merges": [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]}


class PairIndex:
    """Merges a batch of byte strings by rank, all positions of a pair at a time."""

    def __init__(self, model: dict):
        merges = np.array(model["merges"], np.int64).reshape(-1, 3)
        keys = merges[:, 0] << 32 | merges[:, 1]
        self.order = np.argsort(keys)
        self.keys, self.merges = keys[self.order], merges
        self.base = np.array(model["base"], np.int32)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each symbol pair, -1 where none merges."""
        if not len(self.keys):
            return np.full(len(left), -1)
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.order[at], -1)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, number of ids of each word)."""
        lens = np.fromiter((len(w) for w in words), np.int64, len(words))
        sym = self.base[np.frombuffer(b"".join(words), np.uint8)]
        n, ends = len(sym), np.cumsum(lens)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[ends[lens > 0] - 1] = -1
        before[(ends - lens)[lens > 0]] = -1
        places, heap = defaultdict(list), []

        def note(at: np.ndarray) -> None:
            """Enter the pairs that start at these positions."""
            ranks = self._ranks(sym[at], sym[after[at]])
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, own in zip(ranks[np.r_[0, cuts]].tolist() if len(ranks) else [], np.split(at, cuts)):
                if rank not in places:
                    heapq.heappush(heap, rank)
                places[rank].append(own)

        note(np.flatnonzero(after >= 0).astype(np.int32))
        while heap:
            rank = heapq.heappop(heap)
            a, b, merged = self.merges[rank].tolist()
            at = np.unique(np.concatenate(places.pop(rank)))
            at = at[(sym[at] == a) & (after[at] >= 0)]
            at = at[sym[after[at]] == b]
            if a == b:  # of overlapping places the left one merges
                taken, chosen = set(), []
                for p in at.tolist():
                    if p not in taken:
                        chosen.append(p)
                        taken.add(int(after[p]))
                at = np.array(chosen, np.int32)
            if not len(at):
                continue
            gone = after[at]
            follows = after[gone]
            sym[at], sym[gone], after[at] = merged, -1, follows
            more = follows >= 0
            before[follows[more]] = at[more]
            left = before[at]
            note(np.unique(np.concatenate([left[left >= 0], at[more]])))
        live = np.r_[0, np.cumsum(sym >= 0)]
        return sym[sym >= 0], live[ends] - live[ends - lens]


class Coder:
    """Encodes texts of one task; pre-tokens seen before are looked up."""

    def __init__(self, model: dict):
        self.model, self.index = model, PairIndex(model)
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(model["added"], key=len, reverse=True))) + ")") \
            if model["added"] else None
        self._reset()

    def _reset(self) -> None:
        self.known: dict = {i: k for k, i in enumerate(self.model["added"].values())}  # an added token's key is its id
        self.done = len(self.known)
        self.ids = np.array(list(self.known), np.int32)
        self.lens = np.ones(self.done, np.int32)

    def lookups(self, text: str) -> np.ndarray:
        """Table positions of a text's pre-tokens; new ones get the next position."""
        known, out = self.known, []
        put = known.setdefault
        parts = self.added.split(text) if self.added and self.added.search(text) else [text]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(known[self.model["added"][part]])
            else:
                out.extend([put(t, len(known)) for t in PRE_TOKEN.findall(part)])
        return np.array(out, np.int32)

    def full(self) -> bool:
        return len(self.known) > MAX_WORDS

    def settle(self) -> None:
        """Encode the pre-tokens that are new since the last call."""
        words = [w.encode() for w in itertools.islice(self.known, self.done, None)]
        if words:
            ids, lens = self.index.encode(words)
            self.ids, self.lens = np.r_[self.ids, ids], np.r_[self.lens, lens.astype(np.int32)]
            self.done = len(self.known)

    def ids_of(self, looked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, number of ids of each pre-token)."""
        return _gather(self.ids, np.cumsum(self.lens, dtype=np.int64) - self.lens, self.lens, looked)


def _gather(data, starts, lens, at):
    """The pieces ``data[starts[i]:starts[i] + lens[i]]`` for i in ``at``, in a row, and their lengths."""
    size = lens[at]
    ends = np.cumsum(size, dtype=np.int64)
    inside = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size)
    return data[np.repeat(starts[at], size) + inside], size


def _encoded(model, batches):
    """(doc_ids, [ids array of each document]) for runs of documents."""
    coder, waiting = Coder(model), []

    def flush():
        coder.settle()
        starts = np.cumsum(coder.lens, dtype=np.int64) - coder.lens
        for ids, looked in waiting:
            flat, size = _gather(coder.ids, starts, coder.lens, np.concatenate(looked))
            counts = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum([len(x) for x in looked])]]
            yield ids, [flat[a:b] for a, b in zip(counts[:-1].tolist(), counts[1:].tolist())]
        waiting.clear()

    held = 0
    for batch in batches:
        for part in slices(batch, "text"):
            looked = [coder.lookups(t.decode("utf-8", "replace")) for t in text_bytes(part, "text")]
            waiting.append((part.column(0), looked))
            held += sum(map(len, looked))
            if len(coder.known) - coder.done > NEW_WORDS:
                coder.settle()
            if coder.full() or held > MAX_WAITING:
                yield from flush()
                held = 0
                if coder.full():
                    coder._reset()
    yield from flush()


def _decoder(model):
    """A function from an id array to its text's bytes, valid UTF-8."""
    top = max(model["pieces"], default=-1) + 2
    lens = np.zeros(top, np.int64)
    for i, piece in model["pieces"].items():
        lens[i] = len(piece)
    blob = np.frombuffer(b"".join(model["pieces"][i] for i in sorted(model["pieces"])), np.uint8)
    starts = np.cumsum(lens) - lens

    def decode(ids: np.ndarray) -> bytes:
        known = np.where((ids >= 0) & (ids < top), ids, top - 1)
        raw = _gather(blob, starts, lens, known)[0].tobytes()
        try:
            raw.decode("utf-8")
            return raw
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode()
    return decode


def _narrow(docs: DataFrame) -> DataFrame:
    return native(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids array<int> of every row of ``docs(doc_id, text)``."""
    held = docs.sparkSession.sparkContext.broadcast(load_model(path))

    def run(batches):
        for ids, arrays in _encoded(held.value, batches):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([a.astype(np.int32) for a in arrays], pa.list_(pa.int32()))], ["doc_id", "ids"])
    return _narrow(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of every row of ``coded(doc_id, ids)``; null ids are an empty text."""
    held = coded.sparkSession.sparkContext.broadcast(load_model(path))

    def run(batches):
        back = _decoder(held.value)
        for batch in batches:
            texts = [back(np.array(i or [], np.int64)).decode() for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])
    return native(coded, "doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, then decodes the ids, in one pass."""
    held = docs.sparkSession.sparkContext.broadcast(load_model(path))

    def run(batches):
        back = _decoder(held.value)
        for ids, arrays in _encoded(held.value, batches):
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([len(a) for a in arrays], pa.int64()),
                pa.array([hashlib.sha256(a.astype("<u4").tobytes()).hexdigest() for a in arrays], pa.string()),
                pa.array([hashlib.sha256(back(a)).hexdigest() for a in arrays], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _narrow(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
