"""Token-ID files: each document's ids compressed on their own with a shared zstandard dictionary.

Documents are range-partitioned and sorted by doc_id, encoded with the tokenizers library and an end id,
and written as Parquet rows of one *shard* each, so Spark commits and reads them on any store:

    dictionary_hash  SHA-256 of the dictionary that the frames need
    width            bytes of an id (2 or 4, little-endian)
    part, start      writing task and the ids before the shard in it (tasks are in doc_id order)
    doc_ids, counts  the documents of the shard and their numbers of ids
    offsets          where each document's frame begins in ``frames``; one more for the end
    frames           the zstandard frames, one after another

The dictionary is trained on the serialized ids of a bounded sample (``SAMPLE_DOCS`` documents of
smallest id hash, ``SAMPLE_IDS`` ids of each) and kept in ``dictionary``; too small a sample leaves it
empty. A short document is read by its shard's id range and its frame alone.

Defined results: a null text is empty and has the end id only. A null doc_id comes first. Rows of one
doc_id keep a fixed order by text hash. An empty table writes no shard.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import zlib
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wordmill.llm.common import cut_lineage, keep_ids, native, owners_of, text_bytes

SAMPLE_DOCS, SAMPLE_IDS, DICTIONARY_BYTES = 400, 4096, 32 << 10
SHARD_BYTES = 4 << 20
LEVEL = 3
#: Chunks that a coder holds before it starts anew.
MAX_CHUNKS = 700_000

_SHARD = ("dictionary_hash string, width int, part int, start long, first_id long, last_id long, doc_ids array<long>,"
          " counts array<long>, offsets array<long>, frames binary")
_SHARD_ARROW = pa.schema([
    ("dictionary_hash", pa.string()), ("width", pa.int32()), ("part", pa.int32()), ("start", pa.int64()),
    ("first_id", pa.int64()), ("last_id", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("counts", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("frames", pa.binary())])


class _Table(dict):
    """Numbers its keys in the order in which they are first looked up."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class TextCoder:
    """The tokenizers library's ids of whole texts.

    Where the tokenizer drops white space, a text's ids are those of its white-space-separated chunks
    in a row, so that a chunk is encoded once; any other tokenizer gets whole texts. Most chunks are
    plain: letters that no normalization changes, with punctuation around them. One expression cuts all
    new chunks; each distinct piece goes straight to the tokenizer's model, once, and chunks are put
    together from their pieces. Other chunks go through the whole tokenizer.
    """

    #: A line of lower-case letters that no normalization changes, with ASCII punctuation (no apostrophe, which
    #: makes contractions, and no "<", which begins an added token) before and after them; or any line.
    _plain = re.compile(r"^([!-&(-/:;=-@\[-`{-~]*)([a-z\u00df-\u00f6\u00f8-\u024f]*)([!-&(-/:;=-@\[-`{-~]*)$|^.+$", re.MULTILINE)
    #: Bytes that a byte-level vocabulary writes as another character than their own.
    _shown = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 255 and b != 173))}

    def __init__(self, spec: str):
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        parsed = json.loads(spec)
        steps = json.dumps(parsed.get("pre_tokenizer") or {})
        self.by_chunk = ('"invert": true' in steps and "Removed" in steps and "\\\\s" in steps
                         and parsed["model"].get("type") == "BPE"
                         and "Lowercase" in json.dumps(parsed.get("normalizer") or {}))
        self._reset()

    def _reset(self):
        """Empty tables: of chunks (bytes) and of pieces (a string, or a chunk that isn't plain)."""
        self.chunks, self.pieces = _Table(), _Table()
        self.chunk_ids, self.chunk_lens = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.piece_ids, self.piece_lens = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _piece(self, piece: str | bytes) -> list[int]:
        """The ids of one pre-token of lower-case letters, or of one of punctuation, or of a whole chunk."""
        if isinstance(piece, bytes):
            return self._whole(piece.decode("utf-8", "replace"))
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self._shown)
        return [t.id for t in self.tokenizer.model.tokenize(shown)] if piece else []

    def _settle(self) -> None:
        """Encode the chunks that are new since the last call."""
        new = list(itertools.islice(self.chunks, len(self.chunk_lens), None))
        if not new:
            return
        cut = self._plain.findall(b"\n".join(new).decode("utf-8", "replace").lower())
        odd = ("", "", "")
        parts = [x if x != odd else (chunk, "", "") for x, chunk in zip(cut, new, strict=True)]
        at = np.fromiter(map(self.pieces.__getitem__, itertools.chain.from_iterable(parts)), np.int32, 3 * len(parts))
        fresh = [self._piece(x) for x in itertools.islice(self.pieces, len(self.piece_lens), None)]
        lens = np.fromiter(map(len, fresh), np.int32, len(fresh))
        self.piece_ids = np.r_[self.piece_ids, np.fromiter(itertools.chain.from_iterable(fresh), np.int32, int(lens.sum()))]
        self.piece_lens = np.r_[self.piece_lens, lens]
        self.chunk_ids = np.r_[self.chunk_ids, _gather(self.piece_ids, self.piece_lens, at)]
        self.chunk_lens = np.r_[self.chunk_lens, self.piece_lens[at].reshape(-1, 3).sum(1, dtype=np.int32)]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of UTF-8 texts."""
        if not self.by_chunk:
            found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
            return [np.array(e.ids, np.int32) for e in found]
        if len(self.chunks) > MAX_CHUNKS:
            self._reset()
        look = self.chunks.__getitem__
        at = [np.fromiter(map(look, chunks), np.int32, len(chunks)) for chunks in map(bytes.split, texts)]  # ASCII white space
        self._settle()
        looked = np.concatenate(at) if at else np.zeros(0, np.int32)
        upto = np.r_[0, np.cumsum(self.chunk_lens[looked], dtype=np.int64)]
        ends = upto[np.cumsum([0, *map(len, at)])]
        ids = _gather(self.chunk_ids, self.chunk_lens, looked)
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


class _Shared:
    """What every writing task needs; as a broadcast value it keeps its coder from task to task of a worker."""

    def __init__(self, spec: str, dictionary: bytes):
        self.spec, self.dictionary, self.coder = spec, dictionary, None

    def __reduce__(self):
        return _Shared, (self.spec, self.dictionary)

    def get_coder(self) -> TextCoder:
        if self.coder is None:
            self.coder = TextCoder(self.spec)
        return self.coder


def _gather(data: np.ndarray, lens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The pieces of ``data`` numbered ``at``, in a row; piece i has ``lens[i]`` items."""
    starts, size = np.cumsum(lens, dtype=np.int64) - lens, lens[at].astype(np.int64)
    ends = np.cumsum(size)
    return data[np.arange(int(size.sum())) + np.repeat(starts[at] - ends + size, size)]


def _runs(batch: pa.RecordBatch, column: str, limit: int):
    at, held = 0, 0
    texts = text_bytes(batch, column)
    for k, text in enumerate(texts):
        if k > at and held + len(text) > limit:
            yield batch.slice(at, k - at), texts[at:k]
            at, held = k, 0
        held += len(text)
    if texts:
        yield batch.slice(at), texts[at:]


def _serial(ids: np.ndarray, width: int) -> bytes:
    return ids.astype("<u2" if width == 2 else "<u4").tobytes()


def train_dictionary(docs: DataFrame, spec: str, width: int) -> bytes:
    """A dictionary from the bounded sample; empty where the sample is too small to train on."""
    picked = native(docs, "doc_id").select(F.col("doc_id").cast("long")).where("doc_id is not null").distinct()
    picked = cut_lineage(picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS))

    def run(batches):
        coder = TextCoder(spec)
        for batch in batches:
            for _, texts in _runs(batch, "text", 1 << 20):
                arrays = coder.encode(texts)
                yield pa.RecordBatch.from_arrays([pa.array([_serial(a[:SAMPLE_IDS], width) for a in arrays], pa.binary())],
                                                 ["ids"])
    rows = keep_ids(native(docs, "doc_id", "text"), picked, "left_semi").select(F.col("text").cast("string"))
    samples = [r.ids for r in rows.mapInArrow(run, "ids binary").limit(2 * SAMPLE_DOCS).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sorted(samples), k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes):
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=True)


def _decompressor(dictionary: bytes):
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdDecompressor(dict_data=held)


def write(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 1) -> None:
    """Writes ``folder/dictionary`` and ``folder/shards`` for ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    spec = Path(tokenizer_path).read_text(encoding="utf-8")
    width = 2 if max(Tokenizer.from_str(spec).get_vocab_size(True), end_id + 1) <= 1 << 16 else 4
    dictionary = train_dictionary(docs, spec, width)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary))], "hash string, data binary").coalesce(1).write.parquet(
        f"{folder}/dictionary")
    held = spark.sparkContext.broadcast(_Shared(spec, dictionary))  # a tokenizer file and at most DICTIONARY_BYTES

    def run(batches):
        coder, pack, part = held.value.get_coder(), _compressor(held.value.dictionary), TaskContext.get().partitionId()
        start, ids, counts, frames = 0, [], [], []

        def shard():
            known = [i for i in ids if i is not None]
            return pa.RecordBatch.from_pylist([{
                "dictionary_hash": digest, "width": width, "part": part, "start": start,
                "first_id": min(known, default=None), "last_id": max(known, default=None), "doc_ids": ids,
                "counts": counts, "offsets": [0, *np.cumsum([len(f) for f in frames]).tolist()],
                "frames": b"".join(frames)}], _SHARD_ARROW)
        held_bytes = 0
        for batch in batches:
            for rows, texts in _runs(batch, "text", 2 << 20):
                arrays = coder.encode(texts)
                for doc_id, array in zip(rows.column(0).to_pylist(), arrays):
                    frame = pack.compress(_serial(np.append(array, end_id), width))
                    if frames and held_bytes + len(frame) > SHARD_BYTES:
                        yield shard()
                        start, held_bytes = start + sum(counts), 0
                        ids, counts, frames = [], [], []
                    ids.append(doc_id)
                    counts.append(len(array) + 1)
                    frames.append(frame)
                    held_bytes += len(frame)
        if ids:
            yield shard()
    ordered = (native(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
               .repartitionByRange(owners_of(spark), F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")))
    ordered.mapInArrow(run, _SHARD).write.option("compression", "none").parquet(f"{folder}/shards")


def _dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    if hashlib.sha256(row.data).hexdigest() != row.hash:
        raise ValueError("the dictionary doesn't have the hash that it was written with")
    return row.hash, bytes(row.data)


def _documents(held):
    """(shard row, document's place in it, ids as little-endian uint32) of each document."""
    digest, dictionary = held

    def read(batches):
        unpack = _decompressor(dictionary)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary_hash"] != digest:
                    raise ValueError("a shard needs another dictionary")
                view = memoryview(row["frames"])
                for k, (a, b) in enumerate(zip(row["offsets"], row["offsets"][1:])):
                    raw = unpack.decompress(view[a:b])
                    yield row, k, np.frombuffer(raw, "<u2" if row["width"] == 2 else "<u4").astype("<u4")
    return read


def read(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, ids of all documents, or of some: their shards are found by id range (pushed to the scan)."""
    held = spark.sparkContext.broadcast(_dictionary(spark, folder))
    shards = spark.read.schema(_SHARD).parquet(f"{folder}/shards")
    if doc_ids is not None:
        spans = [(F.col("first_id") <= i) & (F.col("last_id") >= i) for i in doc_ids]
        shards = shards.where(reduce(lambda a, b: a | b, spans, F.lit(False)))
    wanted = None if doc_ids is None else set(doc_ids)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                if wanted is not None:  # only the wanted frames are touched
                    keep = [k for k, i in enumerate(row["doc_ids"]) if i in wanted]
                    offsets = [(row["offsets"][k], row["offsets"][k + 1]) for k in keep]
                else:
                    keep, offsets = range(len(row["doc_ids"])), list(zip(row["offsets"], row["offsets"][1:]))
                if row["dictionary_hash"] != held.value[0]:
                    raise ValueError("a shard needs another dictionary")
                unpack, view = _decompressor(held.value[1]), memoryview(row["frames"])
                kind = "<u2" if row["width"] == 2 else "<u4"
                ids = [np.frombuffer(unpack.decompress(view[a:b]), kind).astype(np.int32) for a, b in offsets]
                yield pa.RecordBatch.from_arrays([pa.array([row["doc_ids"][k] for k in keep], pa.int64()),
                                                  pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
    return shards.mapInArrow(run, "doc_id long, ids array<int>")


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""
    held = spark.sparkContext.broadcast(_dictionary(spark, folder))
    shards = spark.read.schema(_SHARD).parquet(f"{folder}/shards")
    # one row for each writing task
    totals = shards.groupBy("part").agg(F.sum(F.expr("aggregate(counts, 0L, (a, c) -> a + c)")).alias("n")).collect()
    parts = sorted((r.part, r.n) for r in totals)
    before = dict(zip((p for p, _ in parts), np.cumsum([0, *(n for _, n in parts)]).tolist()))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches):
        documents = _documents(held.value)
        for batch in batches:
            out, at = [], 0
            for row, k, ids in documents([batch]):
                at = before[row["part"]] + row["start"] if k == 0 else at
                out.append((row["doc_ids"][k], at, len(ids), zlib.crc32(ids.tobytes())))
                at += len(ids)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                 ["doc_id", "start", "n_tokens", "ids_crc32"])
    return shards.mapInArrow(run, schema)
