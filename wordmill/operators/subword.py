"""Byte-level BPE learned from a corpus or read from files, encoding and decoding.

* Text is cut into pre-tokens natively with the public GPT-2 pattern. A task
  segments each distinct pre-token that it meets once, with the model's merges
  as a broadcast rank table, so the cost does not depend on the number of
  merges and encoding and decoding need no shuffle.
* A model is bounded by its files: byte ids, ranked merges and special tokens.
  It comes from learned merges or from vocabulary and merge tables (S8), whose
  printable alphabet is mapped back to bytes.
* Learning (T10) takes the best adjacent pair of the distinct pre-tokens, weighted by
  frequency (count desc, then left id, right id asc), several a round where their
  order is proven. Pair counts are kept up by signed changes from the pre-tokens
  that a round rewrites, and are not counted anew.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.functions.exchange import _arrays, _cuts, _rebuilt
from wordmill.session import cut_lineage

# The public GPT-2 pre-token pattern and its end-of-text token.
PRETOKEN_PATTERN = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
END_OF_TEXT = "<|endoftext|>"
END_OF_TEXT_ID = 50256
BASE_SYMBOLS = 256
#: Bytes of distinct pre-tokens and their ids that a task remembers at once, and what an entry takes beside them, about.
CACHE_BYTES = 96 << 20
CACHE_ENTRY = 200
#: Pre-tokens or ids that a task works on at once, about.
SLICE_VALUES = 1 << 17
#: Pairs looked at in one round of learning, and pairs whose counts are kept from round to round.
ROUND_PAIRS = 1024
FRONTIER = 50_000

Merge = tuple[int, int]


def byte_alphabet() -> list[str]:
    """The printable character of each byte in published byte-level vocabulary files."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    chars = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in chars)
    chars |= {b: chr(256 + k) for k, b in enumerate(list(hidden))}
    return [chars[b] for b in range(256)]


@dataclass(frozen=True)
class Model:
    """Byte ids, merges as (left, right, new id) in rank order, and special tokens."""

    byte_ids: tuple[int, ...]
    merges: tuple[tuple[int, int, int], ...]
    special: dict[str, int] = field(default_factory=lambda: {END_OF_TEXT: END_OF_TEXT_ID})

    def __post_init__(self):
        taken = {*self.byte_ids, *(m[2] for m in self.merges)}
        clash = {t: i for t, i in self.special.items() if i in taken}
        if clash:
            raise ValueError(f"special ids are also ids of ordinary tokens: {clash}")

    @classmethod
    def learned(cls, merges: Sequence[Merge], special: dict[str, int] | None = None) -> Model:
        """Bytes are 0-255 and merge ``r`` makes id ``256 + r``; the default special id moves past them."""
        last = BASE_SYMBOLS + len(merges)
        own = {END_OF_TEXT: max(END_OF_TEXT_ID, last)} if special is None else special
        return cls(tuple(range(BASE_SYMBOLS)),
                   tuple((int(a), int(b), BASE_SYMBOLS + r) for r, (a, b) in enumerate(merges)), own)

    @classmethod
    def from_tables(cls, vocab: DataFrame, merges: DataFrame, special: Sequence[str] = (END_OF_TEXT,)) -> Model:
        """From <token, token_id> and <rank, left, right> in the printable alphabet.

        One row for each token and merge of the model comes to the driver.
        """
        ids = {r["token"]: r["token_id"] for r in vocab.collect()}
        ranked = merges.orderBy("rank").collect()
        return cls(tuple(ids[c] for c in byte_alphabet()),
                   tuple((ids[r["left"]], ids[r["right"]], ids[r["left"] + r["right"]]) for r in ranked),
                   {t: ids[t] for t in special if t in ids})

    @classmethod
    def from_file(cls, path: str) -> Model:
        """From one published tokenizer file of a byte-level vocabulary (read by the driver, bounded by the model)."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        return cls(tuple(ids[c] for c in byte_alphabet()), tuple((ids[a], ids[b], ids[a + b]) for a, b in pairs),
                   {t["content"]: t["id"] for t in spec["added_tokens"]})

    def pieces(self) -> dict[int, bytes]:
        """The bytes of every id."""
        out = {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        for left, right, new in self.merges:
            out[new] = out[left] + out[right]
        return out | {i: t.encode("utf-8") for t, i in self.special.items()}


def pretokens(text: Column | str) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(t, F.lit(PRETOKEN_PATTERN), 0)


def pretoken_table(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct pre-tokens with frequencies: <pretoken, n>."""
    return (df.select(F.explode(pretokens(text_col)).alias("pretoken"))
              .groupBy("pretoken").agg(F.count(F.lit(1)).alias("n")))


def _segmenter(model: Model):
    """A function from a pre-token to its ids: lowest rank first, leftmost on ties.

    Everything it needs is inside it, so tasks carry it by value.
    """
    import heapq

    ranks = {(a, b): (r, new) for r, (a, b, new) in enumerate(model.merges)}
    byte_ids = model.byte_ids

    def segment(word: str) -> list[int]:
        sym: list = [byte_ids[b] for b in word.encode("utf-8")]
        after = [*range(1, len(sym)), -1]
        before = list(range(-1, len(sym) - 1))
        heap: list = []

        def note(i):
            found = ranks.get((sym[i], sym[after[i]])) if after[i] >= 0 else None
            if found:
                heapq.heappush(heap, (found[0], i, found[1]))
        for i in range(len(sym)):
            note(i)
        while heap:
            rank, i, new = heapq.heappop(heap)
            j = after[i]
            if sym[i] is None or j < 0 or ranks.get((sym[i], sym[j]), (None,))[0] != rank:
                continue  # the pair is gone
            sym[i], sym[j], after[i] = new, None, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            note(i)
            if before[i] >= 0:
                note(before[i])
        return [s for s in sym if s is not None]
    return segment


def encode(df: DataFrame, model: Model | Sequence[Merge], id_col: str | Sequence[str] = "doc_id",
           text_col: str = "text", special: str = "raise", out_col: str = "ids") -> DataFrame:
    """T7 (+T9): byte-level BPE ids per row.

    ``special``: 'allow' turns every special token into its id; 'raise' fails on a text
    containing one (the library default); 'as_text' encodes it as ordinary text.
    """
    model = model if isinstance(model, Model) else Model.learned(model)
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    marks = list(model.special)
    if special == "raise":
        found = F.lit(False)
        for mark in marks:
            found = found | (F.instr(text, mark) > 0)
        text = F.when(found, F.raise_error(F.lit(f"text contains a special token of {marks}"))).otherwise(text)
    if special == "allow" and marks:
        quoted = "|".join("\\Q" + m + "\\E" for m in sorted(marks, key=len, reverse=True))
        between = F.split(text, quoted, -1)
        own = F.concat(F.regexp_extract_all(text, F.lit(f"({quoted})"), 1), F.array(F.lit("")))
        # the pattern never yields a special token as one pre-token, so its text can stand for it
        pieces = F.filter(F.flatten(F.zip_with(between, own, lambda t, m: F.concat(pretokens(t), F.array(m)))),
                          lambda p: p != "")
    elif special in ("raise", "as_text", "allow"):
        pieces = pretokens(text)
    else:
        raise ValueError(f"unknown special policy {special!r}")
    src = df.select(*ids, pieces.alias("_wm_p"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    # the rank table travels with the task's function, which Spark broadcasts when it is large
    segment, limit, marked = _segmenter(model), CACHE_BYTES, dict(model.special) if special == "allow" else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bytes] = {}  # the ids of a word as int64
        held = 0
        for part, flat, lens in _slices(batches):
            coded = flat.dictionary_encode()
            own: list[bytes] = []
            for w in coded.dictionary.to_pylist():
                found = known.get(w)
                if found is None:
                    found = np.array([marked[w]] if w in marked else segment(w), np.int64).tobytes()
                    held += CACHE_ENTRY + len(w) + len(found)
                    if held > limit:
                        known.clear()
                        held = CACHE_ENTRY + len(w) + len(found)
                    known[w] = found
                own.append(found)
            at = coded.indices.to_numpy(zero_copy_only=False)
            values, sizes = _gathered(np.frombuffer(b"".join(own), np.int64), np.array([len(x) >> 3 for x in own], np.int64), at)
            yield _with_lists(part, values, _row_sums(sizes, lens), out_col)
    return src.mapInArrow(run, f"{schema}, `{out_col}` array<bigint>")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray]]:
    """Runs of rows of at most SLICE_VALUES elements (one row at least): rows, elements of their last column, elements a row."""
    for batch in batches:
        for a, b in _cuts(_arrays(batch.column(batch.num_columns - 1))[1], SLICE_VALUES):
            part = batch.slice(a, b - a)
            yield part, *_arrays(part.column(part.num_columns - 1))


def _gathered(flat: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``at`` of ``flat``, which is cut into runs of ``sizes``, one after another, and their sizes."""
    first, own = np.cumsum(sizes) - sizes, sizes[at]
    return flat[np.repeat(first[at] - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))], own


def _row_sums(sizes: np.ndarray, lens: np.ndarray) -> np.ndarray:
    upto = np.r_[0, np.cumsum(sizes)]
    return np.diff(upto[np.r_[0, np.cumsum(lens)]])


def _with_lists(part: pa.RecordBatch, values: np.ndarray, lens: np.ndarray, name: str) -> pa.RecordBatch:
    """``part`` with arrays of ``lens`` elements of ``values`` in place of its last column."""
    return pa.RecordBatch.from_arrays([*part.columns[:-1], _rebuilt(pa.array(values), lens)], [*part.schema.names[:-1], name])


def decode(df: DataFrame, model: Model | Sequence[Merge], id_col: str | Sequence[str] = "doc_id",
           ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """Ids -> bytes -> UTF-8 text (invalid bytes become U+FFFD); an unknown id raises."""
    model = model if isinstance(model, Model) else Model.learned(model)
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    src = df.select(*ids, ids_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    table = sorted(model.pieces().items())
    held = df.sparkSession.sparkContext.broadcast(
        (np.array([i for i, _ in table], np.int64), b"".join(x for _, x in table), np.array([len(x) for _, x in table], np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, blob, sizes = held.value
        blob = np.frombuffer(blob, np.uint8)
        for part, flat, lens in _slices(batches):
            if flat.null_count:
                raise ValueError("unknown id: null")
            own = flat.to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            strange = own[known[at] != own]
            if len(strange):
                raise ValueError(f"unknown id: {strange[0]}")
            data, each = _gathered(blob, sizes, at)
            ends = np.cumsum(_row_sums(each, lens)).tolist()
            data = data.tobytes()
            texts = [data[a:b].decode("utf-8", "replace") for a, b in zip([0, *ends], ends)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], [*part.schema.names[:-1], out_col])
    return src.mapInArrow(run, f"{schema}, `{out_col}` string")


_BLOCK = "sym binary, n binary"


def _as_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their frequencies as blocks: symbols (int32, -1 before each word) and frequencies (int64)."""
    for batch in batches:
        words = batch.column(0).cast(pa.binary()).to_pylist()
        sym = [x for w in words for x in (-1, *w)]
        yield _block(np.array(sym, np.int32), batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64))


def _block(sym: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([sym.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())],
                                      ["sym", "n"])


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield np.frombuffer(row["sym"], np.int32), np.frombuffer(row["n"], np.int64)


def _apply(sym: np.ndarray, made: Sequence[tuple[int, int, int]]) -> np.ndarray:
    """The symbols after the merges, one after another, each leftmost first.

    Merges that follow one another and can't overlap (no right symbol is another's left one, none is made by
    another) are done in one pass over the symbols.
    """
    for run in _apart(made):
        if len(sym) < 2:
            break
        left, right, new = (np.array(x, np.int64) for x in zip(*sorted(run)))
        starts = np.zeros(int(max(sym.max(), left.max())) + 2, bool)  # the last one is for -1
        starts[left] = True
        at = np.flatnonzero(starts[sym[:-1]])
        at = at[sym[at + 1] >= 0]
        key = sym[at].astype(np.int64) << 32 | sym[at + 1]
        keys = left << 32 | right
        which = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = keys[which] == key
        at, which = at[hit], which[hit]
        if left[0] == right[0] and len(at) > 1:  # alone in its run: of overlapping places every other one merges
            begins = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            odd = (np.arange(len(at)) - np.repeat(begins, np.diff(np.r_[begins, len(at)]))) % 2 == 0
            at, which = at[odd], which[odd]
        if len(at):
            sym = sym.copy()
            sym[at] = new[which]
            sym = np.delete(sym, at + 1)
    return sym


def _apart(made: Sequence[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """``made`` in runs of merges that can't overlap or build on one another; a pair of one symbol twice is a run."""
    run: list[tuple[int, int, int]] = []
    lefts, rights, news = set(), set(), set()
    for left, right, new in made:
        if run and (left == right or run[-1][0] == run[-1][1] or left in rights or right in lefts or left in news or right in news):
            yield run
            run, lefts, rights, news = [], set(), set(), set()
        run.append((left, right, new))
        lefts.add(left)
        rights.add(right)
        news.add(new)
    if run:
        yield run


def _pairs(sym: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Adjacent pairs as left << 32 | right, and the frequency of the word of each."""
    inside = (sym[:-1] >= 0) & (sym[1:] >= 0)
    word = np.cumsum(sym < 0)[:-1][inside] - 1
    return sym[:-1][inside].astype(np.int64) << 32 | sym[1:][inside], n[word]


def _summed(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1)) if len(keys) else np.zeros(0, np.int64)
    sums = np.add.reduceat(counts, first) if len(first) else counts
    live = sums != 0
    return pa.RecordBatch.from_arrays([pa.array(keys[first][live]), pa.array(sums[live])], ["pair", "d"])


def _counted(pending: list) -> Callable:
    """Counts of all pairs of a task's blocks after the ``pending`` merges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sym, n in _blocks_of(batches):
            yield _summed(*_pairs(_apply(sym, pending), n))
    return run


def _changed(pending: list, made: list, known) -> Callable:
    """Signed changes that the ``made`` merges bring to pair counts, of ``known`` pairs and of new symbols.

    Only words that hold a merged pair are rewritten and counted, before and after.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, newest = known.value
        for sym, n in _blocks_of(batches):
            sym = _apply(sym, pending)
            word = np.cumsum(sym < 0) - 1
            touched = np.zeros(len(n), bool)
            starts = np.zeros(int(max(sym.max(initial=0), max(m[0] for m in made))) + 2, bool)  # the last one is for -1
            starts[[m[0] for m in made]] = True
            at = np.flatnonzero(starts[sym[:-1]])
            at = at[sym[at + 1] >= 0]
            pair = sym[at].astype(np.int64) << 32 | sym[at + 1]
            touched[word[at[np.isin(pair, [m[0] << 32 | m[1] for m in made])]]] = True
            if touched.any():
                old, own = sym[touched[word]], n[touched]
                (a, x), (b, y) = _pairs(old, own), _pairs(_apply(old, made), own)
                keys, counts = np.concatenate([a, b]), np.concatenate([-x, y])
                keep = (keys >> 32 >= newest) | (keys & 0xFFFFFFFF >= newest) | np.isin(keys, pairs)
                yield _summed(keys[keep], counts[keep])
    return run


def _rewritten(pending: list) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sym, n in _blocks_of(batches):
            yield _block(_apply(sym, pending), n)
    return run


Place = tuple[int, int, int]  # (-count, left, right): pairs come in ascending order


def _next_merges(leading: dict[int, int], last: Place, most: int, min_count: int) -> list[Merge]:
    """The pairs that would be taken one after another, as far as these counts tell.

    ``leading`` has every pair up to ``last``. Merging (a, b) leaves the count of another pair alone unless
    the two can overlap, that is unless one's right symbol is the other's left. A pair that it creates stands
    where (x, a) or (b, y) stood and counts at most as much; so the next pair in order is safe while it counts
    more than each of those. A pair of one symbol twice ends the round.
    """
    best = heapq.nsmallest(ROUND_PAIRS, ((-c, k >> 32, k & 0xFFFFFFFF) for k, c in leading.items() if c >= min_count))
    cut = best[-1][0] if len(best) == ROUND_PAIRS else 0
    taken: list[Merge] = []
    lefts: set[int] = set()
    rights: set[int] = set()
    for k, (negative, left, right) in enumerate(best):
        if len(taken) == most or (negative, left, right) > last or taken and negative >= cut:
            break
        if left in rights or right in lefts:
            break
        ties = (p for p in best[k + 1:] if p[0] == negative)
        if any(r in lefts or x in rights for _, x, r in ties):
            break
        taken.append((left, right))
        lefts.add(left)
        rights.add(right)
        if left == right:
            break
    return taken


def _leading(blocks: DataFrame, pending: list) -> tuple[dict[int, int], Place]:
    """The FRONTIER pairs that come first, and the last of them; with all pairs, a place after every pair."""
    rows = (blocks.mapInArrow(_counted(pending), "pair long, d long").groupBy("pair").agg(F.sum("d").alias("d"))
            .orderBy(F.col("d").desc(), "pair").limit(FRONTIER).collect())
    end = rows[-1] if len(rows) == FRONTIER else None
    return {r["pair"]: r["d"] for r in rows}, (-end["d"], end["pair"] >> 32, end["pair"] & 0xFFFFFFFF) if end else (0, 0, 0)


def learn_merges(df: DataFrame, text_col: str = "text", num_merges: int = 100,
                 min_count: int = 2, checkpoint_every: int = 16) -> list[Merge]:
    """Learn up to ``num_merges`` merges from a corpus (stops early when no pair
    reaches ``min_count``). Returns the ranked merge list.

    The distinct pre-tokens stay in the tasks as blocks of symbols. The driver holds the FRONTIER pairs of
    highest count; a round takes as many merges as their order is proven for (``_next_merges``), and its one
    job returns the signed changes of those pairs' counts and the pairs of new symbols that count no less than
    the frontier's last one. A pair's count rises in one round only, that of its newest symbol, so no pair from
    outside can come before it; when the best pair falls behind that place, all pairs are counted again.
    """
    blocks = cut_lineage(pretoken_table(df, text_col).select(F.encode("pretoken", "UTF-8"), "n")
                         .mapInArrow(_as_blocks, _BLOCK))
    spark = df.sparkSession
    merges: list[Merge] = []
    pending: list[tuple[int, int, int]] = []
    leading: dict[int, int] = {}
    last, rounds, known = (0, 0, 0), 0, None
    while len(merges) < num_merges:
        new = _next_merges(leading, last, num_merges - len(merges), min_count)
        if not new:
            if known is not None and -last[0] < min_count:
                break
            leading, last = _leading(blocks, pending)
            known = spark.sparkContext.broadcast((np.array(sorted(leading), np.int64), BASE_SYMBOLS + len(merges)))
            if not leading or max(leading.values()) < min_count:
                break
            continue
        made = [(a, b, BASE_SYMBOLS + len(merges) + k) for k, (a, b) in enumerate(new)]
        merges += new
        changes = (blocks.mapInArrow(_changed(pending, made, known), "pair long, d long")
                   .groupBy("pair").agg(F.sum("d").alias("d")).where((F.col("d") < 0) | (F.col("d") >= -last[0])).collect())
        for pair, d in changes:
            now = leading.get(pair, 0) + d
            if now > 0:
                leading[pair] = now
            else:
                leading.pop(pair, None)
        pending += made
        rounds += 1
        if rounds % checkpoint_every == 0:
            blocks, pending = cut_lineage(blocks.mapInArrow(_rewritten(pending), _BLOCK)), []
    return merges


def merges_frame(spark, merges: Sequence[Merge]) -> DataFrame:
    """<rank, left, right, token_id> for a merge list."""
    rows = [(r, int(a), int(b), BASE_SYMBOLS + r) for r, (a, b) in enumerate(merges)]
    return spark.createDataFrame(rows, "rank int, left bigint, right bigint, token_id bigint")


def token_table(spark, model: Model) -> DataFrame:
    """<token_id, hex, token> of every id; ``token`` in the printable alphabet (specials as they are)."""
    alphabet, special = byte_alphabet(), {i: t for t, i in model.special.items()}
    rows = [(i, b.hex().upper(), special.get(i) or "".join(alphabet[x] for x in b))
            for i, b in sorted(model.pieces().items())]
    return spark.createDataFrame(rows, "token_id bigint, hex string, token string")
