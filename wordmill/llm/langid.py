"""Language identification by multilingual mixture inference.

A document is a mixture of languages. Every byte position has a likelihood under each language's
character n-gram model (byte trigrams of the lower-cased letters, add-alpha smoothed); positions sum to words.
Expectation-maximisation estimates the document's language proportions from the word likelihoods,
and the language set is selected by penalised likelihood: starting from the best single language, the
next one is added only while it raises the log-likelihood by more than ``penalty * log(words + 1)``.
One more component, under which every trigram is equally likely, stands for words of no learned
language. The predicted language has the largest proportion; ties go to the first name.
``score`` is the mean responsibility of that language over the document's words, ``noise`` that of no language.

The models are learned from all training rows: trigram counts are summed in each task, then shuffled.
A model is 65,536 hashed trigrams a language, so what is broadcast is bounded by the number of
languages; more than ``MAX_LANGUAGES`` is an error.

Defined results: null texts and texts without a letter are ``und`` with score 0. With no training
row every text is ``und``. Rows with a null lang or null doc_id teach nothing. Repeated rows count as often
as they occur.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import native, slices, text_bytes

BINS = 1 << 16
MAX_LANGUAGES = 400
UND = "und"
_LETTER = re.compile(r"[^\W\d_]")
#: Letters stay, all else is a space: ASCII letters and the bytes of non-ASCII characters.
_TABLE = bytes(b if chr(b).isalpha() and b < 128 or b >= 128 else 32 for b in range(256))


def _norm(text: bytes) -> bytes:
    """Lower-cased letters with one space around every text (a null text has no bytes)."""
    low = text.lower() if text.isascii() else text.decode("utf-8", "ignore").lower().encode()
    return b" " + low.translate(_TABLE) + b" "


def _codes(data: np.ndarray) -> np.ndarray:
    """Bin of the trigram that ends at each position from the third on."""
    x = data.astype(np.uint32)
    x = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return ((x * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def _counts(batches):
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch, "text"):
            langs = part.column(1).to_pylist()
            texts = text_bytes(part, "text")
            for lang in sorted(set(langs)):
                data = np.frombuffer(b"".join(_norm(t) for t, x in zip(texts, langs) if x == lang), np.uint8)
                codes = _codes(data)
                codes = codes[data[2:] != 32] if len(codes) else codes
                totals[lang] = totals.get(lang, 0) + np.bincount(codes, minlength=BINS)
    for lang, counts in totals.items():
        bins = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(bins), pa.string()), pa.array(bins, pa.int32()),
                                          pa.array(counts[bins], pa.int64())], ["lang", "bin", "n"])


def learn(train: DataFrame, alpha: float = 0.05) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities [bin, language or none]) from every row of ``train(text, lang)``."""
    rows = native(train, "lang", "text").where("lang is not null").select(
        F.col("lang").cast("string"), F.col("text").cast("string"))
    counted = rows.select("lang", "text").mapInArrow(
        lambda batches: _counts(b.select(["text", "lang"]) for b in batches), "lang string, bin int, n long")
    table = counted.groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    per_lang = (table.groupBy("lang").agg(F.collect_list(F.struct("bin", "n")).alias("bins"))
                .limit(MAX_LANGUAGES + 1).orderBy("lang").collect())
    if len(per_lang) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((BINS, len(per_lang)))
    for k, row in enumerate(per_lang):
        counts[[b.bin for b in row.bins], k] = [b.n for b in row.bins]
    logs = np.log((counts + alpha) / (counts.sum(0) + alpha * BINS))
    uniform = np.full((BINS, 1), -np.log(BINS))
    return [r.lang for r in per_lang], np.hstack([logs, uniform]).astype(np.float32)


def mixtures(loglik: np.ndarray, first: np.ndarray, penalty: float = 4.0, rounds: int = 8):
    """(proportions [doc, language], mean responsibilities) by EM with penalised choice of the set.

    ``loglik`` is [word, language]; document d owns the words from ``first[d]`` to ``first[d + 1]``
    (at least one).
    """
    n_docs, n_langs = len(first), loglik.shape[1]
    words = np.diff(np.r_[first, len(loglik)])
    doc = np.repeat(np.arange(n_docs), words)
    top = loglik.max(1, keepdims=True)
    rel = np.maximum(loglik - top, -60.0).astype(np.float64)
    single = np.add.reduceat(rel, first, 0)
    lik = np.exp(rel)
    chosen = np.zeros((n_docs, n_langs), bool)
    chosen[np.arange(n_docs), single.argmax(1)] = True
    value = single.max(1)
    share = chosen.astype(float)

    def fit(sets, docs):
        """EM over the documents ``docs`` only."""
        rows = np.flatnonzero(np.isin(doc, docs)) if len(docs) < n_docs else np.arange(len(doc))
        part, local = lik[rows], np.searchsorted(docs, doc[rows])
        at = np.r_[0, np.cumsum(words[docs])[:-1]]
        pi = sets / sets.sum(1, keepdims=True)
        for _ in range(rounds):
            joint = part * pi[local]
            pi = np.add.reduceat(joint / np.maximum(joint.sum(1, keepdims=True), 1e-300), at, 0) / words[docs][:, None]
        total = np.add.reduceat(np.log(np.maximum((part * pi[local]).sum(1), 1e-300)), at)
        return pi, total

    open_docs = np.arange(n_docs)
    for _ in range(n_langs - 1):  # add the language that explains most of what the set explains badly
        if not len(open_docs):
            break
        pi = share / share.sum(1, keepdims=True)
        now = np.maximum((lik * pi[doc]).sum(1), 1e-300)
        gain = np.add.reduceat(np.log1p(0.2 * (lik / now[:, None] - 1)), first, 0)
        gain[chosen] = -np.inf
        best = gain.argmax(1)
        hope = open_docs[gain[open_docs, best[open_docs]] > 0]
        if not len(hope):
            break
        sets = chosen[hope].astype(float)
        sets[np.arange(len(hope)), best[hope]] = 1
        pi, total = fit(sets, hope)
        better = total > value[hope] + penalty * np.log(words[hope] + 1)
        open_docs = hope[better]
        chosen[open_docs, best[open_docs]] = True
        share[open_docs], value[open_docs] = pi[better], total[better]
    joint = lik * (share / share.sum(1, keepdims=True))[doc]
    resp = joint / np.maximum(joint.sum(1, keepdims=True), 1e-300)
    return share, np.add.reduceat(resp, first, 0) / words[:, None]


_PREDICTED = ["doc_id", "lang_pred", "score", "lang_set", "noise", "fit", "n_words"]


def _predictor(model, penalty: float):
    def run(batches):
        langs, logs = model.value
        for batch in batches:
            for part in slices(batch, "text"):
                texts = text_bytes(part, "text")
                has = [bool(langs) and bool(_LETTER.search(t.decode("utf-8", "ignore"))) for t in texts]
                names, scores, sets = [UND] * len(texts), [0.0] * len(texts), [[] for _ in texts]
                noise, fits, n_words = ([0.0] * len(texts) for _ in range(3))
                rows = [i for i, x in enumerate(has) if x]
                if rows:
                    norm = [_norm(texts[i]) for i in rows]
                    data = np.frombuffer(b"".join(norm), np.uint8)
                    letter = data != 32
                    begin = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
                    ends = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
                    codes = np.r_[0, 0, _codes(data)]
                    spot = np.flatnonzero(letter)  # no word is without a letter, so each has a position
                    at = np.cumsum(ends - begin) - (ends - begin)
                    loglik = np.add.reduceat(logs[codes[spot]], at, 0)
                    first = np.searchsorted(begin, np.cumsum([0, *(len(t) for t in norm)])[:-1])
                    share, resp = mixtures(loglik, first, penalty)
                    real = share[:, :-1]
                    # where no language is in the set, the likeliest one alone is named
                    alone = np.add.reduceat(loglik[:, :-1], first, 0).argmax(1)
                    best = np.where(real.max(1) > 0, real.argmax(1), alone)
                    named = real > 0
                    named[np.arange(len(rows)), best] = True
                    doc = np.repeat(np.arange(len(rows)), np.diff(np.r_[first, len(loglik)]))
                    own = np.where(named[doc], loglik[:, :-1], -np.inf).max(1) / (ends - begin)
                    rising = np.lexsort((own, doc))
                    upto = np.r_[0, np.cumsum((ends - begin)[rising])]
                    count = np.diff(np.r_[first, len(loglik)])
                    middle = own[rising][np.searchsorted(upto, (upto[first] + upto[first + count]) / 2) - 1]
                    for k, i in enumerate(rows):
                        names[i], scores[i] = langs[best[k]], float(min(1.0, resp[k, best[k]]))
                        sets[i] = [langs[x] for x in np.flatnonzero(real[k] > 0)]
                        noise[i] = float(min(1.0, resp[k, -1]))
                        fits[i], n_words[i] = float(middle[k]), float(count[k])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                     pa.array(sets, pa.list_(pa.string())),
                     *(pa.array(x, pa.float64()) for x in (noise, fits, n_words))], _PREDICTED)
    return run


def held_out(doc_id: Column) -> Column:
    """True for the documents that teach nothing: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], penalty: float = 4.0) -> DataFrame:
    """doc_id, lang_pred, score, lang_set, noise, fit, n_words of every row of ``docs(doc_id, text)``.

    fit: median over the words, weighted by their bytes, of the log-likelihood of a byte under the likeliest
    language of the set.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    narrow = native(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(_predictor(held, penalty), "doc_id long, lang_pred string, score double, lang_set array<string>,"
                             " noise double, fit double, n_words double")


def identify(docs: DataFrame, penalty: float = 4.0) -> DataFrame:
    """doc_id, held_out, lang_pred, score, lang_set, noise; learned from the rows that aren't held out."""
    train = docs.where(docs["doc_id"].isNotNull() & ~held_out(docs["doc_id"]))
    out = predict(docs, learn(train), penalty)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "lang_set", "noise")


def floors(known: DataFrame, model: tuple[list[str], np.ndarray], far: float = 2.0, least: float = 1.0) -> dict[str, float]:
    """The fit that long documents of each language may not fall short of, from rows of learned languages.

    ``known(doc_id, text)`` taught nothing. The floor lies below its language's median fit by ``far`` times
    the widest gap of any language between median and first percentile, taken as ``least`` nats at least;
    a language without a row has the lowest of all floors. No row at all: no floor.
    """
    fits = predict(known, model).where(F.col("lang_pred") != UND).groupBy("lang_pred").agg(
        F.percentile_approx("fit", [0.01, 0.5], 10_000).alias("q")).collect()  # a row per language
    if not fits:
        return {}
    gap = max(least, *(r["q"][1] - r["q"][0] for r in fits))
    floor = {r["lang_pred"]: r["q"][1] - far * gap for r in fits}
    return {lang: floor.get(lang, min(floor.values())) for lang in model[0]}


def drop_rejected(docs: DataFrame, max_noise: float = 0.5, spare: float = 4.0, doubt: float = 2.5) -> DataFrame:
    """``docs`` without what is ``und`` or in no learned language.

    That is, a text of more than 2 * ``spare`` words whose fit is below the floor of its language (see ``floors``;
    from the held-out rows with a lang) by more than ``doubt`` over the root of its words; or, where no
    language has a floor, one with more than ``max_noise`` of its words, and ``spare`` words beyond, under the
    component for no language.

    Decided row by row in one pass over the texts, so repeated ids and null ids need no join.
    """
    out = F.coalesce(held_out(docs["doc_id"]), F.lit(False))
    model = learn(docs.where(docs["doc_id"].isNotNull() & ~out))
    low = floors(docs.where(out & docs["lang"].isNotNull()), model)
    held = docs.sparkSession.sparkContext.broadcast((model, low))

    def run(batches):
        judge = _predictor(_Held(held.value[0]), 4.0)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column(part.schema.get_field_index("text"))
                pair = pa.RecordBatch.from_arrays([pa.nulls(part.num_rows, pa.int64()), texts], ["doc_id", "text"])
                got = pa.Table.from_batches(judge([pair])).to_pydict()
                n = np.array(got["n_words"])
                noisy = np.array(got["noise"]) * n > max_noise * n + spare
                below = np.array(got["fit"]) - [held.value[1].get(x, np.inf) for x in got["lang_pred"]]
                strange = np.isfinite(below) & (below < -doubt / np.sqrt(np.maximum(n, 1)))
                bad = noisy & np.isneginf(below) | strange & (n > 2 * spare)
                yield part.filter(pa.array([n != UND and not x for n, x in zip(got["lang_pred"], bad)], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


class _Held:
    """A value in the place of a broadcast one."""

    def __init__(self, value):
        self.value = value
