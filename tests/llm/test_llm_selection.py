"""Importance resampling, document fingerprints and the filter audit against brute force on small, awkward tables."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from wordmill.llm import filter_audit, fingerprints, resample

LONG = "Fifty thousand Words of improbable prose & nothing else, " * 9000
PROSE = [" ".join(f"w{(i * j) % 37}x" for j in range(15 + i)) for i in range(12)]
TEXTS = ["", None, "Hello World", "hello world", "ÉCOLE straße", "a", " \t\n", LONG, "😀 emoji\x00nul", "x" * 300, *PROSE,
         PROSE[3], "SHOUT " * 120, "one two " * 60, " ".join(f"word{i}" for i in range(150)) + " $"]
# a repeated row, repeated ids with other texts, null ids, one of them with a text of an id
ROWS = ([(i, t, ("en", "de", None, "")[i % 4]) for i, t in enumerate(TEXTS)]
        + [(2, "Hello World", "en"), (12, PROSE[2], "de"), (12, LONG + "!", "de"), (None, PROSE[4], "en"),
           (None, LONG, None), (None, None, "fr"), (-5, PROSE[5], "en")])
SCHEMA = ("doc_id long, text string, lang string, part string, pos long, digest string, mask int, n long, good int,"
          " _part int, _row long, rank long, `class` string, _text string, _kind string, score string, digit int, chunk int")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, "d", 2, 3, 4, 5, 6, 7, "c", "t", "k", "s", 8, 9) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# importance resampling -----------------------------------------------------------------------

def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def grams_of(text, width=2):
    words = words_of(text)
    return [" ".join(words[i:i + n]) for n in range(1, width + 1) for i in range(len(words) - n + 1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZ9 -éß😀\0\n"), max_size=40), max_size=6), st.integers(1, 4), st.sampled_from([7, 10_000]))
def test_features_are_hashed_word_runs(texts, width, buckets):
    texts = [*texts, "y" * 200 + " b " + "z" * 65]
    found, of, words = resample.features([t.encode() for t in texts], width, buckets)
    want = collections.Counter((i, zlib.crc32(g.encode()) % buckets) for i, t in enumerate(texts) for g in grams_of(t, width))
    assert collections.Counter(zip(of.tolist(), found.tolist())) == want
    assert words.tolist() == [len(words_of(t)) for t in texts]


def brute_resample(rows, target, percent=25, min_words=20, buckets=10_000, seed=7):
    def bucket(g):
        return zlib.crc32(g.encode()) % buckets
    s = collections.Counter(bucket(g) for _, t, _ in rows for g in grams_of(t))
    t = collections.Counter(bucket(g) for x in target for g in grams_of(x))
    s_all, t_all = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    out = []
    for doc_id, text, _ in rows:
        g = grams_of(text)
        weight = sum(gain(bucket(x)) for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(g), weight, score, None, len(words_of(text)) >= min_words])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return collections.Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("percent", [25, 100, 0])
def test_resample_draws_what_brute_force_draws(spark, docs, percent):
    target = spark.createDataFrame([(1, PROSE[7] + " hello world"), (2, None), (3, "w3x w5x w6x")], "item_id long, text string")
    got = collections.Counter(map(tuple, resample.resample(docs, target, percent=percent).collect()))
    assert got == brute_resample(ROWS, [r["text"] for r in target.collect()], percent)


def test_resample_of_unique_ids_and_of_nothing(spark, nothing):
    rows = [(i * 7919 - 40_000, PROSE[i % 12] + f" w{i}", "en") for i in range(300)]
    target = spark.createDataFrame([(PROSE[0],)], "text string")
    got = collections.Counter(map(tuple, resample.resample(frame(spark, rows), target).collect()))
    assert got == brute_resample(rows, [PROSE[0]])
    assert resample.resample(nothing, target).count() == 0
    none = resample.resample(frame(spark, rows[:20]), target.limit(0)).collect()
    assert sorted(r["rank"] for r in none if r["rank"]) == [1, 2, 3, 4, 5][:25 * sum(
        len(words_of(t)) >= 20 for _, t, _ in rows[:20]) // 100]


@pytest.mark.parametrize("chunk", [1, 7, 5000])
def test_radix_sort(spark, chunk):
    rows = [(i, (i * 48271) % 513, (i * i) % 3 or -1) for i in range(400)]  # -1 is the largest unsigned key
    frame_ = spark.createDataFrame(rows, "i long, a long, b long").repartition(5)
    got = resample.radix_sort(frame_, [("i", 9), ("a", 10), ("b", 64)], digit_bits=11, chunk=chunk).collect()
    want = sorted(rows, key=lambda r: (r[2] % 2**64, r[1], r[0]))
    assert [tuple(r[:3]) for r in sorted(got, key=lambda r: r["pos"])] == want
    assert sorted(r["pos"] for r in got) == list(range(400))


# fingerprints --------------------------------------------------------------------------------

def brute_class(window):
    c = collections.Counter(window).values()
    top = round(len(window) * math.log2(len(window)) * (1 << 20))
    return fingerprints.BINS * (top - sum(round(x * np.log2(x) * (1 << 20)) for x in c)) // top


def brute_selected(text, ranks):
    w, run = fingerprints.WINDOW, fingerprints.RUN
    keys = [(ranks[brute_class(text[i:i + w])], i) for i in range(len(text) - w + 1)]
    if len(keys) < run:
        return list(range(len(keys)))
    points = collections.Counter(min(keys[i:i + run])[1] for i in range(len(keys) - run + 1))
    most = max(points.values())
    return sorted(i for i, p in points.items() if p >= fingerprints.POINTS) or [min(i for i in points if points[i] == most)]


def test_selected_windows_are_those_of_brute_force():
    rng = np.random.default_rng(3)
    ranks = rng.permutation(fingerprints.BINS + 1)
    texts = [bytes(rng.integers(97, 97 + k, n).astype(np.uint8)) for k in (1, 3, 20) for n in (0, 1, 7, 8, 9, 23, 24, 150)]
    data, starts, size = fingerprints._joined(texts)
    at = fingerprints.selected(data, starts, size, ranks)
    want = [s + i for t, s in zip(texts, starts) if len(t) >= fingerprints.WINDOW for i in brute_selected(t, ranks)]
    assert at.tolist() == want
    alone = [fingerprints.filters_of([t], ranks)[0] for t in texts]
    for a, b in zip(fingerprints.filters_of(texts, ranks), alone):
        assert np.array_equal(a, b) and np.array_equal(fingerprints.read(fingerprints.written(a)), a)


def test_class_counts_cover_every_window(spark):
    texts = ["the quick brown fox", "short", "", None, "aaaaaaaaaaaaaaaaaaa", "ünïcödé text of bytes"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    counts = collections.Counter(brute_class(t.encode()[i:i + 8]) for t in texts if t for i in range(len(t.encode()) - 7))
    order = sorted(range(fingerprints.BINS + 1), key=lambda c: (c < fingerprints.DULL, counts[c], c))
    assert np.argsort(fingerprints.rarity_ranks(docs)).tolist() == order


def test_fingerprints_of_texts_and_edits(docs):
    got = collections.Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in fingerprints.fingerprints(docs).collect())
    rows = sorted(((i, t or "") for i, t, _ in ROWS),
                  key=lambda r: (r[0] is None, -(r[0] or 0), np.uint64(xxhash.xxh64_intdigest(r[1], 42)).astype(np.int64)))
    want = collections.Counter()
    for k, (i, t) in enumerate(rows):
        half, after = len(t) // 2, rows[(k + 1) % len(rows)][1]
        want[i, len(t), hashlib.sha256((t[:len(t) - half] + after[:half]).encode()).hexdigest()] += 1
    assert got == want


def test_fingerprints_tell_edits_from_strangers(spark):
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(4000)]
    texts = [" ".join(rng.choice(words, n)) for n in rng.integers(30, 900, 60)] + ["same text " * 30] * 2 + ["", None, "", "ab"]
    docs = frame(spark, [(i, t, "en") for i, t in enumerate(texts)]).repartition(4)
    rows = {r["doc_id"]: r for r in fingerprints.fingerprints(docs).collect()}
    assert len(rows) == len(texts)
    ranks = fingerprints.rarity_ranks(docs)
    for i, t in enumerate(texts):
        after = (texts[i - 1] or "").encode()
        mine, theirs = fingerprints.filters_of([(t or "").encode(), after], ranks)
        assert rows[i]["fingerprint"] == fingerprints.written(mine)
        assert rows[i]["near_next"] == pytest.approx(fingerprints.likeness(mine, theirs))
    assert all(rows[i]["near_edited"] > 0.3 > 0.15 > rows[i]["near_next"] for i in range(1, 60))
    assert rows[61]["near_next"] == 1 and rows[60]["fingerprint"] == rows[61]["fingerprint"]
    assert rows[63]["near_next"] == 1 and rows[65]["near_next"] == 0 and rows[64]["fingerprint"] == "0:"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=2, max_size=2))
def test_likeness_is_symmetric_and_bounded(seeds):
    a, b = (np.packbits(np.random.default_rng(s).random((1 + s % 3, 2048)) < 0.2, axis=1) for s in seeds)
    assert fingerprints.likeness(a, b) == pytest.approx(fingerprints.likeness(b, a))
    assert 0 <= fingerprints.likeness(a, b) <= 1 and fingerprints.likeness(a, a) == 1


def test_fingerprints_of_one_row_and_none(spark, nothing):
    assert fingerprints.fingerprints(nothing).count() == 0
    one = fingerprints.fingerprints(frame(spark, [(None, "only this text is here, twice", None)])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0 and one[0]["n_chars"] == 29


# filter audit --------------------------------------------------------------------------------

def test_removal_intervals_are_the_orders_themselves():
    for k in (1, 3, 5):
        orders = list(itertools.permutations(range(k)))
        assert [filter_audit.lehmer_rank(p) for p in orders] == list(range(len(orders)))
        got = collections.Counter()
        for mask, step, start, end in filter_audit.removal_intervals(k):
            got.update((mask, step, r) for r in range(start, end))
        want = collections.Counter((m, next(s + 1 for s, x in enumerate(p) if m >> x & 1), r)
                                   for m in range(1, 1 << k) for r, p in enumerate(orders))
        assert got == want


def failed(row, rows):
    i, t = row[0], row[1] or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    return "".join(f for f, bad in (
        ("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)),
        ("C", 100 * len(re.findall("[A-Z]", t)) > 10 * len(t)), ("D", re.search("[#$%&*|]", t)),
        ("E", i is not None and any(j is not None and j < i and (x or "") == t for j, x, _ in rows))) if bad)


def test_audit_is_that_of_applying_every_order(spark, docs):
    marks = [(0, 1, 0), (2, 1, 1), (7, 0, 1), (7, 1, None), (12, 1, 1), (15, None, 1), (22, 1, 0), (None, 1, 1), (-5, 0, 0)]
    labels = spark.createDataFrame([(*m, "g", 1) for m in marks], "doc_id long, quality int, toxic int, good string, n long")
    good = {i for i, q, _ in marks if q == 1 and i is not None}
    toxic = {i for i, _, x in marks if x == 1 and i is not None}
    want, removed_by = {}, collections.Counter()
    for part in {r[2] or "" for r in ROWS}:
        mine = [(r[0], failed(r, ROWS)) for r in ROWS if (r[2] or "") == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                removed_by[part, letter] += len(gone)
                want[part, order, step] = [
                    len(left), len(gone), sum(letter in f for _, f in mine) - len(gone), sum(f == letter for _, f in mine),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
    got = filter_audit.audit(docs, labels).collect()
    assert len(got) == len(want)
    for r in got:
        assert list(r[3:9]) == want[r["part"], r["filter_order"], r["step"]]
        assert r["shapley"] == removed_by[r["part"], r["filter_order"][r["step"] - 1]]


def test_audit_of_nothing(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(nothing, labels).count() == 0
