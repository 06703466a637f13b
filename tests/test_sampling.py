"""D1-D8 and the partition-independence of every seeded order."""

import hashlib

from pyspark.sql import functions as F

from wordmill.operators import sampling as smp
from wordmill.operators.indexing import hash_index, sorted_index


def py_order(ids, seed=123):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


def test_hash_index_matches_python_and_is_partition_free(spark, partitions):
    ids = list(range(0, 3000, 7))
    expect = {i: k for k, i in enumerate(py_order(ids))}
    for n in (1, 4, 64):
        partitions(n)
        df = spark.createDataFrame([(i,) for i in ids], "id long")
        got = {r.id: r.idx for r in hash_index(df, "id", 123, digits=2).collect()}
        assert got == expect


def test_sorted_index(spark):
    df = spark.createDataFrame([(w,) for w in ["b", "a", "d", "c", "aa"]], "w string")
    got = {r.w: r.idx for r in sorted_index(df, "w").collect()}
    assert got == {"a": 0, "aa": 1, "b": 2, "c": 3, "d": 4}


def _labels(spark, rows):
    return spark.createDataFrame(rows, "id long, label string")


def test_balance_cases(spark):
    eq = _labels(spark, [(i, "spam" if i % 2 else "ham") for i in range(10)])
    assert smp.balance(eq, "label", "id", classes=["ham", "spam"]).count() == 10
    missing = _labels(spark, [(i, "ham") for i in range(5)])
    assert smp.balance(missing, "label", "id", classes=["ham", "spam"]).count() == 0
    third = _labels(spark, [(1, "ham"), (2, "ham"), (3, "spam"), (4, "other")])
    out = smp.balance(third, "label", "id", classes=["ham", "spam"]).collect()
    assert sorted(r.label for r in out) == ["ham", "spam"]
    one = _labels(spark, [(1, "ham")])
    assert smp.balance(one, "label", "id").count() == 1
    big = _labels(spark, [(i, "ham") for i in range(30)] + [(100 + i, "spam") for i in range(7)])
    out = smp.balance(big, "label", "id", classes=["ham", "spam"]).collect()
    hams = sorted(r.id for r in out if r.label == "ham")
    assert len(hams) == 7 and hams == sorted(py_order(list(range(30)))[:7])


def test_random_split_bounds(spark):
    for n, (tr, va) in {0: (0, 0), 1: (0, 0), 10: (7, 7), 1000: (700, 799)}.items():
        df = spark.createDataFrame([(i,) for i in range(n)], "id long")
        out = smp.random_split(df, "id").groupBy("split").count().collect()
        sizes = {r.split: r["count"] for r in out}
        assert sizes.get("train", 0) == tr
        assert sizes.get("validation", 0) == va - tr
        assert sizes.get("test", 0) == n - va


def test_ordered_split(spark):
    for n, (tr, te, va) in {20: (17, 2, 1), 1100: (935, 110, 55)}.items():
        df = spark.createDataFrame([(i,) for i in range(n)], "id long")
        out = smp.ordered_split(df, "id").collect()
        sizes = {}
        for r in out:
            sizes[r.split] = sizes.get(r.split, 0) + 1
        assert (sizes["train"], sizes["test"], sizes["validation"]) == (tr, te, va)
        firsts = {s: min(r.id for r in out if r.split == s) for s in sizes}
        assert firsts == {"train": 0, "test": tr, "validation": tr + te}


def test_batches_and_first_batches(spark):
    df = spark.createDataFrame([(i,) for i in range(19)], "idx long")
    b = smp.assign_batches(df.withColumn("n", F.lit(19)), "idx", 8, drop_last=True, total_col="n")
    assert sorted({r.batch_id for r in b.collect()}) == [0, 1]
    b2 = smp.assign_batches(df, "idx", 8)
    assert smp.first_batches(b2, "batch_id", 2).count() == 16
    x = spark.range(1).select(smp.num_batches(F.lit(19), 8, True).alias("a"),
                              smp.num_batches(F.lit(19), 8, False).alias("b")).first()
    assert (x.a, x.b) == (2, 3)


def test_char_split(spark):
    df = spark.createDataFrame([(1, "abcdefghij"), (2, "é" * 7), (3, "")], "id int, text string")
    out = {r.id: (r.train_text, r.val_text) for r in smp.char_split(df, "text", 0.9).collect()}
    assert out == {1: ("abcdefghi", "j"), 2: ("é" * 6, "é"), 3: ("", "")}
