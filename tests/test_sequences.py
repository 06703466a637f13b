"""Q1-Q6, Q10-Q11 against literal arrays (FIXTURES section 4)."""

from pyspark.sql import functions as F

from wordmill.operators import sequences as seq

PAD = 50256


def test_windows_lengths(spark):
    rows = [(n, list(range(100, 100 + n))) for n in (0, 1, 4, 5, 7, 8)]
    df = spark.createDataFrame(rows, "n int, ids array<bigint>")
    got = sorted((r.n, r.start, list(r.input_ids), list(r.target_ids))
                 for r in seq.sliding_windows(df, "ids", 4, 3).collect())
    first = ([100, 101, 102, 103], [101, 102, 103, 104])
    assert got == [(5, 0, *first), (7, 0, *first), (8, 0, *first),
                   (8, 3, [103, 104, 105, 106], [104, 105, 106, 107])]


def test_pad_truncate(spark):
    rows = [(1, [1, 2]), (2, [1, 2, 3, 4]), (3, [1, 2, 3, 4, 5, 6]), (4, [])]
    df = spark.createDataFrame(rows, "id int, ids array<bigint>")
    out = {r.id: list(r.p) for r in df.select("id", seq.pad_truncate("ids", 4).alias("p")).collect()}
    assert out == {1: [1, 2, PAD, PAD], 2: [1, 2, 3, 4], 3: [1, 2, 3, 4], 4: [PAD] * 4}
    own = {r.id: list(r.p) for r in df.select("id", seq.pad_truncate("ids", 3, F.col("id") + 6).alias("p")).collect()}
    assert own == {1: [1, 2, 7], 2: [1, 2, 3], 3: [1, 2, 3], 4: [10, 10, 10]}
    longest = seq.pad_to_longest(df, "ids", None).collect()
    assert all(len(r.padded) == 6 and r.max_length == 6 for r in longest)


def test_collate_masks_and_cut(spark):
    batch = [[0, 1, 2, 3, 4], [5, 6], [7, PAD, 9], [1]]
    df = spark.createDataFrame([(i, 0, b) for i, b in enumerate(batch)],
                               "rid int, batch_id int, ids array<bigint>")
    whole = {r.rid: (list(r.input_ids), list(r.target_ids)) for r in seq.collate(df, "ids").collect()}
    assert whole == {
        0: ([0, 1, 2, 3, 4], [1, 2, 3, 4, PAD]), 1: ([5, 6, PAD, PAD, PAD], [6, PAD, -100, -100, -100]),
        2: ([7, PAD, 9, PAD, PAD], [PAD, 9, -100, -100, -100]), 3: ([1, PAD, PAD, PAD, PAD], [PAD, -100, -100, -100, -100])}
    cut = {r.rid: (list(r.input_ids), list(r.target_ids))
           for r in seq.collate(df, "ids", allowed_max_length=3).collect()}
    assert cut == {i: (x[:3], y[:3]) for i, (x, y) in whole.items()}


def test_last_n_and_classifier_input(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5],), ([1],)], "ids array<bigint>")
    r = df.select(seq.last_n("ids", 3).alias("x")).collect()
    assert [list(x.x) for x in r] == [[3, 4, 5], [1]]
    r = df.select(seq.classifier_input("ids", 4, 2).alias("x")).collect()
    assert [list(x.x) for x in r] == [[1, 2, PAD, PAD], [1, PAD, PAD, PAD]]


def test_pad_to_split_longest(spark):
    df = spark.createDataFrame([("train", [1, 2, 3]), ("test", [1, 2, 3, 4, 5]), ("test", [9])],
                               "split string, ids array<bigint>")
    out = seq.pad_to_split_longest(df, "ids").select("split", "padded").collect()
    assert sorted(list(r.padded) for r in out) == sorted([[1, 2, 3], [1, 2, 3], [9, PAD, PAD]])
