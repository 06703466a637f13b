"""S1-S7 write/read invariants, ST1-ST2 batch equivalence, L1-L3."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from wordmill.operators import learning as ml
from wordmill.sources import files as io
from wordmill.streaming import ingest as st

TRICKY = [("ham", 'He said "hi", then left'), ("spam", "line1\nline2, with comma"), ("ham", "NA"),
          ("spam", '"quoted at start'), ("ham", "tab\tinside")]


def test_csv_round_trips(spark):
    df = spark.createDataFrame(TRICKY, "Label string, Text string")
    p = io.scratch_path(spark, "t-tsv")
    io.write_labelled_tsv(df, p)
    assert sorted(io.read_labelled_tsv(spark, p).collect()) == sorted(df.collect())
    sp = spark.createDataFrame([(1 if l == "spam" else 0, t, "train" if i % 2 else "test")
                                for i, (l, t) in enumerate(TRICKY)], "Label int, Text string, split string")
    p2 = io.scratch_path(spark, "t-csv")
    io.write_split_csv(sp, p2)
    back = io.read_split_csv(spark, p2 + "/split=train").collect()
    assert sorted(back) == sorted((r.Label, r.Text) for r in sp.collect() if r.split == "train")


def test_json_arrays_and_lines(spark):
    df = spark.createDataFrame([("a", "", "x"), ("b", "in", "y\nz")], "instruction string, input string, output string")
    p = io.scratch_path(spark, "t-json")
    io.write_json_arrays(df, p)
    assert sorted(io.read_json_records(spark, p).collect()) == sorted(df.collect())
    p2 = io.scratch_path(spark, "t-jsonl")
    io.write_json_records(df, p2)
    assert sorted(spark.read.schema(io.INSTRUCTION_SCHEMA).json(p2).collect()) == sorted(df.collect())


def test_whole_text_and_skip_existing(spark):
    d = tempfile.mkdtemp(prefix="wm-text-")
    with open(os.path.join(d, "story.txt"), "w", encoding="utf-8") as f:
        f.write("line one\n\nline three")
    rows = io.read_whole_text(spark, d).collect()
    assert len(rows) == 1 and rows[0].text == "line one\n\nline three"
    p = io.scratch_path(spark, "t-ignore")
    io.write_if_absent(spark.createDataFrame([(1,)], "x int"), p)
    io.write_if_absent(spark.createDataFrame([(2,)], "x int"), p)
    assert [r.x for r in spark.read.parquet(p).collect()] == [1]


def test_merge_list_and_vocab_json(spark):
    d = tempfile.mkdtemp(prefix="wm-model-")
    with open(os.path.join(d, "vocab.json"), "w") as f:
        f.write('{"a": 0, "b": 1, "ab": 256}')
    with open(os.path.join(d, "merges.txt"), "w") as f:
        f.write("#version: 0.2\na b\nab c\n")
    v = {r.token: r.token_id for r in io.read_vocab_json(spark, d + "/vocab.json").collect()}
    assert v == {"a": 0, "b": 1, "ab": 256}
    m = sorted(tuple(r) for r in io.read_merge_list(spark, d + "/merges.txt").collect())
    assert m == [(0, "a", "b"), (1, "ab", "c")]


def test_stream_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="wm-src-")
    df = spark.createDataFrame([(i, f"doc {i} text") for i in range(50)], "doc_id long, text string")
    df.write.mode("overwrite").parquet(src + "/a")
    sink, ck = io.scratch_path(spark, "t-sink"), io.scratch_path(spark, "t-ck")
    fn = lambda x: x.select("doc_id", F.length("text").alias("n"))
    out = st.ingest(st.stream_files(spark, src + "/a", df.schema), fn, sink, ck)
    assert sorted(out.collect()) == sorted(fn(df).collect())
    again = st.ingest(st.stream_files(spark, src + "/a", df.schema), fn, sink, ck)
    assert again.count() == 50  # finished files are not read again


def test_every_file_of_a_slow_stream_arrives(spark):
    src = tempfile.mkdtemp(prefix="wm-many-")
    df = spark.range(0, 1200, 1, 12).withColumnRenamed("id", "doc_id")
    df.write.mode("overwrite").parquet(src + "/a")
    stream = st.stream_files(spark, src + "/a", df.schema, max_files_per_trigger=1)
    out = st.ingest(stream, lambda x: x, io.scratch_path(spark, "t-sink"), io.scratch_path(spark, "t-ck"))
    assert out.count() == 1200
    with pytest.raises(TimeoutError):
        st.ingest(stream, lambda x: x, io.scratch_path(spark, "t-sink"), io.scratch_path(spark, "t-ck"), timeout_s=0.2)


def _write_lines(spark, folder, rows):
    lines = [(r, i, json.dumps({"message": {"content": c}, "done": done})) for r, i, c, done in rows]
    spark.createDataFrame(lines, "rid long, line_no long, json string").coalesce(1).write.mode("append").parquet(folder)


def test_stream_reassembly_over_micro_batches_and_a_restart(spark):
    src, sink, ck = (io.scratch_path(spark, x) for x in ("t-lines", "t-rs", "t-rck"))
    schema = "rid long, line_no long, json string"

    def run(**kw):
        out = st.reassemble_stream(st.stream_files(spark, src, schema, max_files_per_trigger=1), "rid", "line_no", "json", sink, ck, **kw)
        return sorted(map(tuple, out.collect()))
    _write_lines(spark, src, [(1, 2, "c", False), (1, 1, "b", False), (2, 1, "x", False)])
    _write_lines(spark, src, [(1, 0, "a", False), (3, 0, "whole", True), (3, 1, "late", False)])
    assert run() == [(1, "abc", False), (2, "x", False), (3, "whole", True)]
    # a restart goes on from the open replies; what follows a done line belongs to nothing
    _write_lines(spark, src, [(1, 4, "e", True), (1, 3, "d", False), (1, 5, "f", False), (3, 2, "later", True)])
    _write_lines(spark, src, [(2, 0, "w", False), (1, 6, "g", True)])
    want = [(1, "abcde", True), (2, "wx", False), (3, "whole", True)]
    assert run() == want and run() == want  # the last run finds no new line
    state = spark.read.format("statestore").load(ck).select("key.rid", "value.groupState.*").collect()
    assert {r.rid: list(r.contents) for r in state} == {1: [], 2: ["x", "w"], 3: []}


def test_a_silent_reply_is_given_up(spark):
    src, sink, ck = (io.scratch_path(spark, x) for x in ("t-lines", "t-rs", "t-rck"))
    schema = "rid long, line_no long, json string, at timestamp"

    def run(*rows):
        lines = [(r, i, json.dumps({"message": {"content": c}, "done": done}), f"2024-01-01 {t}") for r, i, c, done, t in rows]
        frame = spark.createDataFrame(lines, "rid long, line_no long, json string, at string")
        frame.withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(src)
        out = st.reassemble_stream(st.stream_files(spark, src, schema), "rid", "line_no", "json", sink, ck, timeout_s=100,
                                   time_col="at", forget="10 minutes")
        return sorted(map(tuple, out.collect()))
    assert run((1, 0, "a", False, "10:00:00"), (2, 0, "b", True, "10:00:00"), (4, 0, "d", False, "10:05:00")) == [
        (1, "a", False), (2, "b", True), (4, "d", False)]
    assert run((3, 0, "c", False, "10:12:00")) == [(1, "a", False), (2, "b", True), (3, "c", False), (4, "d", False)]
    left = spark.read.format("statestore").load(ck).select("key.rid").collect()
    assert sorted(r.rid for r in left) == [3, 4]  # the silent open reply and the mark of the finished one are gone
    assert run((4, 1, "e", True, "10:13:00")) == [(1, "a", False), (2, "b", True), (3, "c", False), (4, "de", True)]


def test_malformed_reply_line_stops_the_stream(spark):
    src, sink, ck = (io.scratch_path(spark, x) for x in ("t-lines", "t-rs", "t-rck"))
    spark.createDataFrame([(1, 0, "{}")], "rid long, line_no long, json string").write.parquet(src)
    stream = st.stream_files(spark, src, "rid long, line_no long, json string")
    with pytest.raises(Exception, match="malformed reply line"):
        st.reassemble_stream(stream, "rid", "line_no", "json", sink, ck)


def test_batch_scoring_and_linear_head(spark):
    df = spark.createDataFrame([(i, [float((i * 7 + k) % 5) for k in range(4)]) for i in range(40)],
                               "vec_id long, embedding array<double>")
    scored = ml.score_batches(df, ml.argmax_scorer_factory("vec_id", "embedding"), "vec_id bigint, pred int")
    import numpy as np
    exp = {r.vec_id: int(np.argmax(r.embedding)) for r in df.collect()}
    assert {r.vec_id: r.pred for r in scored.collect()} == exp
    train = df.withColumn("label", F.element_at("embedding", 1).cast("int") % 2)
    model = ml.fit_linear_head(train, "embedding", "label")
    pred = ml.apply_linear_head(model, train, "embedding", probs_col="p").collect()
    assert len(pred) == 40 and all(abs(sum(r.p) - 1) < 1e-9 and r.pred == int(np.argmax(r.p)) for r in pred)
    most = max(sum(r.label == k for r in pred) for k in (0, 1))
    assert sum(r.pred == r.label for r in pred) > most


PROMO = "You are a winner you have been specially selected to receive a cash award claim now"
FRIEND = "Hey are we still meeting for dinner at my place tomorrow evening"


def test_text_classifier_losses_cap_and_sample_texts(spark):
    rows = [(f"{PROMO} {i}", 1, "train") for i in range(12)] + [(f"{FRIEND} {i}", 0, "train") for i in range(12)]
    rows += [(PROMO, 1, "test"), (FRIEND, 0, "test"), (FRIEND + " soon", 0, "test")]
    df = spark.createDataFrame(rows, "Text string, label int, split string")
    train = df.where("split = 'train'")
    cap = ml.longest_text(train, "Text")
    assert cap == 17
    model = ml.fit_text_classifier(train, "Text", "label", cap)
    out = {r.split: r for r in ml.quality_by(ml.classify(model, df, "Text", max_length=cap, probs_col="probs"), ["split"]).collect()}
    assert (out["train"].n_rows, out["train"].accuracy, out["train"].majority) == (24, 1.0, 0.5)
    assert out["train"].loss < 0.1 and out["test"].accuracy == 1.0 and abs(out["test"].majority - 2 / 3) < 1e-12
    long = spark.createDataFrame([(FRIEND + " x" * 10 + " " + PROMO * 50,), (PROMO,), ("",)], "Text string")
    pred = [r.pred for r in ml.classify(model, long, "Text", max_length=12).collect()]
    assert pred[0] == 0 and pred[1] == 1 and pred[2] in (0, 1)  # beyond the cap nothing counts
