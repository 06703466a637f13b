"""P4-P9, J1-J4."""

import json

import pytest

from wordmill.operators import judge
from wordmill.operators import prompts as pr


HEAD = ("Below is an instruction that describes a task. Write a response that appropriately completes the request."
        "\n\n### Instruction:\n")


def test_templates_and_extraction(spark):
    rows = [("Do x", "", "ok"), ("Do y", "ctx", " done\n"), ("Do z", None, "")]
    df = spark.createDataFrame(rows, "instruction string, input string, output string")
    out = df.select(pr.format_input("instruction", "input").alias("p"),
                    pr.training_text("instruction", "input", "output").alias("full")).collect()
    assert [r.p for r in out] == [HEAD + "Do x", HEAD + "Do y\n\n### Input:\nctx", HEAD + "Do z"]
    assert [r.full for r in out] == [HEAD + "Do x\n\n### Response:\nok",
                                     HEAD + "Do y\n\n### Input:\nctx\n\n### Response:\n done\n",
                                     HEAD + "Do z\n\n### Response:\n"]
    ext = df.select(pr.extract_response(pr.training_text("instruction", "input", "output"),
                                        pr.format_input("instruction", "input")).alias("x")).collect()
    assert [r.x for r in ext] == ["ok", "done", ""]


def test_reply_parse(spark):
    good = ["85", " 85\n", "+5", "-3", "12345678901234567890"]
    bad = ["85.0", "", "abc", "1_0", "Score: 85"]
    df = spark.createDataFrame([(s,) for s in good + bad], "reply string")
    got = [r.s for r in df.select(pr.parse_int_reply("reply").alias("s")).collect()]
    assert got == [85, 85, 5, -3, 12345678901234567890, None, None, None, None, None]
    summary = judge.score_summary(df.where("length(reply) < 20")).first()
    assert (summary.n_scored, summary.n_total, summary.avg_score) == (4, 9, 43.0)
    none = judge.score_summary(df.where("reply = 'abc'")).first()
    assert none.n_scored == 0 and none.avg_score is None


def test_payload_and_stub_judge(spark):
    df = spark.createDataFrame([(1, 'say "hi"\n')], "id long, prompt string")
    payload = json.loads(df.select(pr.chat_payload("prompt").alias("p")).first().p)
    assert payload == {"model": "llama3", "messages": [{"role": "user", "content": 'say "hi"\n'}],
                       "options": {"seed": 123, "temperature": 0, "num_ctx": 2048}}
    lines = judge.ask_judge(df, ["id"], "prompt")
    reply = judge.reassemble(lines, "id").first().reply
    assert reply == str(judge.stub_score('say "hi"\n'))


def test_reassemble_order_and_chunks(spark):
    rows = [(7, i, json.dumps({"message": {"content": c}})) for i, c in enumerate("hello world")]
    df = spark.createDataFrame(list(reversed(rows)), "rid long, line_no long, json string")
    assert judge.reassemble(df, "rid", chunk_lines=3).first().reply == "hello world"


def test_reassemble_ends_at_done_and_rejects_bad_lines(spark):
    rows = [(1, 0, '{"message": {"content": "a"}}'), (1, 1, '{"message": {"content": "b"}, "done": true}'),
            (1, 2, '{"message": {"content": "c"}}'), (2, 0, '{"message": {"content": "x"}}')]
    df = spark.createDataFrame(rows, "rid long, line_no long, json string")
    for size in (1, 2, 4096):
        got = {r.rid: (r.reply, r.whole) for r in
               judge.reassemble(df, "rid", chunk_lines=size, complete_col="whole").collect()}
        assert got == {1: ("ab", True), 2: ("x", False)}
    bad = df.union(spark.createDataFrame([(2, 1, "not json"), (2, 2, '{"done": true}')], df.schema))
    assert judge.malformed_lines(bad).count() == 2
    with pytest.raises(Exception, match="malformed reply line"):
        judge.reassemble(bad, "rid").collect()
    assert {r.rid: r.reply for r in judge.reassemble(bad, "rid", malformed="skip").collect()} == {1: "ab", 2: "x"}


def test_flatten(spark):
    df = spark.createDataFrame([("a\nb\n",)], "t string")
    assert df.select(pr.flatten_newlines("t")).first()[0] == "a b "
