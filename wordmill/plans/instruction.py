"""Entry B: instruction records -> ordered split -> templates; judge prompts, replies, scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.operators import judge
from wordmill.operators import prompts as pr
from wordmill.operators import sampling as smp
from wordmill.plans import sqlbits as q
from wordmill.sources import adapters
from wordmill.session import load_table


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.instruction_records(spark, sf_dir)


def with_split(spark, sf_dir) -> DataFrame:
    return smp.ordered_split(records(spark, sf_dir), ["conv_id", "turn"])


def d5_ordered_split(spark, sf_dir):
    return with_split(spark, sf_dir).select("conv_id", "turn", "idx", "split")


def p4_prompt(spark, sf_dir):
    r = records(spark, sf_dir)
    return r.select("conv_id", "turn", pr.format_input("instruction", "input").alias("prompt"))


def p5_training_text(spark, sf_dir):
    r = records(spark, sf_dir)
    return r.select("conv_id", "turn",
                    pr.training_text("instruction", "input", "output").alias("full_text"))


def _with_response(spark, sf_dir) -> DataFrame:
    """Records plus ``model_response`` extracted (P7) from the full training text."""
    r = records(spark, sf_dir)
    full = pr.training_text("instruction", "input", "output")
    prompt = pr.format_input("instruction", "input")
    return r.withColumn("model_response", pr.extract_response(full, prompt))


def p6_judge_prompt(spark, sf_dir):
    r = _with_response(spark, sf_dir)
    return r.select("conv_id", "turn", pr.judge_prompt(
        "instruction", "input", "output", "model_response").alias("judge_prompt"))


def p7_extract_response(spark, sf_dir):
    return _with_response(spark, sf_dir).select("conv_id", "turn", "model_response")


def p8_flatten(spark, sf_dir):
    docs = adapters.corpus(spark, sf_dir)
    flat = pr.flatten_newlines("text")
    return docs.select("doc_id", F.md5(flat).alias("flat_md5"),
                       F.instr(flat, "\n").alias("first_newline"))


def p9_parse_reply(spark, sf_dir):
    rep = adapters.score_replies(spark, sf_dir)
    return rep.select("doc_id", "reply", pr.parse_int_reply("reply").cast("bigint").alias("score"))


def j1_payload(spark, sf_dir):
    r = _with_response(spark, sf_dir)
    jp = pr.judge_prompt("instruction", "input", "output", "model_response")
    return r.select("conv_id", "turn", pr.chat_payload(jp).alias("payload"))


def _judged(spark, sf_dir) -> DataFrame:
    r = _with_response(spark, sf_dir).withColumn(
        "judge_prompt", pr.judge_prompt("instruction", "input", "output", "model_response"))
    lines = judge.ask_judge(r, ["conv_id", "turn"], "judge_prompt")
    return judge.reassemble(lines, ["conv_id", "turn"])


def j2_ask_judge(spark, sf_dir):
    return _judged(spark, sf_dir).select("conv_id", "turn", "reply")


def j3_reassemble(spark, sf_dir):
    lines = adapters.reply_lines(spark, sf_dir)
    return judge.reassemble(lines, "request_id").select("request_id", "reply")


def j4_score_summary(spark, sf_dir):
    return judge.score_summary(adapters.score_replies(spark, sf_dir), "reply")


QUERIES = {
    "d5_ordered_split": d5_ordered_split,
    "p4_prompt": p4_prompt,
    "p5_training_text": p5_training_text,
    "p6_judge_prompt": p6_judge_prompt,
    "p7_extract_response": p7_extract_response,
    "p8_flatten": p8_flatten,
    "p9_parse_reply": p9_parse_reply,
    "j1_payload": j1_payload,
    "j2_ask_judge": j2_ask_judge,
    "j3_reassemble": j3_reassemble,
    "j4_score_summary": j4_score_summary,
}

_R = q.INSTRUCTIONS
_P = q.format_input("instruction", "input")
_FULL = f"concat({_P}, chr(10), chr(10), '### Response:', chr(10), output)"
_RESP = q.py_strip(f"replace(substr({_FULL}, length({_P}) + 1), '### Response:', '')")
_JUDGE = (f"concat('Given the input `', {_P}, '` and correct output `', output, "
          f"'`, score the model response `', model_response, '` on a scale from 0 to 100, "
          f"where 100 is the best score. Respond with the integer number only.')")
_WITH_RESP = f"SELECT *, {_RESP} AS model_response FROM ({_R}) r"
_REPLIES = """
SELECT doc_id, CASE b WHEN 0 THEN '85.0' WHEN 1 THEN 'Score: 85' WHEN 2 THEN '' WHEN 3 THEN ' 85' || chr(10)
                 ELSE CAST(h % 101 AS VARCHAR) END AS reply
FROM (SELECT doc_id, h, h % 20 AS b FROM
      (SELECT doc_id, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT AS h FROM documents) x) y
"""
_SCORE = ("CASE WHEN regexp_full_match(reply, '\\s*[+-]?[0-9]+\\s*') "
          "THEN CAST(regexp_extract(reply, '([+-]?[0-9]+)', 1) AS BIGINT) END")

ORACLE = {
    "d5_ordered_split": f"""
SELECT conv_id, turn, idx, CASE WHEN idx < floor(n * {q.dbl(0.85)}) THEN 'train'
  WHEN idx < floor(n * {q.dbl(0.85)}) + floor(n * {q.dbl(0.1)}) THEN 'test' ELSE 'validation' END AS split
FROM (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx, count(*) OVER () AS n
      FROM ({_R}) r) s""",
    "p4_prompt": f"SELECT conv_id, turn, {_P} AS prompt FROM ({_R}) r",
    "p5_training_text": f"SELECT conv_id, turn, {_FULL} AS full_text FROM ({_R}) r",
    "p6_judge_prompt": f"SELECT conv_id, turn, {_JUDGE} AS judge_prompt FROM ({_WITH_RESP}) w",
    "p7_extract_response": f"SELECT conv_id, turn, model_response FROM ({_WITH_RESP}) w",
    "p8_flatten": "SELECT doc_id, md5(replace(text, chr(10), ' ')) AS flat_md5, "
                  "CAST(instr(replace(text, chr(10), ' '), chr(10)) AS INTEGER) AS first_newline FROM documents",
    "p9_parse_reply": f"SELECT doc_id, reply, {_SCORE} AS score FROM ({_REPLIES}) r",
    "j1_payload": f"""
SELECT conv_id, turn, to_json({{'model': 'llama3', 'messages': [{{'role': 'user', 'content': {_JUDGE}}}],
       'options': {{'seed': 123, 'temperature': 0, 'num_ctx': 2048}}}})::VARCHAR AS payload FROM ({_WITH_RESP}) w""",
    "j2_ask_judge": f"""
SELECT conv_id, turn, CAST((('0x' || substr(md5({_JUDGE}), 1, 8))::BIGINT % 101) AS VARCHAR) AS reply
FROM ({_WITH_RESP}) w""",
    "j3_reassemble": """
SELECT user_id AS request_id, string_agg(CAST(json_extract_string(props, '$.k') AS VARCHAR), '' ORDER BY event_id) AS reply
FROM events GROUP BY user_id""",
    "j4_score_summary": f"""
SELECT count(score) AS n_scored, count(*) AS n_total, round(avg(score), 2) AS avg_score
FROM (SELECT {_SCORE} AS score FROM ({_REPLIES}) r) s""",
}
