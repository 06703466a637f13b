"""Prompt templates, response extraction, reply parsing, request payloads.

All are row-local native expressions (no Python in the hot path).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordmill.functions.text import WS_CLASS, py_strip

# Fixed template values that must equal the reference's prompts.
PREAMBLE = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request."
)
INSTRUCTION_HEADER = "\n\n### Instruction:\n"
INPUT_HEADER = "\n\n### Input:\n"
RESPONSE_HEADER = "\n\n### Response:\n"
RESPONSE_MARKER = "### Response:"
JUDGE_TEMPLATE = (
    "Given the input `{prompt}` and correct output `{output}`, "
    "score the model response `{candidate}` on a scale from 0 to 100, "
    "where 100 is the best score. Respond with the integer number only."
)
JUDGE_MODEL = "llama3"
JUDGE_OPTIONS = {"seed": 123, "temperature": 0, "num_ctx": 2048}

# An integer reply: optional whitespace, sign, ASCII digits, whitespace.
INT_REPLY_PATTERN = "(?U)^[" + WS_CLASS + "]*[+-]?[0-9]+[" + WS_CLASS + "]*$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_input(instruction: Column | str, inp: Column | str) -> Column:
    """Preamble + instruction, and the input block only when input is non-empty."""
    i = _c(inp)
    input_block = F.when(F.coalesce(i, F.lit("")) != "", F.concat(F.lit(INPUT_HEADER), i)) \
                   .otherwise(F.lit(""))
    return F.concat(F.lit(PREAMBLE + INSTRUCTION_HEADER), _c(instruction), input_block)


def training_text(instruction: Column | str, inp: Column | str, output: Column | str) -> Column:
    """P5: prompt + response header + output."""
    return F.concat(format_input(instruction, inp), F.lit(RESPONSE_HEADER), _c(output))


def judge_prompt(instruction: Column | str, inp: Column | str, output: Column | str,
                 candidate: Column | str) -> Column:
    """The judge sentence; ``candidate`` is any column (chosen by name)."""
    head, rest = JUDGE_TEMPLATE.split("{prompt}")
    mid1, rest = rest.split("{output}")
    mid2, tail = rest.split("{candidate}")
    return F.concat(F.lit(head), format_input(instruction, inp), F.lit(mid1), _c(output),
                    F.lit(mid2), _c(candidate), F.lit(tail))


def extract_response(generated: Column | str, prompt: Column | str) -> Column:
    """Drop the first len(prompt) chars, delete every response marker, strip."""
    g = _c(generated)
    rest = F.substring(g, F.length(_c(prompt)) + 1, F.greatest(F.length(g), F.lit(1)))
    return py_strip(F.replace(rest, F.lit(RESPONSE_MARKER), F.lit("")))


def flatten_newlines(text: Column | str) -> Column:
    """Every newline becomes a space."""
    return F.replace(_c(text), F.lit("\n"), F.lit(" "))


def parse_int_reply(reply: Column | str) -> Column:
    """DECIMAL(38,0) when the reply is an integer (whitespace allowed around), else NULL.

    An integer beyond 38 digits fits no SQL type and is rejected like any other reply.
    """
    r = _c(reply)
    digits = F.regexp_extract(r, "([+-]?[0-9]+)", 1)
    return F.when(r.rlike(INT_REPLY_PATTERN), digits.try_cast("decimal(38,0)"))


def chat_payload(prompt: Column | str, model: str = JUDGE_MODEL,
                 options: dict | None = None) -> Column:
    """The chat request body as compact JSON text."""
    opts = options or JUDGE_OPTIONS
    return F.to_json(F.struct(
        F.lit(model).alias("model"),
        F.array(F.struct(F.lit("user").alias("role"), _c(prompt).alias("content"))).alias("messages"),
        F.struct(*[F.lit(v).alias(k) for k, v in opts.items()]).alias("options")))
