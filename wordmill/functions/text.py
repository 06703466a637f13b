"""Native text expressions shared by the tokenization and prompt operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's word tokenizer:
#   single punctuation delimiters:  , . : ; ? _ ! " ( ) '
#   double dash delimiter:          --
#   any one whitespace character is a delimiter too; delimiters are kept as
#   tokens (whitespace ones are then dropped as blank).
PUNCT_CLASS = r",.:;?_!\"()'"
# Python's `\s` / str.strip() whitespace = Unicode White_Space plus the
# separators U+001C..U+001F; `(?U)` turns Java's `\s` into White_Space.
WS_CLASS = r"\s\x{1c}-\x{1f}"

# A token is a delimiter, or a maximal run of other characters in which a
# hyphen belongs to the word unless it starts a `--`.
WORD_TOKEN_PATTERN = (
    "(?U)[" + PUNCT_CLASS + "]|--|(?:[^" + PUNCT_CLASS + WS_CLASS + r"\-]++|-(?!-))+"
)

# Decode cleanup: whitespace before one of the punctuation delimiters is removed.
DECODE_SPACE_PATTERN = "(?U)[" + WS_CLASS + "]+([" + PUNCT_CLASS + "])"

# Whole-string whitespace trim with Python's definition of whitespace.
TRIM_PATTERN = "(?U)^[" + WS_CLASS + "]+|[" + WS_CLASS + "]+$"


def word_tokens(text: Column | str) -> Column:
    """ARRAY<STRING> of word tokens, delimiters kept, blanks dropped."""
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(t, F.lit(WORD_TOKEN_PATTERN), 0)


def decode_join(tokens: Column) -> Column:
    """T6 text form: join with single spaces, then close up before punctuation."""
    return F.regexp_replace(F.array_join(tokens, " "), DECODE_SPACE_PATTERN, "$1")


def py_strip(c: Column) -> Column:
    """``str.strip()``: removes leading/trailing Unicode whitespace, not only spaces."""
    return F.regexp_replace(c, TRIM_PATTERN, "")
