"""DuckDB SQL fragments for the oracle queries (independent formulations).

The oracle side deliberately uses a different formulation from the Spark
side where it can (e.g. split-with-sentinel here, extract-with-lookahead in
Spark), so agreement is evidence rather than a copy.
"""

from __future__ import annotations


def word_tokens(text: str) -> str:
    """T1 in DuckDB: mark delimiters with chr(1), split, drop blank pieces."""
    return (
        "list_filter(string_split(regexp_replace(" + text + ", "
        "'([,.:;?_!\"()'']|--|\\s)', chr(1) || '\\1' || chr(1), 'g'), chr(1)), "
        "lambda x: NOT regexp_full_match(x, '\\s*'))"
    )


def hash_key(seed, *parts: str) -> str:
    pieces = [f"'{seed}'"]
    for p in parts:
        pieces += ["':'", f"CAST({p} AS VARCHAR)"]
    return "md5(concat(" + ", ".join(pieces) + "))"


def hash_uniform(seed, *parts: str) -> str:
    return f"(('0x' || substr({hash_key(seed, *parts)}, 1, 8))::BIGINT / 4294967296.0)"


def dbl(x: float) -> str:
    """A binary double literal (a bare 0.7 is DECIMAL in DuckDB)."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def decode_clean(joined: str) -> str:
    return "regexp_replace(" + joined + ", '\\s+([,.:;?_!\"()''])', '\\1', 'g')"


def py_strip(s: str) -> str:
    return "regexp_replace(" + s + ", '^\\s+|\\s+$', '', 'g')"


LABELLED = (
    "SELECT d.doc_id, CASE WHEN l.quality = 0 THEN 'spam' ELSE 'ham' END AS Label, "
    "d.text AS Text FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
)

INSTRUCTIONS = """
SELECT c.conv_id, c.turn, c.text AS instruction, coalesce(s.system_text, '') AS input,
       c.next_text AS output
FROM (SELECT conv_id, turn, role, text,
             lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
             lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
      FROM conversations) c
LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS system_text FROM conversations
           WHERE role = 'system' GROUP BY conv_id) s ON c.conv_id = s.conv_id
WHERE c.role = 'user' AND c.next_role = 'assistant'
"""

CLASS_SCORES = """
SELECT vec_id AS row_id, CAST(i - 1 AS INTEGER) AS class_id,
       CAST(embedding[i] AS DOUBLE) AS logit, CAST(label AS INTEGER) AS target
FROM embeddings, range(1, 65) r(i)
WHERE i <= len(embedding)
"""

PREAMBLE = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request."
)


def format_input(instr: str, inp: str) -> str:
    return (
        "concat('" + PREAMBLE + "', chr(10), chr(10), '### Instruction:', chr(10), " + instr
        + ", CASE WHEN coalesce(" + inp + ", '') <> '' THEN concat(chr(10), chr(10), "
        "'### Input:', chr(10), " + inp + ") ELSE '' END)"
    )


def balanced(seed: int = 123, classes=("ham", "spam")) -> str:
    """D1 over the labelled messages, classes given."""
    cls = ", ".join(f"'{c}'" for c in classes)
    least = ", ".join(
        f"coalesce(sum(CASE WHEN Label = '{c}' THEN 1 END), 0)" for c in classes)
    least_expr = f"least({least})" if len(classes) > 1 else least
    return f"""
SELECT r.doc_id, r.Label, r.Text FROM (
  SELECT *, row_number() OVER (PARTITION BY Label ORDER BY {hash_key(seed, 'doc_id')}, doc_id) - 1 AS rk
  FROM ({LABELLED}) m WHERE Label IN ({cls})) r,
  (SELECT {least_expr} AS k FROM ({LABELLED}) m2 WHERE Label IN ({cls})) mn
WHERE r.rk < mn.k
"""


def split3(src: str, seed: int = 123, tr: float = 0.7, va: float = 0.1) -> str:
    return f"""
SELECT *, CASE WHEN idx < floor(n * {dbl(tr)}) THEN 'train'
               WHEN idx < floor(n * {dbl(tr + va)}) THEN 'validation' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY {hash_key(seed, 'doc_id')}, doc_id) - 1 AS idx,
             count(*) OVER () AS n FROM ({src}) s0) s1
"""


def spam_splits(seed: int = 123) -> str:
    """Balance -> label ids -> 0.7/0.1/0.2 split: the classification data set."""
    lab = (f"SELECT doc_id, CASE Label WHEN 'ham' THEN 0 WHEN 'spam' THEN 1 END AS Label, Text "
           f"FROM ({balanced(seed)}) b")
    return split3(lab, seed)


def toks(src: str, id_cols: str = "doc_id", text: str = "text") -> str:
    return f"SELECT {id_cols}, {word_tokens(text)} AS toks FROM ({src}) s_t"


def long_tokens(src: str, id_cols: str = "doc_id", text: str = "text") -> str:
    return (f"SELECT {id_cols}, t.i - 1 AS pos, toks[t.i] AS token "
            f"FROM ({toks(src, id_cols, text)}) x, range(1, len(toks) + 1) t(i)")


def vocab(src: str, id_cols: str = "doc_id", text: str = "text") -> str:
    return ("SELECT token, row_number() OVER (ORDER BY token) - 1 AS token_id, n FROM "
            f"(SELECT token, count(*) AS n FROM ({long_tokens(src, id_cols, text)}) l GROUP BY token) v")


def encoded(src: str, vocab_sql: str, id_col: str = "doc_id", text: str = "text") -> str:
    """<id, ids> for every source row ([] when it has no tokens)."""
    return f"""
SELECT d.{id_col}, coalesce(e.ids, []) AS ids FROM ({src}) d LEFT JOIN (
  SELECT l.{id_col}, list(v.token_id ORDER BY l.pos) AS ids
  FROM ({long_tokens(src, id_col, text)}) l JOIN ({vocab_sql}) v ON l.token = v.token GROUP BY l.{id_col}) e
ON d.{id_col} = e.{id_col}
"""


def pad(ids: str, m: str, pad_id: int | str = 50256) -> str:
    return f"list_concat({ids}[1:{m}], list_resize([]::BIGINT[], greatest({m} - len({ids}[1:{m}]), 0), {pad_id}))"


def ids_md5(ids: str) -> str:
    return f"md5(array_to_string({ids}, ' '))"


DOCS = "SELECT doc_id, text FROM documents"
DOC_VOCAB = vocab(DOCS)
DOC_ENC = encoded(DOCS, DOC_VOCAB)
