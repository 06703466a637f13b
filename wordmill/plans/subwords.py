"""Subword coding over the corpus: learn merges, encode, decode, special tokens."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from wordmill.operators import subword as bpe
from wordmill.session import cut_lineage
from wordmill.sources import adapters

#: Merges that the queries learn.
NUM_MERGES = 2_000
#: Merges behind the ids of T9, which SQL learns too.
SPECIAL_MERGES = 30


def published(path: str | None = None) -> bpe.Model:
    """The model of a published byte-level tokenizer file: 50,000 merges and the end-of-text token by default."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.Model.from_file(path)


def learned(spark: SparkSession, sf_dir: str, num_merges: int = NUM_MERGES):
    return bpe.learn_merges(adapters.corpus(spark, sf_dir), "text", num_merges)


def t10_learn_merges(spark, sf_dir, num_merges: int = NUM_MERGES):
    return bpe.merges_frame(spark, learned(spark, sf_dir, num_merges))


def ids_row(enc):
    """The number of ids of a document and their digest."""
    return enc.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), F.md5(F.array_join("ids", " ")).alias("ids_md5"))


def t7_subword_encode(spark, sf_dir):
    return ids_row(bpe.encode(adapters.corpus(spark, sf_dir), published()))


def t8_subword_decode(spark, sf_dir):
    docs, model = adapters.corpus(spark, sf_dir), published()
    dec = bpe.decode(bpe.encode(docs, model), model, out_col="decoded")
    return dec.select("doc_id", F.md5("decoded").alias("text_md5"))


def _marked(spark, sf_dir):
    docs = adapters.corpus(spark, sf_dir)
    return docs.select("doc_id", F.concat(F.col("text"), F.lit(bpe.END_OF_TEXT), F.col("text")).alias("text"))


def _special(marked, policy, keep=()):
    model = published()
    enc = cut_lineage(bpe.encode(marked, model, ["doc_id", *keep], special=policy))
    n_special = F.size(F.filter("ids", lambda x: x == F.lit(model.special[bpe.END_OF_TEXT])))
    dec = bpe.decode(enc, model, out_col="decoded")
    # digests meet, not texts
    return enc.select("doc_id", n_special.cast("bigint").alias("n_special"), *keep).join(
        dec.select("doc_id", F.md5("decoded").alias("text_md5")), "doc_id")


def t9_special_tokens(spark, sf_dir):
    """Marked texts coded with learned merges (digest of the ids) and with the published ones (marks found, text back)."""
    merges = learned(spark, sf_dir, SPECIAL_MERGES)
    own = bpe.encode(_marked(spark, sf_dir).withColumn("marked", F.col("text")), merges, ["doc_id", "marked"],
                     special="allow")
    coded = own.select("doc_id", F.col("marked").alias("text"), F.md5(F.array_join("ids", " ")).alias("ids_md5"))
    return _special(coded, "allow", ["ids_md5"])


def t9_special_as_text(spark, sf_dir):
    return _special(_marked(spark, sf_dir), "as_text")


QUERIES = {
    "t10_learn_merges": t10_learn_merges,
    "t7_subword_encode": t7_subword_encode,
    "t8_subword_decode": t8_subword_decode,
    "t9_special_tokens": t9_special_tokens,
    "t9_special_as_text": t9_special_as_text,
}

# Pre-tokens without look-ahead: a mark before the last white space of a run that a word follows
# ends the run there; then every symbol of a pre-token is framed on its own, so that replace()
# merges left to right without overlap, and each merge is one more CTE.
_PRE = ("regexp_extract_all(regexp_replace(text, '(\\s+)(\\s[^\\s])', '\\1' || chr(1) || '\\2', 'g'), "
        "'''s|''t|''re|''ve|''m|''ll|''d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}\\x01]+|\\s+')")


def _learn_sql(n: int) -> str:
    """CTEs occ <doc_id, i, w>, w<k> <w, n, u> and m<k> <l, r, cnt> of ``n`` rounds."""
    parts = [
        f"toks AS MATERIALIZED (SELECT doc_id, {_PRE} AS ws FROM documents)",
        "occ AS MATERIALIZED (SELECT doc_id, r.i AS i, ws[r.i] AS w FROM toks, range(1, len(ws) + 1) r(i))",
        "w0 AS MATERIALIZED (SELECT w, count(*) AS n, '<' || array_to_string(list_transform("
        "regexp_extract_all(hex(encode(w)), '..'), lambda h: CAST(('0x' || h)::BIGINT AS VARCHAR)), '><') || '>' AS u "
        "FROM occ GROUP BY w)"]
    for k in range(n):
        parts.append(
            f"m{k} AS MATERIALIZED (SELECT l, r, cnt FROM (SELECT CAST(s[j.i] AS BIGINT) AS l, CAST(s[j.i + 1] AS BIGINT) AS r, "
            f"sum(n) AS cnt FROM (SELECT n, string_split(substr(u, 2, length(u) - 2), '><') AS s FROM w{k}) x, "
            f"range(1, len(s)) j(i) GROUP BY ALL) y ORDER BY cnt DESC, l, r LIMIT 1)")
        parts.append(
            f"w{k + 1} AS MATERIALIZED (SELECT w, n, replace(u, '<' || m.l || '><' || m.r || '>', '<{256 + k}>') AS u "
            f"FROM w{k}, m{k} m)")
    return ", ".join(parts)


def learned_sql(n: int) -> str:
    rows = " UNION ALL ".join(f"SELECT CAST({k} AS INTEGER) AS rank, l AS left, r AS right, "
                              f"CAST({256 + k} AS BIGINT) AS token_id FROM m{k}" for k in range(n))
    return f"WITH {_learn_sql(n)} {rows}"


def _coded(n: int) -> str:
    """CTEs up to ids <doc_id, text, s>: the ids of ``n`` learned merges, joined by spaces."""
    return f"""
WITH {_learn_sql(n)},
coded AS (SELECT o.doc_id, string_agg(replace(substr(w.u, 2, length(w.u) - 2), '><', ' '), ' ' ORDER BY o.i) AS s
          FROM occ o JOIN w{n} w ON o.w = w.w GROUP BY o.doc_id),
ids AS (SELECT d.doc_id, d.text, coalesce(c.s, '') AS s FROM documents d LEFT JOIN coded c ON c.doc_id = d.doc_id)"""


def coded_sql(n: int) -> str:
    """Ids and their digests with ``n`` learned merges: what ``ids_row`` gives."""
    return f"""{_coded(n)}
SELECT doc_id, CAST(CASE WHEN s = '' THEN 0 ELSE length(s) - length(replace(s, ' ', '')) + 1 END AS BIGINT) AS n_ids,
       md5(s) AS ids_md5 FROM ids"""


# One CTE a merge is too slow for NUM_MERGES (T10): tests compare 30 with ``learned_sql`` and ``coded_sql``.
_MARKED = f"md5(concat(text, '{bpe.END_OF_TEXT}', text)) AS text_md5"
ORACLE = {
    "t8_subword_decode": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
    "t9_special_tokens": f"{_coded(SPECIAL_MERGES)} SELECT doc_id, CAST(1 AS BIGINT) AS n_special, "
                         f"md5(trim(s || ' {bpe.END_OF_TEXT_ID} ' || s)) AS ids_md5, {_MARKED} FROM ids",
    "t9_special_as_text": f"SELECT doc_id, CAST(0 AS BIGINT) AS n_special, {_MARKED} FROM documents",
}
