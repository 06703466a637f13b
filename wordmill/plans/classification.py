"""Entry A: labelled messages -> balance -> label ids -> split -> tokens -> vocabulary.

Each query takes (spark, sf_dir) and returns a DataFrame; tables that several branches read
(splits, vocabularies) are materialised while it is built. ``ORACLE`` holds the DuckDB twins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.functions.text import word_tokens
from wordmill.operators import labels as lab
from wordmill.operators import sampling as smp
from wordmill.operators import tokens as tok
from wordmill.operators.indexing import sorted_index
from wordmill.plans import sqlbits as q
from wordmill.sources import adapters
from wordmill.sources import files as io
from wordmill.session import cut_lineage, load_table

SEED = 123


def spam_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classification data set: <doc_id, Label 0/1, Text, idx, split>."""
    narrow = narrow_splits(spark, sf_dir)
    texts = adapters.corpus(spark, sf_dir).withColumnRenamed("text", "Text")
    return narrow.join(texts, "doc_id").select("doc_id", "Label", "Text", "idx", "split")


def narrow_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """<doc_id, Label 0/1, idx, split>: balanced and split on ids alone, materialised once.

    The texts are joined afterwards, one shuffle for all that balancing and splitting decide.
    """
    labels = adapters.message_labels(spark, sf_dir)
    bal = cut_lineage(smp.balance(labels, "Label", "doc_id", seed=SEED, classes=["ham", "spam"]))
    ids = bal.withColumn("Label", lab.map_labels("Label").cast("int"))
    return cut_lineage(smp.random_split(ids, "doc_id", 0.7, 0.1, 0.2, seed=SEED))


def split_token_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: rows, total word tokens and longest row per (split, label)."""
    sp = spam_splits(spark, sf_dir).withColumn("n_tokens", F.size(word_tokens("Text")))
    return sp.groupBy("split", "Label").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("n_tokens").cast("bigint").alias("total_tokens"),
        F.max("n_tokens").cast("bigint").alias("longest"))


def d1_balance(spark, sf_dir):
    labels = adapters.message_labels(spark, sf_dir)
    return smp.balance(labels, "Label", "doc_id", seed=SEED, classes=["ham", "spam"]).select(
        "doc_id", "Label")


def d2_concat(spark, sf_dir):
    msgs = adapters.labelled_messages(spark, sf_dir)
    spam = lab.where_label(msgs, "Label", "spam")
    ham = lab.where_label(msgs, "Label", "ham")
    return spam.unionByName(ham).select("doc_id", "Label")


def d3_shuffle(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents").select("doc_id")
    return smp.shuffle_index(docs, "doc_id", seed=SEED)


def d4_random_split(spark, sf_dir):
    return narrow_splits(spark, sf_dir).select("doc_id", "Label", "idx", "split")


def d6_sorted_index(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events").select("event_id", "ts")
    return sorted_index(ev, ["ts", "event_id"]).select("event_id", "idx")


def d7_num_batches(spark, sf_dir):
    sp = narrow_splits(spark, sf_dir)
    sizes = sp.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    drop = F.col("split") == "train"
    return sizes.select(
        "split", "n_rows",
        F.when(drop, smp.num_batches(F.col("n_rows"), 8, True))
         .otherwise(smp.num_batches(F.col("n_rows"), 8, False)).alias("n_batches"))


def d8_first_batches(spark, sf_dir):
    sp = narrow_splits(spark, sf_dir)
    # batch position inside each split = global idx minus the split's first idx
    start = sp.groupBy("split").agg(F.min("idx").alias("start"))
    pos = sp.join(F.broadcast(start), "split").withColumn("pos", F.col("idx") - F.col("start"))
    b = smp.assign_batches(pos, "pos", 8)
    kept = smp.first_batches(b, "batch_id", 5)
    return kept.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.max("batch_id").alias("last_batch"))


def p1_filter_label(spark, sf_dir):
    msgs = adapters.labelled_messages(spark, sf_dir)
    return lab.where_label(msgs, "Label", "spam").select("doc_id")


def p2_label_ids(spark, sf_dir):
    conv = load_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return conv.select("conv_id", "turn",
                       lab.map_labels("role", {"user": 0, "assistant": 1}).cast("int")
                       .alias("role_id"))


def p3_prediction_name(spark, sf_dir):
    emb = load_table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return emb.select("vec_id", lab.prediction_name("label").alias("name"))


def p10_char_split(spark, sf_dir):
    docs = adapters.corpus(spark, sf_dir)
    s = smp.char_split(docs, "text", 0.9)
    return s.select("doc_id", F.length("train_text").cast("bigint").alias("train_chars"),
                    F.length("val_text").cast("bigint").alias("val_chars"),
                    F.md5("train_text").alias("train_md5"), F.md5("val_text").alias("val_md5"))


def p11_class_counts(spark, sf_dir):
    return lab.class_counts(adapters.labelled_messages(spark, sf_dir), "Label")


def t1_word_split(spark, sf_dir):
    docs = tok.tokenize_words(adapters.corpus(spark, sf_dir))
    return docs.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"),
                       F.md5(F.array_join("tokens", "\u0001")).alias("tokens_md5"))


def t11_longest(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents").select("lang", "text")
    t = tok.tokenize_words(docs)
    return t.groupBy("lang").agg(tok.longest_length(t, "tokens").cast("bigint").alias("longest"),
                                 F.sum(F.size("tokens")).cast("bigint").alias("total_tokens"))


def _vocab(spark, sf_dir):
    return tok.build_vocab(tok.explode_tokens(adapters.corpus(spark, sf_dir), "doc_id"))


def t2_vocab(spark, sf_dir):
    return _vocab(spark, sf_dir).select("token", "token_id")


def t3_vocab_size(spark, sf_dir):
    long = tok.explode_tokens(adapters.corpus(spark, sf_dir), "doc_id")
    return long.agg(tok.vocab_size(long).alias("vocab_size"))


def t3_sketches(spark, sf_dir):
    """Sketches of each source are stored, read back and united; exact size, and whether the estimate is within 3 standard errors."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    long = tok.explode_tokens(docs, ["doc_id", "source"])
    path = io.scratch_path(spark, "vocab-sketches")
    tok.vocab_sketches(long, ["source"]).write.parquet(path)
    united = tok.united_vocab_size(spark.read.parquet(path))
    exact = long.agg(tok.vocab_size(long).alias("vocab_size"))  # one row, as the estimate
    within = F.abs(F.col("estimate") - F.col("vocab_size")) <= F.col("vocab_size") * (3 * 1.04 / 128)
    return exact.crossJoin(F.broadcast(united)).select("vocab_size", within.alias("within"))


def t4_inverse_vocab(spark, sf_dir):
    v = _vocab(spark, sf_dir)
    return v.select("token_id", "token", F.length("token").cast("bigint").alias("token_chars"))


def _encoded(spark, sf_dir):
    docs = adapters.corpus(spark, sf_dir)
    return tok.encode_texts(docs, _vocab(spark, sf_dir))


def t5_encode(spark, sf_dir):
    enc = _encoded(spark, sf_dir)
    return enc.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"),
                      F.md5(F.array_join("ids", " ")).alias("ids_md5"))


def _encoded_beyond(spark, sf_dir, oov):
    """Every document in the vocabulary of the labelled ones, digests with null ids as '-'."""
    docs = adapters.corpus(spark, sf_dir)
    known = docs.join(load_table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    vocab = tok.build_vocab(tok.explode_tokens(known, "doc_id"))
    enc = tok.encode_texts(docs, vocab, oov=oov, unk_id=-1)
    shown = F.transform("ids", lambda i: F.coalesce(i.cast("string"), F.lit("-")))
    return enc.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), F.md5(F.array_join(shown, " ")).alias("ids_md5"))


def t5_oov_null(spark, sf_dir):
    return _encoded_beyond(spark, sf_dir, "null")


def t5_oov_skip(spark, sf_dir):
    return _encoded_beyond(spark, sf_dir, "skip")


def t5_oov_unk(spark, sf_dir):
    return _encoded_beyond(spark, sf_dir, "unk")


def t6_decode(spark, sf_dir):
    vocab = _vocab(spark, sf_dir)
    enc = tok.encode_texts(adapters.corpus(spark, sf_dir), vocab)
    dec = tok.decode_ids(enc, vocab)
    return dec.select("doc_id", F.length("decoded").cast("bigint").alias("decoded_chars"),
                      F.md5("decoded").alias("decoded_md5"))


def t12_token_freq(spark, sf_dir):
    long = tok.explode_tokens(adapters.corpus(spark, sf_dir), "doc_id")
    return tok.token_frequencies(long)


QUERIES = {
    "split_token_stats": split_token_stats,
    "d1_balance": d1_balance,
    "d2_concat": d2_concat,
    "d3_shuffle": d3_shuffle,
    "d4_random_split": d4_random_split,
    "d6_sorted_index": d6_sorted_index,
    "d7_num_batches": d7_num_batches,
    "d8_first_batches": d8_first_batches,
    "p1_filter_label": p1_filter_label,
    "p2_label_ids": p2_label_ids,
    "p3_prediction_name": p3_prediction_name,
    "p10_char_split": p10_char_split,
    "p11_class_counts": p11_class_counts,
    "t1_word_split": t1_word_split,
    "t11_longest": t11_longest,
    "t2_vocab": t2_vocab,
    "t3_vocab_size": t3_vocab_size,
    "t4_inverse_vocab": t4_inverse_vocab,
    "t5_encode": t5_encode,
    "t3_sketches": t3_sketches,
    "t5_oov_null": t5_oov_null,
    "t5_oov_skip": t5_oov_skip,
    "t5_oov_unk": t5_oov_unk,
    "t6_decode": t6_decode,
    "t12_token_freq": t12_token_freq,
}

_SPLITS = q.spam_splits(SEED)
_TOKS = f"SELECT doc_id, {q.word_tokens('text')} AS toks FROM documents"
_LONG = f"SELECT doc_id, t.i - 1 AS pos, toks[t.i] AS token FROM ({_TOKS}) x, range(1, len(toks) + 1) t(i)"
_VOCAB = ("SELECT token, row_number() OVER (ORDER BY token) - 1 AS token_id, n FROM "
          f"(SELECT token, count(*) AS n FROM ({_LONG}) l GROUP BY token) v")
_ENC = f"""
SELECT d.doc_id, coalesce(e.ids, []) AS ids FROM documents d LEFT JOIN (
  SELECT l.doc_id, list(v.token_id ORDER BY l.pos) AS ids
  FROM ({_LONG}) l JOIN ({_VOCAB}) v ON l.token = v.token GROUP BY l.doc_id) e
ON d.doc_id = e.doc_id
"""
_DEC = f"""
SELECT d.doc_id, {q.decode_clean("coalesce(array_to_string(t.toks, ' '), '')")} AS decoded
FROM documents d LEFT JOIN ({_TOKS}) t ON d.doc_id = t.doc_id
"""

_KNOWN = f"SELECT token FROM ({_LONG}) l WHERE doc_id IN (SELECT doc_id FROM labels)"


def _beyond(shown: str, where: str) -> str:
    return f"""
WITH l AS ({_LONG}), v AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS token_id FROM (SELECT DISTINCT token FROM ({_KNOWN}) k) t),
e AS (SELECT l.doc_id, count(*) AS n, string_agg({shown}, ' ' ORDER BY l.pos) AS s
      FROM l LEFT JOIN v ON l.token = v.token {where} GROUP BY l.doc_id)
SELECT d.doc_id, CAST(coalesce(e.n, 0) AS BIGINT) AS n_ids, md5(coalesce(e.s, '')) AS ids_md5
FROM documents d LEFT JOIN e ON e.doc_id = d.doc_id"""


ORACLE = {
    "split_token_stats": f"""
SELECT split, Label, count(*) AS n_rows, CAST(sum(len({q.word_tokens('Text')})) AS BIGINT) AS total_tokens,
       CAST(max(len({q.word_tokens('Text')})) AS BIGINT) AS longest
FROM ({_SPLITS}) s GROUP BY split, Label""",
    "d1_balance": f"SELECT doc_id, Label FROM ({q.balanced(SEED)}) b",
    "d2_concat": f"SELECT doc_id, Label FROM ({q.LABELLED}) m WHERE Label = 'spam' "
                 f"UNION ALL SELECT doc_id, Label FROM ({q.LABELLED}) m WHERE Label = 'ham'",
    "d3_shuffle": f"SELECT doc_id, row_number() OVER (ORDER BY {q.hash_key(SEED, 'doc_id')}, doc_id) - 1 AS idx FROM documents",
    "d4_random_split": f"SELECT doc_id, Label, idx, split FROM ({_SPLITS}) s",
    "d6_sorted_index": "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS idx FROM events",
    "d7_num_batches": f"""
SELECT split, count(*) AS n_rows,
       CAST(CASE WHEN split = 'train' THEN floor(count(*) / 8) ELSE ceil(count(*) / 8) END AS BIGINT) AS n_batches
FROM ({_SPLITS}) s GROUP BY split""",
    "d8_first_batches": f"""
SELECT split, count(*) AS n_rows, max(batch_id) AS last_batch FROM (
  SELECT split, CAST(floor((idx - min(idx) OVER (PARTITION BY split)) / 8) AS BIGINT) AS batch_id
  FROM ({_SPLITS}) s) b WHERE batch_id < 5 GROUP BY split""",
    "p1_filter_label": f"SELECT doc_id FROM ({q.LABELLED}) m WHERE Label = 'spam'",
    "p2_label_ids": "SELECT conv_id, turn, CAST(CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 END AS INTEGER) AS role_id FROM conversations",
    "p3_prediction_name": "SELECT vec_id, CASE WHEN label = 1 THEN 'spam' ELSE 'ham' END AS name FROM embeddings",
    "p10_char_split": """
SELECT doc_id, length(substr(text, 1, k)) AS train_chars, length(substr(text, k + 1)) AS val_chars,
       md5(substr(text, 1, k)) AS train_md5, md5(substr(text, k + 1)) AS val_md5
FROM (SELECT doc_id, text, CAST(floor(length(text) * CAST(0.9 AS DOUBLE)) AS BIGINT) AS k FROM documents) d""",
    "p11_class_counts": f"SELECT Label, count(*) AS n_rows FROM ({q.LABELLED}) m GROUP BY Label",
    "t1_word_split": f"SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens, md5(array_to_string(toks, chr(1))) AS tokens_md5 FROM ({_TOKS}) t",
    "t11_longest": f"""
SELECT lang, CAST(coalesce(max(len(toks)), 0) AS BIGINT) AS longest, CAST(sum(len(toks)) AS BIGINT) AS total_tokens
FROM (SELECT lang, {q.word_tokens('text')} AS toks FROM documents) t GROUP BY lang""",
    "t2_vocab": f"SELECT token, token_id FROM ({_VOCAB}) v",
    "t3_vocab_size": f"SELECT count(DISTINCT token) AS vocab_size FROM ({_LONG}) l",
    "t4_inverse_vocab": f"SELECT token_id, token, length(token) AS token_chars FROM ({_VOCAB}) v",
    "t5_encode": f"SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_ids, md5(array_to_string(ids, ' ')) AS ids_md5 FROM ({_ENC}) e",
    "t3_sketches": f"SELECT count(DISTINCT token) AS vocab_size, true AS within FROM ({_LONG}) l",
    "t5_oov_null": _beyond("coalesce(CAST(v.token_id AS VARCHAR), '-')", ""),
    "t5_oov_skip": _beyond("CAST(v.token_id AS VARCHAR)", "WHERE v.token_id IS NOT NULL"),
    "t5_oov_unk": _beyond("CAST(coalesce(v.token_id, -1) AS VARCHAR)", ""),
    "t6_decode": f"SELECT doc_id, length(decoded) AS decoded_chars, md5(decoded) AS decoded_md5 FROM ({_DEC}) d",
    "t12_token_freq": f"SELECT token, count(*) AS n FROM ({_LONG}) l GROUP BY token",
}
