"""Token sequences -> windows, padded rows, batches, collation, schedules and ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.functions.text import word_tokens
from wordmill.operators import distributions as dist
from wordmill.operators import ledger as led
from wordmill.operators import prompts as pr
from wordmill.operators import sequences as seq
from wordmill.operators import tokens as tok
from wordmill.plans import sqlbits as q
from wordmill.plans.classification import narrow_splits, spam_splits
from wordmill.session import cut_lineage, load_table
from wordmill.sources import adapters

def doc_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tok.build_vocab(tok.explode_tokens(adapters.corpus(spark, sf_dir), "doc_id"))


def with_pad_id(df: DataFrame, vocab: DataFrame) -> DataFrame:
    """Adds ``pad_id``, the vocabulary size: the first id that is no word."""
    size = vocab.agg(F.count(F.lit(1)).cast("bigint").alias("pad_id"))
    return df.crossJoin(F.broadcast(size))  # one row


def encoded_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tok.encode_texts(adapters.corpus(spark, sf_dir), doc_vocab(spark, sf_dir))


def encoded_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification splits with word ids of their text: <doc_id, Label, split, idx, ids>."""
    sp = spam_splits(spark, sf_dir)
    vocab = doc_vocab(spark, sf_dir)
    enc = tok.encode_texts(sp.select("doc_id", F.col("Text").alias("text")), vocab)
    # read by several branches (per split, per epoch): materialise once
    return cut_lineage(with_pad_id(
        sp.select("doc_id", "Label", "split", "idx").join(enc, "doc_id"), vocab))


def md5_ids(c: str) -> F.Column:
    return F.md5(F.array_join(c, " "))


def q1_windows(spark, sf_dir):
    w = seq.sliding_windows(encoded_docs(spark, sf_dir), "ids", 256, 128)
    return w.select("doc_id", F.col("start").cast("bigint").alias("start"),
                    md5_ids("input_ids").alias("input_md5"),
                    md5_ids("target_ids").alias("target_md5"))


def q2_next_token(spark, sf_dir):
    nxt = seq.next_tokens(encoded_docs(spark, sf_dir), "doc_id")
    return nxt.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token_id", "next_id")


def q3_pad(spark, sf_dir):
    sp = encoded_splits(spark, sf_dir).where(F.col("split") == "train")
    p = seq.pad_to_longest(sp, "ids", None, F.col("pad_id"))
    return p.select("doc_id", F.col("max_length").cast("bigint").alias("max_length"),
                    md5_ids("padded").alias("padded_md5"))


def q4_pad_to_train(spark, sf_dir):
    p = seq.pad_to_split_longest(encoded_splits(spark, sf_dir), "ids", "split", "train", F.col("pad_id"))
    return p.select("doc_id", "split", F.size("padded").cast("bigint").alias("n_ids"),
                    md5_ids("padded").alias("padded_md5"))


def q5_batches(spark, sf_dir):
    sp = narrow_splits(spark, sf_dir)
    train = led.make_batches(sp.where(F.col("split") == "train"), "doc_id", 8,
                             shuffle=True, drop_last=True, seed=123)
    # every split is a loader of its own
    for name in ("validation", "test"):
        train = train.unionByName(led.make_batches(sp.where(F.col("split") == name), "doc_id", 8,
                                                   shuffle=False, drop_last=False))
    return train.select("doc_id", "split", "batch_id")


def _instruction_ids(spark, sf_dir) -> DataFrame:
    recs = adapters.instruction_records(spark, sf_dir)
    full = recs.select("conv_id", "turn",
                       pr.training_text("instruction", "input", "output").alias("text"))
    vocab = tok.build_vocab(tok.explode_tokens(full, ["conv_id", "turn"]))
    return with_pad_id(tok.encode_texts(full, vocab, id_col=["conv_id", "turn"]), vocab)


def _collated(spark, sf_dir) -> DataFrame:
    b = led.make_batches(_instruction_ids(spark, sf_dir), ["conv_id", "turn"], 8, shuffle=False, drop_last=False)
    return seq.collate(b, "ids", "batch_id", F.col("pad_id"), -100, allowed_max_length=1024)


def q6_collate(spark, sf_dir):
    return _collated(spark, sf_dir).select(
        "conv_id", "turn", "batch_id", F.size("input_ids").cast("bigint").alias("n_ids"),
        md5_ids("input_ids").alias("input_md5"), md5_ids("target_ids").alias("target_md5"))


def m6_masked_targets(spark, sf_dir):
    """Q6 -> M6 -> M7: per-token loss of the collated targets, -100 left out, mean of batch means.

    The class scores of a token are the embedding of its row (token id modulo the number of
    vectors), its target class the next id modulo the number of classes.
    """
    c = _collated(spark, sf_dir).select("conv_id", "turn", "batch_id",
                                        F.posexplode(F.arrays_zip("input_ids", "target_ids")).alias("pos", "t"))
    emb = load_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n = emb.agg(F.count(F.lit(1)).alias("n_vec"), F.max(F.size("embedding")).alias("n_cls"))
    target = F.when(F.col("t.target_ids") == -100, F.lit(-100)).otherwise(F.pmod(F.col("t.target_ids"), F.col("n_cls")))
    x = c.crossJoin(F.broadcast(n)).select("batch_id", F.pmod(F.col("t.input_ids"), F.col("n_vec")).alias("vec_id"),
                                           target.cast("int").alias("target"))
    # tokens of one (vector, target) have one loss: it is computed once and weighted
    seen = cut_lineage(x.groupBy("batch_id", "vec_id", "target").agg(F.count(F.lit(1)).alias("n")))
    pairs = seen.select("vec_id", "target").distinct().join(emb, "vec_id")
    long = pairs.select("vec_id", "target", F.posexplode("embedding").alias("class_id", "v"))
    loss = dist.cross_entropy(long.withColumn("logit", F.col("v").cast("double")), ["vec_id"])
    kept = seen.join(loss, ["vec_id", "target"]).groupBy("batch_id").agg(
        (F.sum(F.col("loss") * F.col("n")) / F.sum("n")).alias("loss"), F.sum("n").alias("n"))
    masked = seen.where(F.col("target") == -100).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_masked"))
    return kept.agg(F.sum("n").cast("bigint").alias("n_tokens"), F.round(F.avg("loss"), 6).alias("loss")).crossJoin(
        F.broadcast(masked))


def q10_last_n(spark, sf_dir):
    e = encoded_docs(spark, sf_dir)
    return e.select("doc_id", md5_ids(seq.last_n("ids", 256)).alias("context_md5"))


def q11_classifier_input(spark, sf_dir):
    sp = encoded_splits(spark, sf_dir)
    longest = sp.where(F.col("split") == "train").agg(F.max(F.size("ids")).alias("m"))  # one row
    x = sp.where(F.col("split") == "test").crossJoin(F.broadcast(longest))
    return x.select("doc_id", md5_ids(seq.classifier_input("ids", F.col("m"), 1024, F.col("pad_id")))
                    .alias("input_md5"))


def _schedule(train):
    """The train loader's visits."""
    return led.epoch_schedule(train, "doc_id", num_epochs=5, batch_size=8, seed=123, drop_last=True)


def q7_schedule(spark, sf_dir):
    train = narrow_splits(spark, sf_dir).where(F.col("split") == "train").select("doc_id")
    return _schedule(train).select("doc_id", "epoch", "batch_id", "step")


def _ledger(spark, sf_dir):
    """A row is padded to the longest one, so it has that many tokens; only their number is looked at."""
    train = narrow_splits(spark, sf_dir).where(F.col("split") == "train").select("doc_id")
    texts = adapters.corpus(spark, sf_dir).join(train, "doc_id", "left_semi")
    longest = texts.agg(F.max(F.size(word_tokens("text"))).cast("bigint").alias("n_tok"))  # one row
    return led.exposure_ledger(_schedule(train.crossJoin(F.broadcast(longest))), "n_tok")


def q8_exposure(spark, sf_dir):
    return _ledger(spark, sf_dir).select("epoch", "step", "examples_seen", "tokens_seen")


def q9_eval_points(spark, sf_dir):
    return led.eval_points(_ledger(spark, sf_dir), 5).select("step", "examples_seen", "tokens_seen")


QUERIES = {
    "q1_windows": q1_windows,
    "q2_next_token": q2_next_token,
    "q3_pad": q3_pad,
    "q4_pad_to_train": q4_pad_to_train,
    "q5_batches": q5_batches,
    "q6_collate": q6_collate,
    "m6_masked_targets": m6_masked_targets,
    "q10_last_n": q10_last_n,
    "q11_classifier_input": q11_classifier_input,
    "q7_schedule": q7_schedule,
    "q8_exposure": q8_exposure,
    "q9_eval_points": q9_eval_points,
}

_SPL = q.spam_splits(123)
_SPL_ENC = f"""
SELECT s.doc_id, s.Label, s.split, s.idx, e.ids FROM ({_SPL}) s
JOIN ({q.encoded(f"SELECT doc_id, Text AS text FROM ({_SPL}) s2", q.DOC_VOCAB)}) e ON s.doc_id = e.doc_id
"""
_PAD = f"(SELECT count(*) FROM ({q.DOC_VOCAB}) pv)"
_TRAIN_MAX = f"(SELECT max(len(ids)) FROM ({_SPL_ENC}) t WHERE split = 'train')"
_INSTR = f"""
SELECT conv_id || '/' || turn AS rid, conv_id, turn,
       concat({q.format_input('instruction', 'input')}, chr(10), chr(10), '### Response:', chr(10), output) AS text
FROM ({q.INSTRUCTIONS}) r
"""
_INSTR_IDS = f"""
SELECT i.conv_id, i.turn, e.ids, (SELECT count(*) FROM ({q.vocab(_INSTR, 'rid')}) iv) AS pad FROM ({_INSTR}) i
JOIN ({q.encoded(f"SELECT rid, text FROM ({_INSTR}) x", q.vocab(_INSTR, 'rid'), 'rid')}) e ON i.rid = e.rid
"""
_COLL = f"""
SELECT conv_id, turn, batch_id, pad, m, p[1:m-1] AS inp, p[2:m] AS tgt FROM (
  SELECT *, list_concat(ids, list_resize([]::BIGINT[], m - len(ids), pad)) AS p FROM (
    SELECT *, max(len(ids) + 1) OVER (PARTITION BY batch_id) AS m FROM (
      SELECT *, CAST(floor((row_number() OVER (ORDER BY conv_id, turn) - 1) / 8) AS BIGINT) AS batch_id
      FROM ({_INSTR_IDS}) a) b) c) d
"""
_MASKED = f"""
SELECT conv_id, turn, batch_id, inp[1:1024] AS inp,
       list_transform(tgt, lambda x, i: CASE WHEN x = pad AND f > 0 AND i > f THEN -100 ELSE x END)[1:1024] AS tgt
FROM (SELECT *, list_position(tgt, pad) AS f FROM ({_COLL}) c) x
"""
_SCHED = f"""
SELECT doc_id, epoch, CAST(floor(i / 8) AS BIGINT) AS batch_id, CAST(floor(n / 8) AS BIGINT) AS nb, longest AS n_tok
FROM (SELECT t.*, e.epoch, max(len(t.ids)) OVER () AS longest,
             row_number() OVER (PARTITION BY e.epoch ORDER BY {q.hash_key(123, 'e.epoch', 't.doc_id')}, e.epoch, t.doc_id) - 1 AS i,
             count(*) OVER (PARTITION BY e.epoch) AS n
      FROM ({_SPL_ENC}) t, (SELECT CAST(range AS INTEGER) AS epoch FROM range(5)) e WHERE t.split = 'train') s
WHERE floor(i / 8) < floor(n / 8)
"""
_LEDGER = f"""
SELECT epoch, step, CAST(sum(ex) OVER (ORDER BY step) AS BIGINT) AS examples_seen, CAST(sum(tk) OVER (ORDER BY step) AS BIGINT) AS tokens_seen
FROM (SELECT epoch, epoch * nb + batch_id AS step, count(*) AS ex, CAST(sum(n_tok) AS BIGINT) AS tk
      FROM ({_SCHED}) s GROUP BY epoch, epoch * nb + batch_id) g
"""

ORACLE = {
    "q1_windows": f"""
SELECT doc_id, CAST(s.st AS BIGINT) AS start, {q.ids_md5('ids[s.st + 1 : s.st + 256]')} AS input_md5,
       {q.ids_md5('ids[s.st + 2 : s.st + 257]')} AS target_md5
FROM ({q.DOC_ENC}) e, LATERAL (SELECT unnest(range(0, len(e.ids) - 256, 128)) AS st) s
WHERE len(e.ids) > 256""",
    "q2_next_token": f"""
SELECT l.doc_id, CAST(l.pos AS BIGINT) AS pos, v.token_id,
       lead(v.token_id) OVER (PARTITION BY l.doc_id ORDER BY l.pos) AS next_id
FROM ({q.long_tokens(q.DOCS)}) l JOIN ({q.DOC_VOCAB}) v ON l.token = v.token""",
    "q3_pad": f"""
SELECT doc_id, CAST(m AS BIGINT) AS max_length, {q.ids_md5(q.pad('ids', 'm', 'pad'))} AS padded_md5
FROM (SELECT *, {_TRAIN_MAX} AS m, {_PAD} AS pad FROM ({_SPL_ENC}) t WHERE split = 'train') x""",
    "q4_pad_to_train": f"""
SELECT doc_id, split, CAST(len({q.pad('ids', 'm', 'pad')}) AS BIGINT) AS n_ids, {q.ids_md5(q.pad('ids', 'm', 'pad'))} AS padded_md5
FROM (SELECT *, {_TRAIN_MAX} AS m, {_PAD} AS pad FROM ({_SPL_ENC}) t) x""",
    "q5_batches": f"""
SELECT doc_id, split, batch_id FROM (
  SELECT doc_id, split, CAST(floor((row_number() OVER (ORDER BY {q.hash_key(123, 'doc_id')}, doc_id) - 1) / 8) AS BIGINT) AS batch_id,
         count(*) OVER () AS n
  FROM ({_SPL_ENC}) t WHERE split = 'train') a WHERE batch_id < floor(n / 8)
UNION ALL
SELECT doc_id, split, CAST(floor((row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1) / 8) AS BIGINT) AS batch_id
FROM ({_SPL_ENC}) t WHERE split <> 'train'""",
    "q6_collate": f"""
SELECT conv_id, turn, batch_id, CAST(len(inp) AS BIGINT) AS n_ids, {q.ids_md5('inp')} AS input_md5,
       {q.ids_md5('tgt')} AS target_md5 FROM ({_MASKED}) m""",
    "m6_masked_targets": f"""
WITH tok AS (SELECT batch_id, inp[r.i] AS x, tgt[r.i] AS y FROM ({_MASKED}) m, range(1, 1025) r(i) WHERE r.i <= len(inp)),
cnt AS (SELECT count(*) AS nv, max(len(embedding)) AS nc FROM embeddings),
seen AS (SELECT batch_id, x % nv AS vec_id, CASE WHEN y = -100 THEN -100 ELSE y % nc END AS target FROM tok, cnt),
z AS (SELECT vec_id, list_max(embedding) AS top, embedding FROM embeddings),
lse AS (SELECT vec_id, embedding, CAST(top AS DOUBLE) + ln(list_sum(list_transform(embedding, lambda v: exp(CAST(v AS DOUBLE) - CAST(top AS DOUBLE))))) AS l FROM z),
per AS (SELECT s.batch_id, avg(lse.l - CAST(lse.embedding[s.target + 1] AS DOUBLE)) AS bl, count(*) AS n
        FROM seen s JOIN lse ON lse.vec_id = s.vec_id WHERE s.target <> -100 GROUP BY s.batch_id)
SELECT CAST(sum(n) AS BIGINT) AS n_tokens, round(avg(bl), 6) AS loss,
       (SELECT count(*) FROM seen WHERE target = -100) AS n_masked FROM per""",
    "q10_last_n": f"SELECT doc_id, {q.ids_md5('ids[greatest(len(ids) - 255, 1) : greatest(len(ids) - 255, 1) + 255]')} AS context_md5 FROM ({q.DOC_ENC}) e",
    "q11_classifier_input": f"""
SELECT doc_id, {q.ids_md5(q.pad('ids', 'least(m, 1024)', 'pad').replace('list_resize([]::BIGINT[], greatest(least(m, 1024) -', 'list_resize([]::BIGINT[], greatest(m -'))} AS input_md5
FROM (SELECT *, {_TRAIN_MAX} AS m, {_PAD} AS pad FROM ({_SPL_ENC}) t WHERE split = 'test') x""",
    "q7_schedule": f"SELECT doc_id, epoch, batch_id, epoch * nb + batch_id AS step FROM ({_SCHED}) s",
    "q8_exposure": f"SELECT epoch, step, examples_seen, CAST(tokens_seen AS BIGINT) AS tokens_seen FROM ({_LEDGER}) l",
    "q9_eval_points": f"SELECT step, examples_seen, CAST(tokens_seen AS BIGINT) AS tokens_seen FROM ({_LEDGER}) l WHERE step % 5 = 0",
}
