"""Class scores (embeddings as logits) -> argmax, softmax, top-k, sampling, losses, reports;
vector standardisation and pooled token embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.operators import distributions as dist
from wordmill.operators import evaluation as ev
from wordmill.operators import ledger as led
from wordmill.operators import sampling as smp
from wordmill.operators import tokens as tok
from wordmill.operators import vectors as vec
from wordmill.plans import sqlbits as q
from wordmill.sources import adapters
from wordmill.session import cut_lineage, load_table

R6 = 6


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.class_scores(spark, sf_dir)


def row_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """<row_id, target, idx, split, batch_id>: 0.7/0.1/0.2 split, batches of 8 in split order
    (train drops its short last batch)."""
    rows = load_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("label").cast("int").alias("target"))
    # a narrow table that several branches read: materialised once
    sp = cut_lineage(smp.random_split(rows, "row_id", 0.7, 0.1, 0.2, seed=123))
    start = sp.groupBy("split").agg(F.min("idx").alias("_s"), F.count(F.lit(1)).alias("_n"))
    x = sp.join(F.broadcast(start), "split")  # three rows
    x = x.withColumn("batch_id", F.floor((F.col("idx") - F.col("_s")) / 8).cast("bigint"))
    keep = (F.col("split") != "train") | (F.col("batch_id") < F.floor(F.col("_n") / 8))
    return x.where(keep).drop("_s", "_n")


def m1_argmax(spark, sf_dir):
    return dist.argmax(scores(spark, sf_dir)).select("row_id", F.col("pred").cast("int").alias("pred"))


def m2_softmax(spark, sf_dir):
    p = dist.softmax(scores(spark, sf_dir))
    return p.select("row_id", "class_id", F.round("prob", R6).alias("prob"))


def m3_top_k(spark, sf_dir):
    k = dist.top_k(scores(spark, sf_dir), 5, mode="drop")
    return k.select("row_id", "class_id", F.round("logit", R6).alias("logit"))


def m4_temperature(spark, sf_dir):
    t = dist.softmax(dist.with_temperature(scores(spark, sf_dir), 1.4))
    return t.select("row_id", "class_id", F.round("prob", R6).alias("prob"))


def m5_sample(spark, sf_dir):
    s = dist.sample(scores(spark, sf_dir), seed=123, step=0, top_k_=25, temperature=1.4)
    return s.select("row_id", F.col("sampled").cast("int").alias("sampled"))


def m6_cross_entropy(spark, sf_dir):
    ce = dist.cross_entropy(scores(spark, sf_dir))
    return ce.select("row_id", F.round("loss", R6).alias("loss"))


def _scored_rows(spark, sf_dir) -> DataFrame:
    """<row_id, target, pred, loss, split, batch_id> of every row of a loader."""
    rs = row_splits(spark, sf_dir).select("row_id", "split", "batch_id")
    return dist.row_scores(scores(spark, sf_dir)).join(rs, "row_id")


def m7_loader_loss(spark, sf_dir):
    r = ev.split_report(_scored_rows(spark, sf_dir), 5)
    return r.select("split", F.round("loss_first", R6).alias("loss_first5"), F.round("loss_all", R6).alias("loss_all"),
                    F.round("loss_rows", R6).alias("loss_rows"))


def m8_accuracy(spark, sf_dir):
    r = ev.split_report(_scored_rows(spark, sf_dir), 5)
    return r.select("split", F.round("acc_first", R6).alias("acc_first5"), F.round("acc_all", R6).alias("acc_all"))


def m9_eval_report(spark, sf_dir):
    r = ev.split_report(_scored_rows(spark, sf_dir))
    names = spark.createDataFrame([(s,) for s in ("train", "validation", "test")], "split string")
    return names.join(F.broadcast(r), "split", "left").select(  # three rows
        "split", F.round(F.coalesce("loss_all", F.lit(float("nan"))), R6).alias("loss"),
        F.round(F.coalesce("acc_all", F.lit(0.0)), R6).alias("accuracy"))


def m10_loss_curve(spark, sf_dir):
    """Losses at every fifth step against epochs and tokens seen (rows x columns: a row has its classes)."""
    rows = cut_lineage(_scored_rows(spark, sf_dir).select("row_id", "split", "batch_id", "loss"))
    width = load_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.size("embedding").cast("bigint").alias("n_tok"))
    train = rows.where(F.col("split") == "train").select("row_id", "loss").join(width, "row_id")
    sched = cut_lineage(led.epoch_schedule(train, "row_id", num_epochs=5, batch_size=8, seed=123))
    points = led.eval_points(led.exposure_ledger(sched, "n_tok"), 5)
    train_loss = ev.loader_loss(sched, 5, "epoch").withColumnRenamed("loss", "train_loss")
    val = rows.where(F.col("split") == "validation")
    val_loss = ev.loader_loss(val, 5).withColumnRenamed("loss", "val_loss")
    points = cut_lineage(points.join(train_loss, "epoch").crossJoin(F.broadcast(val_loss)))  # one row
    curve = ev.loss_curve(points, 5, 5)
    return curve.select("step", "examples_seen", "tokens_seen", F.round("epoch_pos", R6).alias("epoch_pos"),
                        F.round("train_loss", R6).alias("train_loss"),
                        F.round("val_loss", R6).alias("val_loss"))


def v1_layer_norm(spark, sf_dir):
    base = load_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    emb = vec.layer_norm(base.where(F.size("embedding") > 0), "embedding", "n")
    # the _outer form keeps Catalyst from copying the whole expression into an inferred filter
    return emb.select("vec_id", F.posexplode_outer("n").alias("dim", "value")).select(
        "vec_id", F.col("dim").cast("int").alias("dim"), F.round("value", R6).alias("value"))


def v2_pooled(spark, sf_dir):
    docs = adapters.corpus(spark, sf_dir)
    vocab = tok.build_vocab(tok.explode_tokens(docs, "doc_id"))
    pooled = vec.pool_arrays(tok.encode_texts(docs, vocab), "doc_id", "ids", load_table(spark, sf_dir, "embeddings"))
    return pooled.select("doc_id", F.posexplode_outer("pooled").alias("dim", "value")).select(
        "doc_id", F.col("dim").cast("int").alias("dim"), F.round("value", R6).alias("value"))


QUERIES = {
    "m1_argmax": m1_argmax,
    "m2_softmax": m2_softmax,
    "m3_top_k": m3_top_k,
    "m4_temperature": m4_temperature,
    "m5_sample": m5_sample,
    "m6_cross_entropy": m6_cross_entropy,
    "m7_loader_loss": m7_loader_loss,
    "m8_accuracy": m8_accuracy,
    "m9_eval_report": m9_eval_report,
    "m10_loss_curve": m10_loss_curve,
    "v1_layer_norm": v1_layer_norm,
    "v2_pooled": v2_pooled,
}

_S = q.CLASS_SCORES
_CE = f"""
SELECT row_id, target, ln(sum(exp(logit - m))) + max(m) - max(CASE WHEN class_id = target THEN logit END) AS loss
FROM (SELECT *, max(logit) OVER (PARTITION BY row_id) AS m FROM ({_S}) s WHERE target <> -100) x
GROUP BY row_id, target
"""
_ARGMAX = f"SELECT row_id, CAST(arg_max(class_id, (logit, -class_id)) AS INTEGER) AS pred, any_value(target) AS target FROM ({_S}) s GROUP BY row_id"
_ROWS = "SELECT vec_id AS row_id, CAST(label AS INTEGER) AS target FROM embeddings"
_RS = f"""
SELECT row_id, target, split, batch_id FROM (
  SELECT *, CAST(floor((idx - min(idx) OVER (PARTITION BY split)) / 8) AS BIGINT) AS batch_id,
         count(*) OVER (PARTITION BY split) AS sn
  FROM ({q.split3(_ROWS.replace('vec_id AS row_id', 'vec_id AS doc_id'), 123)}) s0) s1
WHERE split <> 'train' OR batch_id < floor(sn / 8)
""".replace("SELECT row_id, target, split, batch_id", "SELECT doc_id AS row_id, target, split, batch_id")
ROW_SPLITS = _RS
_LOSS_B = f"SELECT r.split, r.batch_id, avg(c.loss) AS bl FROM ({_CE}) c JOIN ({_RS}) r ON c.row_id = r.row_id GROUP BY r.split, r.batch_id"
_PRED_S = f"SELECT r.split, r.batch_id, a.pred, a.target FROM ({_ARGMAX}) a JOIN ({_RS}) r ON a.row_id = r.row_id"
_SCHED = f"""
SELECT row_id, epoch, batch_id, epoch * nb + batch_id AS step FROM (
  SELECT row_id, epoch, CAST(floor(i / 8) AS BIGINT) AS batch_id, CAST(floor(n / 8) AS BIGINT) AS nb, n, i FROM (
    SELECT t.row_id, e.epoch,
           row_number() OVER (PARTITION BY e.epoch ORDER BY {q.hash_key(123, 'e.epoch', 't.row_id')}, e.epoch, t.row_id) - 1 AS i,
           count(*) OVER (PARTITION BY e.epoch) AS n
    FROM ({_RS}) t, (SELECT CAST(range AS INTEGER) AS epoch FROM range(5)) e WHERE t.split = 'train') a) b
WHERE batch_id < nb
"""
_POINTS = f"""
SELECT epoch, step, CAST(sum(ex) OVER (ORDER BY step) AS BIGINT) AS examples_seen,
       CAST(sum(tk) OVER (ORDER BY step) AS BIGINT) AS tokens_seen FROM
  (SELECT epoch, step, count(*) AS ex, sum(len(embedding)) AS tk FROM ({_SCHED}) s JOIN embeddings e ON e.vec_id = s.row_id
   GROUP BY epoch, step) g
"""

ORACLE = {
    "m1_argmax": f"SELECT row_id, pred FROM ({_ARGMAX}) a",
    "m2_softmax": f"SELECT row_id, class_id, round(exp(logit - m) / sum(exp(logit - m)) OVER (PARTITION BY row_id), 6) AS prob FROM (SELECT *, max(logit) OVER (PARTITION BY row_id) AS m FROM ({_S}) s) x",
    "m3_top_k": f"SELECT row_id, class_id, round(logit, 6) AS logit FROM (SELECT *, rank() OVER (PARTITION BY row_id ORDER BY logit DESC) AS rk FROM ({_S}) s) x WHERE rk <= 5",
    "m4_temperature": f"SELECT row_id, class_id, round(exp(l - m) / sum(exp(l - m)) OVER (PARTITION BY row_id), 6) AS prob FROM (SELECT *, max(l) OVER (PARTITION BY row_id) AS m FROM (SELECT row_id, class_id, logit / {q.dbl(1.4)} AS l FROM ({_S}) s) x0) x",
    "m5_sample": f"""
SELECT row_id, CAST(coalesce(min(CASE WHEN cum >= u THEN class_id END), max(class_id)) AS INTEGER) AS sampled FROM (
  SELECT row_id, class_id, sum(p) OVER (PARTITION BY row_id ORDER BY class_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
         {q.hash_uniform(123, 'row_id', '0')} AS u
  FROM (SELECT row_id, class_id, exp(l - m) / sum(exp(l - m)) OVER (PARTITION BY row_id) AS p
        FROM (SELECT *, max(l) OVER (PARTITION BY row_id) AS m FROM
              (SELECT row_id, class_id, logit / {q.dbl(1.4)} AS l FROM
               (SELECT *, rank() OVER (PARTITION BY row_id ORDER BY logit DESC) AS rk FROM ({_S}) s) k WHERE rk <= 25) t0) t) x) y
GROUP BY row_id""",
    "m6_cross_entropy": f"SELECT row_id, round(loss, 6) AS loss FROM ({_CE}) c",
    "m7_loader_loss": f"""
SELECT b.split, round(avg(CASE WHEN batch_id < 5 THEN bl END), 6) AS loss_first5, round(avg(bl), 6) AS loss_all, any_value(g.lr) AS loss_rows
FROM ({_LOSS_B}) b JOIN (SELECT r.split, round(avg(c.loss), 6) AS lr FROM ({_CE}) c JOIN ({_RS}) r ON c.row_id = r.row_id GROUP BY r.split) g
  ON g.split = b.split GROUP BY b.split""",
    "m8_accuracy": f"""
SELECT split, round(coalesce(count_if(batch_id < 5 AND pred = target) / count_if(batch_id < 5), 0), 6) AS acc_first5,
       round(count_if(pred = target) / count(*), 6) AS acc_all
FROM ({_PRED_S}) p GROUP BY split""",
    "m9_eval_report": f"""
SELECT s.split, round(coalesce(l.loss, 'NaN'::DOUBLE), 6) AS loss, round(coalesce(a.acc, 0), 6) AS accuracy
FROM (VALUES ('train'), ('validation'), ('test')) s(split)
LEFT JOIN (SELECT split, avg(bl) AS loss FROM ({_LOSS_B}) b GROUP BY split) l ON s.split = l.split
LEFT JOIN (SELECT split, count_if(pred = target) / count(*) AS acc FROM ({_PRED_S}) p GROUP BY split) a ON s.split = a.split""",
    "m10_loss_curve": f"""
SELECT p.step, p.examples_seen, p.tokens_seen,
       round(CASE WHEN n.n <= 1 THEN 0.0 ELSE floor(p.step / 5) * 5.0 / (n.n - 1) END, 6) AS epoch_pos,
       round(t.train_loss, 6) AS train_loss, round(v.val_loss, 6) AS val_loss
FROM ({_POINTS}) p
JOIN (SELECT epoch, avg(bl) AS train_loss FROM (
        SELECT s.epoch, s.batch_id, avg(c.loss) AS bl FROM ({_SCHED}) s JOIN ({_CE}) c ON s.row_id = c.row_id
        WHERE s.batch_id < 5 GROUP BY s.epoch, s.batch_id) b GROUP BY epoch) t ON p.epoch = t.epoch,
     (SELECT avg(bl) AS val_loss FROM ({_LOSS_B}) b WHERE split = 'validation' AND batch_id < 5) v,
     (SELECT count(*) AS n FROM ({_POINTS}) p2 WHERE step % 5 = 0) n
WHERE p.step % 5 = 0""",
    "v1_layer_norm": """
SELECT vec_id, CAST(i - 1 AS INTEGER) AS dim, round((CAST(embedding[i] AS DOUBLE) - mu) / sqrt(var + 1e-5), 6) AS value
FROM (SELECT vec_id, embedding,
             list_avg(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS mu,
             list_var_pop(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS var FROM embeddings) e,
     range(1, 65) r(i) WHERE i <= len(embedding)""",
    "v2_pooled": f"""
SELECT d.doc_id, p.dim, p.value FROM documents d LEFT JOIN (
  SELECT l.doc_id, CAST(r.i - 1 AS INTEGER) AS dim, round(avg(CAST(e.embedding[r.i] AS DOUBLE)), 6) AS value
  FROM ({q.long_tokens(q.DOCS)}) l JOIN ({q.DOC_VOCAB}) v ON l.token = v.token
  JOIN embeddings e ON e.vec_id = v.token_id, range(1, 65) r(i)
  GROUP BY l.doc_id, r.i) p ON p.doc_id = d.doc_id""",
}
