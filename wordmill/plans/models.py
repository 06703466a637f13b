"""Batch scoring, classifiers and generated responses at table scale."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.operators import closed_form as cf
from wordmill.operators import labels as lab
from wordmill.operators import learning as ml
from wordmill.operators import ngram as ng
from wordmill.operators import prompts as pr
from wordmill.operators import sampling as smp
from wordmill.operators import tokens as tok
from wordmill.plans import scoring
from wordmill.plans import sqlbits as q
from wordmill.plans.classification import spam_splits
from wordmill.plans.scoring import row_splits
from wordmill.sources import adapters
from wordmill.sources import files as io
from wordmill.session import cut_lineage, load_table


def l1_batch_scoring(spark: SparkSession, sf_dir: str):
    emb = load_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    scored = ml.score_batches(emb, ml.argmax_scorer_factory("vec_id", "embedding"),
                              "vec_id bigint, pred int")
    return scored


def _spam_model(spark, sf_dir):
    sp = cut_lineage(spam_splits(spark, sf_dir).withColumnRenamed("Label", "label"))
    train = sp.where(F.col("split") == "train")
    cap = ml.longest_text(train, "Text")
    return sp, ml.fit_text_classifier(train, "Text", "label", cap), cap


def _rounded(quality: DataFrame) -> DataFrame:
    return quality.select("split", "n_rows", F.round("loss", 6).alias("loss"), F.round("accuracy", 6).alias("accuracy"))


def _facts(quality: DataFrame) -> DataFrame:
    """What SQL can predict of a fitted model: rows, its losses are numbers, training learned something."""
    learned = (F.col("split") != "train") | (F.col("accuracy") >= F.col("majority"))
    sound = (F.col("loss") >= 0) & F.col("accuracy").between(0, 1) & learned
    return quality.select("split", F.col("n_rows").cast("bigint").alias("n_rows"), sound.alias("sound"))


def _text_quality(spark, sf_dir) -> DataFrame:
    sp, model, cap = _spam_model(spark, sf_dir)
    return ml.quality_by(ml.classify(model, sp, "Text", max_length=cap, probs_col="probs"), ["split"])


def l2_text_classifier(spark, sf_dir):
    return _rounded(_text_quality(spark, sf_dir))


def l2_facts(spark, sf_dir):
    return _facts(_text_quality(spark, sf_dir))


def _head_quality(spark, sf_dir) -> DataFrame:
    rs = row_splits(spark, sf_dir).select("row_id", "split", F.col("target").alias("label"))
    emb = load_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"), "embedding")
    data = cut_lineage(rs.join(emb, "row_id"))
    model = ml.fit_linear_head(data.where(F.col("split") == "train"), "embedding", "label")
    return ml.quality_by(ml.apply_linear_head(model, data, "embedding", probs_col="probs"), ["split"])


def l3_linear_head(spark, sf_dir):
    return _rounded(_head_quality(spark, sf_dir))


def l3_facts(spark, sf_dir):
    return _facts(_head_quality(spark, sf_dir))


def _classified(spark, sf_dir) -> DataFrame:
    sp, model, cap = _spam_model(spark, sf_dir)
    test = sp.where(F.col("split") == "test").select("doc_id", "Text")
    pred = ml.classify(model, test, "Text", max_length=cap)
    return pred.select("doc_id", lab.prediction_name("pred").alias("predicted"))


def l4_classify_texts(spark, sf_dir):
    return _classified(spark, sf_dir)


def l4_facts(spark, sf_dir):
    return _classified(spark, sf_dir).select("doc_id", F.col("predicted").isin("spam", "ham").alias("named"))


def _bayes_scores(spark, sf_dir) -> DataFrame:
    """Scores of every split under the model of the training split, texts cut to its longest one."""
    sp = cut_lineage(spam_splits(spark, sf_dir).select("doc_id", "split", F.col("Label").alias("label"), "Text"))
    train = sp.where(F.col("split") == "train")
    cap = ml.longest_text(train, "Text")
    model = cf.token_bayes(ml.with_word_tokens(train, "Text"), "tokens", "label", 2)
    rows = ml.with_word_tokens(sp, "Text", max_length=max(1, cap))
    return cf.bayes_scores(rows, ["doc_id", "split", "label"], "tokens", model)


def l2_bayes(spark, sf_dir):
    return cf.quality(_bayes_scores(spark, sf_dir), ["split"], "scores", "label")


def l4_bayes(spark, sf_dir):
    found = _bayes_scores(spark, sf_dir).where(F.col("split") == "test")
    return found.withColumn("pred", cf.best_class("scores")).select(
        "doc_id", lab.prediction_name("pred").alias("predicted"), F.round(F.element_at("scores", 2) - F.element_at("scores", 1), 6).alias("margin"))


#: Classes of the embeddings.
HEAD_CLASSES = 10


def _head_rows(spark, sf_dir):
    rs = row_splits(spark, sf_dir).select("row_id", "split", F.col("target").alias("label"))
    emb = load_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"), "embedding")
    data = cut_lineage(rs.join(emb, "row_id"))
    return data, cf.least_squares_head(data.where(F.col("split") == "train"), "embedding", "label", HEAD_CLASSES)


def l3_weights(spark, sf_dir):
    _, weights = _head_rows(spark, sf_dir)
    rows = [(i, c, float(w)) for i, row in enumerate(weights) for c, w in enumerate(row)]
    return spark.createDataFrame(rows, "feature int, class_id int, w double").select(
        "feature", "class_id", F.round("w", 6).alias("weight"))


def l3_predictions(spark, sf_dir):
    data, weights = _head_rows(spark, sf_dir)
    return data.select("row_id", "split", cf.head_scores(weights, "embedding").alias("scores")).select(
        "row_id", "split", cf.best_class("scores").alias("pred"))


def l3_quality(spark, sf_dir):
    data, weights = _head_rows(spark, sf_dir)
    scored = data.select("split", "label", cf.head_scores(weights, "embedding").alias("scores"))
    return cf.quality(scored, ["split"], "scores", "label")


#: Ids that L9 generates at most (the reference's limit).
MAX_NEW_TOKENS = 256


def l9_responses(spark, sf_dir):
    """Continues the prompts of the held-out records up to the end-of-text id and exports the responses."""
    key = ["conv_id", "turn"]
    recs = smp.ordered_split(adapters.instruction_records(spark, sf_dir), key)
    recs = cut_lineage(recs.withColumn("full", pr.training_text("instruction", "input", "output"))
                       .withColumn("prompt", F.concat(pr.format_input("instruction", "input"),
                                                      F.lit(pr.RESPONSE_HEADER)))
                       .withColumn("rid", F.concat_ws("/", *key)))
    vocab = tok.build_vocab(tok.explode_tokens(recs.select("rid", F.col("full").alias("text")), "rid"))
    # the end-of-text id is the first one beyond the vocabulary, at the end of each training text
    end = vocab.agg(F.count(F.lit(1)).cast("bigint").alias("end_id")).first()["end_id"]
    train = tok.encode_texts(recs.where(F.col("split") == "train").select("rid", F.col("full").alias("text")),
                             vocab, id_col="rid")
    counts = cut_lineage(ng.fit(train.select(F.concat("ids", F.array(F.lit(end))).alias("ids")), "ids", 2))
    test = recs.where(F.col("split") == "test")
    prompts = cut_lineage(tok.encode_texts(test.select("rid", F.col("prompt").alias("text")), vocab, id_col="rid"))
    gen = ng.greedy_continue(prompts, "rid", "ids", counts, MAX_NEW_TOKENS, order=2, eos_id=end)
    # only what was generated is decoded: nothing of the prompt has to be cut off again
    text = tok.decode_ids(gen, vocab, id_col="rid", ids_col="generated", out_col="generated_text")
    out = test.join(text, "rid").withColumn("model_response", pr.extract_response("generated_text", F.lit("")))
    path = io.scratch_path(spark, "instruction-responses")
    io.write_json_records(out.select(*key, "instruction", "input", "output", "model_response"), path)
    back = spark.read.schema("conv_id bigint, turn bigint, " + io.RESPONSE_SCHEMA).json(path)
    return back.select(*key, F.length("model_response").cast("bigint").alias("response_chars"),
                       F.md5("model_response").alias("response_md5"))


QUERIES = {
    "l1_batch_scoring": l1_batch_scoring,
    "l2_text_classifier": l2_text_classifier,
    "l3_linear_head": l3_linear_head,
    "l2_facts": l2_facts,
    "l3_facts": l3_facts,
    "l4_classify_texts": l4_classify_texts,
    "l4_facts": l4_facts,
    "l2_bayes": l2_bayes,
    "l3_weights": l3_weights,
    "l3_predictions": l3_predictions,
    "l3_quality": l3_quality,
    "l4_bayes": l4_bayes,
    "l9_responses": l9_responses,
}

_SPLITS = q.spam_splits(123)

ORACLE = {
    "l2_facts": f"SELECT split, count(*) AS n_rows, true AS sound FROM ({_SPLITS}) s GROUP BY split",
    "l3_facts": f"SELECT split, count(*) AS n_rows, true AS sound FROM ({scoring.ROW_SPLITS}) s GROUP BY split",
    "l4_facts": f"SELECT doc_id, true AS named FROM ({_SPLITS}) s WHERE split = 'test'",
    "l1_batch_scoring": f"""
SELECT vec_id, CAST(arg_max(i - 1, (CAST(embedding[i] AS DOUBLE), -(i - 1))) AS INTEGER) AS pred
FROM embeddings, range(1, 65) r(i) WHERE i <= len(embedding) GROUP BY vec_id""",
}

_BAYES = f"""
WITH s AS MATERIALIZED ({_SPLITS}),
l AS MATERIALIZED (SELECT s.doc_id, s.split, s.Label, t.pos, t.token FROM s JOIN ({q.long_tokens('SELECT doc_id, Text FROM s', 'doc_id', 'Text')}) t
                   ON t.doc_id = s.doc_id),
cap AS (SELECT greatest(coalesce(max(pos) + 1, 0), 1) AS m FROM l WHERE split = 'train'),
n AS (SELECT token, count(*) FILTER (Label = 0) AS n0, count(*) FILTER (Label = 1) AS n1 FROM l WHERE split = 'train' GROUP BY token),
z AS (SELECT count(*) AS v, sum(n0) AS s0, sum(n1) AS s1 FROM n),
w AS MATERIALIZED (SELECT token, ln((n0 + 1.0::DOUBLE) / (s0 + v)) AS w0, ln((n1 + 1.0::DOUBLE) / (s1 + v)) AS w1 FROM n, z),
p AS (SELECT ln(count(*) FILTER (Label = 0)::DOUBLE / count(*)) AS p0, ln(count(*) FILTER (Label = 1)::DOUBLE / count(*)) AS p1
      FROM s WHERE split = 'train'),
d AS (SELECT l.doc_id, sum(w0) AS a0, sum(w1) AS a1 FROM l, cap, w WHERE l.token = w.token AND l.pos < cap.m GROUP BY l.doc_id),
x AS MATERIALIZED (SELECT s.doc_id, s.split, s.Label, p0 + coalesce(a0, 0) AS s0, p1 + coalesce(a1, 0) AS s1
                   FROM s CROSS JOIN p LEFT JOIN d ON d.doc_id = s.doc_id)"""
ORACLE |= {
    "l2_bayes": f"""{_BAYES}
SELECT split, count(*) AS n_rows,
       round(avg(ln(exp(s0 - greatest(s0, s1)) + exp(s1 - greatest(s0, s1))) + greatest(s0, s1) - CASE Label WHEN 0 THEN s0 ELSE s1 END), 6) AS loss,
       round(avg(CAST((CASE WHEN s1 > s0 THEN 1 ELSE 0 END) = Label AS DOUBLE)), 6) AS accuracy FROM x GROUP BY split""",
    "l4_bayes": f"""{_BAYES}
SELECT doc_id, CASE WHEN s1 > s0 THEN 'spam' ELSE 'ham' END AS predicted, round(s1 - s0, 6) AS margin FROM x WHERE split = 'test'""",
}

# Gauss-Jordan elimination of [Gram + 1 | class sums], one row a step; the matrix is positive definite.
_HEAD = f"""
WITH RECURSIVE
d AS MATERIALIZED (SELECT r.row_id, r.split, r.target AS label, [1.0::DOUBLE] || CAST(e.embedding AS DOUBLE[]) AS x
                   FROM ({scoring.ROW_SPLITS}) r JOIN embeddings e ON e.vec_id = r.row_id),
t AS MATERIALIZED (SELECT label, x FROM d WHERE split = 'train'),
g AS (SELECT i, j, sum(x[i] * x[j]) + CASE WHEN i = j THEN 1 ELSE 0 END AS v FROM t, range(1, 66) a(i), range(1, 66) b(j) GROUP BY i, j
      UNION ALL
      SELECT i, 66 + c, coalesce(sum(x[i]) FILTER (label = c), 0) FROM t, range(1, 66) a(i), range({HEAD_CLASSES}) b(c) GROUP BY i, c),
rows_ AS (SELECT i, list(v ORDER BY j) AS r FROM g GROUP BY i),
m(k, a) AS (
  SELECT 1, list(r ORDER BY i) FROM rows_
  UNION ALL
  SELECT k + 1, list_transform(a, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k])
         ELSE list_transform(r, lambda v, j: v - r[k] / a[k][k] * a[k][j]) END) FROM m WHERE k <= 65),
w AS MATERIALIZED (SELECT a FROM m WHERE k = 66),
s AS MATERIALIZED (SELECT row_id, split, label, list_transform(range({HEAD_CLASSES}), lambda c:
          list_sum(list_transform(x, lambda v, i: v * a[i][66 + c]))) AS s FROM d, w),
q AS (SELECT *, list_max(s) AS top FROM s)"""
ORACLE |= {
    "l3_weights": f"""{_HEAD}
SELECT CAST(i - 1 AS INTEGER) AS feature, CAST(c AS INTEGER) AS class_id, round(a[i][66 + c], 6) AS weight
FROM w, range(1, 66) f(i), range({HEAD_CLASSES}) b(c)""",
    "l3_predictions": f"{_HEAD} SELECT row_id, split, CAST(list_position(s, top) - 1 AS INTEGER) AS pred FROM q",
    "l3_quality": f"""{_HEAD}
SELECT split, count(*) AS n_rows,
       round(avg(ln(list_sum(list_transform(s, lambda v: exp(v - top)))) + top - s[label + 1]), 6) AS loss,
       round(avg(CAST(list_position(s, top) - 1 = label AS DOUBLE)), 6) AS accuracy FROM q GROUP BY split""",
}

_RECS = f"""
SELECT conv_id, turn, conv_id || '/' || turn AS rid, split,
       concat({q.format_input('instruction', 'input')}, chr(10), chr(10), '### Response:', chr(10)) AS prompt,
       concat({q.format_input('instruction', 'input')}, chr(10), chr(10), '### Response:', chr(10), output) AS full_text
FROM (SELECT *, CASE WHEN idx < floor(n * {q.dbl(0.85)}) THEN 'train'
                     WHEN idx < floor(n * {q.dbl(0.85)}) + floor(n * {q.dbl(0.1)}) THEN 'test' ELSE 'validation' END AS split
      FROM (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx, count(*) OVER () AS n
            FROM ({q.INSTRUCTIONS}) r0) r1) r2
"""
_RVOCAB = q.vocab(f"SELECT rid, full_text AS text FROM ({_RECS}) a", "rid")
_TRAIN_IDS = q.encoded(f"SELECT rid, full_text AS text FROM ({_RECS}) a WHERE split = 'train'", _RVOCAB, "rid")
_PROMPT_IDS = q.encoded(f"SELECT rid, prompt AS text FROM ({_RECS}) a WHERE split = 'test'", _RVOCAB, "rid")
_L9 = f"""
WITH RECURSIVE
vocab AS MATERIALIZED (SELECT token, token_id FROM ({_RVOCAB}) v0),
fin AS MATERIALIZED (SELECT count(*) AS end_id FROM vocab),
texts AS MATERIALIZED (SELECT list_append(ids, end_id) AS ids FROM ({_TRAIN_IDS}) t, fin),
counts AS MATERIALIZED (SELECT ids[i - 1] AS ctx, ids[i] AS next, count(*) AS n
                        FROM texts, range(2, len(ids) + 1) r(i) GROUP BY ALL),
best AS MATERIALIZED (SELECT ctx, arg_max(next, (n, -next)) AS best FROM counts GROUP BY ctx),
fb AS MATERIALIZED (SELECT arg_max(next, (n, -next)) AS fallback FROM
                    (SELECT next, sum(n) AS n FROM counts GROUP BY next) u),
prompts AS MATERIALIZED (SELECT rid, ids[len(ids)] AS start FROM ({_PROMPT_IDS}) p),
walk(start, step, cur) AS (
  SELECT DISTINCT start, 0, start FROM prompts
  UNION ALL
  SELECT w.start, w.step + 1, coalesce(b.best, f.fallback)
  FROM walk w LEFT JOIN best b ON b.ctx = w.cur CROSS JOIN fb f WHERE w.step < {MAX_NEW_TOKENS}),
stop AS (SELECT start, min(step) AS at FROM walk, fin WHERE step > 0 AND cur = end_id GROUP BY start),
gen AS (SELECT w.start, string_agg(v.token, ' ' ORDER BY w.step) AS joined
        FROM walk w LEFT JOIN stop s ON s.start = w.start JOIN vocab v ON v.token_id = w.cur
        WHERE w.step > 0 AND (s.at IS NULL OR w.step < s.at) GROUP BY w.start)
SELECT a.conv_id, a.turn, length(x.resp) AS response_chars, md5(x.resp) AS response_md5
FROM (SELECT p.rid, {q.py_strip("replace(" + q.decode_clean("coalesce(g.joined, '')") + ", '### Response:', '')")} AS resp
      FROM prompts p LEFT JOIN gen g ON g.start = p.start) x JOIN ({_RECS}) a ON a.rid = x.rid
"""
ORACLE["l9_responses"] = _L9
