"""Entry C: corpus -> character split -> word ids -> n-gram model -> loss and continuation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.operators import ngram as ng
from wordmill.operators import prompts as pr
from wordmill.operators import sampling as smp
from wordmill.operators import tokens as tok
from wordmill.plans import sqlbits as q
from wordmill.functions.exchange import cut_packed, lookup_arrays
from wordmill.functions.text import word_tokens
from wordmill.session import cut_lineage, free_unused
from wordmill.sources import adapters


def corpus_ids(spark: SparkSession, sf_dir: str):
    """<doc_id, train_ids, val_ids, full_ids> and the vocabulary of both parts.

    Both halves are encoded in one pass by dictionary exchange, which shuffles neither texts nor tokens, and
    the result, which every n-gram query reads several times, is materialised once, as one array a
    document, packed in the reliable checkpoint folder.
    """
    parts = smp.char_split(adapters.corpus(spark, sf_dir), "text", 0.9)
    halves = parts.select("doc_id", F.posexplode(F.array("train_text", "val_text")).alias("part", "text"))
    vocab = tok.build_vocab(halves.select("doc_id", "part", F.posexplode(word_tokens("text")).alias("pos", "token")))
    none = F.array().cast("array<string>")
    words = [F.coalesce(word_tokens(c), none) for c in ("train_text", "val_text")]
    free_unused(spark)
    enc = lookup_arrays(parts.select("doc_id", F.size(words[0]).alias("n_train"), F.concat(*words).alias("words")),
                        ["doc_id", "n_train"], "words", vocab, "token", "token_id", "full_ids", missing="unknown token: ")
    enc = cut_packed(enc)
    free_unused(spark)  # the blocks and messages of the exchange
    ids = _one_text_an_id(enc)
    return ids.select("doc_id", F.slice("full_ids", F.lit(1), F.col("n_train")).alias("train_ids"),
                      F.slice("full_ids", F.col("n_train") + 1, F.size("full_ids") - F.col("n_train")).alias("val_ids"), "full_ids"), vocab


def _one_text_an_id(enc: DataFrame) -> DataFrame:
    """``enc(doc_id, n_train, full_ids)``, materialised; rows that share a doc_id have the tokens of all of them, by part and position.

    Rows without a doc_id have none. Where each row has its own id nothing is shuffled but the ids.
    """
    again = cut_lineage(enc.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").select(
        F.col("doc_id").alias("_wm_id")))
    if again.isEmpty():
        return enc
    same = F.col("doc_id").eqNullSafe(F.col("_wm_id"))
    shared = enc.join(again, same, "left_semi")
    at = shared.select("doc_id", "n_train", F.posexplode("full_ids").alias("pos", "token_id")).where("doc_id IS NOT NULL")
    late = F.col("pos") >= F.col("n_train")
    at = at.select("doc_id", late.alias("late"), F.when(late, F.col("pos") - F.col("n_train")).otherwise(F.col("pos")).alias("pos"), "token_id")
    whole = at.groupBy("doc_id").agg(F.count_if(~F.col("late")).cast("int").alias("n_train"), F.transform(
        F.array_sort(F.collect_list(F.struct("late", "pos", "token_id"))), lambda x: x["token_id"]).alias("full_ids"))
    whole = shared.select("doc_id").join(whole, "doc_id", "left").select(
        "doc_id", F.coalesce("n_train", F.lit(0)).alias("n_train"), F.coalesce("full_ids", F.array().cast("array<bigint>")).alias("full_ids"))
    return cut_packed(enc.join(again, same, "left_anti").unionByName(whole))


def _model(spark, sf_dir):
    ids, vocab = corpus_ids(spark, sf_dir)
    counts = ng.fit(ids, "train_ids", 2)
    return ids, vocab, counts


def _n_tokens(vocab: DataFrame) -> int:
    return vocab.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def l5_fit(spark, sf_dir):
    _, _, counts = _model(spark, sf_dir)
    return counts.select(F.element_at("ctx", 1).alias("ctx"), "next", "n")


def l6_loss(spark, sf_dir):
    ids, vocab, counts = _model(spark, sf_dir)
    v = vocab.agg(F.count(F.lit(1)).alias("v"))
    out = ng.loss(counts, ids, "val_ids", v, 2)
    return out.select("n_pairs", F.round("loss", 6).alias("loss"),
                      F.round("perplexity", 4).alias("perplexity"))


def l5_trigrams(spark, sf_dir):
    ids, _, _ = _model(spark, sf_dir)
    counts = ng.fit_orders(ids, "train_ids", 3).where(F.size("ctx") == 2)
    return counts.select(F.element_at("ctx", 1).alias("ctx1"), F.element_at("ctx", 2).alias("ctx2"), "next", "n")


def l6_backoff(spark, sf_dir):
    ids, vocab, _ = _model(spark, sf_dir)
    out = ng.backoff_loss(ng.fit_orders(ids, "train_ids", 3, apart=True), ids, "val_ids", vocab.count(), 3,
                          parts=ng.parts_for(_n_tokens(vocab)))
    return out.select("n_pairs", F.round("loss", 6).alias("loss"), F.round("perplexity", 4).alias("perplexity"))


def _ids_text(c: str) -> F.Column:
    return F.array_join(c, " ")


def l7_greedy(spark, sf_dir):
    ids, _, counts = _model(spark, sf_dir)
    g = ng.greedy_continue(ids, "doc_id", "full_ids", counts, 25, order=2)
    return g.select("doc_id", _ids_text("generated").alias("generated"))


def l8_sample(spark, sf_dir):
    ids, vocab, counts = _model(spark, sf_dir)
    tokens = _n_tokens(vocab)
    del vocab
    s = ng.sample_continue(ids, "doc_id", "full_ids", counts, 15, order=2, top_k=25,
                           temperature=1.4, eos_id=None, seed=123, parts=ng.parts_for(tokens))
    return s.select("doc_id", _ids_text("generated").alias("generated"))


def l8_sample_stop(spark, sf_dir):
    """L8 with a stop id that occurs: the id of the full stop."""
    ids, vocab, counts = _model(spark, sf_dir)
    stop = vocab.where(F.col("token") == ".").select("token_id").first()
    tokens = _n_tokens(vocab)
    del vocab  # its files are not needed from here on
    s = ng.sample_continue(ids, "doc_id", "full_ids", counts, 15, order=2, top_k=25,
                           temperature=1.4, eos_id=stop[0] if stop else None, seed=123, parts=ng.parts_for(tokens))
    return s.select("doc_id", _ids_text("generated").alias("generated"))


def l10_sample_report(spark, sf_dir):
    ids, vocab, counts = _model(spark, sf_dir)
    g = ng.greedy_continue(ids, "doc_id", "full_ids", counts, 50, order=2)
    text = tok.decode_ids(ids.join(g, "doc_id").select(
        "doc_id", F.concat("full_ids", "generated").alias("ids")), vocab)
    flat = pr.flatten_newlines("decoded")
    return text.select("doc_id", F.length(flat).cast("bigint").alias("n_chars"), F.md5(flat).alias("text_md5"))


QUERIES = {
    "l5_fit": l5_fit,
    "l6_loss": l6_loss,
    "l5_trigrams": l5_trigrams,
    "l6_backoff": l6_backoff,
    "l7_greedy": l7_greedy,
    "l8_sample": l8_sample,
    "l8_sample_stop": l8_sample_stop,
    "l10_sample_report": l10_sample_report,
}

_PARTS = ("SELECT doc_id, substr(text, 1, k) AS train_text, substr(text, k + 1) AS val_text FROM "
          "(SELECT doc_id, text, CAST(floor(length(text) * CAST(0.9 AS DOUBLE)) AS BIGINT) AS k FROM documents) d")
_BOTH = (f"SELECT doc_id * 2 AS rid, train_text AS text FROM ({_PARTS}) p "
         f"UNION ALL SELECT doc_id * 2 + 1 AS rid, val_text AS text FROM ({_PARTS}) p")
_VOCAB = q.vocab(_BOTH, "rid")
_ENC = q.encoded(_BOTH, _VOCAB, "rid")
_IDS = f"""
SELECT t.rid // 2 AS doc_id, t.ids AS train_ids, v.ids AS val_ids, list_concat(t.ids, v.ids) AS full_ids
FROM ({_ENC}) t JOIN ({_ENC}) v ON v.rid = t.rid + 1 WHERE t.rid % 2 = 0
"""
_COUNTS = f"SELECT train_ids[i - 1] AS ctx, train_ids[i] AS next, count(*) AS n FROM ({_IDS}) x, range(2, len(train_ids) + 1) r(i) GROUP BY ALL"
_BEST = f"SELECT ctx, arg_max(next, (n, -next)) AS best FROM ({_COUNTS}) c GROUP BY ctx"
_FB = f"SELECT arg_max(next, (n, -next)) AS fallback FROM (SELECT next, sum(n) AS n FROM ({_COUNTS}) c GROUP BY next) u"


def _greedy_sql(steps: int) -> str:
    return f"""
WITH RECURSIVE best AS MATERIALIZED ({_BEST}), fb AS MATERIALIZED ({_FB}),
prompts AS MATERIALIZED (SELECT doc_id, full_ids, full_ids[len(full_ids)] AS start FROM ({_IDS}) x),
walk(start, step, cur, path) AS (
  SELECT DISTINCT start, 0, start, []::BIGINT[] FROM prompts
  UNION ALL
  SELECT w.start, w.step + 1, coalesce(b.best, f.fallback), list_append(w.path, coalesce(b.best, f.fallback))
  FROM walk w LEFT JOIN best b ON b.ctx = w.cur CROSS JOIN fb f WHERE w.step < {steps})
SELECT p.doc_id, p.full_ids, w.path FROM prompts p JOIN walk w ON p.start = w.start AND w.step = {steps}
"""


_CAND = f"""
SELECT ctx, next, CASE WHEN rn_desc = 1 THEN 2.0 ELSE hi END AS hi, hi - p AS lo FROM (
  SELECT ctx, next, p, sum(p) OVER (PARTITION BY ctx ORDER BY next ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi,
         row_number() OVER (PARTITION BY ctx ORDER BY next DESC) AS rn_desc FROM (
    SELECT ctx, next, w / sum(w) OVER (PARTITION BY ctx) AS p FROM (
      SELECT ctx, next, exp((ln(n) - max(ln(n)) OVER (PARTITION BY ctx)) / {q.dbl(1.4)}) AS w FROM (
        SELECT *, rank() OVER (PARTITION BY ctx ORDER BY n DESC) AS rk FROM (
          SELECT ctx, next, n FROM ({_COUNTS}) c
          UNION ALL SELECT -1 AS ctx, next, sum(n) AS n FROM ({_COUNTS}) c GROUP BY next) a) b
      WHERE rk <= 25) c2) d) e
"""
_SAMPLE = f"""
WITH RECURSIVE cand AS MATERIALIZED ({_CAND}), known AS MATERIALIZED (SELECT DISTINCT ctx FROM cand),
walk(doc_id, step, cur, path) AS (
  SELECT doc_id, 0, full_ids[len(full_ids)], []::BIGINT[] FROM ({_IDS}) x
  UNION ALL
  SELECT w.doc_id, w.step + 1, c.next, list_append(w.path, c.next)
  FROM (SELECT w0.doc_id, w0.step, w0.path, coalesce(k.ctx, -1) AS eff,
               {q.hash_uniform(123, 'w0.doc_id', 'w0.step')} AS u
        FROM walk w0 LEFT JOIN known k ON k.ctx = w0.cur WHERE w0.step < 15) w
  JOIN cand c ON c.ctx = w.eff AND c.lo <= w.u AND w.u < c.hi)
SELECT doc_id, array_to_string(path, ' ') AS generated FROM walk WHERE step = 15
"""

ORACLE = {
    "l5_fit": f"SELECT ctx, next, n FROM ({_COUNTS}) c",
    "l6_loss": f"""
SELECT CAST(sum(mult) AS BIGINT) AS n_pairs, round(sum(-ln((coalesce(c.n, 0) + 1) / (coalesce(t.ctx_n, 0) + v.v)) * mult) / sum(mult), 6) AS loss,
       round(exp(sum(-ln((coalesce(c.n, 0) + 1) / (coalesce(t.ctx_n, 0) + v.v)) * mult) / sum(mult)), 4) AS perplexity
FROM (SELECT val_ids[i - 1] AS ctx, val_ids[i] AS next, count(*) AS mult FROM ({_IDS}) x, range(2, len(val_ids) + 1) r(i) GROUP BY ALL) p
LEFT JOIN ({_COUNTS}) c ON c.ctx = p.ctx AND c.next = p.next
LEFT JOIN (SELECT ctx, sum(n) AS ctx_n FROM ({_COUNTS}) c2 GROUP BY ctx) t ON t.ctx = p.ctx,
(SELECT count(*) AS v FROM ({_VOCAB}) vv) v""",
    "l7_greedy": f"SELECT doc_id, array_to_string(path, ' ') AS generated FROM ({_greedy_sql(25)}) g",
    "l8_sample": _SAMPLE,
    "l8_sample_stop": f"""
WITH RECURSIVE {_SAMPLE.split("WITH RECURSIVE", 1)[1].rsplit("SELECT doc_id, array_to_string", 1)[0].rstrip()},
last AS (SELECT doc_id, path FROM walk WHERE step = 15),
stop AS (SELECT token_id FROM ({_VOCAB}) v WHERE token = '.')
SELECT doc_id, array_to_string(CASE WHEN list_contains(path, token_id) THEN path[1 : list_position(path, token_id) - 1]
                               ELSE path END, ' ') AS generated
FROM last LEFT JOIN stop ON true""",
}

_L10 = f"""
WITH g AS ({_greedy_sql(50).replace("WITH RECURSIVE", "SELECT * FROM (WITH RECURSIVE", 1)}) gg),
ids AS (SELECT doc_id, list_concat(full_ids, path) AS all_ids FROM g),
toks AS (SELECT i.doc_id, string_agg(v.token, ' ' ORDER BY r.k) AS joined
         FROM ids i, range(1, len(i.all_ids) + 1) r(k)
         JOIN ({_VOCAB}) v ON v.token_id = i.all_ids[r.k] GROUP BY i.doc_id)
SELECT doc_id, length(replace({q.decode_clean('joined')}, chr(10), ' ')) AS n_chars,
       md5(replace({q.decode_clean('joined')}, chr(10), ' ')) AS text_md5 FROM toks
"""
ORACLE["l10_sample_report"] = _L10

_GRAMS = "SELECT {k}, train_ids[i] AS next, count(*) AS n FROM x, range({s}, len(train_ids) + 1) r(i) GROUP BY ALL"
_UNI, _BI, _TRI = (_GRAMS.format(k=k, s=s) for k, s in (
    ("0 AS c0", 1), ("train_ids[i - 1] AS c1", 2), ("train_ids[i - 2] AS c2, train_ids[i - 1] AS c1", 3)))
ORACLE["l5_trigrams"] = f"WITH x AS MATERIALIZED ({_IDS}), t AS ({_TRI}) SELECT c2 AS ctx1, c1 AS ctx2, next, n FROM t"
ORACLE["l6_backoff"] = f"""
WITH x AS MATERIALIZED ({_IDS}), u AS MATERIALIZED ({_UNI}), b AS MATERIALIZED ({_BI}), t AS MATERIALIZED ({_TRI}),
bt AS (SELECT c1, sum(n) AS s FROM b GROUP BY c1), tt AS (SELECT c2, c1, sum(n) AS s FROM t GROUP BY c2, c1),
z AS (SELECT (SELECT sum(n) FROM u) + (SELECT count(*) FROM ({_VOCAB}) v) AS z),
p AS (SELECT CASE WHEN i > 2 THEN val_ids[i - 2] END AS c2, val_ids[i - 1] AS c1, val_ids[i] AS next
      FROM x, range(2, len(val_ids) + 1) r(i)),
q AS (SELECT CASE WHEN t.n IS NOT NULL THEN -ln(t.n / tt.s)
                  WHEN b.n IS NOT NULL THEN -ln(b.n / bt.s) - CASE WHEN p.c2 IS NULL THEN 0 ELSE ln(0.4::DOUBLE) END
                  ELSE -ln((coalesce(u.n, 0) + 1) / z.z) - CASE WHEN p.c2 IS NULL THEN 1 ELSE 2 END * ln(0.4::DOUBLE) END AS l
      FROM p LEFT JOIN t ON t.c2 = p.c2 AND t.c1 = p.c1 AND t.next = p.next LEFT JOIN tt ON tt.c2 = p.c2 AND tt.c1 = p.c1
      LEFT JOIN b ON b.c1 = p.c1 AND b.next = p.next LEFT JOIN bt ON bt.c1 = p.c1 LEFT JOIN u ON u.next = p.next, z)
SELECT count(*) AS n_pairs, round(avg(l), 6) AS loss, round(exp(avg(l)), 4) AS perplexity FROM q"""
