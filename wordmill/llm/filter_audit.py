"""Filter interaction audit: what each filter removes at each step of every order of the filters.

1. A document's failed filters are a bit mask. Equal texts fail the same text filters, so rows meet by
   their text's SHA-256 with partial aggregates only: a group of copies is one row per part and label,
   and the smallest doc_id of the text decides which of its rows are repeats.
2. A mask is removed at the first of its letters. The orders that begin with given letters are one
   interval of lexicographic (Lehmer) ranks, so each mask and step is a list of intervals: its count is
   added where an interval starts and taken away where it ends.
3. Running sums over the ranks give what a step of an order removes; the other figures follow.

From step 2 on the tables have at most 2**k rows per part for k filters, whatever the corpus size.

Defined results: a null text is an empty text, a null part the empty string. A null doc_id is neither
smaller nor larger than another, so such rows repeat nothing and have no label. Rows with one doc_id and
one text repeat each other only if a smaller doc_id has the text. A document counts as labelled if any of
its label rows says so. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import itertools
import math
import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wordmill.llm.common import cut_lineage, native

#: White space of the contract's words.
SPACE = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SUMS = ("n", "good", "toxic")


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of one text: A short, B repetitive, C shouting, D symbols."""
    words = F.array_remove(F.split(text, SPACE, -1), "")
    n = F.size(words)
    upper = F.length(text) - F.length(F.translate(text, _UPPER, ""))
    return {"A": n < 100, "B": 100 * F.size(F.array_distinct(words)) < 80 * n, "C": 100 * upper > 10 * F.length(text),
            "D": text.rlike("[#$%&*|]")}


def mask_counts(docs: DataFrame, labels: DataFrame, repeated: int = 4) -> DataFrame:
    """part, mask, n, good, toxic: rows of ``docs(doc_id, text, lang)`` by failed filters.

    Bit i of the mask is the i-th of ``text_filters``; bit ``repeated`` says that a smaller doc_id has
    the very same text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_filters(F.col("text")).values())]
    rows = (native(docs, "doc_id", "text", "lang")
            .select(F.col("doc_id").cast("long"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                    text.alias("text"))
            .select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
                    reduce(operator.add, bits).alias("mask")))
    rows = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    marks = (native(labels, "doc_id", "quality", "toxic").where("doc_id is not null")
             .groupBy(F.col("doc_id").cast("long").alias("_id"), F.lit(0).cast("long").alias("_salt"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")))
    # rows without a doc_id have no label and are spread by their texts
    salt = F.when(F.col("doc_id").isNull(), 1 + F.pmod(F.xxhash64("digest"), F.lit(1 << 20))).otherwise(F.lit(0))
    rows = (rows.withColumn("_key", F.coalesce("doc_id", F.lit(0))).withColumn("_at", salt.cast("long"))
            .join(marks, (F.col("_key") == F.col("_id")) & (F.col("_at") == F.col("_salt")), "left")
            .withColumn("good", F.coalesce("good", F.lit(False))).withColumn("toxic", F.coalesce("toxic", F.lit(False))))
    # a doc_id stands once in each of these groups: the smallest one's rows are min_by(n, doc_id)
    groups = (rows.groupBy("digest", "part", "mask", "good", "toxic")
              .agg(F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"),
                   F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null")))
    is_first = F.col("first") == F.min("first").over(W.partitionBy("digest"))
    groups = groups.withColumn("once", F.col("n_null") + F.when(is_first, F.col("n_first")).otherwise(0))
    again = F.struct((F.col("mask") + (1 << repeated)).alias("mask"), (F.col("n") - F.col("once")).alias("n"))
    split = F.explode(F.array(F.struct("mask", F.col("once").alias("n")), again))
    return (groups.select("part", "good", "toxic", split.alias("s")).where("s.n > 0")
            .groupBy("part", F.col("s.mask").alias("mask"))
            .agg(F.sum("s.n").alias("n"), F.sum(F.when(F.col("good"), F.col("s.n")).otherwise(0)).alias("good"),
                 F.sum(F.when(F.col("toxic"), F.col("s.n")).otherwise(0)).alias("toxic")))


def lehmer_rank(order: tuple[int, ...]) -> int:
    """Place of a permutation of 0..k-1 among all of them in lexicographic order."""
    k = len(order)
    return sum(sum(later < x for later in order[i + 1:]) * math.factorial(k - 1 - i) for i, x in enumerate(order))


def removal_intervals(k: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, start, end): ranks start <= r < end of the orders that remove ``mask`` at ``step``."""
    out = []
    for mask in range(1, 1 << k):
        failed = [x for x in range(k) if mask >> x & 1]
        passed = [x for x in range(k) if not mask >> x & 1]
        for step in range(1, len(passed) + 2):
            for before in itertools.permutations(passed, step - 1):
                for letter in failed:
                    head = (*before, letter)
                    start = lehmer_rank(head + tuple(x for x in range(k) if x not in head))
                    out.append((mask, step, start, start + math.factorial(k - step)))
    return out


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table whose size follows the number of filters alone."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def audit_masks(counts: DataFrame, letters: str) -> DataFrame:
    """One row per part, order and step from ``counts(part, mask, n, good, toxic)``, see the module."""
    spark, k = counts.sparkSession, len(letters)
    orders = [(r, "".join(letters[x] for x in p), s + 1, letters[x], x)
              for r, p in enumerate(itertools.permutations(range(k))) for s, x in enumerate(p)]
    steps = _table(spark, orders, "rank int, filter_order string, step int, letter string, bit int")
    spans = _table(spark, removal_intervals(k), "mask int, step int, start int, stop int")
    counts = counts.select("part", F.col("mask").cast("int"), *_SUMS)
    ends = F.explode(F.array(
        F.struct(F.col("start").alias("rank"), *_SUMS),
        F.struct(F.col("stop").alias("rank"), *[(-F.col(c)).alias(c) for c in _SUMS])))
    steps_at = counts.join(spans, "mask").select("part", "step", ends.alias("e")).select("part", "step", "e.*")
    totals = counts.groupBy("part").agg(F.sum("n").alias("total"))
    every_rank = F.explode(F.sequence(F.lit(0), F.lit(math.factorial(k) - 1)))
    grid = (totals.select("part", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"))
            .select("part", "step", every_rank.alias("rank"), *[F.lit(0).cast("long").alias(c) for c in _SUMS]))
    arrays = (steps_at.unionByName(grid).where(F.col("rank") < math.factorial(k))
              .groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in _SUMS]))
    running = W.partitionBy("part", "step").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    removed = arrays.select("part", "step", "rank", *[F.sum(c).over(running).alias(c) for c in _SUMS])
    bit = F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    alone = F.col("mask") == F.expr("1 << bit")
    fails = (counts.withColumn("bit", bit).groupBy("part", "bit")
             .agg(F.sum(F.when(F.expr("(mask >> bit) & 1 = 1"), F.col("n")).otherwise(0)).alias("fails"),
                  F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("unique_fails")))
    so_far = W.partitionBy("part", "rank").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    return (removed.join(steps, ["rank", "step"]).join(totals, "part").join(fails, ["part", "bit"])
            .select("part", "filter_order", "step", (F.col("total") - F.sum("n").over(so_far)).alias("kept"),
                    F.col("n").alias("removed"), (F.col("fails") - F.col("n")).alias("redundant"), "unique_fails",
                    F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
                    F.sum("n").over(W.partitionBy("part", "bit")).alias("shapley")))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and their counts for the five filters A-E over ``docs(doc_id, text, lang)``.

    ``labels(doc_id, quality, toxic)`` covers some of the documents. kept: after this step; removed:
    here; redundant: failing this step's filter, removed earlier; unique_fails: failing it only;
    good_lost, toxic_lost: removed here with that label; shapley: removed by it over all orders.
    """
    return audit_masks(cut_lineage(mask_counts(docs, labels)), "ABCDE")


def oracle() -> str:
    """DuckDB twin of ``audit`` over documents and labels: every order applied to every mask."""
    return r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS x, coalesce(lang, '') AS part FROM documents),
        w AS (SELECT doc_id, x, part, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda s: s <> '') AS ws,
                     min(doc_id) OVER (PARTITION BY x) AS first_id FROM t),
        l AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
              FROM labels GROUP BY doc_id),
        m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                     CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END ||
                     CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END ||
                     CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * length(x) THEN 'C' ELSE '' END ||
                     CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' ELSE '' END ||
                     CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS failed
              FROM w LEFT JOIN l USING (doc_id)),
        c AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
              FROM m GROUP BY part, failed),
        f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
        o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
              WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
        s AS (SELECT filter_order, step::INT AS step, substr(filter_order, step, 1) AS letter,
                     substr(filter_order, 1, step - 1) AS before FROM o, range(1, 6) r(step)),
        j AS (SELECT c.part, s.filter_order, s.step, s.letter, c.n, c.good, c.toxic, contains(c.failed, s.letter) AS fails,
                     c.failed = s.letter AS only_it, c.failed <> '' AND
                     regexp_replace(s.before, '[^' || c.failed || '.]', '', 'g') <> '' AS earlier FROM c, s),
        g AS (SELECT part, filter_order, step, letter,
                     coalesce(sum(n) FILTER (NOT earlier AND NOT fails), 0)::BIGINT AS kept,
                     coalesce(sum(n) FILTER (NOT earlier AND fails), 0)::BIGINT AS removed,
                     coalesce(sum(n) FILTER (earlier AND fails), 0)::BIGINT AS redundant,
                     coalesce(sum(n) FILTER (only_it), 0)::BIGINT AS unique_fails,
                     coalesce(sum(good) FILTER (NOT earlier AND fails), 0)::BIGINT AS good_lost,
                     coalesce(sum(toxic) FILTER (NOT earlier AND fails), 0)::BIGINT AS toxic_lost
              FROM j GROUP BY part, filter_order, step, letter)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM g"""
