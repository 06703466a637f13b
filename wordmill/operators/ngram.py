"""An n-gram next-token model fitted, scored and used for continuation.

Re-aimed from transformer pre-training: the model is a table of counts
``<ctx ARRAY<BIGINT>, next, n>`` (ctx = the previous ``order - 1`` ids).

* Fitting is one aggregate with map-side partial counts (hot n-grams are
  combined before the shuffle).
* Loss pre-aggregates validation pairs to distinct (ctx, next) with a
  multiplicity before joining, so no hot pair is joined row by row.
* Greedy continuation depends only on the context: distinct start contexts are
  continued by path doubling over the contexts that they reach, with few joins.
* Sampled continuation is an inverse-CDF lookup per prompt and step. Each
  context's cumulative probabilities are cut into ``max(ceil(k/4),
  ceil(4096 * share of training occurrences))`` buckets of the [0,1) axis,
  so the per-step join is an equi-join on (ctx, bucket) that meets a handful
  of candidate rows per prompt, and a hot context is split over many keys.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.functions import joins
from wordmill.functions.joins import salted_lookup
from wordmill.functions.order import hash_uniform
from wordmill.session import cut_lineage, free_unused

# Buckets shared out by training frequency: a context with share f gets >= f * 4096.
HOT_BUCKETS = 4096
# Buckets whose candidates a step finds together.
CHUNK_BUCKETS = 32
# Tokens that make a part of the n-grams worth while, and the most parts; each is another pass over the ids.
PART_TOKENS, MAX_PARTS = 1 << 20, 8
# Levels of contexts that greedy walks are followed before the steps of all contexts are made.
GREEDY_LEVELS = 12


def empty_ctx() -> Column:
    return F.array().cast("array<bigint>")


def context_of(ids: Column, order: int) -> Column:
    """The last ``order - 1`` ids (fewer when the row is shorter)."""
    k = order - 1
    if k <= 0:
        return empty_ctx()
    return F.slice(ids, F.greatest(F.size(ids) - F.lit(k) + 1, F.lit(1)), F.lit(k))


def ngram_pairs(df: DataFrame, ids_col: str, order: int = 2) -> DataFrame:
    """Every (ctx, next) occurrence: positions ``i >= order-1``, ctx = ids[i-order+1 .. i-1]."""
    k = order - 1
    n = F.size(ids_col)
    pos = F.sequence(F.lit(k), n - 1)
    x = df.where(n > F.lit(k)).select(F.col(ids_col).alias("_wm_ids"), F.explode(pos).alias("_wm_i"))
    ctx = F.slice("_wm_ids", F.col("_wm_i") - F.lit(k) + 1, F.lit(k)) if k > 0 else empty_ctx()
    return x.select(ctx.cast("array<bigint>").alias("ctx"),
                    F.element_at("_wm_ids", F.col("_wm_i") + 1).cast("bigint").alias("next"))


def fit(df: DataFrame, ids_col: str, order: int = 2) -> DataFrame:
    """N-gram counts ``<ctx, next, n>`` over a table of id arrays.

    A filter on ``ctx`` acts before the shuffle, so counts can be taken part by part.
    """
    return _tallied(ngram_pairs(df, ids_col, order), order, "n")


def _part_of(ids: list[Column], parts: int) -> Column:
    """The part, of so many, of a context given by its ids."""
    return F.pmod(F.xxhash64(*ids), F.lit(parts))


def parts_for(n_tokens: int) -> int:
    """Parts in which the n-grams of so many tokens are worked on, so that the disk holds the shuffles of one part only."""
    return max(1, min(MAX_PARTS, n_tokens // PART_TOKENS))


def _tallied(pairs: DataFrame, order: int, count_col: str) -> DataFrame:
    """Distinct <ctx, next> with their number; the ids of a context are shuffled as plain columns, half as wide as arrays."""
    own = [F.col("ctx")[i].alias(f"_wm_c{i}") for i in range(order - 1)]
    names = [f"_wm_c{i}" for i in range(order - 1)]
    counted = pairs.select(*own, "next").groupBy(*names, "next").agg(F.count(F.lit(1)).alias(count_col))
    ctx = F.array(*names) if names else empty_ctx()
    return counted.select(ctx.cast("array<bigint>").alias("ctx"), "next", count_col)


def context_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("ctx").agg(F.sum("n").alias("ctx_n"),
                                     F.count(F.lit(1)).alias("n_next"))


def loss(counts: DataFrame, val: DataFrame, ids_col: str, vocab_size: DataFrame | int,
         order: int = 2) -> DataFrame:
    """Mean ``-log P(next|ctx)`` with ``P = (c + 1) / (C + V)`` and its perplexity.

    ``vocab_size`` is an int or a one-row DataFrame with column ``v``.
    """
    v = F.lit(vocab_size) if isinstance(vocab_size, int) else F.col("v")
    pairs = _tallied(ngram_pairs(val, ids_col, order), order, "mult")
    # the distinct successors of a frequent context would meet on its key: salted by their number
    totals = context_totals(counts).select("ctx", "ctx_n", "n_next")
    # on the plain ids, by which ``fit`` leaves its counts partitioned
    known = counts.select(*[F.col("ctx")[i].alias(f"_wm_c{i}") for i in range(order - 1)], F.col("next").alias("_wm_next"), "n")
    same = reduce(lambda a, b: a & b, [pairs["ctx"][i] == known[f"_wm_c{i}"] for i in range(order - 1)], pairs["next"] == known["_wm_next"])
    j = salted_lookup(pairs.join(known, same, "left").select("ctx", "next", "mult", "n"), totals, "ctx", salt_cols=["next"],
                      freq_col="n_next")
    if not isinstance(vocab_size, int):
        j = j.crossJoin(F.broadcast(vocab_size.select("v")))  # one row
    p = (F.coalesce(F.col("n"), F.lit(0)) + 1).cast("double") / (
        F.coalesce(F.col("ctx_n"), F.lit(0)) + v).cast("double")
    agg = j.agg(F.sum("mult").alias("n_pairs"),
                (F.sum(-F.log(p) * F.col("mult")) / F.sum("mult")).alias("loss"))
    return agg.withColumn("perplexity", F.exp("loss"))


def fit_orders(df: DataFrame, ids_col: str, order: int = 3, apart: bool = False) -> DataFrame | list[DataFrame]:
    """Counts ``<ctx, next, n>`` of every order from 1 to ``order``; ``size(ctx) + 1`` is the order.

    They come from one pass over the ids, or, with ``apart``, as one table for each order, which can be taken in parts.
    """
    if apart:
        return [fit(df, ids_col, k) for k in range(1, order + 1)]
    pos = F.explode(F.sequence(F.lit(0), F.size(ids_col) - 1))
    x = df.where(F.size(ids_col) > 0).select(F.col(ids_col).alias("_wm_ids"), pos.alias("_wm_i"))
    x = x.withColumn(
        "_wm_k", F.explode(F.sequence(F.lit(0), F.least(F.col("_wm_i"), F.lit(order - 1)))))
    # plain columns are shuffled, the last id of a context in the last one
    own = [F.when(F.col("_wm_k") >= back, F.element_at("_wm_ids", F.greatest(F.col("_wm_i") + 1 - back, F.lit(1)))).cast("bigint")
           .alias(f"_wm_c{back}") for back in range(order - 1, 0, -1)]
    names = [f"_wm_c{back}" for back in range(order - 1, 0, -1)]
    counted = x.select("_wm_k", *own, F.element_at("_wm_ids", F.col("_wm_i") + 1).cast("bigint").alias("next")).groupBy(
        "_wm_k", *names, "next").agg(F.count(F.lit(1)).alias("n"))
    ctx = F.slice(F.array(*names), F.lit(order) - F.col("_wm_k"), F.col("_wm_k")) if names else empty_ctx()
    return counted.select(ctx.cast("array<bigint>").alias("ctx"), "next", "n")


def backoff_loss(counts: DataFrame | list[DataFrame], val: DataFrame, ids_col: str, vocab_size: int, order: int = 3,
                 alpha: float = 0.4, parts: int = 1) -> DataFrame:
    """Mean ``-log S(next | context)`` by back-off over ``fit_orders`` counts, and its perplexity.

    S is n(ctx, next) / n(ctx) where the pair was seen, else ``alpha`` times S under the context without its
    first id; without context it is (n(next) + 1) / (N + V). The first id of a row is not scored. Pairs that an
    order doesn't have go on to the next lower one, counted together again, so every join has distinct keys.
    An order with contexts is worked off in ``parts``, by the hash of the context: the counts are never stored, and the
    shuffle files of a part go before the next one begins.
    """
    own_of = counts if isinstance(counts, list) else [counts.where(F.size("ctx") == k) for k in range(order)]
    pos = F.explode(F.sequence(F.lit(1), F.size(ids_col) - 1))
    x = val.where(F.size(ids_col) > 1).select(F.col(ids_col).alias("_wm_ids"), pos.alias("_wm_i"))
    k = F.least(F.col("_wm_i"), F.lit(order - 1))
    left = x.select(F.slice("_wm_ids", F.col("_wm_i") - k + 1, k).cast("array<bigint>").alias("ctx"),
                    F.element_at("_wm_ids", F.col("_wm_i") + 1).cast("bigint").alias("next"))
    left = cut_lineage(left.groupBy("ctx", "next").agg(F.count(F.lit(1)).alias("mult")))
    scored = []
    for size in range(order - 1, 0, -1):
        done = []
        for part in range(parts):
            done.append(cut_lineage(_scored_part(own_of[size], left, size, part, parts, alpha)))
            if parts > 1:
                free_unused(val.sparkSession)
        done = reduce(DataFrame.unionByName, done)
        scored.append(done.where("ctx IS NULL").select("mult", "l"))
        missed = done.where("ctx IS NOT NULL").select("ctx", "next", "mult")
        left = cut_lineage(left.where(F.size("ctx") < size).unionByName(missed).groupBy("ctx", "next").agg(F.sum("mult").alias("mult")))
    uni = own_of[0].select("next", "n")
    every = uni.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("_wm_all"))  # one row
    last = left.join(uni, "next", "left").crossJoin(F.broadcast(every))
    p = (F.coalesce("n", F.lit(0)) + 1) / (F.col("_wm_all") + F.lit(vocab_size))
    scored.append(last.agg(F.sum("mult").alias("mult"), F.sum(-F.log(p) * F.col("mult")).alias("l")))
    out = reduce(DataFrame.unionByName, scored).agg(F.sum("mult").alias("n_pairs"), (F.sum("l") / F.sum("mult")).alias("loss"))
    return out.withColumn("perplexity", F.exp("loss"))


def _scored_part(own: DataFrame, left: DataFrame, size: int, part: int, parts: int, alpha: float) -> DataFrame:
    """Of the pairs in ``left`` whose context has ``size`` ids and is in this part: a row <ctx, next, mult> with the shorter
    context for each that ``own`` doesn't have, and one row <mult, l> without context for the number and the loss
    of those it has, and the steps down of the others."""
    names = [f"_wm_c{i}" for i in range(size)]

    def plain(df: DataFrame, *cols: str) -> DataFrame:
        x = df.select(*[F.col("ctx")[i].alias(name) for i, name in enumerate(names)], *cols)
        return x.where(_part_of([F.col(name) for name in names], parts) == part) if parts > 1 else x
    # by the plain ids, by which ``fit`` leaves its counts partitioned; the few pairs are held, the counts stream by
    here = plain(left.where(F.size("ctx") == size), F.col("next").alias("_wm_next"), "mult")
    own = plain(own, "next", "n").withColumnsRenamed({name: f"{name}o" for name in names})
    same = reduce(lambda a, b: a & b, [F.col(f"{name}o") == F.col(name) for name in names], F.col("next") == F.col("_wm_next"))
    met = own.join(here.hint("shuffle_hash"), same, "full")
    hit = F.col("n").isNotNull() & F.col("mult").isNotNull()
    # a context's counts are added up in two steps, so that a frequent one meets in no task
    totals = met.where("n IS NOT NULL").groupBy(*[f"{name}o" for name in names]).agg(
        F.sum("n").alias("ctx_n"), F.sum(F.when(hit, F.col("mult"))).alias("mult"),
        F.sum(F.when(hit, -F.log("n") * F.col("mult"))).alias("l")).where("mult IS NOT NULL")
    gone = met.where("n IS NULL").select(*names, "_wm_next", "mult")
    none = F.lit(None).cast("array<bigint>").alias("ctx"), F.lit(None).cast("bigint").alias("next")
    found = totals.agg(F.sum("mult").alias("mult"), F.sum(F.col("l") + F.log("ctx_n") * F.col("mult")).alias("l"))
    steps = gone.agg((F.sum("mult") * F.lit(0)).alias("mult"), (F.sum("mult") * -F.log(F.lit(alpha))).alias("l"))
    shorter = F.array(*names[1:]).cast("array<bigint>").alias("ctx")
    return (gone.select(shorter, F.col("_wm_next").alias("next"), "mult", F.lit(None).cast("double").alias("l"))
            .unionByName(found.select(*none, "mult", "l")).unionByName(steps.select(*none, "mult", "l")))


def best_next(counts: DataFrame) -> DataFrame:
    """Greedy choice per context: the most frequent next id, ties to the lowest id."""
    return counts.groupBy("ctx").agg(
        F.max_by("next", F.struct(F.col("n"), -F.col("next"))).alias("best"))


def global_best(counts: DataFrame) -> DataFrame:
    """One row: the most frequent next id over all contexts (unseen-context fallback)."""
    uni = counts.groupBy("next").agg(F.sum("n").alias("n"))
    return uni.agg(F.max_by("next", F.struct(F.col("n"), -F.col("next"))).alias("fallback"))


def _next_context(ctx: Column, token: Column, order: int) -> Column:
    return context_of(F.concat(ctx, F.array(token)), order).cast("array<bigint>")


def _greedy_steps(counts: DataFrame, starts: DataFrame, order: int, max_new_tokens: int, limit: int | None) -> DataFrame:
    """<ctx, tok, nxt> for the contexts that walks of ``max_new_tokens`` ids from ``starts`` reach, or for all.

    An unseen context goes on with the overall most frequent id. Walks flow together, so those of all starts
    soon reach nothing new, and the few contexts on them are found level by level. Where they go on
    reaching new ones after so many levels as following all contexts has joins, the steps of all contexts are taken;
    after ``order`` steps from a known one nothing new turns up there.
    """
    # one pass over the counts: the row without a context is the fallback
    none = F.lit(None).cast("array<bigint>").alias("ctx")
    both = cut_lineage(best_next(counts).select("ctx", "best").unionByName(
        global_best(counts).select(none, F.col("fallback").alias("best"))))
    fallback = both.where(F.col("ctx").isNull()).first()["best"]
    best = both.where(F.col("ctx").isNotNull())
    if fallback is None:
        return best.select("ctx", F.col("best").alias("tok"), F.col("ctx").alias("nxt"))

    def step(nodes: DataFrame, known: DataFrame) -> DataFrame:
        tok = F.coalesce("best", F.lit(fallback))
        x = nodes.join(known, "ctx", "left").select("ctx", tok.alias("tok"))
        return x.select("ctx", "tok", _next_context(F.col("ctx"), F.col("tok"), order).alias("nxt"))

    def beyond(steps: DataFrame, last: DataFrame) -> DataFrame:
        return cut_lineage(last.select(F.col("nxt").alias("ctx")).distinct().join(steps.select("ctx"), "ctx", "left_anti"))

    new, parts = cut_lineage(starts.where(F.col("ctx").isNotNull()).distinct()), []
    for level in range(min(max_new_tokens, GREEDY_LEVELS)):
        if joins.fits_broadcast(new, limit):  # the table of contexts stays where it is
            known = cut_lineage(best.join(F.broadcast(new), "ctx", "left_semi"))
        else:
            known = best
        parts.append(cut_lineage(step(new, known)))
        steps = reduce(DataFrame.unionByName, parts)
        new = beyond(steps, parts[-1])
        if level + 1 == max_new_tokens or new.isEmpty():
            return cut_lineage(steps)

    steps = cut_lineage(step(best.select("ctx").union(starts.select("ctx")).distinct(), best))
    new = steps
    for _ in range(order):
        new = cut_lineage(step(beyond(steps, new), best))
        if new.isEmpty():
            break
        steps = steps.unionByName(new)
    return cut_lineage(steps)


def greedy_continue(prompts: DataFrame, id_col: str, ids_col: str, counts: DataFrame,
                    max_new_tokens: int, order: int = 2, out_col: str = "generated",
                    eos_id: Column | int | None = None) -> DataFrame:
    """Append ``max_new_tokens`` greedy ids to every prompt; ``eos_id`` ends it and is not appended.

    Prompts sharing their last ``order - 1`` ids share the walk, so it runs over distinct
    contexts, those that the prompts reach. Walks aren't followed step by step: a table of jumps over
    1, 2, 4, ... steps is made by joining it with itself, and the positions of a walk are filled
    in by halves, about ``2 * log2(max_new_tokens)`` joins in all. A context in which many walks
    meet is salted by how many do.
    """
    p = prompts.select(id_col, context_of(F.col(ids_col), order).cast("array<bigint>").alias("start"))
    starts = cut_lineage(p.groupBy("start").agg(F.count(F.lit(1)).alias("n_prompts")))
    # every table that is followed below has at most the rows and columns of ``steps``; the driver holds those broadcast together
    limit = joins.BROADCAST_MAX_BYTES and joins.BROADCAST_MAX_BYTES // (2 * max(max_new_tokens, 1).bit_length() + 1)
    steps = _greedy_steps(counts, starts.select(F.col("start").alias("ctx")), order, max_new_tokens, limit)
    small = joins.fits_broadcast(steps, limit)

    def follow(rows: DataFrame, key: str, table: DataFrame, salt_cols: list[str]) -> DataFrame:
        if small:
            return rows.join(F.broadcast(table), key)
        met = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).join(table, key)
        return salted_lookup(rows, met, key, salt_cols=salt_cols, freq_col="n", how="inner", small=False).drop("n")

    jumps = {1: steps.select("ctx", "nxt")}
    size = 1
    while size * 2 < max_new_tokens:
        half = jumps[size]
        second = half.select(F.col("ctx").alias("mid"), F.col("nxt").alias("end"))
        jumps[size * 2] = cut_lineage(follow(half.withColumnRenamed("nxt", "mid"), "mid", second, ["ctx"])
                                      .select("ctx", F.col("end").alias("nxt")))
        size *= 2
    at = starts.select("start", F.lit(0).alias("pos"), F.col("start").alias("ctx"))
    while size:
        here = at.where(F.col("pos") + size < max_new_tokens)
        moved = follow(here, "ctx", jumps[size], ["start", "pos"]).select(
            "start", (F.col("pos") + size).alias("pos"), F.col("nxt").alias("ctx"))
        at = cut_lineage(at.unionByName(moved))
        size //= 2
    toks = follow(at.where(F.col("pos") < max_new_tokens), "ctx", steps.select("ctx", "tok"), ["start", "pos"])
    ordered = F.array_sort(F.collect_list(F.struct("pos", "tok")))
    path = F.transform(ordered, lambda x: x["tok"])
    paths = toks.groupBy("start").agg(path.alias(out_col))
    if eos_id is not None:
        stop = F.array_position(F.col(out_col), (F.lit(eos_id) if isinstance(eos_id, int) else eos_id).cast("bigint"))
        paths = paths.withColumn(out_col, F.when(stop > 0, F.slice(out_col, F.lit(1), (stop - 1).cast("int")))
                                 .otherwise(F.col(out_col)))
    paths = cut_lineage(starts.join(paths, "start", "left"))
    out = salted_lookup(p, paths, "start", salt_cols=[id_col], freq_col="n_prompts", how="left")
    return out.select(id_col, F.coalesce(out_col, empty_ctx()).alias(out_col))


#: Next ids of one span; running sums of a context meet span by span.
SPAN_IDS = 4096


def candidates(counts: DataFrame, top_k: int | None = None, temperature: float = 1.0,
               order: int = 2) -> DataFrame:
    """Sampling table ``<ctx, bucket, next, lo, hi, nb, next_ctx, next_nb>``.

    Logits are ``log(count)``; top-k keeps ties with the k-th; temperature 0
    keeps only the argmax. Probabilities are cumulated in next-id order; the
    last candidate's upper bound is 2 so a sum ending just below 1 still hits.
    Contexts also include the empty context (unigram counts) as the fallback.
    """
    uni = _fallback(counts.groupBy("next").agg(F.sum("n").alias("n")), top_k, temperature)
    allc = counts.select("ctx", "next", "n").unionByName(uni)
    # a context's training frequency sizes its bucket count too, so a context that
    # dominates the frontier is spread over many (ctx, bucket) join keys
    total = allc.where(F.size("ctx") > 0).agg(F.sum("n").alias("_wm_total"))
    kept, stats = _weighted(allc, top_k, temperature)
    c = _on_axis(kept, stats, total)
    return _followed(c, c.select("ctx", "nb").distinct(), order)


def _fallback(uni: DataFrame, top_k: int | None, temperature: float) -> DataFrame:
    """The counts of the empty context from all <next, n>."""
    if top_k is not None and temperature and temperature > 0:
        # only ids that tie with the k-th can be drawn, so the whole vocabulary meets in no task
        kth = uni.select("n").orderBy(F.col("n").desc()).limit(top_k).agg(F.min("n").alias("_wm_kth"))
        uni = uni.crossJoin(F.broadcast(kth)).where(F.col("n") >= F.col("_wm_kth"))
    return uni.select(empty_ctx().alias("ctx"), "next", "n")


def _weighted(allc: DataFrame, top_k: int | None, temperature: float) -> tuple[DataFrame, DataFrame]:
    """<ctx, next, _wm_w, _wm_span> of the ids that can be drawn, and <ctx, _wm_ctx_n, _wm_top, _wm_rows> of the contexts, materialised."""
    stats = cut_lineage(allc.groupBy("ctx").agg(F.sum("n").alias("_wm_ctx_n"), F.max("n").alias("_wm_top"),
                                                F.count(F.lit(1)).alias("_wm_rows")))
    span = F.floor(F.col("next") / F.lit(SPAN_IDS)).alias("_wm_span")
    if not temperature or temperature <= 0:
        kept = allc.groupBy("ctx").agg(F.max_by("next", F.struct(F.col("n"), -F.col("next"))).alias("next"))
        kept = kept.withColumn("_wm_w", F.lit(1.0))
    else:
        x = salted_lookup(allc, stats.select("ctx", "_wm_top", "_wm_rows"), "ctx", salt_cols=["next"], freq_col="_wm_rows")
        if top_k is not None:
            # the k-th count of a context from the k best of each span of ids
            best = allc.groupBy("ctx", span).agg(F.slice(F.sort_array(F.collect_list("n"), False), 1, top_k).alias("b"))
            kth = best.groupBy("ctx").agg(F.slice(F.sort_array(F.flatten(F.collect_list("b")), False), 1, top_k).alias("b"))
            kth = kth.select("ctx", F.element_at("b", -1).alias("_wm_kth")).join(stats.select("ctx", "_wm_rows"), "ctx")
            x = (salted_lookup(x.drop("_wm_rows"), cut_lineage(kth), "ctx", salt_cols=["next"], freq_col="_wm_rows")
                 .where(F.col("n") >= F.col("_wm_kth")))
        lg = F.log(F.col("n").cast("double")) - F.log(F.col("_wm_top").cast("double"))
        kept = x.select("ctx", "next", F.exp(lg / F.lit(float(temperature))).alias("_wm_w"))
    return cut_lineage(kept.select("ctx", "next", "_wm_w", span)), stats


def _buckets(rows: str) -> Column:
    """Buckets of a context by its candidates and its share of all occurrences."""
    return F.greatest(F.ceil(F.col(rows) / F.lit(4)), F.ceil(
        F.col("_wm_ctx_n") * F.lit(HOT_BUCKETS) / F.col("_wm_total"))).cast("int")


def _on_axis(kept: DataFrame, stats: DataFrame, total: DataFrame) -> DataFrame:
    """<ctx, bucket, next, lo, hi, nb>: the candidates in their places on [0,1), once in each bucket that they touch."""
    # running weights in two levels: inside a span of ids, and over the spans of a context
    inside = Window.partitionBy("ctx", "_wm_span").orderBy("next").rowsBetween(Window.unboundedPreceding, 0)
    spans = kept.groupBy("ctx", "_wm_span").agg(F.sum("_wm_w").alias("w"), F.count(F.lit(1)).alias("c"), F.max("next").alias("m"))
    spans = spans.groupBy("ctx").agg(F.array_sort(F.collect_list(F.struct("_wm_span", "w", "c", "m"))).alias("s"))
    add_w = lambda a: F.aggregate(a, F.lit(0.0), lambda t, y: t + y["w"])
    before = F.transform("s", lambda y, k: F.struct(y["_wm_span"].alias("_wm_span"), add_w(F.slice("s", 1, k)).alias("off")))
    spans = spans.select("ctx", add_w(F.col("s")).alias("_wm_all"), F.element_at("s", -1)["m"].alias("_wm_last"),
                         F.aggregate("s", F.lit(0).cast("bigint"), lambda t, y: t + y["c"]).alias("_wm_c"),
                         F.explode(before).alias("b")).select("ctx", "b._wm_span", "b.off", "_wm_all", "_wm_last", "_wm_c")
    spans = spans.join(stats.select("ctx", "_wm_ctx_n"), "ctx").crossJoin(F.broadcast(total))  # one row
    c = kept.withColumn("_wm_in", F.sum("_wm_w").over(inside)).join(spans, ["ctx", "_wm_span"])
    c = (c.withColumn("hi", (F.col("off") + F.col("_wm_in")) / F.col("_wm_all"))
          .withColumn("lo", F.col("hi") - F.col("_wm_w") / F.col("_wm_all"))
          .withColumn("hi", F.when(F.col("next") == F.col("_wm_last"), F.lit(2.0)).otherwise(F.col("hi")))
          .withColumn("nb", _buckets("_wm_c")))
    top = F.least(F.floor(F.least(F.col("hi"), F.lit(1.0)) * F.col("nb")), F.col("nb") - 1)
    return c.withColumn("bucket", F.explode(F.sequence(
        F.least(F.floor(F.col("lo") * F.col("nb")), F.col("nb") - 1).cast("int"), top.cast("int"))))


def _followed(c: DataFrame, nb: DataFrame, order: int) -> DataFrame:
    """The candidates with the context that each leads to and its buckets, from ``nb`` of all contexts."""
    nxt_ctx = (F.slice(F.concat("ctx", F.array("next")), F.greatest(F.size("ctx") + 2 - F.lit(order - 1), F.lit(1)),
                       F.lit(order - 1)) if order > 1 else empty_ctx())
    c = c.withColumn("next_ctx", nxt_ctx.cast("array<bigint>"))
    known = nb.select(F.col("ctx").alias("next_ctx"), F.col("nb").alias("next_nb"))
    c = c.join(known, "next_ctx", "left")
    empty_nb = nb.where(F.size("ctx") == 0).select(F.col("nb").alias("_wm_enb"))
    c = c.crossJoin(F.broadcast(empty_nb))  # one row
    c = (c.withColumn("next_ctx", F.when(F.col("next_nb").isNull(), empty_ctx())
                      .otherwise(F.col("next_ctx")))
          .withColumn("next_nb", F.coalesce("next_nb", "_wm_enb")))
    return c.select("ctx", "bucket", "next", "lo", "hi", "nb", "next_ctx", "next_nb")


def _candidates_in_parts(counts: DataFrame, parts: int, top_k: int | None, temperature: float, order: int,
                         as_rows: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``as_rows(candidates(...))``, materialised, and <ctx, nb> of all contexts.

    Contexts are worked on in ``parts`` by their hash, twice: for the weights, and, once the buckets of all are known,
    for the rows. The counts are never stored as a whole, and the files of a part go before the next one begins.
    """
    spark, own = counts.sparkSession, [F.col("ctx")[i] for i in range(order - 1)]
    kept, sizes, nexts = [], [], []

    def weigh(some: DataFrame) -> None:
        weights, stats = _weighted(some, top_k, temperature)
        rows = weights.groupBy("ctx").agg(F.count(F.lit(1)).alias("_wm_c"))
        kept.append(weights)
        sizes.append(cut_lineage(rows.join(stats.select("ctx", "_wm_ctx_n"), "ctx")))

    for part in range(parts):
        some = cut_lineage(counts.where(_part_of(own, parts) == part).select("ctx", "next", "n"))
        nexts.append(cut_lineage(some.groupBy("next").agg(F.sum("n").alias("n"))))
        weigh(some)
        del some
        free_unused(spark)
    uni = cut_lineage(reduce(DataFrame.unionByName, nexts).groupBy("next").agg(F.sum("n").alias("n")))
    total = uni.agg(F.sum("n").alias("_wm_total"))
    weigh(_fallback(uni, top_k, temperature))
    nb = reduce(DataFrame.unionByName, sizes).crossJoin(F.broadcast(total)).select("ctx", _buckets("_wm_c").alias("nb"))  # one row
    nb = cut_lineage(nb)
    done = []
    while kept:
        c = _on_axis(kept.pop(), sizes.pop(), total)
        done.append(cut_lineage(as_rows(_followed(c, nb, order))))
        del c
        free_unused(spark)
    return reduce(DataFrame.unionByName, done), nb


def sample_continue(prompts: DataFrame, id_col: str, ids_col: str, counts: DataFrame,
                    max_new_tokens: int, order: int = 2, top_k: int | None = None,
                    temperature: float = 1.0, eos_id: int | None = None, seed: int = 123,
                    checkpoint_every: int = 10, out_col: str = "generated", parts: int = 1) -> DataFrame:
    """Per prompt, top-k -> temperature -> draw, for up to ``max_new_tokens`` steps.

    With ``parts`` the table of candidates is made in so many parts, and only shuffle files of one are on disk at a time.

    The draw for (prompt, step) is ``hash_uniform(seed, prompt, step)``. A
    drawn ``eos_id`` stops that prompt and is not appended.
    """
    # A step reads the table of candidates once, so it holds few rows: those of CHUNK_BUCKETS buckets are one
    # array, and each candidate stands once in it, from its first bucket there on.
    def chunked(cand: DataFrame) -> DataFrame:
        bottom = F.least(F.floor(F.col("lo") * F.col("nb")), F.col("nb") - 1)
        once = cand.where((F.col("bucket") % CHUNK_BUCKETS == 0) | (F.col("bucket") == bottom))
        chunk = F.floor(F.col("bucket") / F.lit(CHUNK_BUCKETS)).alias("chunk")
        return once.groupBy("ctx", chunk).agg(
            F.first("nb").alias("nb"), F.collect_list(F.struct("next", "lo", "hi", "next_ctx", "next_nb")).alias("drawn"))

    if parts > 1 and order > 1:
        cand, nb = _candidates_in_parts(counts, parts, top_k, temperature, order, chunked)
    else:
        cand = cut_lineage(chunked(candidates(counts, top_k, temperature, order)))
        nb = cand.select("ctx", "nb").distinct()
    empty_nb = nb.where(F.size("ctx") == 0).select(F.col("nb").alias("_wm_enb"))
    start = prompts.select(id_col, context_of(F.col(ids_col), order).cast("array<bigint>").alias("cur"))
    # many prompts may end in one context: salted by how many do
    met = start.groupBy("cur").agg(F.count(F.lit(1)).alias("n_prompts"))
    known = cut_lineage(met.join(nb.withColumnRenamed("ctx", "cur"), "cur", "left"))
    start = (salted_lookup(start, known, "cur", salt_cols=[id_col], freq_col="n_prompts")
             .crossJoin(F.broadcast(empty_nb)))
    frontier = start.select(
        id_col, F.when(F.col("nb").isNull(), empty_ctx()).otherwise(F.col("cur")).alias("cur"),
        F.coalesce("nb", "_wm_enb").alias("nb"), F.array().cast("array<bigint>").alias("path"),
        F.lit(False).alias("done"))
    c = cand.select(F.col("ctx").alias("c_ctx"), F.col("chunk").alias("c_chunk"), "drawn")
    for step in range(max_new_tokens):
        u = hash_uniform(seed, id_col, F.lit(step))
        f = (frontier.withColumn("_wm_u", F.when(~F.col("done"), u))
                     .withColumn("_wm_b", F.floor(F.least(F.floor(F.col("_wm_u") * F.col("nb")),
                                                          F.col("nb") - 1) / F.lit(CHUNK_BUCKETS))))
        # One left join per step (done rows carry a NULL chunk and match nothing),
        # so each step reads the previous frontier once and lineage grows linearly.
        j = f.join(c, (f["cur"] == c["c_ctx"]) & (f["_wm_b"] == c["c_chunk"]), "left")
        j = j.withColumn("_wm_hit", F.get(F.filter("drawn", lambda x: (x["lo"] <= F.col("_wm_u")) & (F.col("_wm_u") < x["hi"])), F.lit(0)))
        j = j.select("*", *[F.col(f"_wm_hit.{k}").alias("c_" + k) for k in ("next", "next_ctx", "next_nb")])
        hit = F.col("c_next").isNotNull()
        stop = F.lit(False) if eos_id is None else (F.col("c_next") == F.lit(eos_id))
        go = hit & ~stop
        frontier = j.select(
            id_col,
            F.when(go, F.col("c_next_ctx")).otherwise(F.col("cur")).alias("cur"),
            F.when(go, F.col("c_next_nb")).otherwise(F.col("nb")).alias("nb"),
            F.when(go, F.concat("path", F.array("c_next"))).otherwise(F.col("path")).alias("path"),
            (F.col("done") | (hit & stop)).alias("done"))
        if checkpoint_every and (step + 1) % checkpoint_every == 0 and step + 1 < max_new_tokens:
            frontier = cut_lineage(frontier)
            del f, j
            if parts > 1:
                free_unused(prompts.sparkSession)
    return frontier.select(id_col, F.col("path").alias(out_col))
