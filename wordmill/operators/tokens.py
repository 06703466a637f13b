"""Word tokens, vocabulary, encode/decode, lengths, frequencies.

Long form ``<id, pos, token>`` is used for anything joined or aggregated;
arrays only for per-row storage. The vocabulary is a table, never a map, and
is joined with hot tokens salted (``functions.joins``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.functions import joins
from wordmill.functions.exchange import lookup_arrays
from wordmill.functions.text import decode_join, word_tokens
from wordmill.operators.indexing import sorted_index


def _ids(id_cols: str | Sequence[str]) -> list[str]:
    return [id_cols] if isinstance(id_cols, str) else list(id_cols)


def tokenize_words(df: DataFrame, text_col: str = "text", out_col: str = "tokens") -> DataFrame:
    """T1 (array form): ARRAY<STRING> of word tokens per row."""
    return df.withColumn(out_col, word_tokens(text_col))


def explode_tokens(df: DataFrame, id_cols: str | Sequence[str], text_col: str = "text",
                   pos_col: str = "pos", token_col: str = "token") -> DataFrame:
    """T1 (long form): <id..., pos (0-based, dense), token>."""
    return df.select(*_ids(id_cols), F.posexplode(word_tokens(text_col)).alias(pos_col, token_col))


def token_frequencies(tokens: DataFrame, token_col: str = "token",
                      count_col: str = "n") -> DataFrame:
    """Occurrences per token (partial counts before the shuffle)."""
    return tokens.groupBy(token_col).agg(F.count(F.lit(1)).alias(count_col))


def build_vocab(tokens: DataFrame, token_col: str = "token", id_col: str = "token_id",
                count_col: str = "n") -> DataFrame:
    """Distinct tokens numbered 0..V-1 in code-point order, with frequencies."""
    freq = token_frequencies(tokens, token_col, count_col)
    return sorted_index(freq, token_col, index_col=id_col).select(token_col, id_col, count_col)


def vocab_size(tokens: DataFrame, token_col: str = "token", exact: bool = True) -> Column:
    """Number of distinct tokens as an aggregate expression."""
    if exact:
        return F.count_distinct(F.col(token_col))
    return F.approx_count_distinct(F.col(token_col))


def vocab_sketches(tokens: DataFrame, group_cols: Sequence[str], token_col: str = "token", log_buckets: int = 14) -> DataFrame:
    """<group..., sketch>: a mergeable distinct-count sketch of each group's tokens, a few KB whatever their number."""
    return tokens.groupBy(*group_cols).agg(F.hll_sketch_agg(token_col, F.lit(log_buckets)).alias("sketch"))


def united_vocab_size(sketches: DataFrame, sketch_col: str = "sketch") -> DataFrame:
    """<estimate> of the distinct tokens of all groups; relative standard error 1.04 / sqrt(2**log_buckets)."""
    return sketches.agg(F.hll_sketch_estimate(F.hll_union_agg(sketch_col)).alias("estimate"))


def encode_tokens(tokens: DataFrame, vocab: DataFrame, id_cols: str | Sequence[str],
                  pos_col: str = "pos", token_col: str = "token", id_col: str = "token_id",
                  count_col: str | None = "n", oov: str = "error",
                  unk_id: int | None = None, hot_fraction: float | None = None,
                  salts: int | None = None, small: bool | None = None) -> DataFrame:
    """T5 (long form): attach ``id_col`` to every token occurrence.

    ``oov``: 'error' raises on an unknown token (the reference's KeyError),
    'null' keeps it with a NULL id, 'skip' drops it, 'unk' uses ``unk_id``.
    """
    dim_cols = [token_col, id_col] + ([count_col] if count_col else [])
    joined = joins.salted_lookup(tokens, vocab.select(*dim_cols), token_col,
                                 salt_cols=[*_ids(id_cols), pos_col], freq_col=count_col,
                                 hot_fraction=hot_fraction, salts=salts, how="left", small=small)
    if count_col:
        joined = joined.drop(count_col)
    found = F.col(id_col)
    if oov == "error":
        joined = joined.withColumn(id_col, F.when(found.isNull(), F.raise_error(
            F.concat(F.lit("unknown token: "), F.col(token_col)))).otherwise(found))
    elif oov == "skip":
        joined = joined.where(found.isNotNull())
    elif oov == "unk":
        joined = joined.withColumn(id_col, F.coalesce(found, F.lit(unk_id)))
    elif oov != "null":
        raise ValueError(f"unknown oov policy {oov!r}")
    return joined


def collect_ordered(df: DataFrame, id_cols: str | Sequence[str], pos_col: str, value_col: str,
                    out_col: str) -> DataFrame:
    """Rebuild per-row arrays in position order after a join (collect_list has no order)."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(pos_col).alias("p"),
                                                 F.col(value_col).alias("v"))))
    return df.groupBy(*_ids(id_cols)).agg(F.transform(pairs, lambda s: s["v"]).alias(out_col))


def encode_texts(df: DataFrame, vocab: DataFrame, id_col: str | Sequence[str] = "doc_id",
                 text_col: str = "text", out_col: str = "ids", oov: str = "error", unk_id: int | None = None,
                 count_col: str | None = "n", small: bool | None = None) -> DataFrame:
    """T5 (array form): <id..., ids ARRAY<BIGINT>>, a row for a row; texts without tokens get [].

    Neither texts nor tokens are shuffled (``functions.exchange``). ``oov`` as in ``encode_tokens``.
    """
    ids = _ids(id_col)
    words = df.select(*ids, word_tokens(text_col).alias("_wm_words"))
    found = lookup_arrays(words, ids, "_wm_words", vocab, "token", "token_id", out_col, small,
                          "unknown token: " if oov == "error" else None)
    if oov in ("error", "null"):
        return found
    if oov == "skip":
        return found.withColumn(out_col, F.filter(out_col, lambda i: i.isNotNull()))
    if oov == "unk":
        return found.withColumn(out_col, F.transform(out_col, lambda i: F.coalesce(i, F.lit(unk_id).cast("bigint"))))
    raise ValueError(f"unknown oov policy {oov!r}")


def decode_ids(df: DataFrame, vocab: DataFrame, id_col: str | Sequence[str] = "doc_id", ids_col: str = "ids",
               out_col: str = "decoded", token_col: str = "token",
               vocab_id_col: str = "token_id", count_col: str | None = "n", small: bool | None = None) -> DataFrame:
    """Ids -> tokens via the inverse vocabulary -> text joined with spaces, with
    the space before punctuation removed, a row for a row. An unknown id raises."""
    ids = _ids(id_col)
    found = lookup_arrays(df, ids, ids_col, vocab, vocab_id_col, token_col, "_wm_toks", small, "unknown id: ")
    return found.select(*ids, decode_join("_wm_toks").alias(out_col))


def longest_length(df: DataFrame, ids_col: str = "ids") -> Column:
    """``max(size(ids))`` as an aggregate expression (0 for no rows)."""
    return F.coalesce(F.max(F.size(ids_col)), F.lit(0))
