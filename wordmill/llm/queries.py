"""The operators' queries over whole tables, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.llm import (bpe, decontam, exact_dedup, filter_audit, fingerprints, html_text, langid, licenses, lmscore,
                          resample, secrets, simhash, token_files)
from wordmill.llm.common import load_table
from wordmill.session import ensure_checkpoint_dir

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(load_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load_table(spark, sf_dir, "documents"), width=3, radius=2)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(load_table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(load_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(load_table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(load_table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write(load_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder)
    return token_files.digests(spark, folder)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = load_table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    return lmscore.score(load_table(spark, sf_dir, "documents"), good)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(load_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(load_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_exact_dedup, op3_simhash, op4_license_scan,
                                     op5_secret_scan, op6_html_text, op7_language_id, op8_token_files, op9_lm_score,
                                     op10_bpe, op11_resample, op12_fingerprints, op13_filter_audit)}

def _shingles(table: str, key: str) -> str:
    """Distinct 5-word shingles <key, s> of a table's texts; a shorter text is one shingle."""
    return rf"""
        SELECT {key}, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
                                                          lambda i: array_to_string(w[i:i + 4], ' ')))) AS s
        FROM (SELECT {key}, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{licenses.SEPARATORS}'),
                                        lambda x: x <> '') AS w FROM {table}) t WHERE len(w) > 0"""


ORACLE = {
    "op1_decontamination": f"""
        WITH d AS ({_shingles('documents', 'doc_id')}), q AS ({_shingles('benchmark', 'item_id')}),
        n AS (SELECT item_id, count(*) AS n_shingles FROM q GROUP BY item_id)
        SELECT d.doc_id, q.item_id, n.n_shingles, count(*) AS n_shared, count(*) / n.n_shingles AS containment
        FROM q JOIN d ON d.s = q.s JOIN n ON n.item_id = q.item_id GROUP BY d.doc_id, q.item_id, n.n_shingles
        HAVING count(*) >= 0.8 * n.n_shingles - 1e-9""",
    "op2_exact_dedup": f"""
        WITH n AS (SELECT doc_id, {_LOWER} AS norm FROM documents),
        w AS (SELECT doc_id, norm, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
                     row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept
              FROM n WINDOW g AS (PARTITION BY norm))
        SELECT doc_id, keep_id, group_size, kept, sha256(norm) AS text_sha256 FROM w""",
    "op4_license_scan": licenses.oracle(),
    "op13_filter_audit": filter_audit.oracle(),
}
