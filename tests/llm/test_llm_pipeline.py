"""The registered queries and the pipeline's stages on the driver's tables."""

import re
import zlib

import duckdb
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from wordmill.llm import decontam, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = con.execute(queries.ORACLE[name]).df()[list(got.columns)]

    def rows(df):
        plain = ([None if pd.isna(x) else x.item() if hasattr(x, "item") else x for x in r] for r in df.itertuples(index=False))
        return sorted(str([float(x) if isinstance(x, int) and not isinstance(x, bool) else x for x in r]) for r in plain)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_query_runs_over_its_whole_table(spark, name):
    table = "pages" if name == "op6_html_text" else "documents"
    assert queries.QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_dedup_stage_keeps_one_of_each_component(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    longest = table.orderBy(F.length("text").desc(), "doc_id").limit(12)
    copies = [longest.withColumn("doc_id", F.col("doc_id") + 100_000 * k).withColumn("text", F.concat("text", F.lit(" end" * k)))
              for k in (1, 2)]
    docs = table.unionByName(copies[0]).unionByName(copies[1])
    prints = {r.doc_id: plain_simhash(r.text) for r in docs.collect()}
    root = {i: i for i in prints}
    while (now := {i: min(root[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 2) for i in prints}) != root:
        root = now  # smallest doc_id reachable
    kept = sorted(r.doc_id for r in corpus_pipeline.simhash_dedup(spark, docs, SF).collect())
    assert kept == sorted(set(root.values())) and sum(i >= 100_000 for i in kept) < 12


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()} if "text" in docs.columns else None
        out = stage(spark, docs, SF)
        out.write.parquet(f"file://{tmp_path}/{name}")
        after = spark.read.parquet(f"file://{tmp_path}/{name}")
        ids = sorted(r.doc_id for r in after.select("doc_id").collect())
        if name == "bpe":
            assert ids == sorted(before)
        else:
            assert after.columns == docs.columns
        lower = {i: t.lower() for i, t in before.items()}
        if name == "language_id":
            assert ids == sorted(before)  # every document of the table is clean text
        if name == "exact_dedup":
            last = {}
            for i in sorted(lower):
                last[re.sub("[A-Z]", lambda m: m[0].lower(), before[i])] = i
            assert ids == sorted(last.values())
        if name == "decontamination":
            items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
            want = [decontam.shingle_set(r.text.encode(), 5) for r in items]
            hit = {i for i, t in before.items() for q in want
                   if q and len(q & decontam.shingle_set(t.encode(), 5)) >= 0.8 * len(q) - 1e-9}
            assert hit and ids == sorted(set(before) - hit)
        names.append(name)
        docs = after
    assert names == ["language_id", "exact_dedup", "simhash_dedup", "decontamination", "bpe"]
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


@pytest.mark.parametrize("left_out", ["en", "fr"])
def test_language_stage_rejects_a_language_that_was_not_learned(spark, left_out):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = docs.withColumn("lang", F.when(F.col("lang") != left_out, F.col("lang")))
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, known, SF).select("doc_id").collect()}
    was = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    foreign = {i for i, lang in was.items() if lang == left_out}
    assert len(foreign) > 100 and len(foreign & kept) <= 0.1 * len(foreign)
    assert kept - foreign == set(was) - foreign  # what is in a learned language stays, all of it


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op7_language_id"](spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in got)
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got) > 20
