"""Physical-plan properties the design relies on (pruning, bounded broadcasts)."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from wordmill.functions.joins import salted_lookup
from wordmill.operators.indexing import hash_index

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_needed_columns(spark):
    plan = _plan(E.queries()["p1_filter_label"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint>" in plan
    assert "ReadSchema: struct<doc_id:bigint,quality:int>" in plan
    assert "text" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_hash_index_broadcasts_only_bucket_offsets(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "doc_id")
    plan = _plan(hash_index(df, "doc_id"))
    assert "BroadcastExchange" in plan          # the <= 4096-row offsets table
    assert "Window" in plan and "SinglePartition" in plan  # only over the offsets


def test_salted_join_beyond_broadcast_limit(spark):
    facts = spark.range(0, 2000).select(F.col("id").alias("row"), (F.col("id") % 7).alias("k"))
    dim = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    small = _plan(salted_lookup(facts, dim, "k", ["row"], freq_col="n"))
    assert "BroadcastHashJoin" in small
    big = salted_lookup(facts, dim, "k", ["row"], freq_col="n", broadcast_max_bytes=3)
    plan = _plan(big)
    assert "_wm_salt" in plan                    # salted (key, salt) join beyond the limit
    assert big.count() == 2000
