"""Driver tables -> the input shapes the operators consume (FIXTURES.md section 3).

Every adapter is a lazy projection/join over the parquet tables, so Catalyst
prunes columns and pushes filters into the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordmill.session import load_table


def labelled_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """<doc_id, Label ('spam' if quality=0 else 'ham'), Text> from documents x labels."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = load_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return (docs.join(labels, "doc_id")
                .select("doc_id",
                        F.when(F.col("quality") == 0, "spam").otherwise("ham").alias("Label"),
                        F.col("text").alias("Text")))


def message_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """<doc_id, Label> of the labelled messages without their text."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id")
    labels = load_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id").select(
        "doc_id", F.when(F.col("quality") == 0, "spam").otherwise("ham").alias("Label"))


def instruction_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """<conv_id, turn, instruction, input, output> from conversations.

    A user turn followed (by turn order in its conversation) by an assistant
    turn is one record; ``input`` is the conversation's system text or ''.
    """
    conv = load_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    w = Window.partitionBy("conv_id").orderBy("turn")
    paired = (conv.withColumn("next_role", F.lead("role").over(w))
                  .withColumn("next_text", F.lead("text").over(w)))
    pairs = paired.where((F.col("role") == "user") & (F.col("next_role") == "assistant"))
    system = (conv.where(F.col("role") == "system")
                  .groupBy("conv_id").agg(F.min_by("text", "turn").alias("system_text")))
    return (pairs.join(system, "conv_id", "left")
                 .select("conv_id", "turn",
                         F.col("text").alias("instruction"),
                         F.coalesce(F.col("system_text"), F.lit("")).alias("input"),
                         F.col("next_text").alias("output")))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: <doc_id, text>."""
    return load_table(spark, sf_dir, "documents").select("doc_id", "text")


def class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """<row_id, class_id, logit DOUBLE, target> by exploding each embedding."""
    emb = load_table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("row_id"), F.col("label").alias("target"),
                      F.posexplode("embedding").alias("class_id", "v")).select(
        "row_id", F.col("class_id").cast("int").alias("class_id"),
        F.col("v").cast("double").alias("logit"), F.col("target").cast("int").alias("target"))


def reply_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """<request_id, line_no, json> where json = {"message":{"content": $.k of props}}."""
    ev = load_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "props")
    content = F.get_json_object("props", "$.k")
    return ev.select(F.col("user_id").alias("request_id"), F.col("event_id").alias("line_no"),
                     "ts",
                     F.to_json(F.struct(F.struct(content.alias("content")).alias("message")))
                     .alias("json"))


# Fixed reply shapes of the score-reply adapter (FIXTURES.md section 3).
ODD_REPLIES = ("85.0", "Score: 85", "", " 85\n")


def score_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """<doc_id, reply>: mostly integers 0-100 as text, a fixed share of odd shapes."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id")
    h = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("bigint")
    bucket = F.pmod(h, F.lit(20))
    reply = F.when(bucket == 0, ODD_REPLIES[0])
    for i, shape in enumerate(ODD_REPLIES[1:], start=1):
        reply = reply.when(bucket == i, shape)
    reply = reply.otherwise(F.pmod(h, F.lit(101)).cast("string"))
    return docs.select("doc_id", reply.alias("reply"))
