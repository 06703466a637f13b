"""Sources and sinks: every query writes data derived from the tables to a fresh
folder under the shared checkpoint folder and reads it back (write-read invariants)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from wordmill.operators import prompts as pr
from wordmill.operators import subword as bpe
from wordmill.plans import sqlbits as q
from wordmill.plans.classification import spam_splits
from wordmill.plans.subwords import learned
from wordmill.sources import adapters
from wordmill.sources import files as io
from wordmill.session import load_table


def s1_tsv(spark: SparkSession, sf_dir: str):
    path = io.scratch_path(spark, "messages-tsv")
    io.write_labelled_tsv(adapters.labelled_messages(spark, sf_dir), path)
    back = io.read_labelled_tsv(spark, path)
    return back.select("Label", F.md5("Text").alias("text_md5"))


def s2_csv(spark, sf_dir):
    path = io.scratch_path(spark, "splits-csv")
    sp = spam_splits(spark, sf_dir).select("split", "Label", "Text")
    io.write_split_csv(sp, path)  # one pass over the texts, a folder for each split
    back = io.read_split_csv(spark, path)
    if "split" not in back.columns:  # no row, no folder
        back = back.withColumn("split", F.lit(None).cast("string"))
    return back.select("split", "Label", F.md5("Text").alias("text_md5"))


def s3_json(spark, sf_dir):
    path = io.scratch_path(spark, "records-json")
    recs = adapters.instruction_records(spark, sf_dir)
    io.write_json_arrays(recs.select("conv_id", "turn", "instruction", "input", "output"), path)
    back = io.read_json_records(spark, path, "conv_id bigint, turn bigint, " + io.INSTRUCTION_SCHEMA)
    return back.select("conv_id", "turn", F.md5(F.concat_ws("\u0001", "instruction", "input", "output"))
                       .alias("record_md5"))


#: Documents of one file, which is one row when it is read whole.
S4_LINES = 200


def s4_whole_text(spark, sf_dir):
    """Text files of at most S4_LINES documents, a document a line; every file is read back whole."""
    path = io.scratch_path(spark, "corpus-text")
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    docs.orderBy("doc_id").select(F.concat_ws("\t", "doc_id", F.hex(F.encode("text", "UTF-8"))).alias("value")) \
        .write.mode("overwrite").option("maxRecordsPerFile", S4_LINES).text(path)
    lines = io.read_whole_text(spark, path).select(F.explode(F.split("text", "\n")).alias("v")).where("v <> ''")
    return lines.select(F.substring_index("v", "\t", 1).cast("bigint").alias("doc_id"),
                        F.md5(F.unhex(F.substring_index("v", "\t", -1))).alias("text_md5"))


def s5_write_splits(spark, sf_dir):
    path = io.scratch_path(spark, "splits-partitioned")
    io.write_split_csv(spam_splits(spark, sf_dir).select("split", "Label", "Text"), path)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"') \
        .schema("Label int, Text string, split string").csv(path)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.sum(F.length("Text")).cast("bigint").alias("n_chars"))


def s6_json_write(spark, sf_dir):
    path = io.scratch_path(spark, "responses-json")
    recs = adapters.instruction_records(spark, sf_dir)
    resp = recs.withColumn("model_response", pr.extract_response(
        pr.training_text("instruction", "input", "output"), pr.format_input("instruction", "input")))
    io.write_json_records(resp, path)
    back = spark.read.schema("conv_id bigint, turn bigint, " + io.RESPONSE_SCHEMA).json(path)
    return back.select("conv_id", "turn", F.md5("model_response").alias("response_md5"))


def s7_write_if_absent(spark, sf_dir):
    path = io.scratch_path(spark, "skip-existing")
    first = load_table(spark, sf_dir, "documents").select("doc_id", "lang")
    io.write_if_absent(first, path)
    second = load_table(spark, sf_dir, "labels").select("doc_id", F.lit("x").alias("lang"))
    io.write_if_absent(second, path)  # target exists: nothing is written
    return spark.read.parquet(path)


def s8_model_files(spark, sf_dir):
    """Writes a learned model as vocabulary and merge files, reads them as tables and makes a model of those."""
    merges = learned(spark, sf_dir)
    base = io.scratch_path(spark, "bpe-model")
    io.write_model_files(spark, bpe.Model.learned(merges), base)
    vocab = io.read_vocab_json(spark, f"{base}/vocab")
    model = bpe.Model.from_tables(vocab, io.read_merge_list(spark, f"{base}/merges"))
    return bpe.merges_frame(spark, [(a, b) for a, b, _ in model.merges])


QUERIES = {
    "s1_tsv": s1_tsv,
    "s2_csv": s2_csv,
    "s3_json": s3_json,
    "s4_whole_text": s4_whole_text,
    "s5_write_splits": s5_write_splits,
    "s6_json_write": s6_json_write,
    "s7_write_if_absent": s7_write_if_absent,
    "s8_model_files": s8_model_files,
}

_P = q.format_input("instruction", "input")
_FULL = f"concat({_P}, chr(10), chr(10), '### Response:', chr(10), output)"
_RESP = q.py_strip(f"replace(substr({_FULL}, length({_P}) + 1), '### Response:', '')")

ORACLE = {
    "s1_tsv": f"SELECT Label, md5(Text) AS text_md5 FROM ({q.LABELLED}) m",
    "s2_csv": f"SELECT split, Label, md5(Text) AS text_md5 FROM ({q.spam_splits(123)}) s",
    "s3_json": f"SELECT conv_id, turn, md5(concat_ws(chr(1), instruction, input, output)) AS record_md5 FROM ({q.INSTRUCTIONS}) r",
    "s4_whole_text": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
    "s5_write_splits": f"SELECT split, count(*) AS n_rows, CAST(sum(length(Text)) AS BIGINT) AS n_chars FROM ({q.spam_splits(123)}) s GROUP BY split",
    "s6_json_write": f"SELECT conv_id, turn, md5({_RESP}) AS response_md5 FROM ({q.INSTRUCTIONS}) r",
    "s7_write_if_absent": "SELECT doc_id, lang FROM documents",
}
