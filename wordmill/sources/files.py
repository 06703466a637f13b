"""File sources and sinks with explicit schemas (no inference).

CSV rules match pandas' defaults: fields are quoted with '"' when needed and
a quote inside a field is doubled; quoted fields may span lines. Spark needs
``escape='"'`` and ``multiLine`` for that. Only a missing value is NULL; a
literal ``NA`` stays text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.session import ensure_checkpoint_dir

LABELLED_SCHEMA = "Label string, Text string"
SPLIT_SCHEMA = "Label int, Text string"
INSTRUCTION_SCHEMA = "instruction string, input string, output string"
RESPONSE_SCHEMA = INSTRUCTION_SCHEMA + ", model_response string"


def _csv_reader(spark: SparkSession, schema: str, header: bool, sep: str, quote: str):
    r = (spark.read.schema(schema).option("header", header).option("sep", sep)
         .option("mode", "FAILFAST"))
    if quote:  # a quoted field may span lines, so a file can't be cut between tasks
        return r.option("multiLine", True).option("quote", quote).option("escape", quote)
    return r.option("quote", "")  # quoting off: raw TSV lines, split freely


def read_labelled_tsv(spark: SparkSession, path: str, quote: str = '"',
                      schema: str = LABELLED_SCHEMA) -> DataFrame:
    """Header-less tab-separated <Label, Text>; ``quote=''`` reads raw lines."""
    return _csv_reader(spark, schema, False, "\t", quote).csv(path)


def read_split_csv(spark: SparkSession, path: str, schema: str = SPLIT_SCHEMA) -> DataFrame:
    """Headed CSV <Label INT, Text> (quoted fields, embedded newlines)."""
    return _csv_reader(spark, schema, True, ",", '"').csv(path)


def read_json_records(spark: SparkSession, path: str, schema: str = INSTRUCTION_SCHEMA) -> DataFrame:
    """S3: a JSON array of objects per file -> one row per element."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with its whole content (``wholetext`` as the keyword)."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("path"), F.col("value").alias("text"))


def _csv_writer(df: DataFrame, header: bool, sep: str = ","):
    return (df.write.option("header", header).option("sep", sep).option("quote", '"')
            .option("escape", '"').option("nullValue", ""))


def write_split_csv(df: DataFrame, path: str, split_col: str = "split",
                    mode: str = "overwrite") -> None:
    """Every split as headed CSV without an index column, one folder per split."""
    _csv_writer(df, True).mode(mode).partitionBy(split_col).csv(path)


def write_labelled_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header-less TSV in the S1 layout (quoted where needed)."""
    _csv_writer(df.select("Label", "Text"), False, "\t").mode(mode).csv(path)


def write_json_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Records as JSON Lines (one object per line)."""
    df.write.mode(mode).json(path)


def write_json_arrays(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON array files: one ``[...]`` per input partition, one file per task.

    Map-only (no shuffle) and row by row: a task writes the opening bracket, one object a line
    with its comma, and the closing bracket, so it never holds more than a batch.
    """
    js = df.select(F.to_json(F.struct(*df.columns)).alias("j"))

    def per_partition(batches):
        import pandas as pd
        first = True
        for pdf in batches:
            rows = [("[" if first and k == 0 else ",") + x for k, x in enumerate(pdf["j"].tolist())]
            if rows:
                first = False
                yield pd.DataFrame({"value": rows})
        if not first:
            yield pd.DataFrame({"value": ["]"]})

    js.mapInPandas(per_partition, "value string").write.mode(mode).text(path)


def write_if_absent(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Skip the work when the target already exists (``mode('ignore')``)."""
    df.write.mode("ignore").format(fmt).save(path)


def read_vocab_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object ``{token: id}`` -> <token, token_id> (one file is one model)."""
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json(F.col("value"), "map<string,bigint>")
    return raw.select(F.explode(m).alias("token", "token_id"))


def read_merge_list(spark: SparkSession, path: str) -> DataFrame:
    """A rank-ordered merge list ``left right`` per line (a ``#version`` first line skipped) ->
    <rank, left, right>."""
    raw = spark.read.text(path, wholetext=True)
    lines = raw.select(F.posexplode(F.split(F.col("value"), "\n")).alias("line_no", "line"))
    kept = lines.where((F.length(F.trim("line")) > 0) & ~((F.col("line_no") == 0) & F.col("line").startswith("#version")))
    parts = F.split(F.col("line"), " ")
    ranked = kept.select("line_no", parts[0].alias("left"), parts[1].alias("right"))
    first = ranked.agg(F.min("line_no").alias("_wm_first"))
    # lines are consecutive after the header, so rank = line_no - first kept line
    return ranked.crossJoin(first).select(
        (F.col("line_no") - F.col("_wm_first")).alias("rank"), "left", "right")


def write_model_files(spark: SparkSession, model, path: str) -> None:
    """S8 counterpart: ``path/vocab`` (one JSON map) and ``path/merges`` (a ranked pair a line)
    in the printable byte alphabet. Both are bounded by the model."""
    from wordmill.operators.subword import token_table
    table = token_table(spark, model)
    vocab = table.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("token", "token_id")))).alias("value"))
    vocab.coalesce(1).write.mode("overwrite").text(f"{path}/vocab")
    name = {r["token_id"]: r["token"] for r in table.collect()}
    lines = [("#version: 0.2",), *((f"{name[a]} {name[b]}",) for a, b, _ in model.merges)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("overwrite").text(f"{path}/merges")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/wordmill-files/{name}-{uuid.uuid4().hex}"
