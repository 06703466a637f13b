"""Streaming queries: incremental ingest (ST1) and reply reassembly (ST2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.functions.text import word_tokens
from wordmill.operators import prompts as pr
from wordmill.operators import sequences as seq
from wordmill.operators import tokens as tok
from wordmill.plans import sqlbits as q
from wordmill.sources import files as io
from wordmill.session import load_table
from wordmill.streaming import ingest as st


def _table_glob(sf_dir: str, name: str) -> str:
    # the file source lists a folder or a glob; the table is one file in a shared folder
    return f"{sf_dir.rstrip('/')}/{name}.parque[t]"


def _row_local(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.size(word_tokens("text")).cast("bigint").alias("n_tokens"),
                     F.md5(pr.flatten_newlines("text")).alias("flat_md5"))


def st1_ingest(spark: SparkSession, sf_dir: str):
    schema = load_table(spark, sf_dir, "documents").schema
    sink, ck = io.scratch_path(spark, "ingest-sink"), io.scratch_path(spark, "ingest-ck")
    st.ingest(st.stream_files(spark, _table_glob(sf_dir, "documents"), schema), _row_local, sink, ck)
    # a second run over the same files finds nothing new: every file is read once
    return st.ingest(st.stream_files(spark, _table_glob(sf_dir, "documents"), schema),
                     _row_local, sink, ck)


#: Ids of a streamed row, and micro-batches of the documents.
ST1_LENGTH = 64
ST1_BATCHES = 4


def st1_encode(spark: SparkSession, sf_dir: str):
    """The documents arrive in four batches of files; each micro-batch is encoded in the labelled documents' vocabulary, then padded."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    known = docs.join(load_table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    vocab = tok.build_vocab(tok.explode_tokens(known, "doc_id"))
    size = vocab.count()  # the unknown id; the pad id is the next one
    folder, sink, ck = (io.scratch_path(spark, f"encode-{x}") for x in ("docs", "sink", "ck"))
    files = spark.sparkContext.defaultParallelism  # of a batch, as many as tasks run at a time
    docs.repartition(ST1_BATCHES * files).write.parquet(folder)

    def padded(batch: DataFrame) -> DataFrame:
        enc = tok.encode_texts(batch, vocab, oov="unk", unk_id=size)
        return enc.select("doc_id", seq.pad_truncate("ids", ST1_LENGTH, size + 1).alias("ids"))
    out = st.ingest_batches(st.stream_files(spark, folder, docs.schema, max_files_per_trigger=files), padded, sink, ck)
    return out.select("doc_id", F.md5(F.array_join("ids", " ")).alias("ids_md5"))


def st2_reassemble(spark, sf_dir):
    """The events come as files of consecutive event_ids, a micro-batch each; the stream is stopped half-way and restarted."""
    ev = load_table(spark, sf_dir, "events")
    folder, sink, ck = (io.scratch_path(spark, f"reassembly-{x}") for x in ("lines", "sink", "ck"))
    low, high = ev.agg(F.min("event_id"), F.max("event_id")).first()
    part = F.floor((F.col("event_id") - low) * ST2_FILES / (high - low + 1)) if low is not None else F.lit(0)
    out = None
    for half in range(2):
        for k in range(half * ST2_FILES // 2, (half + 1) * ST2_FILES // 2):
            ev.where(part == k).coalesce(1).write.mode("append").parquet(folder)
        out = _replies(spark, folder, ev.schema, sink, ck)
    return out


#: Files, and so micro-batches, of the reply lines.
ST2_FILES = 4


def _replies(spark, folder, schema, sink, ck):
    lines = st.stream_files(spark, folder, schema, max_files_per_trigger=1)
    # a user's events are the lines of one reply; a purchase is its last line
    message = F.struct(F.get_json_object("props", "$.k").alias("content"))
    lines = lines.select(F.col("user_id").alias("request_id"), F.col("event_id").alias("line_no"),
                         F.to_json(F.struct(message.alias("message"),
                                            (F.col("event_type") == "purchase").alias("done"))).alias("json"))
    return st.reassemble_stream(lines, "request_id", "line_no", "json", sink, ck)


QUERIES = {
    "st1_ingest": st1_ingest,
    "st1_encode": st1_encode,
    "st2_reassemble": st2_reassemble,
}

_KNOWN = q.vocab("SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
ORACLE = {
    "st1_encode": f"""
WITH v AS MATERIALIZED ({_KNOWN}), z AS (SELECT count(*) AS n FROM v),
e AS (SELECT l.doc_id, list(coalesce(v.token_id, z.n) ORDER BY l.pos) AS ids
      FROM ({q.long_tokens('SELECT * FROM documents')}) l LEFT JOIN v ON l.token = v.token, z WHERE l.pos < {ST1_LENGTH} GROUP BY l.doc_id)
SELECT d.doc_id, md5(array_to_string(list_resize(coalesce(e.ids, []), {ST1_LENGTH}, z.n + 1), ' ')) AS ids_md5
FROM documents d LEFT JOIN e ON e.doc_id = d.doc_id, z""",
    "st1_ingest": f"""
SELECT doc_id, CAST(len({q.word_tokens('text')}) AS BIGINT) AS n_tokens,
       md5(replace(text, chr(10), ' ')) AS flat_md5 FROM documents""",
    "st2_reassemble": """
WITH ends AS (SELECT user_id, min(CASE WHEN event_type = 'purchase' THEN event_id END) AS last_id
              FROM events GROUP BY user_id)
SELECT e.user_id AS request_id, any_value(x.last_id) IS NOT NULL AS complete,
       string_agg(CAST(json_extract_string(e.props, '$.k') AS VARCHAR), '' ORDER BY e.event_id) AS reply
FROM events e JOIN ends x ON e.user_id = x.user_id
WHERE x.last_id IS NULL OR e.event_id <= x.last_id GROUP BY e.user_id""",
}
