"""ST1-ST2: incremental ingest and reply reassembly with Structured Streaming.

* ST1: a file source with a checkpoint never re-reads a finished file (the
  re-aimed skip-if-present rule). Row-local operators run on the stream and
  the sink is a parquet folder; ``trigger(availableNow=True)`` drains what is
  there and stops, so the streamed result can be compared with the batch one.
* ST2: keyed state holds the lines of open replies; a reply is given out at its
  ``done`` line, once, and its lines leave the state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import StructType


def stream_files(spark: SparkSession, path_glob: str, schema: StructType | str,
                 fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path_glob)


def _drained(query: StreamingQuery, timeout_s: float | None) -> None:
    """Waits for an availableNow query; a limit that runs out stops it and raises."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"the stream was not drained in {timeout_s} s; the sink holds only a part")
    if query.exception() is not None:
        raise query.exception()


def ingest(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], sink_path: str,
           checkpoint_path: str, timeout_s: float | None = None) -> DataFrame:
    """ST1: run ``transform`` over every new file once; return the sink as a batch frame."""
    out = transform(stream)
    q = (out.writeStream.format("parquet").outputMode("append")
         .option("path", sink_path).option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    _drained(q, timeout_s)
    return stream.sparkSession.read.schema(out.schema).parquet(sink_path)


def ingest_batches(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], sink_path: str,
                   checkpoint_path: str, timeout_s: float | None = None) -> DataFrame:
    """ST1 for operators that join static tables of any size: ``transform`` sees each micro-batch as a batch frame.

    A batch is written to a folder of its number, so a batch that is run again replaces itself.
    """
    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{sink_path}/batch={number}")
    q = (stream.writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(write)
         .trigger(availableNow=True).start())
    _drained(q, timeout_s)
    spark = stream.sparkSession
    empty = transform(spark.createDataFrame([], stream.schema))
    return spark.read.schema(empty.schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).parquet(sink_path) \
        if _exists(spark, sink_path) else empty


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


_OPEN = "lines array<bigint>, contents array<string>, finished boolean"


def _append_lines(request_cols: Sequence[str], timed: bool):
    """The state of a reply is its lines so far; they are given out, and dropped, at the done line."""
    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        lines, contents, finished = state.get if state.exists else ([], [], False)

        def row(upto: int | None, complete: bool) -> pd.DataFrame:
            kept = sorted((n, c) for n, c in zip(lines, contents) if upto is None or n <= upto)
            return pd.DataFrame([(*key, "".join(c for _, c in kept), complete)], columns=[*request_cols, "reply", "complete"])
        if state.hasTimedOut:
            state.remove()
            if not finished:
                yield row(None, False)
            return
        if not finished:
            ends, latest = [], 0
            lines, contents = list(lines), list(contents)
            for b in batches:
                lines += b["line"].tolist()
                contents += b["content"].tolist()
                ends += b["line"][b["done"]].tolist()
                latest = max(latest, *b["ms"])
            if ends:
                yield row(min(ends), True)
                lines, contents, finished = [], [], True
            state.update((lines, contents, finished))
            if timed:
                state.setTimeoutTimestamp(latest + 1)
    return run


def reassemble_stream(lines: DataFrame, request_col: str | Sequence[str], line_col: str, json_col: str,
                      sink_path: str, checkpoint_path: str, complete_col: str = "complete", out_col: str = "reply",
                      timeout_s: float | None = None, time_col: str | None = None, forget: str = "1 hour") -> DataFrame:
    """ST2: <request..., reply, complete>: ``message.content`` in line order up to the done line.

    Keyed state holds the lines of open replies only. A reply is written to the sink once, when its done line
    comes; of a finished one a mark stays, so that later lines belong to nothing and no line is read again.
    Lines may come in any order, the done line no earlier than the micro-batch of the last one before it.
    A malformed line stops the stream. With ``time_col``, a timestamp, a reply that is silent while the stream's
    time moves on by ``forget`` is given out as incomplete and its state dropped (as the mark of a finished one
    is); lines older than that are late and belong to nothing. The state lives in the checkpoint: a restart with the same
    paths goes on where the last run ended. What is returned is the sink with the replies still open.
    """
    keys = [request_col] if isinstance(request_col, str) else list(request_col)
    content = F.get_json_object(json_col, "$.message.content")
    content = F.when(content.isNull(), F.raise_error(
        F.concat(F.lit("malformed reply line: "), F.coalesce(F.col(json_col), F.lit("null"))))).otherwise(content)
    time = F.current_timestamp() if time_col is None else F.col(time_col).cast("timestamp")
    rows = lines.select(*keys, F.col(line_col).cast("long").alias("line"), content.alias("content"),
                        F.coalesce(F.get_json_object(json_col, "$.done") == "true", F.lit(False)).alias("done"),
                        time.alias("time"), F.unix_millis(time).alias("ms"))
    if time_col is not None:
        rows = rows.withWatermark("time", forget)
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema)
    schema = f"{key_schema}, reply string, complete boolean"
    timeout = GroupStateTimeout.NoTimeout if time_col is None else GroupStateTimeout.EventTimeTimeout
    out = rows.groupBy(*keys).applyInPandasWithState(_append_lines(keys, time_col is not None), schema, _OPEN, "append", timeout)
    q = (out.writeStream.format("parquet").outputMode("append").option("path", sink_path)
         .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())
    _drained(q, timeout_s)
    spark = lines.sparkSession
    given = spark.read.schema(schema).parquet(sink_path)
    state = spark.read.format("statestore").load(checkpoint_path).select("key.*", "value.groupState.*")
    in_order = F.array_sort(F.arrays_zip("lines", "contents"))
    still = state.where("not finished").select(
        *keys, F.array_join(F.transform(in_order, lambda x: x["contents"]), "").alias("reply"), F.lit(False).alias("complete"))
    return given.unionByName(still).select(*keys, F.col("reply").alias(out_col), F.col("complete").alias(complete_col))
