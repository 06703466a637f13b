"""Ask a judge per row, reassemble streamed replies, summarise scores.

J2 runs the client inside ``mapInPandas``: one client per task (from a
factory), so concurrency equals the number of partitions and nothing passes
through the driver. The default client is a deterministic local stub; a real
HTTP chat client is available but never used in tests.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.operators.prompts import chat_payload, parse_int_reply

ChatClient = Callable[[str], list[str]]


def stub_score(prompt: str) -> int:
    """The stub judge's score: first 32 bits of md5(prompt) mod 101."""
    return int(hashlib.md5(prompt.encode("utf-8")).hexdigest()[:8], 16) % 101


def stub_client_factory() -> ChatClient:
    """A deterministic judge: replies the stub score, streamed one char per line."""
    def ask(payload: str) -> list[str]:
        prompt = json.loads(payload)["messages"][0]["content"]
        text = str(stub_score(prompt))
        lines = [json.dumps({"message": {"content": ch}}) for ch in text]
        lines.append(json.dumps({"message": {"content": ""}, "done": True}))
        return lines
    return ask


def http_client_factory(url: str = "http://localhost:11434/api/chat",
                        timeout: float = 120.0) -> Callable[[], ChatClient]:
    """A chat client posting JSON and reading newline-delimited JSON replies."""
    def make() -> ChatClient:
        import urllib.request

        def ask(payload: str) -> list[str]:
            req = urllib.request.Request(url, data=payload.encode("utf-8"), method="POST")
            req.add_header("Content-Type", "application/json")
            out = []
            with urllib.request.urlopen(req, timeout=timeout) as resp:
                for raw in resp:
                    line = raw.decode("utf-8").strip()
                    if line:
                        out.append(line)
            return out
        return ask
    return make


def ask_judge(df: DataFrame, id_cols: Sequence[str], prompt_col: str,
              client_factory: Callable[[], ChatClient] = stub_client_factory,
              model: str = "llama3") -> DataFrame:
    """J1+J2: one chat request per row -> <ids..., line_no, json> reply lines."""
    ids = list(id_cols)
    req = df.select(*ids, chat_payload(prompt_col, model).alias("_wm_payload"))
    id_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                          for f in req.schema.fields if f.name in ids)
    schema = f"{id_schema}, line_no bigint, json string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        for pdf in batches:
            id_vals = [pdf[c].tolist() for c in ids]
            out = {c: [] for c in ids}
            line_no, body = [], []
            for r, payload in enumerate(pdf["_wm_payload"].tolist()):
                for i, line in enumerate(client(payload)):
                    for c, vals in zip(ids, id_vals):
                        out[c].append(vals[r])
                    line_no.append(i)
                    body.append(line)
            yield pd.DataFrame({**out, "line_no": line_no, "json": body})

    return req.mapInPandas(run, schema)


def _content(json_col: str):
    """``message.content`` of a reply line, NULL when the line is malformed or has none."""
    return F.get_json_object(F.col(json_col), "$.message.content")


def malformed_lines(lines: DataFrame, json_col: str = "json") -> DataFrame:
    """The reply lines that ``reassemble`` would fail on."""
    return lines.where(_content(json_col).isNull())


def reassemble(lines: DataFrame, request_cols: str | Sequence[str], line_col: str = "line_no",
               json_col: str = "json", out_col: str = "reply", chunk_lines: int = 4096,
               malformed: str = "raise", complete_col: str | None = None) -> DataFrame:
    """Concatenate ``message.content`` per request in line order, up to the ``done`` line.

    A line without content raises (``malformed='raise'``) or is left out ('skip', with
    ``malformed_lines`` as the rejects). Lines after the first ``"done": true`` line belong to no
    reply; ``complete_col`` tells whether that line was seen. Two levels so a very long reply is
    not sorted in one task: lines are first concatenated per (request, line_no div chunk_lines),
    then the ordered chunks per request.
    """
    if malformed not in ("raise", "skip"):
        raise ValueError(f"unknown policy {malformed!r}")
    req = [request_cols] if isinstance(request_cols, str) else list(request_cols)
    content = _content(json_col)
    if malformed == "raise":
        content = F.when(content.isNull(), F.raise_error(
            F.concat(F.lit("malformed reply line: "), F.coalesce(F.col(json_col), F.lit("null"))))).otherwise(content)
    done = F.coalesce(F.get_json_object(F.col(json_col), "$.done") == "true", F.lit(False))
    parts = lines.select(*req, F.col(line_col).alias("_wm_line"), content.alias("_wm_v"), done.alias("_wm_done"))
    if malformed == "skip":
        parts = parts.where(F.col("_wm_v").isNotNull())
    parts = parts.withColumn("_wm_chunk", F.floor(F.col("_wm_line") / F.lit(chunk_lines)))

    def joined(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
        """The values of each key in order, cut after the first done one."""
        s = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col("_wm_v").alias("v"),
                                                 F.col("_wm_done").alias("d"))))
        x = df.groupBy(*keys).agg(s.alias("_wm_s"))
        at = F.array_position(F.transform("_wm_s", lambda y: y["d"]), F.lit(True))
        kept = F.when(at > 0, F.slice("_wm_s", F.lit(1), at.cast("int"))).otherwise(F.col("_wm_s"))
        return x.select(*keys, F.array_join(F.transform(kept, lambda y: y["v"]), "").alias("_wm_v"),
                        (at > 0).alias("_wm_done"))

    out = joined(joined(parts, [*req, "_wm_chunk"], "_wm_line"), req, "_wm_chunk")
    extra = [F.col("_wm_done").alias(complete_col)] if complete_col else []
    return out.select(*req, F.col("_wm_v").alias(out_col), *extra)


def score_summary(df: DataFrame, reply_col: str = "reply") -> DataFrame:
    """J4 (+P9): parsed count, total count, mean of parsed scores to 2 places (NULL if none)."""
    s = parse_int_reply(reply_col)
    return df.agg(F.count(s).alias("n_scored"), F.count(F.lit(1)).alias("n_total"),
                  F.round(F.avg(s.cast("double")), 2).alias("avg_score"))


def rejected_replies(df: DataFrame, reply_col: str = "reply") -> DataFrame:
    """P9 second output: the rows whose reply is not an integer."""
    return df.where(parse_int_reply(reply_col).isNull())
