"""Secret scans by a trigram inverted index.

Each rule's regular expression is parsed and turned into a Boolean query of trigrams that any match
must contain (alternatives become OR, sequences AND, case folded). Texts are indexed in segments, as
a scan task meets them: posting lists of the query trigrams only, intersected and united per rule;
the rows that remain are verified with the expression itself. Rules whose expression has no
mandatory trigram are matched against every row. Nothing is shuffled.

Defined results: a null text is empty and has no span. Offsets are code points, end exclusive.
Matches of a kind don't overlap; kinds may. Repeated rows repeat; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import product
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import native, slices, text_bytes

#: Most literal strings that one stretch of an expression is expanded to.
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    ignore_case: bool = False
    group: int = 0
    least: int = 0  # characters that the group needs

    def compiled(self):
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


#: The base kinds in the order in which they are listed.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]+", least=32),
)
#: Kinds that this operator adds: published shapes of well-known credentials.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"(?:gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{22,})"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("live_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
)


def trigram_query(pattern: str):
    """None (no mandatory trigram), a trigram, or ("and" | "or", queries) over lower-cased text."""
    strings, query, _ = _walk(parser.parse(pattern))
    return _both(query, _literal(strings))


def _both(*queries):
    own = {q for q in queries if q is not None}
    return None if not own else own.pop() if len(own) == 1 else ("and", frozenset(own))


def _either(queries):
    own = set(queries)
    return None if None in own or not own else own.pop() if len(own) == 1 else ("or", frozenset(own))


def _literal(strings):
    """What a text that holds one of the strings must contain."""
    return _either(_both(*(s[i:i + 3] for i in range(len(s) - 2))) for s in strings)


def _characters(items) -> set[str] | None:
    out = set()
    for kind, value in items:
        if kind is op.LITERAL:
            out.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < 8:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _walk(nodes):
    """(strings that the end of the sequence may spell, query of all before them, whether they spell all of it)."""
    strings, query, whole = {""}, None, True

    def extend(more):
        nonlocal strings, query, whole
        if more is None or len(strings) * len(more) > MAX_STRINGS:
            query, strings, whole = _both(query, _literal(strings)), {""}, False
        if more is not None:
            strings = {a + b for a, b in product(strings, more)} if len(more) <= MAX_STRINGS else {""}

    for kind, value in nodes:
        if kind is op.LITERAL:
            extend({chr(value).lower()})
        elif kind is op.IN:
            extend(_characters(value))
        elif kind is op.AT:
            continue
        elif kind is op.SUBPATTERN:
            inner, own, plain = _walk(value[3])
            if own is None and plain:
                extend(inner)
            else:
                query = _both(query, own)
                extend(None)
                query = _both(query, _literal(inner))
        elif kind is op.BRANCH:
            walked = [_walk(x) for x in value[1]]
            if all(q is None and plain for _, q, plain in walked):
                extend(set().union(*(s for s, _, _ in walked)))
            else:
                extend(None)
                query = _both(query, _either(_both(q, _literal(s)) for s, q, _ in walked))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, body = value
            inner, own, plain = _walk(body)
            if own is None and plain and low == 0 and high == 1:
                extend(inner | {""})
            elif low >= 1:
                if own is None and plain and low == high and low <= 4:
                    for _ in range(low):
                        extend(inner)
                else:
                    extend(None)
                    query = _both(query, own, _literal(inner))
            else:
                extend(None)
        else:
            extend(None)
    return strings, query, whole


def _trigrams(query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(_trigrams, query[1]))


class Segment:
    """Posting lists (ascending row numbers) of the wanted trigrams over one run of texts."""

    def __init__(self, texts: list[bytes], wanted: np.ndarray):
        data = np.frombuffer(b"\0\0".join(t.lower() for t in texts) + b"\0\0", np.uint8)
        ends = np.cumsum([len(t) + 2 for t in texts])
        code = (data[:-2].astype(np.uint32) << np.uint32(16)) | (data[1:-1].astype(np.uint32) << np.uint32(8)) | data[2:]
        at = np.flatnonzero(wanted[code])
        code, row = code[at], np.searchsorted(ends, at, "right")
        key = np.unique(code.astype(np.int64) << 32 | row)
        code, row = key >> 32, key & 0xFFFFFFFF
        cuts = np.flatnonzero(np.diff(code)) + 1
        heads = code[np.r_[0, cuts]].tolist() if len(code) else []
        self.lists = dict(zip(heads, np.split(row, cuts)))

    def rows(self, query) -> np.ndarray:
        if isinstance(query, str):
            return self.lists.get(int.from_bytes(query.encode(), "big"), np.zeros(0, np.int64))
        kind, parts = query
        found = sorted((self.rows(q) for q in parts), key=len)
        out = found[0]
        for rows in found[1:]:
            out = np.intersect1d(out, rows, True) if kind == "and" else np.union1d(out, rows)
        return out


def _matches(rule: Rule, expression) -> Callable[[str], list[tuple[int, int]]]:
    def found(text):
        return [m.span() for m in expression.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]
    return found


def _digest(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)


def scan(docs: DataFrame, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_spans, spans of every row of ``docs(doc_id, text)``."""
    rules = (*BASE, *more)
    queries = [q if (q := trigram_query(r.pattern)) and all(len(t.encode()) == 3 for t in _trigrams(q)) else None
               for r in rules]

    def run(batches):
        wanted = np.zeros(1 << 24, bool)
        wanted[[int.from_bytes(t.encode(), "big") for q in queries for t in _trigrams(q)]] = True
        find = [_matches(r, r.compiled()) for r in rules]
        for batch in batches:
            for part in slices(batch, "text"):
                raw = text_bytes(part, "text")
                texts = [t.decode("utf-8", "replace") for t in raw]
                segment = Segment(raw, wanted)
                spans = [[] for _ in raw]
                for k, query in enumerate(queries):
                    for row in (range(len(raw)) if query is None else segment.rows(query).tolist()):
                        spans[row].extend((a, k, rules[k].kind, b) for a, b in find[k](texts[row]))
                for own in spans:
                    own.sort()
                base = [[s for s in own if s[1] < len(BASE)] for own in spans]
                counts = [pa.array([sum(s[1] == k for s in own) for own in base], pa.int64()) for k in range(len(BASE))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *counts, pa.array(map(_digest, base), pa.string()),
                     pa.array(map(_digest, spans), pa.string())],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"])
    narrow = native(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string")
