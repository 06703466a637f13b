"""License scans by a positional rare-token index, in DataFrame functions only.

A template is a run of licence words with mandatory key phrases at fixed offsets. Document
frequencies of the templates' words are counted over all documents; each template is posted in the
index under the highest-IDF words of its key phrases, with their offsets. A file's index words are
looked up with their positions; postings of one template are intersected by relative position
(word position minus template offset), and a start that remains is verified by its key phrases.
Every key phrase contains the words it is looked up by, so no place is missed. Everything after the frequencies happens inside
the row: nothing is shuffled but at most one count per template word and task.

Defined results: a null text is empty. Places may overlap and are all counted. Without a base place
``first_word`` and ``last_word`` are null. ``score`` is the largest share of a template's words that stand
at their places around a verified start, 0 without one. Repeated rows repeat.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import lower_az, native

#: Fixed value: what lies between words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    keys: tuple[tuple[str, ...], ...]
    base: bool = False

    def key_offsets(self) -> list[tuple[int, tuple[str, ...]]]:
        """(first offset in the template, phrase) of each key phrase."""
        return [(next(i for i in range(len(self.words)) if self.words[i:i + len(k)] == k), k) for k in self.keys]


def _template(label: str, text: str, *keys: str, base: bool = False) -> Template:
    return Template(label, tuple(text.split()), tuple(tuple(k.split()) for k in keys or (text,)), base)


#: The base phrases, then notices of well-known licences with their key phrases.
TEMPLATES = (
    _template("mit", "mit license", base=True),
    _template("apache", "apache license", base=True),
    _template("gpl", "general public license", base=True),
    _template("mit-notice", "released under the mit license", "under the mit license"),
    _template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software",
              "permission is hereby granted", "obtaining a copy of this software"),
    _template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    _template("gpl-3.0", "this work is licensed under the gnu general public license version 3",
              "gnu general public license version 3"),
    _template("gpl-2.0", "this work is licensed under the gnu general public license version 2",
              "gnu general public license version 2"),
    _template("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    _template("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    _template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    _template("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    _template("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    _template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
              "redistribution and use in source and binary forms"),
    _template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    _template("unlicense", "this is free and unencumbered software released into the public domain",
              "free and unencumbered software"),
    _template("spdx", "spdx license identifier"),
)


def words_of(text: Column) -> Column:
    """The words of a text: runs of digits, a-z and non-ASCII characters after lower-casing A-Z."""
    return F.array_remove(F.split(lower_az(text), SEPARATORS), "")


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """word, n_docs of the vocabulary's words, over every row of ``docs(text)``."""
    known = F.array(*[F.lit(w) for w in vocabulary])
    return (native(docs, "text").select(F.explode(F.array_intersect(words_of(F.col("text")), known)).alias("word"))
            .groupBy("word").agg(F.count("*").alias("n_docs")))


def rare_words(template: Template, frequency: dict[str, int], most: int = 2) -> list[tuple[str, int]]:
    """The template's index entries: its ``most`` key words of highest IDF, with their offsets."""
    places = {w: at + i for at, key in reversed(template.key_offsets()) for i, w in reversed(list(enumerate(key)))}
    return sorted(places.items(), key=lambda e: (frequency.get(e[0], 0), e[0]))[:most]


def _row_barrier(df: DataFrame, *cols: Column) -> DataFrame:
    """``df`` with these columns computed once: an explode that the optimizer doesn't inline."""
    return df.select(F.explode(F.array(F.struct(*cols))).alias("r")).select("r.*")


def _verified(template: Template, frequency: dict[str, int]) -> Column:
    """Ascending starts of a template in the row's ``words``, from its ``spots`` <at, word>."""
    def starts(word, offset):
        return F.transform(F.filter("spots", lambda s: s["word"] == word), lambda s: s["at"] - offset)
    both = F.array_distinct(reduce(F.array_intersect, [starts(*e) for e in rare_words(template, frequency)]))

    def holds(start):
        return reduce(lambda a, b: a & b, [
            (start + at >= 0) & (F.slice("words", F.greatest(start + at, F.lit(0)) + 1, len(key)) == F.array(*map(F.lit, key)))
            for at, key in template.key_offsets()])
    return F.array_sort(F.filter(both, holds))


def _share(template: Template, starts: Column) -> Column:
    """Largest share of the template's words that stand in their places around a start; null without one."""
    def matched(start):
        own = [F.coalesce((F.get("words", start + i) == w).cast("int"), F.lit(0)) for i, w in enumerate(template.words)]
        return reduce(lambda a, b: a + b, own) / F.lit(float(len(own)))
    return F.array_max(F.transform(starts, matched))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of ``docs(doc_id, text)``."""
    vocabulary = sorted({w for t in templates for k in t.keys for w in k})
    # at most one row for each template word comes to the driver
    frequency = {r.word: r.n_docs for r in document_frequencies(docs, vocabulary).collect()}
    index = sorted({w for t in templates for w, _ in rare_words(t, frequency)})
    rows = _row_barrier(native(docs, "doc_id", "text"), F.col("doc_id").cast("long").alias("doc_id"),
                        words_of(F.col("text")).alias("words"))
    spots = F.filter(F.transform("words", lambda w, i: F.when(w.isin(index), F.struct(i.alias("at"), w.alias("word")))),
                     lambda s: s.isNotNull())
    rows = _row_barrier(rows, F.col("doc_id"), F.col("words"), spots.alias("spots"))
    rows = _row_barrier(rows, F.col("doc_id"), F.size("words").cast("long").alias("n_words"), F.col("words"),
                        *[_verified(t, frequency).alias(f"t{k}") for k, t in enumerate(templates)])
    base = [f"t{k}" for k, t in enumerate(templates) if t.base]

    def named(which):
        own = [F.when(F.size(f"t{k}") > 0, F.lit(templates[k].label)) for k in which]
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*own)))), ",")
    shares = [F.coalesce(_share(t, F.col(f"t{k}")), F.lit(0.0)) for k, t in enumerate(templates)]
    return rows.select(
        "doc_id", "n_words", reduce(lambda a, b: a + b, [F.size(c) for c in base]).cast("long").alias("n_base"),
        F.array_min(F.concat(*base)).cast("long").alias("first_word"),
        F.array_max(F.concat(*base)).cast("long").alias("last_word"),
        named([k for k, t in enumerate(templates) if t.base]).alias("base_labels"),
        named(range(len(templates))).alias("labels"), F.greatest(*shares).alias("score"))


def oracle(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """DuckDB SQL for ``scan(documents)``: every position of every text is tried."""
    def starts(t):
        tests = [f"coalesce(w[i + {at + j + 1}], '') = '{x}'" for at, key in t.key_offsets() for j, x in enumerate(key)]
        low = min(at for at, _ in t.key_offsets())
        return f"list_filter(range({-low}, n_words), lambda i: {' AND '.join(tests)})"

    def share(t, k):
        parts = " + ".join(f"(CASE WHEN i + {j} >= 0 AND coalesce(w[i + {j + 1}], '') = '{x}' THEN 1 ELSE 0 END)"
                           for j, x in enumerate(t.words))
        return f"coalesce(list_max(list_transform(t{k}, lambda i: ({parts}) / {float(len(t.words))})), 0.0)"

    def named(which):
        own = ", ".join(f"CASE WHEN len(t{k}) > 0 THEN '{templates[k].label}' END" for k in which)
        return f"array_to_string(list_sort(list_filter([{own}], lambda x: x IS NOT NULL)), ',')"
    base = [k for k, t in enumerate(templates) if t.base]
    every = f"list_concat({', '.join(f't{k}' for k in base[:1])}, list_concat({', '.join(f't{k}' for k in base[1:])}))"
    return rf"""
        WITH s AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SEPARATORS}'), lambda x: x <> '') AS w
                   FROM documents),
        n AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n_words FROM s),
        p AS (SELECT doc_id, w, n_words, {', '.join(f'{starts(t)} AS t{k}' for k, t in enumerate(templates))} FROM n),
        q AS (SELECT *, {every} AS b FROM p)
        SELECT doc_id, n_words, CAST(len(b) AS BIGINT) AS n_base, CAST(list_min(b) AS BIGINT) AS first_word,
               CAST(list_max(b) AS BIGINT) AS last_word, {named(base)} AS base_labels,
               {named(range(len(templates)))} AS labels,
               greatest({', '.join(share(t, k) for k, t in enumerate(templates))}) AS score
        FROM q"""
