"""Collects the registered queries and their DuckDB twins from every plan module."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession

_MODULES = (
    "wordmill.plans.classification",
    "wordmill.plans.instruction",
    "wordmill.plans.training_data",
    "wordmill.plans.scoring",
    "wordmill.plans.corpus",
    "wordmill.plans.subwords",
    "wordmill.plans.io",
    "wordmill.plans.models",
    "wordmill.plans.streams",
)


def _mods():
    return [importlib.import_module(m) for m in _MODULES]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wordmill.plans.classification import split_token_stats
    return split_token_stats(spark, sf_dir)


def all_queries() -> dict:
    out: dict = {}
    for m in _mods():
        out.update(m.QUERIES)
    return out


def all_oracles() -> dict:
    out: dict = {}
    for m in _mods():
        out.update(m.ORACLE)
    return out
