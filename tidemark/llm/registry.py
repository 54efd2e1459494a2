"""The text queries and the SQL of those that SQL can say."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

MODULES = (
    "decontaminate",
    "main_text",
    "licenses",
    "quality_gam",
    "suffix_dedup",
    "sentencepiece_viterbi",
    "minhash_dedup",
    "paragraph_dedup",
    "quality_rules",
    "url_filter",
    "source_mix",
    "merkle_manifest",
    "conversation_trie",
)


def _modules():
    return [importlib.import_module(f"tidemark.llm.{name}") for name in MODULES]


def queries() -> dict[str, Query]:
    return {module.NAME: module.query for module in _modules()}


def oracle_sql() -> dict[str, str]:
    return {module.NAME: module.SQL for module in _modules() if module.SQL}
