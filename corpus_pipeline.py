"""A corpus pipeline: STAGES are applied to documents one after another, each written before the next reads it."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

import tidemark
from tidemark.llm import decontaminate, minhash_dedup, paragraph_dedup, quality_rules, sentencepiece_viterbi
from tidemark.session import discard, write_and_read, written_tables

cloudpickle.register_pickle_by_value(tidemark)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, n_chars counted anew."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.judge(docs).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id stays."""
    return minhash_dedup.dedup(docs).select(*docs.columns)


def repeated_paragraphs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Paragraphs that stand in an earlier document, or earlier in the same, are cut out; documents stay."""
    return _with_text(paragraph_dedup.dedup(docs), docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The benchmark's words are cut out of documents of which they are a twentieth or more; documents stay."""
    found = decontaminate.find_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    cut = decontaminate.remove_spans(found, where=decontaminate.contaminated())
    return _with_text(cut, docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to."""
    return sentencepiece_viterbi.code_texts(docs).withColumn("n_tokens", F.size("tokens").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("substring_dedup", repeated_paragraphs),
    ("decontamination", decontaminated),
    ("sentencepiece", encoded),
]

ORACLE_SQL = None


#: tables that the stage before wrote on its way
_LEFT: list[str] = []


def _after_the_other(stage: Stage) -> Stage:
    """A stage begins when the rows of the one before are written: what that wrote on its way is emptied first."""

    @functools.wraps(stage)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _LEFT)
        _LEFT.clear()
        with written_tables() as paths:
            out = stage(spark, docs, sf_dir)
        _LEFT.extend(paths)
        return out

    return begun


#: the columns that stages read
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def _others_aside(stage: Stage) -> Stage:
    """Other columns of documents pass a stage in one struct, so that none is taken for a column that the stage
    makes on its way; one that has the name of a result of the last stage is replaced by it."""

    @functools.wraps(stage)
    def passed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in OWN]
        if not others:
            return stage(spark, docs, sf_dir)
        packed = docs.select(*[c for c in docs.columns if c in OWN], F.struct(*others).alias("_others"))
        out = stage(spark, packed, sf_dir)
        new = [c for c in out.columns if c not in packed.columns]
        back = [F.col(c) if c in OWN else F.col("_others")[c].alias(c) for c in docs.columns if c not in new]
        return out.select(*back, *new)

    return passed


STAGES = [(name, _after_the_other(_others_aside(stage))) for name, stage in STAGES]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = write_and_read(docs, name)
    return docs
