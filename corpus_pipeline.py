"""Filter, deduplicate, decontaminate and encode ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept,
and calls one operator of ``nodecast.llm``.  All but the last return the columns
of ``documents``.  A stage numbers its rows and rejects by that number, so that
rows that share an id, or have none, are each judged by their own text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from nodecast.llm import bpe_codec, decontaminate, language, simhash, toxicity
from nodecast.llm.queries import (
    LEVEL,
    MAX_BITS,
    ONE_WORD_IN,
    SHINGLE,
    TOKENIZER,
    WINDOW,
    table,
)
from nodecast.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents with a number ``_row`` of each row, written so that it stays."""
    return materialize(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "numbered")


def _without(rows: DataFrame, rejected: DataFrame) -> DataFrame:
    """The documents whose number is not in ``rejected``.  The numbers are
    written first, so that Spark knows their size when it chooses how to join."""
    numbers = materialize(rejected.select("_row"), "rejected")
    return rows.join(numbers, "_row", "left_anti").select(*COLUMNS)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    rows = _numbered(docs)
    model = toxicity.fit(rows, table(spark, sf_dir, "labels"))  # labels know documents by their id
    return _without(rows, toxicity.score(rows, model, key="_row").where("toxic"))


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain enough."""
    rows = _numbered(docs)
    found = language.identify(rows, "lang", LEVEL, key="_row", declared="lang", address="source")
    return _without(rows, found.where("NOT kept"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the least id,
    without an id only if none has one."""
    rows = _numbered(docs)
    groups = simhash.near_duplicates(rows, SHINGLE, MAX_BITS, key="_row")
    named = groups.select("_row", "component_id").join(rows.select("_row", "doc_id"), "_row")
    first = F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "_row"))
    firsts = named.groupBy("component_id").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = firsts.select("component_id", F.col("first._row").alias("first_row"))
    return _without(rows, named.join(firsts, "component_id").where("_row != first_row"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages do not contaminate."""
    rows = _numbered(docs)
    found = decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"), WINDOW, ONE_WORD_IN, key="_row")
    return _without(rows, found.where("contaminated"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the tokens of each document and of their decoding."""
    return bpe_codec.digests(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", without_toxic),
    ("language", in_known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("bpe", encoded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
