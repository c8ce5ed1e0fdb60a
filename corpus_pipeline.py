"""Corpus pipeline: quality rules, SimHash near-dedup, suffix-array dedup, decontamination, packing.

Each stage works on all rows that the one before it kept, calls one operator of ``ledgerlake.llm``, and all but the last
return the columns of ``documents``: the first drops the documents that the rules reject and the lines that fail, the second
keeps one document of each near-duplicate group, the third cuts repeated strings of 200 bytes out of the texts, the
fourth drops documents that repeat a benchmark item, and the last packs token sequences.

An empty table passes through all stages; extra columns stay until the last one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import latent, packing, quality, simhash, substrings
from ledgerlake.llm.common import store, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.cut(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return latent.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings),
    ("decontamination", decontamination), ("packing", pack)]

ORACLE_SQL: str | None = None
"""Suffix arrays, latent search and a tokenizer cannot be written in SQL; tests hold each stage against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the table ``documents``, each on the stored rows of the one before."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = store(docs, f"pipeline-{name}")
    return docs
