"""The queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import (chat, latent, lmscore, packing, quality, ranked, simhash, spelling, substrings, tokenfiles,
                            urls, warc, wrappers)
from ledgerlake.llm.common import fresh_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the line-first verdict of every document."""
    return quality.report(table(spark, sf_dir, "documents"))


ORACLE["op5_quality"] = quality.ORACLE_SQL


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents")))


@query
def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document left after the removal of strings of 200 bytes that start anywhere else."""
    return substrings.digest(table(spark, sf_dir, "documents"))


@query
def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    return urls.judge(table(spark, sf_dir, "pages"))


ORACLE["op4_urls"] = urls.ORACLE_SQL


@query
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back; conversation -7 holds control strings."""
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_turns(turns))


@query
def op2_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by its host's wrapper."""
    return wrappers.extract(table(spark, sf_dir, "pages"))


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page's response record."""
    return warc.digest(warc.derive(warc.responses(table(spark, sf_dir, "pages"))))


@query
def op9_latent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that every document repeats."""
    return latent.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_lmscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stupid-backoff score of every document under the corpus's own trigram counts."""
    return lmscore.scores(table(spark, sf_dir, "documents"))


@query
def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op11_ranked"] = ranked.ORACLE_SQL


@query
def op12_tokenfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, read back from the token files."""
    path = fresh_path(spark, "token-files")
    tokenfiles.write(table(spark, sf_dir, "documents"), path)
    return tokenfiles.read(spark, path, with_ids=False)


@query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, root and number of near words of every word of the documents."""
    return spelling.variants(table(spark, sf_dir, "documents"))
