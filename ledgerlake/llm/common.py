"""Helpers shared by the training-data operators: table access, stored intermediates, components."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import ensure_checkpoint_dir

TARGET_BYTES = 8 << 20
"""Text bytes that a Python task receives at a time."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of a batch that a Python task receives at once: texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TARGET_BYTES))


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared checkpoint folder that nothing has used."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: the lineage is cut, the rows survive
    the loss of executors, and later readers prune columns.  The files stay until the folder is cleaned
    or :func:`discard` is called."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files behind a frame made by :func:`store`, once nothing reads it any more."""
    spark, path = df.sparkSession, df._stored_path
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only the columns an operator reads, so that extra columns never clash with its own names."""
    return df.select(*[F.col(f"`{n}`").alias(n) for n in names])


def numbered(docs: DataFrame, doc_col: str) -> tuple[DataFrame, str]:
    """``docs`` with a column that is unique per row: doc_col itself, or where that repeats or is null, a number."""
    ids = docs.select(F.col(f"`{doc_col}`").alias("doc"))
    if ids.groupBy("doc").count().where("count > 1 OR doc IS NULL").isEmpty():
        return docs, doc_col
    return store(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered"), "__row"


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` by alternating large-star and small-star steps.

    Returns ``node, root`` (the smallest node of the component) for every node that has an edge to another
    node.  Each step is a pre-aggregated minimum per node and a join that splits skewed keys; each round is
    stored, so a lost executor repeats one round at most.  The number of rounds grows with the logarithm
    of the longest path.
    """
    def starred(pairs: DataFrame, large: bool) -> DataFrame:
        if large:
            both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            out = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:  # every u points to smaller v only
            least = pairs.groupBy("u").agg(F.min("v").alias("m"))
            out = (pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .unionByName(least.select("u", F.col("m").alias("v"))))
        return out.where("u <> v").distinct()

    now = store(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        after = store(starred(starred(now, True), False), "edges")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(now)
        now = after
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = mark
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")
