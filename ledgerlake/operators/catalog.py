"""Lineage catalog (G1-G7, K6): model → table → column → source-table lookups.

The catalog rows come from an external extraction step (the reference asks
an LLM; that call is not part of this library).  Everything here is batch
DataFrame work over the three flat catalog tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.text import json_span, split_list, zero_pad
from ledgerlake.operators.writers import store_once
from ledgerlake.operators.lookup import dedupe_lookup, last_name_part

RAW_SOURCE = "raw source"


def models(columns: DataFrame) -> DataFrame:
    """G1: distinct model names (ordered)."""
    return columns.select("model_name").where(F.col("model_name").isNotNull()).distinct().orderBy("model_name")


def tables_of(columns: DataFrame, model: str) -> DataFrame:
    """Tables a model produces (ordered)."""
    return (columns.where(F.col("model_name") == model).select("table_name")
            .where(F.col("table_name").isNotNull()).distinct().orderBy("table_name"))


def columns_of(columns: DataFrame, model: str, table: str) -> DataFrame:
    """Columns of one model's table, NULL text shown as ''."""
    out = columns.where((F.col("model_name") == model) & (F.col("table_name") == table))
    return out.select("column_id", "column_name", "source_table").na.fill("").orderBy("column_name")


def producers(columns: DataFrame) -> DataFrame:
    """table → producing model (one per table; the greatest model name wins)."""
    return dedupe_lookup(columns.select("table_name", "model_name"), ["table_name"], ["model_name"],
                         normalize_keys=False)


def resolve_producer(df: DataFrame, name_col: str, prod: DataFrame, out: str = "producer_model") -> DataFrame:
    """Exact table-name match, else the part after the last '.'."""
    p = prod.select(F.col("table_name").alias("__pt"), F.col("model_name").alias("__pm"))
    exact = df.join(p, F.col(name_col) == F.col("__pt"), "left").withColumnRenamed("__pm", "__m1").drop("__pt")
    p2 = prod.select(F.col("table_name").alias("__pt2"), F.col("model_name").alias("__pm2"))
    both = exact.join(p2, last_name_part(F.col(name_col)) == F.col("__pt2"), "left").drop("__pt2")
    return both.withColumn(out, F.coalesce("__m1", "__pm2")).drop("__m1", "__pm2")


def lineage_edges(columns: DataFrame) -> DataFrame:
    """Every (target table, source table) edge from the delimited source
    lists, each source resolved to its producing model; unresolved sources are
    raw inputs.  One batch join over all columns, not a per-click lookup."""
    edges = columns.select("model_name", F.col("table_name").alias("target_table"),
                           F.explode(split_list("source_table")).alias("source_table")).distinct()
    resolved = resolve_producer(edges, "source_table", producers(columns), "source_model")
    return resolved.withColumn("source_kind", F.when(F.col("source_model").isNull(), F.lit(RAW_SOURCE))
                               .otherwise(F.lit("model")))


def lineage_closure(columns: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """G5 over all levels: ``model_name, source_table, depth, in_cycle`` of every raw source that a model reads, directly
    (depth 1) or through the models that produce its sources; ``depth`` is the least number of steps, ``in_cycle`` says
    whether the model is among its own upstream models.

    A frontier of (model, reached model) pairs moves one step a round by an equi-join with the edges; pairs that were met
    before are dropped, so cycles end, and every round is stored.  Rounds are as many as the longest way."""
    edges = store_once(lineage_edges(columns).select("model_name", "source_table", "source_model").distinct(), "lineage-edges")
    steps = edges.where("source_model IS NOT NULL").select(F.col("model_name").alias("at"), F.col("source_model").alias("next")).distinct()
    seen = store_once(edges.select("model_name", F.col("model_name").alias("at"), F.lit(0).alias("depth")).distinct(), "lineage")
    front = seen
    for _ in range(max_rounds):
        moved = front.join(steps, "at").select("model_name", F.col("next").alias("at"), (F.col("depth") + 1).alias("depth")).distinct()
        front = store_once(moved.join(seen, ["model_name", "at"], "left_anti"), "lineage")
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    else:
        raise RuntimeError(f"lineage goes on after {max_rounds} rounds")
    cyclic = seen.join(steps, "at").where(F.col("next") == F.col("model_name")).select("model_name").distinct().withColumn("in_cycle", F.lit(True))
    raw = edges.where("source_model IS NULL").select(F.col("model_name").alias("at"), "source_table").distinct()
    found = seen.join(raw, "at").groupBy("model_name", "source_table").agg((F.min("depth") + 1).alias("depth"))
    return found.join(cyclic, "model_name", "left").withColumn("in_cycle", F.coalesce("in_cycle", F.lit(False)))


# schema of the extracted column list inside a model answer
COLUMN_LIST_SCHEMA = "array<struct<table_name:string,column_name:string,source_table:string>>"


def normalize_answers(answers: DataFrame, text_col: str, model_col: str, load_time: Column) -> DataFrame:
    """G6 (+F15): JSON list out of free text → one row per entry, fields
    trimmed, entries without table or column name skipped, load time stamped."""
    parsed = answers.select(F.col(model_col).alias("model_name"),
                            F.from_json(json_span(text_col), COLUMN_LIST_SCHEMA).alias("items"))
    rows = parsed.select("model_name", F.explode("items").alias("it"))
    rows = rows.select("model_name", F.trim("it.table_name").alias("table_name"),
                       F.trim("it.column_name").alias("column_name"), F.trim("it.source_table").alias("source_table"))
    rows = rows.where((F.length("table_name") > 0) & (F.length("column_name") > 0))
    return rows.withColumn("dw_ins_time", load_time)


def select_project(columns: DataFrame, project: str | None) -> DataFrame:
    """Models of one project (name prefix), or all models when None."""
    return columns if not project else columns.where(F.col("model_name").startswith(project))


def dense_index(df: DataFrame, order: Sequence[str], out: str = "__idx") -> DataFrame:
    """1..N consecutive index in ``order`` without a single-task window.

    Range-partition on the order keys, store the rows with their partition once
    (a second range partitioning would sample other bounds), number rows inside
    each partition, and add the partition's offset from a per-partition count
    table (one row per partition, so broadcasting it is safe)."""
    ranged = store_once(df.repartitionByRange(*order).withColumn("__pid", F.spark_partition_id()), "dense-index")
    local = ranged.withColumn("__rn", F.row_number().over(Window.partitionBy("__pid").orderBy(*order)))
    counts = local.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (local.join(F.broadcast(offsets.select("__pid", "__off")), "__pid")
            .withColumn(out, F.col("__off") + F.col("__rn")).drop("__pid", "__rn", "__off"))


def surrogate_upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], id_col: str,
                     width: int = 6) -> DataFrame:
    """K6: incoming rows keep the id of their natural key; new keys get
    max(existing id) + their rank, zero-padded to ``width``.  Returns the rows
    to write (existing rows not touched ∪ incoming with ids)."""
    ids = existing.select(*keys, id_col).dropDuplicates(list(keys))
    top = existing.select(F.max(F.col(id_col).cast("bigint"))).scalar()
    matched = incoming.join(ids, list(keys), "left")
    known = matched.where(F.col(id_col).isNotNull())
    fresh = dense_index(matched.where(F.col(id_col).isNull()).drop(id_col), keys, "__new")
    fresh = fresh.withColumn(id_col, zero_pad(F.coalesce(top, F.lit(0)) + F.col("__new"), width)).drop("__new")
    untouched = existing.join(incoming.select(*keys).distinct(), list(keys), "left_anti")
    return untouched.unionByName(known).unionByName(fresh)
