"""Verified queries for sources and sinks with side effects.

Each writes data derived from the driver tables into a fresh folder under the
session's checkpoint directory (the cluster's shared folder), reads it back
through the library's reader, and returns the read-back rows — which the
DuckDB twin reproduces from the same adapter views.
"""

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.operators import writers as K
from ledgerlake.operators.cleanse import dedupe_columns
from ledgerlake.plans.registry import query
from ledgerlake.session import ensure_checkpoint_dir
from ledgerlake.sources import files as FS
from ledgerlake.sources.snapshot import latest_snapshot, read_self_snapshot
from ledgerlake.streaming.arrival import process_arrivals, process_new_contents, replace_batch


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, inside the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerlake-io/{name}-{uuid.uuid4().hex}"


@query("dedupe_columns", ["raw_text_sales"], """SELECT row_key, region FROM raw_text_sales""")
def dedupe_columns_q(t):
    """Duplicate column names — the first one is kept."""
    r = t["raw_text_sales"].select("row_key", "region", "bill_to").toDF("row_key", "region", "region")
    return dedupe_columns(r)


@query("partition_replace", ["order_snapshots"], """
SELECT o_orderkey, o_custkey, period, amount, ds FROM order_snapshots""")
def partition_replace_q(t):
    """K1: write every snapshot, then re-run the newest day: the re-run replaces
    only its own partition (idempotent), older days are untouched."""
    path = scratch(t.spark, "partition_replace")
    snaps = t["order_snapshots"]
    K.partition_replace(snaps, path)
    K.partition_replace(latest_snapshot(snaps), path)
    # the written schema pins ds to text even where partition-type inference is on
    return t.spark.read.schema(snaps.schema).parquet(path).select("o_orderkey", "o_custkey", "period", "amount", "ds")


@query("self_snapshot", ["order_snapshots"], """
SELECT o_orderkey, period, CAST(amount + 1 AS DECIMAL(18,2)) AS amount, '20240401' AS ds FROM order_snapshots
WHERE ds = (SELECT max(ds) FROM order_snapshots)""")
def self_snapshot_q(t):
    """A model reads its own latest stored snapshot and writes the next day
    into the same table (dynamic partition overwrite makes the self-read safe)."""
    path = scratch(t.spark, "self_snapshot")
    first = t["order_snapshots"].select("o_orderkey", "period", "amount", "ds")
    K.partition_replace(first, path)
    prev = read_self_snapshot(t.spark, path, schema=first.schema)
    nxt = prev.select("o_orderkey", "period", (F.col("amount") + 1).cast("decimal(18,2)").alias("amount"),
                      F.lit("20240401").alias("ds"))
    K.partition_replace(nxt, path)
    return latest_snapshot(t.spark.read.schema(first.schema).parquet(path)).select("o_orderkey", "period", "amount", "ds")


@query("full_replace", [], """
SELECT c_custkey, upper(c_mktsegment) AS segment FROM customer""")
def full_replace_q(t):
    """K4: whole-table replace through a staged folder swap."""
    path = scratch(t.spark, "full_replace")
    c = t["customer"]
    K.full_replace(c.select("c_custkey", F.col("c_mktsegment").alias("segment")), path)
    K.full_replace(c.select("c_custkey", F.upper("c_mktsegment").alias("segment")), path)
    return t.spark.read.parquet(path)


@query("schema_drift", ["part_attr"], """
SELECT p_partkey, part_number, model_name, cpu, item_desc, price, item_no, ag_no FROM part_attr""")
def schema_drift_q(t):
    """K5: a frame with a different column set moves the stored table aside as a
    backup; the backup keeps every stored row."""
    spark = t.spark
    path = scratch(spark, "schema_drift")
    K.full_replace(t["part_attr"], path)
    status = K.schema_drift(spark, t["part_attr"].drop("ag_no").withColumn("segment", F.lit("x")), path)
    assert status["status"] == "drift" and status["missing"] == ["ag_no"] and status["extra"] == ["segment"]
    return spark.read.parquet(status["backup"])


_RAW_COLS = ["amount_text", "period_text", "supplier_name", "order_type", "bill_to", "region", "row_key"]


@query("csv_string_scan", ["raw_text_sales"], "SELECT " + ", ".join(
    f"coalesce({c}, '') AS {c}" for c in _RAW_COLS) + " FROM raw_text_sales")
def csv_string_scan_q(t):
    """All-string delimited files (header, quotes, escapes; 'NA' stays text)."""
    path = scratch(t.spark, "csv")
    (t["raw_text_sales"].select(*_RAW_COLS).write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).option("escape", "\\").csv(path))
    return FS.read_string_csv(t.spark, path, _RAW_COLS)


@query("filename_routing", ["fact_sales"], """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
  CAST(revenue AS VARCHAR) AS revenue, CASE WHEN product_line_id = 'NV' THEN 'opp' ELSE 'pac' END AS target_table,
  product_line_id AS name_literal FROM fact_sales""")
def filename_routing_q(t):
    """Files routed to a target table by their name; a literal parsed from the
    name suffix and upper-cased."""
    path = scratch(t.spark, "routing")
    f = t["fact_sales"]
    sheet = F.concat(F.when(F.col("product_line_id") == "NV", F.lit("opp_")).otherwise(F.lit("pac_")),
                     F.lower("product_line_id"))
    f.select("l_orderkey", "l_linenumber", "revenue", sheet.alias("sheet")).write.option("header", True) \
        .partitionBy("sheet").csv(path)
    routed = FS.route_by_filename(t.spark, path, {r"/sheet=pac_[^/]*/": "pac", r"/sheet=opp_[^/]*/": "opp"},
                                  r"/sheet=[a-z]+_([a-z]+)/")
    return routed.select("l_orderkey", "l_linenumber", "revenue", "target_table", "name_literal")


@query("file_arrival_stream", ["fact_sales"], """
SELECT l_orderkey, l_linenumber, period, revenue FROM fact_sales""")
def file_arrival_stream_q(t):
    """Files arrive in two drops; each drop is processed exactly once by a
    checkpointed available-now stream feeding the batch writer."""
    spark = t.spark
    land, out = scratch(spark, "landing"), scratch(spark, "arrivals-out")
    rows = t["fact_sales"].select("l_orderkey", "l_linenumber", "period", "revenue")
    schema = StructType.fromDDL("l_orderkey bigint, l_linenumber int, period string, revenue decimal(18,2)")

    handle = replace_batch(out)
    rows.where(F.col("period") < "1998").write.parquet(f"{land}/drop1")
    process_arrivals(spark, f"{land}/*", schema, handle, "fact", fmt="parquet", options={},
                     checkpoint=f"{land}-ckpt")
    rows.where(F.col("period") >= "1998").write.parquet(f"{land}/drop2")
    process_arrivals(spark, f"{land}/*", schema, handle, "fact", fmt="parquet", options={},
                     checkpoint=f"{land}-ckpt")
    return spark.read.parquet(out).drop("batch_id")


@query("matrix_sheet", ["fact_sales"], """
SELECT period, CAST(count(*) AS VARCHAR) AS lines, CAST(count(DISTINCT l_orderkey) AS VARCHAR) AS orders, 'RATES' AS label
FROM fact_sales GROUP BY period""")
def matrix_sheet_q(t):
    """A sheet with a label line and a header line, read back by place."""
    path = scratch(t.spark, "matrix")
    body = t["fact_sales"].groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("o"))
    lines = body.select(F.concat_ws(",", F.lit("1"), "period").alias("k"), F.concat_ws(",", "period", "n", "o").alias("value"))
    head = t.spark.createDataFrame([("0a", "RATES,,"), ("0b", "month,lines,orders")], "k string, value string")
    head.unionByName(lines).coalesce(1).sortWithinPartitions("k").select("value").write.text(path)
    return FS.read_matrix_sheet(t.spark, path)


_SHEETS = {"NB": ["lines", "orders"], "NR": ["orders"], "NV": ["qty", "lines", "orders"]}


@query("matrix_folder", ["fact_sales"], """
WITH m AS (SELECT product_line_id, substr(period, 1, 4) AS year, period, CAST(count(*) AS VARCHAR) AS lines,
  CAST(count(DISTINCT l_orderkey) AS VARCHAR) AS orders, CAST(CAST(sum(all_qty) AS DECIMAL(38,2)) AS VARCHAR) AS qty FROM fact_sales GROUP BY ALL)
""" + " UNION ALL ".join(
    f"SELECT '{line}, \"' || year || '\"' AS label, period, '{c}' AS column_name, {c} AS value FROM m WHERE product_line_id = '{line}'"
    for line, columns in _SHEETS.items() for c in columns))
def matrix_folder_q(t):
    """S9 by the folder: a sheet per product line and year, of three widths, each with its own label and header."""
    path = scratch(t.spark, "sheets")
    m = t["fact_sales"].groupBy("product_line_id", F.substring("period", 1, 4).alias("year"), "period").agg(
        F.count(F.lit(1)).cast("string").alias("lines"), F.count_distinct("l_orderkey").cast("string").alias("orders"),
        F.sum("all_qty").cast("decimal(38,2)").cast("string").alias("qty"))
    line = F.coalesce(*[F.when(F.col("product_line_id") == k, F.concat_ws(",", "period", *c)) for k, c in _SHEETS.items()])
    head = F.coalesce(*[F.when(F.col("product_line_id") == k, F.concat(F.lit(f'"{k}, ""'), F.col("year"), F.lit('"""\nmonth,' + ",".join(c))))
                        for k, c in _SHEETS.items()])
    sheets = m.groupBy("product_line_id", "year").agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("body"))  # 12 lines a sheet
    sheets.select(F.concat(head, F.lit("\n"), F.col("body")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return FS.read_matrix_folder(t.spark, path).drop("file")


@query("source_corpus", ["fact_sales"], """
SELECT product_line_id AS folder, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(length(branch) + 1) AS BIGINT) AS n_chars
FROM fact_sales WHERE branch IS NOT NULL GROUP BY product_line_id""")
def source_corpus_q(t):
    """Whole text files found recursively by extension; lines and characters of each folder."""
    path = scratch(t.spark, "corpus")
    t["fact_sales"].where("branch IS NOT NULL").select("branch", F.col("product_line_id").alias("folder")) \
        .write.option("maxRecordsPerFile", 20_000).partitionBy("folder").text(path)
    found = FS.source_corpus(t.spark, path, "*.txt")
    return found.select(F.regexp_extract("path", r"/folder=([^/]*)/", 1).alias("folder"), "text").groupBy("folder").agg(
        F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).cast("bigint").alias("n_lines"),
        F.sum(F.length("text")).cast("bigint").alias("n_chars"))


# Rows of a file of a drop: a task holds the bytes of a whole file while it hashes them, so files must not grow with the table.
ROWS_A_FILE = 250_000


@query("file_arrival_contents", ["fact_sales"], """
SELECT l_orderkey, l_linenumber, period, revenue FROM fact_sales""")
def file_arrival_contents_q(t):
    """S12 by content: the first drop's files come again under other names with the second drop; every row is loaded once."""
    spark = t.spark
    land, out, state = (scratch(spark, n) for n in ("landing", "contents-out", "contents-state"))
    rows = t["fact_sales"].select("l_orderkey", "l_linenumber", "period", "revenue")
    schema = StructType.fromDDL("l_orderkey bigint, l_linenumber int, period string, revenue decimal(18,2)")
    name = f"contents-{uuid.uuid4().hex}"
    drops = [rows.where("l_linenumber <= 2"), rows.where("l_linenumber > 2")]
    files = [max(4, -(-drop.count() // ROWS_A_FILE)) for drop in drops]
    for k, drop in enumerate(drops):
        for again, n in [*zip(drops[:k], files), (drop, files[k])]:  # hash-dealt and sorted, so that a second write gives the same bytes
            (again.repartition(n, "l_orderkey").sortWithinPartitions(*again.columns)
             .write.mode("append").option("header", True).csv(land))
        process_new_contents(spark, land, schema, replace_batch(out), f"{name}-{k}", checkpoint=state)
    return spark.read.parquet(out).select("l_orderkey", "l_linenumber", "period", "revenue")
