"""Verified queries: scans and sources."""

from pyspark.sql import functions as F

from ledgerlake.operators.cleanse import normalize_names
from ledgerlake.operators.setops import union_all
from ledgerlake.plans.registry import query
from ledgerlake.sources.snapshot import anchor_value, latest_period, latest_snapshot, month_aligned_snapshot


@query("latest_snapshot", ["order_snapshots"], """
SELECT o_orderkey, o_custkey, period, amount, ds FROM order_snapshots
WHERE ds = (SELECT max(ds) FROM order_snapshots)""")
def latest_snapshot_q(t):
    """Newest daily snapshot of the order table."""
    return latest_snapshot(t["order_snapshots"])


@query("latest_period", ["order_snapshots"], """
WITH s AS (SELECT * FROM order_snapshots WHERE ds = (SELECT max(ds) FROM order_snapshots))
SELECT o_orderkey, o_custkey, period, amount, ds FROM s WHERE period = (SELECT max(period) FROM s)""")
def latest_period_q(t):
    """Latest period inside the latest snapshot."""
    return latest_period(t["order_snapshots"])


@query("month_aligned_snapshot", ["order_snapshots"], """
WITH m AS (SELECT substr(ds, 1, 6) AS month, max(ds) AS ds FROM order_snapshots GROUP BY substr(ds, 1, 6))
SELECT m.month AS month, s.ds AS ds, count(*) AS n_rows, CAST(sum(s.amount) AS DECIMAL(38,2)) AS total
FROM order_snapshots s JOIN m ON s.ds = m.ds GROUP BY m.month, s.ds""")
def month_aligned_snapshot_q(t):
    """S3: per snapshot month, the newest snapshot taken in that month."""
    snaps = t["order_snapshots"]
    months = snaps.select(F.substring("ds", 1, 6).alias("period"))
    rows = month_aligned_snapshot(snaps, months)
    return (rows.groupBy(F.col("__month").alias("month"), "ds")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("amount").cast("decimal(38,2)").alias("total")))


@query("anchor_period", ["order_snapshots"], """
WITH s AS (SELECT * FROM order_snapshots WHERE ds = (SELECT max(ds) FROM order_snapshots))
SELECT (SELECT max(period) FROM s) AS anchor_period, count(*) AS n_rows
FROM s WHERE period = (SELECT max(period) FROM s)""")
def anchor_period_q(t):
    """The single-valued anchor period, and the row count it selects."""
    snap = latest_snapshot(t["order_snapshots"])
    anchor = anchor_value(snap, "period")
    return snap.where(F.col("period") == anchor).agg(
        F.max("period").alias("anchor_period"), F.count(F.lit(1)).alias("n_rows"))


def _sheet(df, product_line, cols):
    return df.where(F.col("product_line_id") == product_line).select(*cols)


@query("tagged_union", ["fact_sales"], """
SELECT l_orderkey AS order_key, l_linenumber AS line_no, revenue, CAST(NULL AS DECIMAL(12,2)) AS quantity, 'NB' AS sheet
FROM fact_sales WHERE product_line_id = 'NB'
UNION ALL
SELECT l_orderkey, l_linenumber, CAST(NULL AS DECIMAL(18,2)), all_qty, 'NR' FROM fact_sales WHERE product_line_id = 'NR'
UNION ALL
SELECT l_orderkey, l_linenumber, revenue, all_qty, 'NV' FROM fact_sales WHERE product_line_id = 'NV'""")
def tagged_union_q(t):
    """Three 'sheets' with different headers → tag column + names
    normalised + union by name (missing columns NULL)."""
    f = t["fact_sales"]
    nb = _sheet(f, "NB", [F.col("l_orderkey").alias(" Order Key"), F.col("l_linenumber").alias("Line  No"),
                          F.col("revenue").alias("Revenue ")])
    nr = _sheet(f, "NR", [F.col("l_orderkey").alias("Order Key"), F.col("l_linenumber").alias("Line No"),
                          F.col("all_qty").alias("QUANTITY")])
    nv = _sheet(f, "NV", [F.col("l_orderkey").alias("Order Key"), F.col("l_linenumber").alias("Line No"),
                          F.col("revenue").alias("Revenue"), F.col("all_qty").alias("Quantity")])
    sheets = [normalize_names(s).withColumn("sheet", F.lit(tag)) for s, tag in ((nb, "NB"), (nr, "NR"), (nv, "NV"))]
    return union_all(sheets)


@query("table_read_clean", [], """
SELECT c_custkey AS cust_key, c_name AS cust_name, c_mktsegment AS market_segment FROM customer""")
def table_read_clean_q(t):
    """Whole-table read with header clean-up."""
    c = t["customer"].select(F.col("c_custkey").alias(" Cust Key "), F.col("c_name").alias("Cust\tName"),
                             F.col("c_mktsegment").alias("Market   Segment"))
    return normalize_names(c)
