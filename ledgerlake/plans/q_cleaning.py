"""Verified queries: projection and cleaning."""

from pyspark.sql import functions as F

from ledgerlake.functions import money as M
from ledgerlake.operators.cleanse import (
    blank_to_null, drop_blank_columns, drop_blank_rows, enforce_contract, normalize_names, project,
    rename_present, require_key, stringify_contract, tag_columns, write_typing,
)
from ledgerlake.plans.registry import query


@query("normalize_names", ["raw_text_sales"], """
SELECT row_key, supplier_name, order_type AS order_type__ FROM raw_text_sales""")
def normalize_names_q(t):
    """Strip / whitespace→'_' / lower on every header."""
    r = t["raw_text_sales"].select(F.col("row_key").alias("  Row Key"), F.col("supplier_name").alias("Supplier \t Name"),
                                   F.col("order_type").alias("ORDER TYPE _"))
    return normalize_names(r)


@query("rename_map", ["fact_sales"], """
SELECT l_orderkey, l_linenumber, all_qty AS quantity, revenue AS sales_amount FROM fact_sales""")
def rename_map_q(t):
    """Conditional rename (absent source names are ignored)."""
    f = t["fact_sales"].select("l_orderkey", "l_linenumber", "all_qty", "revenue")
    return rename_present(f, {"all_qty": "quantity", "revenue": "sales_amount", "Sales Qty": "qty"})


@query("enforce_contract", ["raw_text_sales"], """
SELECT row_key, period_text, amount_text, CAST(NULL AS VARCHAR) AS customer_name FROM raw_text_sales""")
def enforce_contract_q(t):
    """Exact output contract — missing columns NULL, extras dropped, order fixed."""
    return enforce_contract(t["raw_text_sales"], ["row_key", "period_text", "amount_text", "customer_name"])


@query("tag_columns", ["fact_sales"], """
SELECT l_orderkey, l_linenumber, 'ACCRAW' AS source_tag, 'weekly' AS freq FROM fact_sales""")
def tag_columns_q(t):
    """P5: constant / source tag columns."""
    return tag_columns(t["fact_sales"].select("l_orderkey", "l_linenumber"), {"source_tag": "ACCRAW", "freq": "weekly"})


@query("drop_blank_columns", ["raw_text_sales"], """
SELECT row_key, CASE WHEN trim(amount_text) <> '' THEN amount_text END AS amount_text, region FROM raw_text_sales""")
def drop_blank_columns_q(t):
    """Drop all-blank columns and 'Unnamed*' headers (one count pass)."""
    r = t["raw_text_sales"].select("row_key", "amount_text", "region",
                                   F.lit("  ").alias("blank_col"), F.col("supplier_name").alias("Unnamed: 4"))
    return drop_blank_columns(r)


@query("drop_blank_rows", ["raw_text_sales"], """
SELECT * FROM (
  SELECT CASE WHEN trim(amount_text) <> '' THEN amount_text END AS amount_text,
         CASE WHEN trim(region) <> '' THEN region END AS region,
         CASE WHEN trim(order_type) <> '' THEN order_type END AS order_type
  FROM raw_text_sales) q
WHERE amount_text IS NOT NULL OR region IS NOT NULL OR order_type IS NOT NULL""")
def drop_blank_rows_q(t):
    """Drop rows with no non-blank value."""
    return drop_blank_rows(t["raw_text_sales"].select("amount_text", "region", "order_type"))


@query("blank_to_null", ["raw_text_sales"], """
SELECT row_key, CASE WHEN trim(amount_text) <> '' THEN amount_text END AS amount_text, region FROM raw_text_sales""")
def blank_to_null_q(t):
    """Blank / whitespace-only text → NULL."""
    return blank_to_null(t["raw_text_sales"].select("row_key", "amount_text", "region"))


@query("require_key", ["raw_text_sales"], """
SELECT row_key, amount_text FROM raw_text_sales WHERE length(trim(amount_text)) > 0""")
def require_key_q(t):
    """Drop rows whose key is NULL or blank."""
    return require_key(t["raw_text_sales"].select("row_key", "amount_text"), "amount_text")


@query("arith_projection", ["fact_sales"], """
SELECT l_orderkey AS order_key, l_linenumber AS line_no,
  CAST(CAST(revenue AS DECIMAL(20,8)) * CAST(cn_rate AS DECIMAL(17,7)) AS DECIMAL(34,15)) AS credit_amount,
  CAST(revenue - CAST(all_qty AS DECIMAL(18,2)) AS DECIMAL(34,15)) AS revenue_less_qty
FROM fact_sales""")
def arith_projection_q(t):
    """Arithmetic projection aliased to contract names."""
    f = t["fact_sales"]
    return project(f, {
        "order_key": F.col("l_orderkey"), "line_no": F.col("l_linenumber"),
        "credit_amount": M.mul("revenue", "cn_rate"),
        "revenue_less_qty": (F.col("revenue") - F.col("all_qty").cast("decimal(18,2)")).cast(M.MONEY),
    })


@query("write_typing", ["part_attr"], """
SELECT p_partkey, CAST(part_number AS VARCHAR) AS part_number, CAST(p_retailprice AS DECIMAL(38,15)) AS p_retailprice,
  CAST(p_size AS VARCHAR) AS p_size, item_desc
FROM part_attr JOIN part ON part.p_partkey = part_attr.p_partkey""".replace("SELECT p_partkey", "SELECT part.p_partkey"))
def write_typing_q(t):
    """K8: forced-string columns, then every float → DECIMAL(38,15)."""
    a = t["part_attr"].select("p_partkey", "part_number", "item_desc")
    p = t["part"].select("p_partkey", "p_retailprice", "p_size")
    df = a.join(p, "p_partkey").select("p_partkey", "part_number", "p_retailprice", "p_size", "item_desc")
    return write_typing(df, force_string=["p_size"], force_unicode=["part_number"])


@query("stringify_contract", ["fact_sales"], """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(period AS VARCHAR) AS period,
  CAST(all_qty AS VARCHAR) AS all_qty, CAST(revenue AS VARCHAR) AS revenue, CAST(NULL AS VARCHAR) AS remark
FROM fact_sales""")
def stringify_contract_q(t):
    """K9: contract columns as text in fixed order."""
    return stringify_contract(t["fact_sales"], ["l_orderkey", "period", "all_qty", "revenue", "remark"])
