"""Mart-shaped views derived from the driver tables.

The reference's domain tables (sales facts, FX rates, cost tables, price quotes,
lineage rows ...) are not shipped, so each one is derived deterministically from
the driver's TPC-H-like tables.  Every view is one SQL template that is valid
in Spark SQL *and* DuckDB: Spark runs it with DataFrame parameters
(``spark.sql(text, lineitem=df)``), the DuckDB oracle inlines it as a CTE.
Both engines therefore start from identical rows.

Scale notes: the period-fan-out views join a part to the months whose number
satisfies a residue rule.  They are written as equi-joins on the residue
(``p % m = (m - k % m) % m``) rather than a filtered cross join, so Spark plans
a hash join against the (calendar-bounded) month set instead of a nested loop.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators.lookup import shuffled
from ledgerlake.session import MART_SQL_CONF, ensure_checkpoint_dir

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# fixed values: the all-text contract of the accumulators
ACCUM_CONTRACT = [
    "source", "product_line_id", "year", "quarter", "month", "period", "sold_to_customer", "customer", "order_type", "business_type",
    "product_type", "distribution", "distribution_type", "territory", "territory2", "branch", "branch2", "country_id",
    "country_chinese", "ou", "warranty", "csid", "part_number", "description", "all_qty", "revenue_usd_hedge_rate", "revenue_fxdiff",
    "net_revenue_usd_agp", "net_revenue_fxdiff", "local_cogs_amount", "local_cogs_amount_fxdiff", "credit_note_hedge_rate",
    "credit_note_fxdiff", "total_ship_fee_company", "total_ship_fee_company_fxdiff", "cost_period", "funding", "csc_ratio",
    "csc_amt", "csc_amt_fxdiff", "ship_fee_hq", "total_ship_fee_hq", "total_ship_fee", "total_ship_fee_fxdiff", "hq_asc",
    "hq_asc_fxdiff", "cogs_amount", "cogs_amount_fxdiff", "opp_amount", "extra_rebate", "nv_sellout_rebate", "os_incentive",
    "local_gp", "local_gp_fxdiff", "hq_asp", "hq_asp_fxdiff", "hq_gp_unit", "hq_gp_unit_fxdiff", "hq_gp", "hq_gp_usd_fxdiff",
    "hq_rev", "hq_rev_usd_fxdiff", "gp_pod", "gp_pod_fxdiff", "gp_net", "gp_net_fxdiff", "model", "segment", "gpu", "cpu_vendor",
    "cpu_platform", "cpu_sku", "lcd_code", "cpu_n", "acc_segment", "revenue_rmb", "net_revenue_rmb", "local_cogs_amount_rmb",
    "credit_note_rmb", "total_ship_fee_rmb", "cogs_amount_rmb", "opp_amount_rmb", "extra_rebate_rmb", "nv_sellout_rebate_rmb",
    "funding_rmb", "os_incentive_rmb", "total_ship_fee_company_rmb", "csc_amt_rmb", "hq_gp_rmb", "gp_pod_rmb", "gp_net_rmb",
    "local_gp_rmb", "is_cte"]

_PL = "CASE {k} % 3 WHEN 0 THEN 'NB' WHEN 1 THEN 'NR' ELSE 'NV' END"
_PART_NUMBER = ("'90' || " + _PL + " || lpad(CAST({k} AS STRING), CAST(greatest(6, length(CAST({k} AS STRING))) AS INT), '0') || "
                "CASE WHEN {k} % 10 = 0 THEN '-A' ELSE '-M' END")
_SHIP_PERIOD = "CAST(year({d}) * 100 + month({d}) AS STRING)"


def _residue_join(mod: int) -> str:
    """Join condition equivalent to ``(a.p_partkey + CAST(m.period AS BIGINT)) % mod = 0``."""
    return f"a.p_partkey % {mod} = ({mod} - CAST(m.period AS BIGINT) % {mod}) % {mod}"


VIEWS: dict[str, str] = {
    "fact_sales": f"""
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_suppkey % 2 = 0 THEN 'ACCRAW' ELSE 'ACIRAW' END AS source,
  {_PL.format(k='l_partkey')} AS product_line_id,
  {_PART_NUMBER.format(k='l_partkey')} AS part_number,
  {_SHIP_PERIOD.format(d='l_shipdate')} AS period,
  CASE l_suppkey % 4 WHEN 0 THEN 'ACC' WHEN 1 THEN 'US-Retail' WHEN 2 THEN 'CA' ELSE 'Channel-SA' END AS branch,
  CASE l_linenumber % 3 WHEN 0 THEN 'REFURBISH' WHEN 1 THEN 'Retail' ELSE 'Channel' END AS business_type,
  CASE WHEN l_suppkey % 5 = 0 THEN 'US' WHEN l_suppkey % 5 = 1 THEN 'CA' ELSE 'SA' END AS country_code,
  l_linestatus AS distribution_type,
  CAST(CAST(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS DECIMAL(2,0))
       * CAST(l_quantity AS DECIMAL(10,2)) AS DECIMAL(12,2)) AS all_qty,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS revenue,
  CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE CAST(l_discount AS DECIMAL(6,4)) END AS cn_rate,
  CASE WHEN l_linenumber % 4 = 0 THEN 'newest' ELSE {_SHIP_PERIOD.format(d='l_shipdate')} END AS cost_period
FROM {{lineitem}}""",
    # the calendar of the facts
    "fact_months": "\nSELECT DISTINCT period FROM {fact_sales}",
    "part_attr": f"""
SELECT p_partkey,
  {_PART_NUMBER.format(k='p_partkey')} AS part_number,
  p_brand AS model_name, p_type AS cpu, upper(p_name) AS item_desc,
  CAST(p_retailprice AS DECIMAL(12,2)) AS price,
  lpad(CAST(p_partkey % 4 AS STRING), 2, '0') || lpad(CAST(p_partkey AS STRING), CAST(greatest(6, length(CAST(p_partkey AS STRING))) AS INT), '0') AS item_no,
  CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE 'AG' || CAST(p_partkey % 50 AS STRING) END AS ag_no
FROM {{part}}""",
    "fx_rates": """
SELECT pl AS product_line, p AS period,
  CASE WHEN k % 11 = 0 THEN CAST(0 AS DECIMAL(17,7)) ELSE CAST(6 + k % 10 * 0.05 AS DECIMAL(17,7)) END AS fx_rate,
  CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(7 + k % 9 * 0.05 AS DECIMAL(17,7)) END AS fx_rate_ex
FROM (SELECT DISTINCT product_line_id AS pl, period AS p, CAST(period AS BIGINT) AS k FROM {fact_sales}) q
WHERE k % 7 <> 0""",
    "cost_pn": f"""
SELECT a.part_number, a.model_name, a.cpu, m.period,
  CAST(a.price + CAST(m.period AS BIGINT) % 100 AS DECIMAL(20,8)) AS item_cost_usd
FROM {{part_attr}} a
JOIN {{fact_months}} m ON {_residue_join(17)}""",
    "cost_branch": f"""
SELECT m.branch AS sales_team, a.model_name, a.cpu, m.period,
  CAST(a.price AS DECIMAL(20,8)) AS item_cost_usd
FROM {{part_attr}} a
JOIN (SELECT DISTINCT period, branch FROM {{fact_sales}}) m ON {_residue_join(97)}""",
    "branch_freight": """
SELECT product_line_id AS product_line, lower(branch) AS sales_team, period,
  CAST(1 + CAST(period AS BIGINT) % 7 AS DECIMAL(10,4)) AS freight
FROM (SELECT DISTINCT product_line_id, branch, period FROM {fact_sales}) q
WHERE CAST(period AS BIGINT) % 5 <> 0""",
    "funding": f"""
SELECT ' ' || a.part_number || ' ' AS pn, m.period,
  CAST(a.p_partkey % 9 AS DECIMAL(10,4)) AS funding
FROM {{part_attr}} a
JOIN {{fact_months}} m ON {_residue_join(23)}""",
    # a + 1 is another product line, a + 6 the same; they are disjoint, so the OR-join is a UNION ALL of two equi-joins
    "bom": """
SELECT a.item_no AS part_number_kp, b.part_number AS part_number_90,
  CAST(1 + a.p_partkey % 3 AS DECIMAL(10,2)) AS kp_qty,
  CASE WHEN a.p_partkey % 8 = 0 THEN 'S' ELSE 'M' END AS substitute_type
FROM {part_attr} a JOIN {part_attr} b ON b.p_partkey = a.p_partkey + 1
UNION ALL
SELECT a.item_no AS part_number_kp, b.part_number AS part_number_90,
  CAST(1 + a.p_partkey % 3 AS DECIMAL(10,2)) AS kp_qty,
  CASE WHEN a.p_partkey % 8 = 0 THEN 'S' ELSE 'M' END AS substitute_type
FROM {part_attr} a JOIN {part_attr} b ON b.p_partkey = a.p_partkey + 6""",
    "quotes": f"""
SELECT a.item_no, a.ag_no, a.item_desc,
  CASE l.l_partkey % 3 WHEN 0 THEN 'nb' WHEN 1 THEN 'nr' ELSE 'nv' END AS product_no,
  {_SHIP_PERIOD.format(d='l.l_shipdate')} AS group_no,
  CAST(l.l_extendedprice AS STRING) AS po_price_text,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS po_price,
  CASE WHEN l.l_returnflag = 'A' THEN 'B' ELSE 'C' END AS buying_mode
FROM {{lineitem}} l JOIN {{part_attr}} a ON l.l_partkey = a.p_partkey""",
    # cost period per part and version (a sheet: blanks around the keys, some cells empty)
    "cost_range": f"""
SELECT ' ' || a.part_number AS pn, m.period || ' ' AS version,
  CASE a.p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '199601' ELSE m.period END AS cost_range
FROM {{part_attr}} a
JOIN {{fact_months}} m ON {_residue_join(3)}""",
    "cn_rates": """
SELECT source, product_line, legal_entity, channel_code, period,
  CAST(CAST(period AS BIGINT) % 10 * 0.01 + length(channel_code) * 0.001 AS DECIMAL(8,4)) AS cn
FROM (SELECT DISTINCT source, product_line_id AS product_line,
    CASE WHEN source = 'ACCRAW' THEN 'OU1' ELSE country_code END AS legal_entity,
    CASE WHEN source = 'ACCRAW' THEN distribution_type WHEN country_code = 'CA' THEN 'Walmart-CA'
         WHEN country_code <> 'US' THEN 'Other Channel 1' WHEN branch = 'US-Retail' THEN 'ACI-Retail' ELSE branch END AS channel_code,
    period FROM {fact_sales}) q""",
    # one branch per snapshot day (o_orderkey % 3 <= d % 3) instead of a cross join
    "order_snapshots": "\nUNION ALL\n".join(
        f"""SELECT o_orderkey, o_custkey, {_SHIP_PERIOD.format(d='o_orderdate')} AS period,
  CAST(o_totalprice AS DECIMAL(18,2)) AS amount, '{d}' AS ds
FROM {{orders}} WHERE o_orderkey % 3 <= {d} % 3"""
        for d in (20240131, 20240229, 20240331)),
    "price_history": f"""
SELECT {_PL.format(k='a.p_partkey')} AS product_line, a.item_no, a.ag_no, m.period,
  CAST(a.price AS DECIMAL(20,8)) AS equo_price,
  CASE WHEN a.p_partkey % 4 = 0 THEN NULL ELSE CAST(a.price + 1 AS DECIMAL(20,8)) END AS cogs_price,
  '20240131' AS ds
FROM {{part_attr}} a
JOIN (SELECT period FROM {{fact_months}}
  WHERE period < (SELECT CAST(CAST(max(period) AS BIGINT) - 200 AS STRING) FROM {{fact_months}})) m ON {_residue_join(5)}""",
    "raw_text_sales": """
SELECT
  CASE WHEN l.l_linenumber % 4 = 0 THEN '  '
       WHEN l.l_linenumber % 4 = 1 THEN '1,' || lpad(CAST(l.l_partkey % 1000 AS STRING), 3, '0') || '.50'
       WHEN l.l_linenumber % 4 = 2 THEN 'n/a'
       ELSE CAST(l.l_partkey AS STRING) END AS amount_text,
  CASE WHEN l.l_linenumber % 2 = 0
       THEN CAST(year(l.l_shipdate) AS STRING) || '-' || lpad(CAST(month(l.l_shipdate) AS STRING), 2, '0')
       ELSE CAST(year(l.l_shipdate) AS STRING) END AS period_text,
  s.s_name AS supplier_name,
  CASE l.l_linenumber % 5 WHEN 0 THEN 'Order RETURN' WHEN 1 THEN 'Discount x' WHEN 2 THEN NULL ELSE 'Standard' END AS order_type,
  CASE l.l_linenumber % 3 WHEN 0 THEN 'abc-btc1' WHEN 1 THEN 'abc-3C' ELSE 'abc-xx' END AS bill_to,
  CASE l.l_suppkey % 4 WHEN 0 THEN 'NA' WHEN 1 THEN 'SA' WHEN 2 THEN ' eu ' ELSE NULL END AS region,
  CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) AS row_key
FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey""",
    "columnlist": """
SELECT lpad(CAST(p.p_partkey AS STRING), CAST(greatest(6, length(CAST(p.p_partkey AS STRING))) AS INT), '0') AS column_id,
  'col_' || CAST(p.p_partkey AS STRING) AS column_name,
  'tbl_' || CAST(p.p_partkey % 60 AS STRING) AS table_name,
  'model_' || CAST(p.p_partkey % 60 % 20 AS STRING) AS model_name,
  CASE p.p_partkey % 4 WHEN 0 THEN 'ods.tbl_' || CAST(p.p_partkey % 59 AS STRING)
       WHEN 1 THEN 'tbl_' || CAST(p.p_partkey % 58 AS STRING) || ', tbl_' || CAST(p.p_partkey % 57 AS STRING)
       WHEN 2 THEN 'raw.' || n.n_name ELSE '' END AS source_table
FROM {part} p JOIN {nation} n ON p.p_partkey % 25 = n.n_nationkey""",
}

# Mart sources of the price-gap chain (D13-D21), same derivation rules.
_PARENT_PL = "CASE (a.p_partkey + 1) % 3 WHEN 0 THEN 'NB' WHEN 1 THEN 'NR' ELSE 'NV' END"
VIEWS.update({
    # item-code → key-part category lookup ('03' codes are absent on purpose)
    "item_code": """
SELECT DISTINCT substr(item_no, 1, 2) AS item_code,
  CASE substr(item_no, 1, 2) WHEN '00' THEN 'LCD' WHEN '01' THEN 'BATT' ELSE 'DDR' END AS category
FROM {part_attr} WHERE substr(item_no, 1, 2) <> '03'""",
    # financial key-part report (text amounts, one snapshot)
    "keypart_report": """
SELECT f.product_line_id AS product_line, coalesce(ic.category, 'SSD') AS category, a.ag_no, a.item_no,
  f.period AS gl_yearmonth, CAST(f.revenue AS STRING) AS net_sale_amount,
  CAST(a.price AS STRING) AS material_cost, CAST(f.all_qty AS STRING) AS quantity, '20240131' AS ds
FROM {fact_sales} f JOIN {part_attr} a ON f.l_partkey = a.p_partkey
LEFT JOIN {item_code} ic ON substr(a.item_no, 1, 2) = ic.item_code""",
    # the key-part gap model's own stored output (one row per key and period)
    "keypart_history": """
SELECT h.product_line, coalesce(ic.category, 'SSD') AS category, h.ag_no, h.period,
  CAST(sum(h.equo_price) AS DOUBLE) / NULLIF(CAST(count(h.equo_price) AS DOUBLE), 0) AS equo_price,
  CAST(sum(h.cogs_price) AS DOUBLE) / NULLIF(CAST(count(h.cogs_price) AS DOUBLE), 0) AS cogs_price,
  '20240131' AS ds
FROM {price_history} h LEFT JOIN {item_code} ic ON substr(h.item_no, 1, 2) = ic.item_code
GROUP BY h.product_line, coalesce(ic.category, 'SSD'), h.ag_no, h.period""",
    # the CPU/GPU gap model's own stored output
    "cpugpu_history": """
SELECT product_line, CASE WHEN item_no LIKE '02135%' OR item_no LIKE '01%' THEN 'CPU' WHEN item_no LIKE '02%' THEN 'C.S' END AS category,
  item_no, period, CAST(equo_price AS DOUBLE) AS equo_price, CAST(cogs_price AS DOUBLE) AS cogs_price,
  CASE WHEN item_no LIKE '%3' THEN NULL ELSE CAST(equo_price AS DOUBLE) + 0.5e0 END AS pac, ds
FROM {price_history}""",
    # standard prices per item and month
    "pac_src": f"""
SELECT {_PL.format(k='a.p_partkey')} AS product_line, a.item_no AS pn, m.period,
  CAST(a.price + a.p_partkey % 5 AS DECIMAL(20,8)) AS pac, '20240131' AS ds
FROM {{part_attr}} a
JOIN {{fact_months}} m ON {_residue_join(3)}""",
    # finished-part attribute result (product line from the part number)
    "keypart_result": """
SELECT substr(part_number, 3, 2) AS product_line, part_number, upper(cpu) AS cpu, model_name, '20240131' AS ds
FROM {part_attr}""",
    "extra_rebate_src": f"""
SELECT a.item_no, {_PARENT_PL} AS product_line, upper(a.cpu) AS cpu,
  CAST(a.p_partkey % 7 AS DECIMAL(10,4)) AS extra_rebate, m.period, '20240131' AS ds
FROM {{part_attr}} a
JOIN {{fact_months}} m ON {_residue_join(31)}""",
    "sellout_src": f"""
SELECT a.item_no, {_PARENT_PL} AS product_line, a.model_name AS product_number,
  CAST(a.p_partkey % 5 + 1 AS DECIMAL(10,4)) AS reb, m.period, '20240131' AS ds
FROM {{part_attr}} a
JOIN {{fact_months}} m ON {_residue_join(29)}""",
    "opp_rebate": f"""
SELECT a.part_number AS sku90pn, substr(a.part_number, 3, 2) AS product_line, m.period,
  CAST(a.p_partkey % 4 AS DECIMAL(10,4)) AS opp_rebate, '20240131' AS ds
FROM {{part_attr}} a
JOIN {{fact_months}} m ON {_residue_join(37)}""",
    "os_incentive": f"""
SELECT a.part_number AS os_part_number, m.period, CAST(1 + a.p_partkey % 3 AS DECIMAL(10,4)) AS inc,
  '20240131' AS ds
FROM {{part_attr}} a
JOIN {{fact_months}} m ON {_residue_join(41)}""",
})

# The stored combined fact with the columns that the enrichment reads (D10, D23), and its lookup tables.
VIEWS.update({
    "sales_detail": f"""
SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, f.source, f.product_line_id, f.part_number, f.period,
  substr(f.period, 1, 4) AS year, substr(f.period, 5, 2) AS month,
  CASE WHEN substr(f.period, 5, 2) <= '03' THEN 'Q1' WHEN substr(f.period, 5, 2) <= '06' THEN 'Q2'
       WHEN substr(f.period, 5, 2) <= '09' THEN 'Q3' ELSE 'Q4' END AS quarter,
  CASE WHEN f.source = 'ACIRAW' THEN CASE f.l_partkey % 6 WHEN 0 THEN 'WALMART INC' WHEN 1 THEN 'Best Buy 12'
       WHEN 2 THEN 'sams club west' WHEN 3 THEN NULL ELSE 'Shop ' || CAST(f.l_partkey % 40 AS STRING) END END AS sold_to_customer,
  CASE f.l_linenumber % 4 WHEN 0 THEN 'Standard' WHEN 1 THEN 'OT-1' WHEN 2 THEN 'CSC' ELSE NULL END AS order_type,
  f.business_type, CASE WHEN f.source = 'ACCRAW' THEN 'PT' || CAST(f.l_partkey % 5 AS STRING) END AS product_type,
  CASE WHEN f.source = 'ACCRAW' THEN CASE f.distribution_type WHEN 'O' THEN 'Distribution' ELSE 'Direct' END END AS distribution,
  f.distribution_type, CASE WHEN f.source = 'ACCRAW' THEN 'ACC' WHEN f.country_code = 'SA' THEN 'LATAM' ELSE 'ACI' END AS territory,
  CASE WHEN f.source = 'ACCRAW' THEN 'ACC' WHEN f.country_code = 'SA' THEN 'LATAM' ELSE 'NA' END AS territory2,
  CASE WHEN f.source = 'ACCRAW' THEN 'ACC' ELSE f.branch END AS branch,
  CASE WHEN f.source = 'ACCRAW' THEN 'CN' ELSE f.country_code END AS country_id,
  CASE WHEN f.source = 'ACCRAW' THEN '中國大陸' ELSE 'zh-' || lower(f.country_code) END AS country_chinese, f.country_code,
  CASE WHEN f.source = 'ACCRAW' THEN 'OU' || CAST(f.l_orderkey % 3 + 1 AS STRING) END AS ou,
  CASE WHEN f.source = 'ACCRAW' THEN CASE WHEN f.l_linenumber % 2 = 0 THEN '12' ELSE '24' END END AS warranty,
  CASE WHEN f.source = 'ACCRAW' THEN 'CS' || CAST(f.l_orderkey % 50 AS STRING) END AS csid,
  'part ' || f.part_number AS description, f.all_qty, f.revenue, f.cn_rate,
  CAST(f.revenue * CAST(f.cn_rate AS DECIMAL(6,4)) AS DECIMAL(20,4)) AS sheet_credit_note,
  CAST(f.revenue * CAST(0.7 AS DECIMAL(2,1)) AS DECIMAL(20,3)) AS local_cogs,
  CASE WHEN f.source = 'ACIRAW' THEN CAST(f.l_partkey % 4 * 0.01 AS DECIMAL(6,4)) END AS sheet_csc_ratio,
  CASE WHEN f.source = 'ACIRAW' THEN CAST(f.revenue * CAST(0.02 AS DECIMAL(3,2)) AS DECIMAL(20,4)) END AS sheet_csc_amt
FROM {{fact_sales}} f""",
    # finished-part attributes, two snapshots
    "keypart_gp": """
SELECT part_number, model_name, 'SEG' || CAST(p_partkey % 3 AS STRING) AS segmentation, 'GPU' || CAST(p_partkey % 5 AS STRING) AS gpu,
  CASE WHEN p_partkey % 2 = 0 THEN 'V1' ELSE 'V2' END AS cpu_vendor, 'PF' || CAST(p_partkey % 6 AS STRING) AS cpu_platform, cpu,
  'LCD' || CAST(p_partkey % 4 AS STRING) AS lcd_code, substr(cpu, 1, 6) AS cpu_n, 'A' || CAST(p_partkey % 7 AS STRING) AS acc_segment,
  CASE WHEN p_partkey % 9 = 0 THEN 'Y' ELSE 'N' END AS cte, '20240131' AS ds
FROM {part_attr} WHERE p_partkey % 25 <> 0
UNION ALL
SELECT part_number, 'old' AS model_name, 'SEG9' AS segmentation, NULL AS gpu, 'V9' AS cpu_vendor, 'PF9' AS cpu_platform, cpu,
  'LCD9' AS lcd_code, 'x' AS cpu_n, 'A9' AS acc_segment, 'N' AS cte, '20240130' AS ds
FROM {part_attr}""",
    # the second set of cost tables, the USD source's own costs, the simulation rows
    "cost_pn_ex": f"""
SELECT a.part_number, a.model_name, a.cpu, m.period, CAST(a.price + 1 + CAST(m.period AS BIGINT) % 50 AS DECIMAL(20,8)) AS item_cost_usd
FROM {{part_attr}} a JOIN {{fact_months}} m ON {_residue_join(23)}""",
    "cost_branch_ex": f"""
SELECT m.branch AS sales_team, a.model_name, a.cpu, m.period, CAST(a.price + 2 AS DECIMAL(20,8)) AS item_cost_usd
FROM {{part_attr}} a JOIN (SELECT DISTINCT period, branch FROM {{fact_sales}}) m ON {_residue_join(89)}""",
    "aci_cost": f"""
SELECT a.part_number AS item, m.period, CAST(a.price + 3 AS DECIMAL(20,8)) AS item_cost_usd
FROM {{part_attr}} a JOIN {{fact_months}} m ON {_residue_join(31)}""",
    "aci_cost_ex": f"""
SELECT a.part_number AS item, m.period, CAST(a.price + 4 AS DECIMAL(20,8)) AS item_cost_usd
FROM {{part_attr}} a JOIN {{fact_months}} m ON {_residue_join(37)}""",
    "simulation": "\nUNION ALL\n".join(f"""
SELECT a.part_number, a.model_name AS model, a.cpu AS cpu_sku, m.period || '{day}' AS estimate_revenue_date,
  CASE (a.p_partkey + {k}) % 5 WHEN 0 THEN 'NA' WHEN 1 THEN 'LATAM' WHEN 2 THEN 'EMEA' ELSE 'CHINA' END AS territory,
  CAST((a.p_partkey + {k}) % 4 AS DECIMAL(12,2)) AS all_qty, CAST((a.price + {k}) * ((a.p_partkey + {k}) % 4) AS DECIMAL(20,4)) AS cogs_amount,
  CAST((a.price + {k} + 2) * ((a.p_partkey + {k}) % 4) AS DECIMAL(20,4)) AS cogs_amount_fxdiff,
  CAST(a.p_partkey % 3 AS DECIMAL(10,4)) AS freight_cost
FROM {{part_attr}} a JOIN {{fact_months}} m ON {_residue_join(mod)}"""
        for k, day, mod in ((0, "05", 41), (3, "20", 59))),
    "hq_ship_fee": """
SELECT product_line_id AS product_line, period, CAST(CAST(period AS BIGINT) % 4 * 0.5 AS DECIMAL(10,4)) AS acc_hqshipfee
FROM (SELECT DISTINCT product_line_id, period FROM {fact_sales}) q WHERE CAST(period AS BIGINT) % 6 <> 0""",
    "csc_percentage": """
SELECT product_line_id AS product_line, warranty, ou AS ledger_short_name, period, c.country_code,
  CAST((CAST(period AS BIGINT) % 8 + length(warranty) + c.more) * 0.01 AS DECIMAL(8,4)) AS reserve_margin
FROM (SELECT DISTINCT product_line_id, warranty, ou, period, 1 AS one FROM {sales_detail} WHERE source = 'ACCRAW') q
JOIN (SELECT 'CN' AS country_code, 0 AS more, 1 AS one UNION ALL SELECT 'HK' AS country_code, 5 AS more, 1 AS one) c ON q.one = c.one
WHERE CAST(period AS BIGINT) % 9 <> 0""",
    "csc_local": """
SELECT product_line_id AS product_line, CASE WHEN business_type = 'REFURBISH' THEN business_type
    ELSE business_type || '-' || country_code END AS channel_code, period, CAST(CAST(period AS BIGINT) % 6 * 0.005 AS DECIMAL(8,4)) AS csc
FROM (SELECT DISTINCT product_line_id, business_type, country_code, period FROM {fact_sales} WHERE source = 'ACIRAW') q
WHERE CAST(period AS BIGINT) % 10 <> 0""",
    # incentives by component; the component map leads to finished parts
    "os_incentive_kp": f"""
SELECT a.item_no AS os_part_number, m.period, CAST(1 + a.p_partkey % 3 AS DECIMAL(10,4)) AS inc, '20240131' AS ds
FROM {{part_attr}} a JOIN {{fact_months}} m ON {_residue_join(43)}""",
})

# Stored accumulators (all text, the whole contract, two snapshot days each).
_ACCUM_TEXT = {"year", "quarter", "month", "sold_to_customer", "order_type", "business_type", "product_type", "distribution",
               "distribution_type", "territory", "territory2", "branch", "country_id", "country_chinese", "ou", "warranty", "csid",
               "description", "source", "product_line_id", "part_number", "period"}


def _stored_accum(where: str, ds: str) -> str:
    """A stored snapshot: identifying columns as they are, every amount the revenue's text."""
    columns = ",\n  ".join(c if c in _ACCUM_TEXT else f"CAST(revenue AS STRING) AS {c}" for c in ACCUM_CONTRACT)
    return f"""SELECT {columns}, '2024-01-01 08:00:00' AS dw_ins_time, '{ds}' AS ds FROM {{sales_detail}} WHERE {where}"""


VIEWS.update({
    "gp_monthly_accum": "\nUNION ALL\n".join(_stored_accum(f"period < '{cut}'", d)
                                              for d, cut in (("20240130", "199906"), ("20240131", "199912"))),
    "gp_weekly_accum": "\nUNION ALL\n".join(_stored_accum(f"period >= '{lo}'", d)
                                             for d, lo in (("20240130", "199801"), ("20240131", "199706"))),
})

# Uploaded sheets of the ingest layer (D1-D12) and their lookup tables.
_DEC2 = "CAST(l.l_extendedprice AS DECIMAL(18,2))"
VIEWS.update({
    "acc_sheet": f"""
SELECT 'OU' || CAST(l.l_suppkey % 9 AS STRING) || '-CN-SH' AS ou,
  CASE WHEN l.l_linenumber % 2 = 0 THEN 'W12' ELSE 'W24' END AS warranty,
  'ORG' || CAST(l.l_suppkey % 7 AS STRING) AS org,
  CASE WHEN l.l_linenumber % 2 = 0
       THEN CAST(year(l.l_shipdate) AS STRING) || '-' || lpad(CAST(month(l.l_shipdate) AS STRING), 2, '0')
       ELSE CAST(year(l.l_shipdate) * 100 + month(l.l_shipdate) AS STRING) END AS period,
  CASE l.l_linenumber % 6 WHEN 0 THEN 'Rtn order' WHEN 2 THEN 'Sales Discount' WHEN 3 THEN NULL
       WHEN 4 THEN 'reject-x' ELSE o.o_orderpriority END AS order_type,
  CASE l.l_linenumber % 3 WHEN 0 THEN 'abc-btc1' WHEN 1 THEN 'abc-3C' ELSE 'abc-xx' END AS bill_to_location,
  s.s_name AS csid, {_PART_NUMBER.format(k='l.l_partkey')} AS item, p.p_name AS item_description,
  CAST(CAST(l.l_quantity AS DECIMAL(10,2)) AS STRING) AS quantity,
  CASE WHEN l.l_partkey % 9 = 0 THEN 'ACC' ELSE ' FG ' END AS category,
  CASE l.l_partkey % 11 WHEN 0 THEN 'NB ACCY' WHEN 1 THEN 'NR-ACCESSORY' WHEN 2 THEN NULL ELSE 'NB' END AS series,
  l.l_linestatus || ' ' AS class_code, {_PL.format(k='l.l_partkey')} AS apply_prod_line,
  CAST({_DEC2} AS STRING) AS sales_revenue,
  CAST({_DEC2} * CAST(l.l_discount AS DECIMAL(6,4)) AS STRING) AS sales_discount,
  CAST({_DEC2} - {_DEC2} * CAST(l.l_discount AS DECIMAL(6,4)) AS STRING) AS sales_net,
  CAST(CAST(p.p_retailprice AS DECIMAL(12,2)) * CAST(l.l_quantity AS DECIMAL(10,2)) AS STRING) AS sales_cost,
  CASE WHEN l.l_partkey % 5 = 0 THEN 'N' ELSE 'Y' END AS is_complete
FROM {{lineitem}} l JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey
JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey JOIN {{part}} p ON l.l_partkey = p.p_partkey""",
    "aci_sheet": f"""
SELECT {_PL.format(k='l.l_partkey')} AS sheet,
  CASE l.l_linenumber % 6 WHEN 0 THEN 'CSC' WHEN 1 THEN 'Refurbish' WHEN 2 THEN 'Channel-US' WHEN 3 THEN 'Other'
       ELSE 'Retail' END AS sales_type,
  {_PART_NUMBER.format(k='l.l_partkey')} AS part_no, p.p_name AS item_description,
  CASE l.l_suppkey % 4 WHEN 0 THEN 'Retail' WHEN 1 THEN 'channel partners' WHEN 2 THEN 'REFURBISH outlet' END AS sales_group,
  CASE l.l_suppkey % 3 WHEN 0 THEN 'na' WHEN 1 THEN ' SA' ELSE 'EU' END AS region,
  CASE WHEN c.c_nationkey % 4 = 0 THEN 'US' WHEN c.c_nationkey % 4 = 1 THEN 'ca' ELSE n.n_name END AS revenue_country,
  CAST(year(l.l_shipdate) * 100 + month(l.l_shipdate) AS STRING) AS period,
  CASE WHEN l.l_linenumber % 7 = 0 THEN 'n/a' ELSE CAST({_DEC2} AS STRING) END AS revenue_amt,
  CAST({_DEC2} * CAST(l.l_discount AS DECIMAL(6,4)) AS STRING) AS total_cn_amt,
  c.c_name AS cust_full_name, CAST(CAST(l.l_quantity AS DECIMAL(10,2)) AS STRING) AS sales_qty_fg,
  CAST(CAST(p.p_retailprice AS DECIMAL(12,2)) * CAST(l.l_quantity AS DECIMAL(10,2)) AS STRING) AS cogs_amt,
  CAST(CAST(l.l_tax AS DECIMAL(6,4)) * 100 AS STRING) AS csc_unit_cost,
  CAST(CAST(l.l_tax AS DECIMAL(6,4)) * CAST(l.l_quantity AS DECIMAL(10,2)) AS STRING) AS total_csc_cost,
  o.o_orderstatus AS ar_trx_type
FROM {{lineitem}} l JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey
JOIN {{customer}} c ON o.o_custkey = c.c_custkey JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
JOIN {{part}} p ON l.l_partkey = p.p_partkey""",
    "org_map": """SELECT 'ORG' || CAST(r_regionkey AS STRING) AS org, r_name AS product_type FROM {region}""",
    "ordertype_map": """
SELECT DISTINCT o_orderpriority AS order_type, 'OT-' || substr(o_orderpriority, 1, 1) AS order_type2
FROM {orders} WHERE o_orderpriority <> '5-LOW'""",
    "distribution_map": """
SELECT DISTINCT l_linestatus AS distribution_type,
  CASE l_linestatus WHEN 'O' THEN 'Distribution' ELSE 'Direct' END AS distribution FROM {lineitem}""",
    "country_names": """
SELECT upper(substr(n_name, 1, 2)) AS country_id, n_name AS country_name, 'zh-' || lower(n_name) AS country_zh
FROM {nation}""",
    "finance_detail": """
SELECT CASE WHEN l.l_linenumber % 2 = 0
            THEN CAST(CAST(year(l.l_shipdate) AS BIGINT) * 365 - 693000 + CAST(month(l.l_shipdate) AS BIGINT) * 30 AS STRING)
            ELSE CAST(year(l.l_shipdate) AS STRING) || '-' || lpad(CAST(month(l.l_shipdate) AS STRING), 2, '0') || '-15'
       END AS gl_date,
  CASE l.l_linenumber % 3 WHEN 0 THEN 'B&S-RM EX-113' WHEN 1 THEN 'B&S-RM EX Book-113' ELSE 'Other' END AS order_type,
  a.item_no, a.item_desc AS item_description, CAST(l.l_quantity AS STRING) AS quantity,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS net_sale_amount,
  CASE WHEN l.l_partkey % 13 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(a.price AS DECIMAL(18,2)) END AS material_cost,
  a.ag_no, CASE WHEN a.ag_no IS NULL THEN '無B&S Group' ELSE '有B&S Group' END AS ag_no_check
FROM {lineitem} l JOIN {part_attr} a ON l.l_partkey = a.p_partkey""",
    "ship_unit": """
SELECT product_line, 'G' || CAST(CAST(period AS BIGINT) % 5 AS STRING) AS geo,
  'T' || CAST(CAST(period AS BIGINT) % 3 AS STRING) AS territory,
  CASE WHEN sales_team = 'acc' THEN 'AIR' ELSE 'SEA' END AS ship_way_type,
  freight AS unit_shipfee, CAST(freight / 2 AS DECIMAL(10,4)) AS unit_storage_fee, period, 'weekly' AS freq
FROM {branch_freight}""",
    "country_group": """
SELECT 'G' || CAST(n_regionkey AS STRING) AS geo, 'T' || CAST(n_nationkey % 3 AS STRING) AS territory,
  upper(substr(n_name, 1, 2)) AS country_code FROM {nation}""",
    "fx_matrix": """
SELECT period,
  max(CASE WHEN product_line = 'NB' THEN fx_rate END) AS nb,
  max(CASE WHEN product_line = 'NR' THEN fx_rate END) AS nr,
  max(CASE WHEN product_line = 'NV' THEN fx_rate END) AS nv
FROM {fx_rates} GROUP BY period""",
})

_PLACEHOLDER = re.compile(r"\{([a-z_]+)\}")


def view_deps(name: str) -> list[str]:
    """Tables / views a view reads, in first-use order."""
    seen: list[str] = []
    for dep in _PLACEHOLDER.findall(VIEWS[name]):
        if dep not in seen:
            seen.append(dep)
    return seen


def closure(names) -> list[str]:
    """Adapter views needed by ``names`` (transitively), dependencies first."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order or n in DRIVER_TABLES:
            return
        for dep in view_deps(n):
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return order


def duckdb_sql(name: str) -> str:
    """The view's SQL with placeholders bound to plain table / CTE names."""
    return _PLACEHOLDER.sub(lambda m: m.group(1), VIEWS[name])


def with_views(views, body: str) -> str:
    """Prefix ``body`` with CTEs for the named adapter views (for DuckDB)."""
    needed = closure(views)
    if not needed:
        return body
    ctes = ",\n".join(f"{n} AS ({duckdb_sql(n)}\n)" for n in needed)
    stripped = body.lstrip()
    if stripped[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{stripped[14:].lstrip()}"
    if stripped[:4].upper() == "WITH":
        return f"WITH {ctes},\n{stripped[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


# Views whose size is bounded by dimensions (parts, months, branches, lines), not
# by the fact: they stand in for stored lookup tables, so they are materialised
# once per table set (Parquet in the shared checkpoint folder). That cuts their
# lineage — every plan that uses them stays small, they are not recomputed from
# the fact for each query, and Spark knows their sizes when it plans a join.  Fact-sized views stay lazy.
DIMENSION_VIEWS = frozenset({
    "fact_months",
    "part_attr", "fx_rates", "cost_pn", "cost_branch", "branch_freight", "funding", "cn_rates", "cost_range", "price_history",
    "bom", "item_code", "keypart_history", "cpugpu_history", "pac_src", "keypart_result", "extra_rebate_src", "sellout_src", "opp_rebate",
    "os_incentive", "columnlist", "org_map", "ordertype_map", "distribution_map", "country_names", "ship_unit",
    "country_group", "fx_matrix", "keypart_gp", "cost_pn_ex", "cost_branch_ex", "aci_cost", "aci_cost_ex", "hq_ship_fee", "csc_percentage",
    "csc_local", "os_incentive_kp", "simulation",
})


# Views that join the parts to the sales or to themselves.  Parts are shuffled there, never broadcast: they are stored in a
# few bytes a row, and Spark plans by file size.
PARTS_SHUFFLED = frozenset({"quotes", "keypart_report", "finance_detail", "bom"})
# Views that multiply the parts by the months and branches of the sales and read nothing else of these.
BRANCH_COSTS = frozenset({"cost_branch", "cost_branch_ex"})

# Rows of the part table in one stored file.  Parts compress to a few bytes each, so that a split by size holds any number of
# them, and a view with many months per part would be made, sorted and read back by one task.
PARTS_A_FILE = 20_000


def store_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: no lineage, pruned reads, a known size."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, most_rows: int | None = None) -> DataFrame:
    """``df`` dealt over all cores where its scan has fewer splits than that (a small or single-block file); work that is
    heavy per row and never shuffles would otherwise run in those few tasks.  Large inputs stay as they are.  With
    ``most_rows`` the partitions follow the rows instead, about that many in each."""
    parts = -(-df.count() // most_rows) if most_rows else df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= parts else df.repartition(parts)


class MartTables:
    """Driver tables and adapter views for one data folder, read lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.materialize = materialize
        self._frames: dict[str, DataFrame] = {}
        # wide projections stay out of one generated method that the JVM would only interpret, in any session
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", MART_SQL_CONF["spark.sql.codegen.hugeMethodLimit"])
        if materialize:
            ensure_checkpoint_dir(spark)

    def __getitem__(self, name: str) -> DataFrame:
        return self.get(name)

    def memo(self, key: str, builder) -> DataFrame:
        """Build a derived (lazy) frame once per table set, so a sub-plan shared
        by several models is one DataFrame (and one plan-time size check)."""
        k = f"memo:{key}"
        if k not in self._frames:
            self._frames[k] = builder()
        return self._frames[k]

    def prepare(self, names) -> None:
        """Make the stored views among ``names`` and what they need, those that do not need each other at the same
        time: each is a small job, and the cluster has room for many."""
        todo = [n for n in closure(names) if n not in self._frames]
        while todo:
            ready = [n for n in todo if not set(view_deps(n)) & set(todo)]
            with ThreadPoolExecutor(8) as pool:
                list(pool.map(self.get, ready))
            todo = [n for n in todo if n not in ready]

    def get(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in DRIVER_TABLES:
                df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                deps = {d: self.get(d) for d in view_deps(name)}
                if name == "sales_detail":  # wide rows with much work on each: all cores from the scan on
                    deps["fact_sales"] = self.spark.sql(VIEWS["fact_sales"], lineitem=spread(self.get("lineitem")))
                if name == "part_attr" and self.materialize:  # its files are the tasks of all views that multiply parts by months
                    deps["part"] = spread(deps["part"], PARTS_A_FILE)
                if name in BRANCH_COSTS and self.materialize:  # the few pairs are stored: Spark knows that they are what to broadcast
                    deps["fact_sales"] = self.memo("fact_branches", lambda: store_table(
                        self.get("fact_sales").select("period", "branch").distinct(), "fact_branches"))
                if name in PARTS_SHUFFLED:
                    deps["part_attr"] = shuffled(deps["part_attr"])
                df = self.spark.sql(VIEWS[name], **deps)
                if self.materialize and name in DIMENSION_VIEWS:
                    df = store_table(df, name)
            self._frames[name] = df
        return self._frames[name]


@lru_cache(maxsize=8)
def _tables_for(spark_id: int, sf_dir: str, spark: SparkSession) -> MartTables:
    return MartTables(spark, sf_dir)


def tables(spark: SparkSession, sf_dir: str) -> MartTables:
    """Shared :class:`MartTables` per (session, folder)."""
    return _tables_for(id(spark), sf_dir, spark)
