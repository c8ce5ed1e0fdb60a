"""Verified queries: filters and classification rules."""

from pyspark.sql import functions as F

from ledgerlake.functions import money as M
from ledgerlake.functions.dates import normalize_period, period_month, period_quarter, period_year
from ledgerlake.operators import rules as R
from ledgerlake.plans.registry import query
from ledgerlake.sources.snapshot import max_of

# fixed values: the retail bill-to suffix rule of the RMB source
RETAIL_SUFFIX = r"(BTC|BTC1|NC|3C)$"


@query("in_filter", ["raw_text_sales"], """
SELECT row_key, region FROM raw_text_sales WHERE upper(trim(region)) IN ('NA', 'EU')""")
def in_filter_q(t):
    """Membership after trim + upper."""
    return R.in_filter(t["raw_text_sales"].select("row_key", "region"), "region", ["NA", "EU"], normalize="upper")


@query("keyword_exclude", ["raw_text_sales"], """
SELECT row_key, order_type FROM raw_text_sales
WHERE NOT coalesce(contains(upper(order_type), 'RETURN') OR contains(upper(order_type), 'DISCOUNT'), false)""")
def keyword_exclude_q(t):
    """P10: drop rows whose order type mentions any keyword; NULL kept."""
    return R.keyword_exclude(t["raw_text_sales"].select("row_key", "order_type"), "order_type", ["return", "discount"])


@query("contains_filter", ["fact_sales"], """
SELECT l_orderkey, l_linenumber, part_number FROM fact_sales WHERE contains(part_number, '-M')""")
def contains_filter_q(t):
    """Part number must contain '-M'."""
    return R.contains_filter(t["fact_sales"].select("l_orderkey", "l_linenumber", "part_number"), "part_number", "-M")


@query("prefix_filter", ["part_attr"], """
SELECT p_partkey, item_no FROM part_attr WHERE item_no LIKE '01%' OR item_no LIKE '02%'""")
def prefix_filter_q(t):
    """``LIKE '01%' OR LIKE '02%'``."""
    return R.prefix_filter(t["part_attr"].select("p_partkey", "item_no"), "item_no", ["01", "02"])


@query("implication_filter", ["fact_sales"], """
SELECT l_orderkey, l_linenumber, product_line_id, source, branch FROM fact_sales
WHERE NOT (product_line_id = 'NV' AND source = 'ACCRAW') OR branch = 'ACC'""")
def implication_filter_q(t):
    """The NV/ACCRAW combination is kept only for the ACC branch."""
    f = t["fact_sales"].select("l_orderkey", "l_linenumber", "product_line_id", "source", "branch")
    return f.where(R.implication(F.col("product_line_id") == "NV", F.col("source") == "ACCRAW", F.col("branch") == "ACC"))


@query("nonzero_or_null", ["raw_text_sales"], """
SELECT row_key, amount_text FROM raw_text_sales
WHERE TRY_CAST(trim(amount_text) AS DOUBLE) IS NULL OR TRY_CAST(trim(amount_text) AS DOUBLE) <> 0""")
def nonzero_or_null_q(t):
    """Drop numeric zeros, keep NULL and unparseable text."""
    return R.nonzero_or_null(t["raw_text_sales"].select("row_key", "amount_text"), "amount_text")


@query("conjunctive_filter", ["fact_sales"], """
SELECT l_orderkey, l_linenumber, business_type, revenue FROM fact_sales
WHERE business_type <> 'REFURBISH' AND revenue <> 0 AND source IN ('ACCRAW', 'ACIRAW') AND all_qty > 0""")
def conjunctive_filter_q(t):
    """Flag ≠ x AND amount ≠ 0 AND type IN (...)."""
    f = t["fact_sales"]
    return f.where((F.col("business_type") != "REFURBISH") & (F.col("revenue") != 0)
                   & F.col("source").isin("ACCRAW", "ACIRAW") & (F.col("all_qty") > 0)
                   ).select("l_orderkey", "l_linenumber", "business_type", "revenue")


@query("const_filter", ["fact_sales"], """
SELECT l_orderkey, l_linenumber, branch FROM fact_sales WHERE branch <> 'CA' AND distribution_type = 'O'""")
def const_filter_q(t):
    """P20: constant (in)equality filters (SQL drops NULL on ``<>``)."""
    f = t["fact_sales"]
    return f.where((F.col("branch") != "CA") & (F.col("distribution_type") == "O")).select(
        "l_orderkey", "l_linenumber", "branch")


@query("case_map", ["fact_sales"], """
SELECT l_orderkey, l_linenumber,
  CASE distribution_type WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Final' END AS distribution,
  CASE product_line_id WHEN 'NB' THEN 'Notebook' WHEN 'NR' THEN 'Router' END AS product_line_name
FROM fact_sales""")
def case_map_q(t):
    """CASE mapping of a code; no ELSE → NULL."""
    f = t["fact_sales"]
    return f.select("l_orderkey", "l_linenumber",
                    R.case_map("distribution_type", {"O": "Open", "F": "Final"}).alias("distribution"),
                    R.case_map("product_line_id", {"NB": "Notebook", "NR": "Router"}).alias("product_line_name"))


# fixed values: the key-part category waterfall (pattern, item-code lookup, prefixes, default)
ITEM_CODE_CATEGORY_SQL = """SELECT DISTINCT substr(item_no, 1, 2) AS item_code,
  CASE substr(item_no, 1, 2) WHEN '01' THEN 'LCD' WHEN '03' THEN 'BATT' END AS category
FROM part_attr WHERE substr(item_no, 1, 2) IN ('01', '03')"""


@query("category_waterfall", ["quotes", "part_attr"], f"""
WITH item_code AS ({ITEM_CODE_CATEGORY_SQL})
SELECT q.item_no, q.group_no AS period,
  CASE WHEN q.item_desc LIKE '%BOLT%' THEN 'BR'
       WHEN ic.category IS NOT NULL THEN ic.category
       WHEN q.item_desc LIKE 'COLD%' OR q.item_desc LIKE 'RED%' THEN 'DDR'
       WHEN q.item_desc LIKE 'C%' THEN 'CPU'
       ELSE 'SSD' END AS category
FROM quotes q LEFT JOIN item_code ic ON substr(q.item_no, 1, 2) = ic.item_code""")
def category_waterfall_q(t):
    """Pattern → looked-up category → prefixes (longest first) → default."""
    q = t["quotes"]
    pa = t["part_attr"]
    ic = (pa.where(F.substring("item_no", 1, 2).isin("01", "03"))
          .select(F.substring("item_no", 1, 2).alias("item_code"),
                  R.case_map(F.substring("item_no", 1, 2), {"01": "LCD", "03": "BATT"}).alias("ic_category"))
          .distinct())
    j = q.join(ic, F.substring(q["item_no"], 1, 2) == ic["item_code"], "left")
    cat = R.category_waterfall([(F.col("item_desc").like("%BOLT%"), "BR")], F.col("ic_category"), "item_desc",
                               {"COLD": "DDR", "RED": "DDR", "C": "CPU"}, "SSD")
    return j.select("item_no", F.col("group_no").alias("period"), cat.alias("category"))


# fixed values: ordered customer keyword dictionary (first keyword found wins)
CUSTOMER_KEYWORDS = [("000000001", "Best Buy"), ("00000001", "Walmart"), ("0000000", "Amazon"), ("Supplier", "Other")]


@query("keyword_dictionary", ["raw_text_sales"], """
SELECT row_key,
  CASE WHEN contains(upper(supplier_name), '000000001') THEN 'Best Buy'
       WHEN contains(upper(supplier_name), '00000001') THEN 'Walmart'
       WHEN contains(upper(supplier_name), '0000000') THEN 'Amazon'
       WHEN contains(upper(supplier_name), 'SUPPLIER') THEN 'Other'
       ELSE 'Unknown' END AS customer
FROM raw_text_sales""")
def keyword_dictionary_q(t):
    """Ordered keyword dictionary, NULL → default."""
    return t["raw_text_sales"].select(
        "row_key", R.keyword_dictionary("supplier_name", CUSTOMER_KEYWORDS, "Unknown").alias("customer"))


@query("override_cascade", ["fact_sales"], """
SELECT l_orderkey, l_linenumber,
  CASE WHEN product_line_id = 'NV' AND source = 'ACIRAW' THEN 'NV-Channel'
       WHEN country_code = 'CA' THEN 'Canada'
       WHEN branch = 'ACC' THEN 'ACC-Retail'
       ELSE business_type END AS business_type
FROM fact_sales""")
def override_cascade_q(t):
    """C4: rules applied in sequence; later rules override earlier ones."""
    f = t["fact_sales"]
    rules = [(F.col("branch") == "ACC", F.lit("ACC-Retail")),
             (F.col("country_code") == "CA", F.lit("Canada")),
             ((F.col("product_line_id") == "NV") & (F.col("source") == "ACIRAW"), F.lit("NV-Channel"))]
    return f.select("l_orderkey", "l_linenumber",
                    R.override_cascade(F.col("business_type"), rules).alias("business_type"))


@query("regex_class", ["raw_text_sales"], """
SELECT row_key, CASE WHEN coalesce(regexp_matches(upper(bill_to), '(BTC|BTC1|NC|3C)$'), false)
  THEN 'Retail' ELSE 'Channel' END AS channel FROM raw_text_sales""")
def regex_class_q(t):
    """Regex suffix class → Retail else Channel."""
    return t["raw_text_sales"].select("row_key", R.regex_class("bill_to", RETAIL_SUFFIX, "Retail", "Channel").alias("channel"))


@query("period_parts", ["raw_text_sales"], """
SELECT row_key, p AS period, substr(p, 1, 4) AS year, substr(p, 5, 2) AS month,
  CASE WHEN TRY_CAST(substr(p, 5, 2) AS INTEGER) BETWEEN 1 AND 3 THEN 'Q1'
       WHEN TRY_CAST(substr(p, 5, 2) AS INTEGER) BETWEEN 4 AND 6 THEN 'Q2'
       WHEN TRY_CAST(substr(p, 5, 2) AS INTEGER) BETWEEN 7 AND 9 THEN 'Q3' ELSE 'Q4' END AS quarter
FROM (SELECT row_key, rpad(regexp_replace(period_text, '[^0-9]', '', 'g'), 6, '0') AS p FROM raw_text_sales) q""")
def period_parts_q(t):
    """C9 (+F5): normalised period → year, month, quarter (month 00 → Q4, q8)."""
    r = t["raw_text_sales"].select("row_key", normalize_period("period_text").alias("period"))
    return r.select("row_key", "period", period_year("period").alias("year"), period_month("period").alias("month"),
                    period_quarter("period").alias("quarter"))


@query("negative_guard", ["fact_sales"], """
SELECT l_orderkey, l_linenumber,
  CASE WHEN all_qty < 0 THEN CAST(0 AS DECIMAL(34,15))
       ELSE CAST(CAST(all_qty AS DECIMAL(20,8)) * CAST(cn_rate AS DECIMAL(17,7)) AS DECIMAL(34,15)) END AS amount
FROM fact_sales""")
def negative_guard_q(t):
    """C11: ``CASE WHEN qty < 0 THEN 0 ELSE rate × qty``."""
    f = t["fact_sales"]
    return f.select("l_orderkey", "l_linenumber", M.guard_negative("all_qty", M.mul("all_qty", "cn_rate")).alias("amount"))


@query("null_guard_diff", ["price_history"], """
SELECT item_no, period,
  CASE WHEN equo_price IS NOT NULL AND cogs_price IS NOT NULL
       THEN CAST(cogs_price - equo_price AS DECIMAL(34,15)) END AS bs_gap
FROM price_history""")
def null_guard_diff_q(t):
    """Gap only when both prices exist."""
    p = t["price_history"]
    return p.select("item_no", "period", M.null_guarded_diff("cogs_price", "equo_price").alias("bs_gap"))


@query("anchor_switch", ["price_history"], """
SELECT item_no, period,
  CASE WHEN period = (SELECT max(period) FROM price_history) THEN cogs_price ELSE equo_price END AS price
FROM price_history""")
def anchor_switch_q(t):
    """In the anchor (latest) period take the report price, else the quote."""
    p = t["price_history"]
    return p.select("item_no", "period",
                    R.anchor_switch("period", max_of(p, "period"), "cogs_price", "equo_price").alias("price"))
