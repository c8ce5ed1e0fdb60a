"""Verified queries: scalar expressions."""

from pyspark.sql import functions as F

from ledgerlake.functions import money as M
from ledgerlake.functions import text as X
from ledgerlake.functions.dates import (
    add_months_period, local_time_text, normalize_period, plain_cast, safe_number, serial_or_text_date,
)
from ledgerlake.plans.registry import query


@query("str_substr", ["fact_sales"], """
SELECT l_orderkey, l_linenumber, substr(part_number, 1, 4) AS pn_prefix, substr(period, 5, 2) AS month
FROM fact_sales""")
def str_substr_q(t):
    """substring / left-N."""
    return t["fact_sales"].select("l_orderkey", "l_linenumber", X.left("part_number", 4).alias("pn_prefix"),
                                  F.substring("period", 5, 2).alias("month"))


@query("str_case_trim", ["raw_text_sales"], """
SELECT row_key, upper(trim(region)) AS region_key, lower(bill_to) AS bill_to_lower FROM raw_text_sales""")
def str_case_trim_q(t):
    """upper / lower / trim."""
    return t["raw_text_sales"].select("row_key", X.norm_key("region").alias("region_key"),
                                      F.lower("bill_to").alias("bill_to_lower"))


@query("str_concat", ["fact_sales"], """
SELECT l_orderkey, l_linenumber, product_line_id || '-' || branch AS pl_branch,
  part_number || '-' || CAST(cn_rate AS VARCHAR) AS pn_rate
FROM fact_sales""")
def str_concat_q(t):
    """concatenation with separator (NULL if any part is NULL)."""
    f = t["fact_sales"]
    return f.select("l_orderkey", "l_linenumber", X.concat_keys("product_line_id", "branch").alias("pl_branch"),
                    X.concat_keys("part_number", F.col("cn_rate").cast("string")).alias("pn_rate"))


@query("str_match", ["part_attr"], """
SELECT p_partkey,
  item_desc LIKE '%GEAR%' AS is_gear, starts_with(item_desc, 'HOT') AS is_hot,
  contains(item_desc, 'OLD') AS has_old, regexp_matches(item_desc, '^(RED|BLUE) ') AS is_colour
FROM part_attr""")
def str_match_q(t):
    """LIKE / startswith / contains / regex."""
    p = t["part_attr"]
    return p.select("p_partkey", F.col("item_desc").like("%GEAR%").alias("is_gear"),
                    F.col("item_desc").startswith("HOT").alias("is_hot"),
                    F.col("item_desc").contains("OLD").alias("has_old"),
                    F.col("item_desc").rlike("^(RED|BLUE) ").alias("is_colour"))


@query("period_normalize", ["raw_text_sales"], """
SELECT row_key, rpad(regexp_replace(period_text, '[^0-9]', '', 'g'), 6, '0') AS period FROM raw_text_sales""")
def period_normalize_q(t):
    """strip non-digits, right-pad with 0 to 6, cut to 6."""
    return t["raw_text_sales"].select("row_key", normalize_period("period_text").alias("period"))


@query("month_arith", ["price_history"], """
SELECT DISTINCT period, strftime(strptime(period, '%Y%m') + INTERVAL 1 MONTH, '%Y%m') AS next_period,
  strftime(strptime(period, '%Y%m') + INTERVAL 2 MONTH, '%Y%m') AS third_period,
  strftime(strptime(period, '%Y%m') - INTERVAL 1 MONTH, '%Y%m') AS prev_period
FROM price_history""")
def month_arith_q(t):
    """month parse / add / format."""
    p = t["price_history"].select("period").distinct()
    return p.select("period", add_months_period("period", 1).alias("next_period"),
                    add_months_period("period", 2).alias("third_period"),
                    add_months_period("period", -1).alias("prev_period"))


@query("serial_date", [], """
SELECT o_orderkey,
  CASE WHEN TRY_CAST(raw AS DOUBLE) IS NOT NULL
       THEN CAST(DATE '1899-12-30' + CAST(floor(TRY_CAST(raw AS DOUBLE)) AS INTEGER) AS DATE)
       ELSE TRY_CAST(TRY_STRPTIME(raw, '%Y-%m-%d') AS DATE) END AS order_date
FROM (SELECT o_orderkey,
        CASE o_orderkey % 3
          WHEN 0 THEN CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS VARCHAR) || '.25'
          WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
          ELSE 'not a date' END AS raw
      FROM orders) q""")
def serial_date_q(t):
    """spreadsheet serial or text → date; bad → NULL."""
    o = t["orders"]
    raw = (F.when(F.col("o_orderkey") % 3 == 0,
                  F.concat(F.datediff(F.to_date("o_orderdate"), F.lit("1899-12-30").cast("date")).cast("string"),
                           F.lit(".25")))
           .when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
           .otherwise(F.lit("not a date")))
    return o.select("o_orderkey", serial_or_text_date(raw).alias("order_date"))


@query("tz_format", [], """
SELECT event_id, strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Taipei', '%Y-%m-%d %H:%M:%S') AS local_time
FROM events""")
def tz_format_q(t):
    """F8: an instant formatted in a named zone."""
    return t["events"].select("event_id", local_time_text("ts").alias("local_time"))


@query("safe_number", ["raw_text_sales"], """
SELECT row_key, TRY_CAST(CASE WHEN trim(replace(amount_text, ',', '')) <> '' THEN trim(replace(amount_text, ',', '')) END
  AS DECIMAL(38,15)) AS amount FROM raw_text_sales""")
def safe_number_q(t):
    """lossy numeric parse (separators removed, blank / junk → NULL)."""
    return t["raw_text_sales"].select("row_key", safe_number("amount_text").alias("amount"))


@query("safe_divide", ["fact_sales", "fx_rates"], """
SELECT f.l_orderkey, f.l_linenumber,
  CAST(f.revenue AS DOUBLE) / NULLIF(CAST(x.fx_rate AS DOUBLE), 0) AS revenue_local,
  coalesce(CAST(f.revenue AS DOUBLE) / NULLIF(CAST(f.all_qty AS DOUBLE), 0), 0.0) AS unit_price
FROM fact_sales f LEFT JOIN fx_rates x ON f.product_line_id = x.product_line AND f.period = x.period""")
def safe_divide_q(t):
    """NULLIF-guarded division; zero / missing rate → NULL, zero qty → 0."""
    f, x = t["fact_sales"], t["fx_rates"]
    j = f.join(x, (f["product_line_id"] == x["product_line"]) & (f["period"] == x["period"]), "left")
    return j.select("l_orderkey", "l_linenumber", M.fx_divide(f["revenue"], x["fx_rate"]).alias("revenue_local"),
                    M.ratio_or_zero(f["revenue"], f["all_qty"]).alias("unit_price"))


@query("null_default", ["fact_sales"], """
SELECT l_orderkey, l_linenumber, coalesce(cn_rate, CAST(0 AS DECIMAL(6,4))) AS cn_rate,
  coalesce(CASE WHEN cost_period = 'newest' THEN NULL ELSE cost_period END, '') AS cost_period
FROM fact_sales""")
def null_default_q(t):
    """COALESCE(x, 0) / COALESCE(tag, '')."""
    f = t["fact_sales"]
    return f.select("l_orderkey", "l_linenumber", F.coalesce("cn_rate", F.lit(0).cast("decimal(6,4)")).alias("cn_rate"),
                    F.coalesce(F.when(F.col("cost_period") != "newest", F.col("cost_period")), F.lit("")).alias("cost_period"))


@query("sign_round", ["fact_sales"], """
SELECT l_orderkey, l_linenumber, CAST(round(-CAST(revenue AS DECIMAL(34,15)), 15) AS DECIMAL(34,15)) AS cost,
  CAST(round(CAST(revenue AS DECIMAL(20,8)) * CAST(cn_rate AS DECIMAL(17,7)), 2) AS DECIMAL(34,15)) AS credit_2dp
FROM fact_sales""")
def sign_round_q(t):
    """sign inversion and rounding."""
    f = t["fact_sales"]
    return f.select("l_orderkey", "l_linenumber", M.negate_round("revenue").alias("cost"),
                    F.round(F.col("revenue").cast(M.AMOUNT) * F.col("cn_rate").cast(M.RATE), 2).cast(M.MONEY).alias("credit_2dp"))


FX_CONVERT_SQL = """
SELECT f.l_orderkey, f.l_linenumber, f.source,
  CAST(f.revenue AS DOUBLE) / NULLIF(CAST(x.fx_rate AS DOUBLE), 0) AS revenue_usd_hedge,
  CAST(f.revenue AS DOUBLE) / NULLIF(CAST(x.fx_rate_ex AS DOUBLE), 0) AS revenue_usd_ex,
  CASE WHEN f.source = 'ACCRAW' THEN CAST(f.revenue AS DECIMAL(34,15)) END AS revenue_rmb
FROM fact_sales f LEFT JOIN fx_rates x ON f.product_line_id = x.product_line AND f.period = x.period"""


@query("fx_convert", ["fact_sales", "fx_rates"], FX_CONVERT_SQL)
def fx_convert_q(t):
    """amount at the hedge and the ex rate, RMB passed through for ACC."""
    f, x = t["fact_sales"], t["fx_rates"]
    j = f.join(x, (f["product_line_id"] == x["product_line"]) & (f["period"] == x["period"]), "left")
    return j.select("l_orderkey", "l_linenumber", "source",
                    M.fx_divide(f["revenue"], x["fx_rate"]).alias("revenue_usd_hedge"),
                    M.fx_divide(f["revenue"], x["fx_rate_ex"]).alias("revenue_usd_ex"),
                    M.gated(F.col("source") == "ACCRAW", M.money(f["revenue"])).alias("revenue_rmb"))


@query("zero_pad", ["fact_sales"], """
SELECT DISTINCT l_partkey, lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS code FROM fact_sales""")
def zero_pad_q(t):
    """zero-padded code."""
    return t["fact_sales"].select("l_partkey", X.zero_pad("l_partkey").alias("code")).distinct()


@query("json_from_text", [], """
SELECT event_id, CASE WHEN json_valid(span) THEN TRY_CAST(json_extract(span, '$.k') AS BIGINT) END AS k
FROM (SELECT event_id, NULLIF(regexp_extract(wrapped, '(?s)([\\[{].*[\\]}])', 1), '') AS span FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'no json here'
        ELSE 'Here you go:\n```json\n' || props || '\n```' END AS wrapped FROM events) q0) q""")
def json_from_text_q(t):
    """JSON span of free text parsed with a schema; unparseable → NULL."""
    e = t["events"]
    wrapped = F.when(F.col("event_id") % 5 == 0, F.lit("no json here")).otherwise(
        F.concat(F.lit("Here you go:\n```json\n"), F.col("props"), F.lit("\n```")))
    return e.select("event_id", X.json_from_text(wrapped, "k BIGINT").getField("k").alias("k"))


@query("clean_answer", [], """
SELECT conv_id, turn,
  regexp_replace(regexp_replace(wrapped, '(?is)<think>.*?</think>', '', 'g'), '^[ \\t\\r\\n`''"]+|[ \\t\\r\\n`''"]+$', '', 'g') AS answer
FROM (SELECT conv_id, turn, '<think>' || role || '</think>' || chr(10) || '"`' || text || '`"' AS wrapped
      FROM conversations) q""")
def clean_answer_q(t):
    """F16: drop think blocks, trim quotes / back-ticks."""
    c = t["conversations"]
    wrapped = F.concat(F.lit("<think>"), F.col("role"), F.lit("</think>\n\"`"), F.col("text"), F.lit("`\""))
    return c.select("conv_id", "turn", X.clean_answer(wrapped).alias("answer"))


@query("split_explode", ["columnlist"], """
SELECT column_id, trim(s) AS source_table
FROM (SELECT column_id, unnest(regexp_split_to_array(source_table, '[,/]')) AS s FROM columnlist) q
WHERE trim(s) <> ''""")
def split_explode_q(t):
    """delimited list → one row per trimmed, non-empty item."""
    c = t["columnlist"]
    return c.select("column_id", F.explode(X.split_list("source_table")).alias("source_table"))


@query("json_path_fallback", [], """
SELECT event_id,
  coalesce(NULLIF(trim(json_extract_string(payload, '$.output.text')), ''),
           NULLIF(trim(json_extract_string(payload, '$.answer')), ''),
           NULLIF(trim(json_extract_string(payload, '$.data.content')), '')) AS answer
FROM (SELECT event_id,
        CASE event_type
          WHEN 'click' THEN '{"output": {"text": "v' || CAST(user_id AS VARCHAR) || '"}}'
          WHEN 'view' THEN '{"output": {"text": "  "}, "answer": "a' || CAST(user_id AS VARCHAR) || '"}'
          WHEN 'purchase' THEN '{"data": {"content": "c' || CAST(event_id AS VARCHAR) || '"}}'
          ELSE props END AS payload FROM events) q""")
def json_path_fallback_q(t):
    """first non-empty of several JSON paths."""
    e = t["events"]
    payload = (F.when(F.col("event_type") == "click",
                      F.concat(F.lit('{"output": {"text": "v'), F.col("user_id").cast("string"), F.lit('"}}')))
               .when(F.col("event_type") == "view",
                     F.concat(F.lit('{"output": {"text": "  "}, "answer": "a'), F.col("user_id").cast("string"), F.lit('"}')))
               .when(F.col("event_type") == "purchase",
                     F.concat(F.lit('{"data": {"content": "c'), F.col("event_id").cast("string"), F.lit('"}}')))
               .otherwise(F.col("props")))
    return e.select("event_id", X.json_path_fallback(payload, ["$.output.text", "$.answer", "$.data.content"]).alias("answer"))


@query("plain_cast", ["fact_sales"], """
SELECT l_orderkey, l_linenumber, CAST(period AS INTEGER) AS period_int, CAST(all_qty AS DECIMAL(34,15)) AS qty,
  CAST(l_partkey AS VARCHAR) AS partkey_text FROM fact_sales""")
def plain_cast_q(t):
    """strict casts (ANSI: bad input raises)."""
    f = t["fact_sales"]
    return f.select("l_orderkey", "l_linenumber", plain_cast("period", "int").alias("period_int"),
                    plain_cast("all_qty", "decimal(34,15)").alias("qty"),
                    plain_cast("l_partkey", "string").alias("partkey_text"))


@query("null_as_zero_sum", ["fact_sales"], """
SELECT l_orderkey, l_linenumber,
  CAST(coalesce(CAST(revenue AS DECIMAL(34,15)), 0)
       - coalesce(CAST(CAST(CAST(revenue AS DECIMAL(20,8)) * CAST(cn_rate AS DECIMAL(17,7)) AS DECIMAL(34,15)) AS DECIMAL(34,15)), 0)
       - coalesce(CAST(all_qty AS DECIMAL(34,15)), 0) AS DECIMAL(34,15)) AS net_amount
FROM fact_sales""")
def null_as_zero_sum_q(t):
    """Σ ± COALESCE(CAST(x AS DECIMAL), 0)."""
    f = t["fact_sales"]
    return f.select("l_orderkey", "l_linenumber",
                    M.signed_sum(plus=["revenue"], minus=[M.mul("revenue", "cn_rate"), "all_qty"]).alias("net_amount"))


@query("staged_calc", ["fact_sales"], """
WITH s1 AS (
  SELECT l_orderkey, l_linenumber, all_qty,
    CAST(coalesce(CAST(revenue AS DECIMAL(34,15)), 0)
       - coalesce(CAST(CAST(revenue AS DECIMAL(20,8)) * CAST(cn_rate AS DECIMAL(17,7)) AS DECIMAL(34,15)), 0) AS DECIMAL(34,15)) AS net_rev
  FROM fact_sales),
s2 AS (SELECT *, CASE WHEN all_qty = 0 OR all_qty IS NULL THEN 0.0
                      ELSE CAST(net_rev AS DOUBLE) / CAST(all_qty AS DOUBLE) END AS unit_net FROM s1),
s3 AS (SELECT *, CAST(net_rev + net_rev AS DECIMAL(34,15)) AS double_net, unit_net * 2 AS double_unit FROM s2)
SELECT l_orderkey, l_linenumber, net_rev, unit_net, double_net, double_unit FROM s3""")
def staged_calc_q(t):
    """Each stage reads the previous stage's columns (CollapseProject folds them)."""
    f = t["fact_sales"]
    s1 = f.withColumn("net_rev", M.signed_sum(plus=["revenue"], minus=[M.mul("revenue", "cn_rate")]))
    s2 = s1.withColumn("unit_net", M.ratio_or_zero("net_rev", "all_qty"))
    s3 = s2.withColumns({"double_net": (F.col("net_rev") + F.col("net_rev")).cast(M.MONEY),
                         "double_unit": F.col("unit_net") * 2})
    return s3.select("l_orderkey", "l_linenumber", "net_rev", "unit_net", "double_net", "double_unit")


@query("gated_columns", ["fact_sales", "fx_rates"], """
SELECT f.l_orderkey, f.l_linenumber,
  CASE WHEN f.source = 'ACCRAW' THEN CAST(CAST(f.revenue AS DECIMAL(20,8)) * CAST(coalesce(x.fx_rate, 0) AS DECIMAL(17,7)) AS DECIMAL(34,15)) END AS revenue_rmb_calc,
  CASE WHEN f.source = 'ACIRAW' THEN f.revenue END AS revenue_aci
FROM fact_sales f LEFT JOIN fx_rates x ON f.product_line_id = x.product_line AND f.period = x.period""")
def gated_columns_q(t):
    """Values only for one source, NULL for the other."""
    f, x = t["fact_sales"], t["fx_rates"]
    j = f.join(x, (f["product_line_id"] == x["product_line"]) & (f["period"] == x["period"]), "left")
    return j.select("l_orderkey", "l_linenumber",
                    M.gated(F.col("source") == "ACCRAW", M.mul(f["revenue"], F.coalesce(x["fx_rate"], F.lit(0)))).alias("revenue_rmb_calc"),
                    M.gated(F.col("source") == "ACIRAW", f["revenue"]).alias("revenue_aci"))
