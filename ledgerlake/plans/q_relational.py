"""Verified queries: joins, aggregates, windows, set operations and reshape
(J1-J21, C7, C8, A1-A9, W1-W5, L2, L3, U1-U6, R1)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.functions import money as M
from ledgerlake.functions.dates import add_months_period
from ledgerlake.operators import aggregate as A
from ledgerlake.operators import asof as W
from ledgerlake.operators import lookup as L
from ledgerlake.operators import setops as U
from ledgerlake.operators import spine as S
from ledgerlake.plans import ingest as I
from ledgerlake.plans.registry import query, shared
from ledgerlake.sources.snapshot import latest_period, latest_snapshot, max_of

# ---------------------------------------------------------------- joins


@query("star_enrichment", ["fact_sales", "part_attr", "fx_rates", "branch_freight", "cn_rates", "funding"], """
WITH cn AS (SELECT source, product_line, period, max(cn) AS cn FROM cn_rates GROUP BY source, product_line, period),
fu AS (SELECT trim(pn) AS pn, period, max(funding) AS funding FROM funding GROUP BY trim(pn), period)
SELECT f.l_orderkey, f.l_linenumber, f.part_number, a.model_name, a.cpu, x.fx_rate, b.freight, cn.cn, fu.funding
FROM fact_sales f
LEFT JOIN part_attr a ON a.part_number = f.part_number
LEFT JOIN fx_rates x ON x.product_line = f.product_line_id AND x.period = f.period
LEFT JOIN branch_freight b ON b.product_line = f.product_line_id AND b.sales_team = lower(f.branch) AND b.period = f.period
LEFT JOIN cn ON cn.source = f.source AND cn.product_line = f.product_line_id AND cn.period = f.period
LEFT JOIN fu ON fu.pn = f.part_number AND fu.period = f.period""")
def star_enrichment_q(t):
    """One fact, five lookups on 1-3 keys; every lookup deduplicated first
    so the fact's row count is preserved."""
    f = t["fact_sales"].select("l_orderkey", "l_linenumber", "part_number", "product_line_id", "period", "branch", "source")
    fund = t["funding"].select(F.trim("pn").alias("pn"), "period", "funding")
    out = L.star_enrich(f, [
        L.LookupSpec(t["part_attr"], {"part_number": "part_number"}, {"model_name": "model_name", "cpu": "cpu"}),
        L.LookupSpec(t["fx_rates"], {"product_line": "product_line_id", "period": "period"}, {"fx_rate": "fx_rate"}),
        L.LookupSpec(t["branch_freight"], {"product_line": "product_line_id", "sales_team": F.lower(F.col("branch")),
                                           "period": "period"}, {"freight": "freight"}),
        L.LookupSpec(t["cn_rates"], {"source": "source", "product_line": "product_line_id", "period": "period"},
                     {"cn": "cn"}),
        L.LookupSpec(fund, {"pn": "part_number", "period": "period"}, {"funding": "funding"}),
    ])
    return out.select("l_orderkey", "l_linenumber", "part_number", "model_name", "cpu", "fx_rate", "freight", "cn",
                      "funding")


@query("ci_join", ["quotes", "price_history"], """
WITH m AS (SELECT DISTINCT product_line, item_no FROM price_history)
SELECT q.item_no, q.group_no, q.po_price, m.product_line
FROM quotes q LEFT JOIN m ON upper(q.product_no) = upper(m.product_line) AND upper(q.item_no) = upper(m.item_no)""")
def ci_join_q(t):
    """Case-insensitive composite equi-join."""
    q = t["quotes"].select("item_no", "group_no", "po_price", "product_no")
    m = t["price_history"].select(F.col("product_line"), F.col("item_no").alias("m_item_no")).distinct()
    j = L.ci_join(q, m, ["product_no", "item_no"], right_keys=["product_line", "m_item_no"])
    return j.select("item_no", "group_no", "po_price", "product_line")


@query("like_join", ["part_attr"], """
WITH pat AS (SELECT DISTINCT '%' || upper(split_part(p_name, ' ', 2)) || '%' AS pattern,
                             upper(split_part(p_name, ' ', 2)) AS tag FROM part)
SELECT a.p_partkey, pat.tag FROM part_attr a JOIN pat ON a.item_desc LIKE pat.pattern""")
def like_join_q(t):
    """``text LIKE pattern`` with the pattern a column, as equi-joins on literal runs."""
    noun = F.upper(F.split(F.col("p_name"), " ").getItem(1))
    pat = t["part"].select(F.concat(F.lit("%"), noun, F.lit("%")).alias("pattern"), noun.alias("tag")).distinct()
    return L.like_join(t["part_attr"].select("p_partkey", "item_desc"), "item_desc", pat, "pattern").select(
        "p_partkey", "tag")


@query("expr_key_join", ["fact_sales", "fx_rates"], """
SELECT f.l_orderkey, f.l_linenumber, x.fx_rate
FROM fact_sales f LEFT JOIN fx_rates x
  ON substr(f.part_number, 3, 2) = x.product_line AND CAST(f.period AS BIGINT) = CAST(x.period AS BIGINT)""")
def expr_key_join_q(t):
    """Keys that are expressions (substring, cast) — still an equi-join."""
    f, x = t["fact_sales"], t["fx_rates"]
    return f.join(x, (F.substring(f["part_number"], 3, 2) == x["product_line"])
                  & (f["period"].cast("bigint") == x["period"].cast("bigint")), "left").select(
        "l_orderkey", "l_linenumber", "fx_rate")


def _cost_and_funding(t):
    cost = t["cost_pn"].groupBy("part_number", "period").agg(F.sum("item_cost_usd").cast("decimal(38,8)").alias("cost"))
    fund = (t["funding"].groupBy(F.trim("pn").alias("part_number"), "period")
            .agg(F.sum("funding").cast("decimal(38,4)").alias("funding")))
    return cost, fund


_COST_FUND_SQL = """cost AS (SELECT part_number, period, CAST(sum(item_cost_usd) AS DECIMAL(38,8)) AS cost FROM cost_pn GROUP BY part_number, period),
fund AS (SELECT trim(pn) AS part_number, period, CAST(sum(funding) AS DECIMAL(38,4)) AS funding FROM funding GROUP BY trim(pn), period)"""


@query("full_outer_coalesce", ["cost_pn", "funding"], f"""
WITH {_COST_FUND_SQL}
SELECT coalesce(c.part_number, f.part_number) AS part_number, coalesce(c.period, f.period) AS period, c.cost, f.funding
FROM cost c FULL OUTER JOIN fund f ON c.part_number = f.part_number AND c.period = f.period""")
def full_outer_coalesce_q(t):
    """Full outer join with coalesced keys."""
    cost, fund = _cost_and_funding(t)
    return S.full_outer_coalesce(cost, fund, ["part_number", "period"])


@query("full_outer_chain", ["cost_pn", "funding", "fact_sales"], f"""
WITH {_COST_FUND_SQL},
rev AS (SELECT part_number, period, CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue FROM fact_sales GROUP BY part_number, period)
SELECT coalesce(c.part_number, f.part_number, r.part_number) AS part_number,
       coalesce(c.period, f.period, r.period) AS period, c.cost, f.funding, r.revenue
FROM cost c FULL OUTER JOIN fund f ON c.part_number = f.part_number AND c.period = f.period
FULL OUTER JOIN rev r ON coalesce(c.part_number, f.part_number) = r.part_number AND coalesce(c.period, f.period) = r.period""")
def full_outer_chain_q(t):
    """Three-way full outer chain; the second condition uses the coalesced keys."""
    cost, fund = _cost_and_funding(t)
    rev = t["fact_sales"].groupBy("part_number", "period").agg(F.sum("revenue").cast("decimal(38,2)").alias("revenue"))
    return S.full_outer_coalesce(S.full_outer_coalesce(cost, fund, ["part_number", "period"]), rev,
                                 ["part_number", "period"])


@query("cross_skeleton", ["price_history"], """
SELECT p.product_line, p.item_no, t.period
FROM (SELECT DISTINCT product_line, item_no FROM price_history) p
CROSS JOIN (SELECT DISTINCT period FROM price_history) t""")
def cross_skeleton_q(t):
    """Every item × every target period (explode of a scalar period array)."""
    ph = t["price_history"]
    return S.period_skeleton(ph.select("product_line", "item_no").distinct(), ph.select("period"))


@query("key_spine", ["cost_pn", "funding", "fact_sales"], """
WITH k AS (SELECT part_number, period FROM cost_pn UNION SELECT trim(pn), period FROM funding
           UNION SELECT part_number, period FROM fact_sales),
c AS (SELECT part_number, period, sum(item_cost_usd) AS cost FROM cost_pn GROUP BY 1, 2),
f AS (SELECT trim(pn) AS part_number, period, sum(funding) AS funding FROM funding GROUP BY 1, 2),
r AS (SELECT part_number, period, sum(revenue) AS revenue FROM fact_sales GROUP BY 1, 2)
SELECT k.part_number, k.period, CAST(coalesce(c.cost, 0) AS DECIMAL(38,8)) AS cost,
  CAST(coalesce(f.funding, 0) AS DECIMAL(38,4)) AS funding, CAST(coalesce(r.revenue, 0) AS DECIMAL(38,2)) AS revenue
FROM k LEFT JOIN c ON k.part_number = c.part_number AND k.period = c.period
LEFT JOIN f ON k.part_number = f.part_number AND k.period = f.period
LEFT JOIN r ON k.part_number = r.part_number AND k.period = r.period""")
def key_spine_q(t):
    """J8 (+U4): union of key tuples from three tables, each measure attached, NULL → 0."""
    cost = t["cost_pn"].select("part_number", "period", F.col("item_cost_usd").alias("cost"))
    fund = t["funding"].select(F.trim("pn").alias("part_number"), "period", "funding")
    rev = t["fact_sales"].select("part_number", "period", "revenue")
    out = S.key_spine([(cost, ["cost"]), (fund, ["funding"]), (rev, ["revenue"])], ["part_number", "period"])
    return out.select("part_number", "period", F.col("cost").cast("decimal(38,8)").alias("cost"),
                      F.col("funding").cast("decimal(38,4)").alias("funding"),
                      F.col("revenue").cast("decimal(38,2)").alias("revenue"))


@query("inner_via_left", ["fact_sales", "funding"], """
SELECT f.l_orderkey, f.l_linenumber, fu.funding
FROM fact_sales f LEFT JOIN funding fu ON trim(fu.pn) = f.part_number AND fu.period = f.period
WHERE fu.funding IS NOT NULL""")
def inner_via_left_q(t):
    """A left join filtered on a right column is an inner join — written as one."""
    f = t["fact_sales"]
    fu = t["funding"].select(F.trim("pn").alias("pn"), F.col("period").alias("fperiod"), "funding")
    return f.join(fu, (fu["pn"] == f["part_number"]) & (fu["fperiod"] == f["period"]) & fu["funding"].isNotNull(),
                  "inner").select("l_orderkey", "l_linenumber", "funding")


@query("dual_path_lookup", ["quotes", "price_history"], """
WITH a AS (SELECT item_no, period, max(equo_price) AS p FROM price_history GROUP BY item_no, period),
b AS (SELECT ag_no, period, max(equo_price) AS p FROM price_history GROUP BY ag_no, period)
SELECT q.item_no, q.group_no, coalesce(a.p, b.p) AS equo_price
FROM quotes q LEFT JOIN a ON a.item_no = q.item_no AND a.period = q.group_no
LEFT JOIN b ON b.ag_no = q.ag_no AND b.period = q.group_no""")
def dual_path_lookup_q(t):
    """Match on (item, period), else on (group, period)."""
    q = t["quotes"].select("item_no", "ag_no", "group_no")
    out = L.fallback_lookup(q, t["price_history"], [{"item_no": "item_no", "period": "group_no"},
                                                   {"ag_no": "ag_no", "period": "group_no"}], "equo_price", "equo_price")
    return out.select("item_no", "group_no", "equo_price")


@query("asof_latest", ["cost_pn", "price_history"], """
SELECT part_number, period, item_cost_usd FROM (
  SELECT part_number, period, item_cost_usd,
    row_number() OVER (PARTITION BY part_number ORDER BY period DESC, item_cost_usd DESC) AS rn
  FROM cost_pn WHERE period <= (SELECT max(period) FROM price_history)) q WHERE rn = 1""")
def asof_latest_q(t):
    """Per part, the latest cost at or before the anchor period."""
    anchor = max_of(t["price_history"], "period")
    return W.asof_latest(t["cost_pn"], ["part_number"], "period", anchor, ["item_cost_usd"])


CN_CASCADE_SQL = """cn_rules AS (
  SELECT rule, product_line, code, period, max(cn) AS cn FROM (
    SELECT product_line, period, cn,
      CASE WHEN source = 'ACCRAW' THEN 'rmb' WHEN channel_code IN ('ACI-Retail', 'Channel-SA') THEN 'retail'
           WHEN starts_with(channel_code, 'Other Channel') THEN 'other' ELSE 'named' END AS rule,
      CASE WHEN source = 'ACCRAW' THEN legal_entity || '|' || channel_code
           WHEN starts_with(channel_code, 'Other Channel') THEN legal_entity ELSE channel_code END AS code FROM cn_rates) x GROUP BY ALL),
cn_codes AS (SELECT *, CASE WHEN source = 'ACCRAW' THEN 'OU1|' || distribution_type END AS c_rmb,
    CASE WHEN source = 'ACIRAW' THEN CASE WHEN country_code <> 'US' THEN 'Online' WHEN branch = 'US-Retail' THEN 'ACI-Retail' ELSE branch END END AS c_retail,
    CASE WHEN source = 'ACIRAW' THEN IF(distribution_type = 'F', 'Walmart', 'Other') || '-' || country_code END AS c_named,
    CASE WHEN source = 'ACIRAW' THEN country_code END AS c_other FROM fact_sales),
cascade AS (
  SELECT f.* EXCLUDE (c_rmb, c_retail, c_named, c_other), CASE WHEN f.source = 'ACIRAW' AND f.business_type = 'REFURBISH'
    THEN CAST(0 AS DECIMAL(8,4)) ELSE coalesce(a.cn, b.cn, c.cn, d.cn) END AS cn
  FROM cn_codes f
  LEFT JOIN cn_rules a ON a.rule = 'rmb' AND a.product_line = f.product_line_id AND a.period = f.period AND a.code = f.c_rmb
  LEFT JOIN cn_rules b ON b.rule = 'retail' AND b.product_line = f.product_line_id AND b.period = f.period AND b.code = f.c_retail
  LEFT JOIN cn_rules c ON c.rule = 'named' AND c.product_line = f.product_line_id AND c.period = f.period AND c.code = f.c_named
  LEFT JOIN cn_rules d ON d.rule = 'other' AND d.product_line = f.product_line_id AND d.period = f.period AND d.code = f.c_other)"""


@shared
def cn_cascade(t):
    """Credit-note rate by the first matching rule (shared by J12, D8 and the enriched fact); the adapter
    fact has no ou, branch2 and customer, so they are derived from branch, country and distribution type."""
    branch2 = (F.when(F.col("country_code") != "US", F.lit("Online")).when(F.col("branch") == "US-Retail", F.lit("ACI-Retail"))
               .otherwise(F.col("branch")))
    customer = F.when(F.col("distribution_type") == "F", F.lit("Walmart")).otherwise(F.lit("Other"))
    return I.credit_note_rate(t["fact_sales"], t["cn_rates"], F.lit("OU1"), branch2, customer)


@query("match_cascade", ["fact_sales", "cn_rates"], f"""
WITH {CN_CASCADE_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, cn FROM cascade""")
def match_cascade_q(t):
    """Keyed rules over subsets of one lookup and a literal rule, first match wins."""
    return cn_cascade(t).select("l_orderkey", "l_linenumber", "l_partkey", "cn")


@query("unique_lookup", ["fact_sales", "funding"], """
WITH u AS (SELECT pn, funding FROM (
  SELECT trim(pn) AS pn, funding, row_number() OVER (PARTITION BY trim(pn) ORDER BY period DESC, funding DESC) AS rn
  FROM funding) q WHERE rn = 1)
SELECT f.l_orderkey, f.l_linenumber, u.funding FROM fact_sales f LEFT JOIN u ON u.pn = f.part_number""")
def unique_lookup_q(t):
    """One row per trimmed key (latest wins), then a non-fanning left join."""
    u = L.dedupe_lookup(t["funding"], ["pn"], ["funding"], order_by=["period"])
    f = t["fact_sales"]
    return f.join(u, u["pn"] == f["part_number"], "left").select("l_orderkey", "l_linenumber", "funding")


@query("subset_lookup", ["fact_sales", "cost_pn"], """
WITH lp AS (SELECT part_number, max(period) AS cost_period FROM cost_pn GROUP BY part_number)
SELECT f.l_orderkey, f.l_linenumber,
  CASE WHEN f.product_line_id IN ('NB', 'NV') THEN coalesce(lp.cost_period, f.period) ELSE f.period END AS cost_period
FROM fact_sales f LEFT JOIN lp ON lp.part_number = f.part_number""")
def subset_lookup_q(t):
    """NB and NV rows take the part's latest cost period, others keep their own period."""
    f = t["fact_sales"]
    lp = t["cost_pn"].groupBy("part_number").agg(F.max("period").alias("cost_period"))
    out = L.subset_lookup(f, F.col("product_line_id").isin("NB", "NV"), lp, f["part_number"], "part_number",
                          "cost_period", F.col("period"), "cost_period")
    return out.select("l_orderkey", "l_linenumber", "cost_period")


@query("split_join_union", ["fact_sales", "branch_freight"], """
WITH b1 AS (SELECT product_line, sales_team, period, max(freight) AS freight FROM branch_freight GROUP BY 1, 2, 3),
b2 AS (SELECT product_line, period, max(freight) AS freight FROM branch_freight GROUP BY 1, 2)
SELECT f.l_orderkey, f.l_linenumber, b1.freight FROM fact_sales f LEFT JOIN b1
  ON b1.product_line = f.product_line_id AND b1.sales_team = lower(f.branch) AND b1.period = f.period
WHERE f.product_line_id = 'NB'
UNION ALL
SELECT f.l_orderkey, f.l_linenumber, b2.freight FROM fact_sales f LEFT JOIN b2
  ON b2.product_line = f.product_line_id AND b2.period = f.period
WHERE f.product_line_id IN ('NR', 'NV')""")
def split_join_union_q(t):
    """NB rows keyed by (line, branch, period); NR/NV by (line, period); then union."""
    f = t["fact_sales"].select("l_orderkey", "l_linenumber", "product_line_id", "period",
                               F.lower("branch").alias("team"))
    bf = t["branch_freight"]
    out = L.split_join_union(f, [
        (F.col("product_line_id") == "NB", bf, {"product_line_id": "product_line", "team": "sales_team",
                                                 "period": "period"}, ["freight"]),
        (F.col("product_line_id").isin("NR", "NV"), bf, {"product_line_id": "product_line", "period": "period"},
         ["freight"]),
    ])
    return out.select("l_orderkey", "l_linenumber", "freight")


@query("bom_explode", ["price_history", "bom"], """
WITH b AS (SELECT part_number_kp, part_number_90, sum(kp_qty) AS kp_qty FROM bom GROUP BY 1, 2)
SELECT p.item_no, p.period, p.equo_price, b.part_number_90, CAST(b.kp_qty AS DECIMAL(38,2)) AS kp_qty
FROM price_history p LEFT JOIN b ON p.item_no = b.part_number_kp""")
def bom_explode_q(t):
    """Component price rows exploded to finished parts (summed quantity)."""
    p = t["price_history"].select("item_no", "period", "equo_price")
    out = L.bom_explode(p, t["bom"], "item_no", "part_number_kp", "part_number_90", "kp_qty")
    return out.select("item_no", "period", "equo_price", "part_number_90",
                      F.col("kp_qty").cast("decimal(38,2)").alias("kp_qty"))


@query("role_playing_join", ["fact_sales", "fx_rates"], """
SELECT f.l_orderkey, f.l_linenumber, cur.fx_rate AS fx_rate, prv.fx_rate AS prev_fx_rate
FROM fact_sales f
LEFT JOIN fx_rates cur ON cur.product_line = f.product_line_id AND cur.period = f.period
LEFT JOIN fx_rates prv ON prv.product_line = f.product_line_id
  AND prv.period = strftime(strptime(f.period, '%Y%m') - INTERVAL 1 MONTH, '%Y%m')""")
def role_playing_join_q(t):
    """The FX table joined twice, for the month and the month before."""
    f = t["fact_sales"].withColumn("prev_period", add_months_period("period", -1))
    x = t["fx_rates"]
    cur = x.select(F.col("product_line").alias("c_pl"), F.col("period").alias("c_p"), F.col("fx_rate"))
    prv = x.select(F.col("product_line").alias("p_pl"), F.col("period").alias("p_p"), F.col("fx_rate").alias("prev_fx_rate"))
    j = (f.join(cur, (F.col("c_pl") == f["product_line_id"]) & (F.col("c_p") == f["period"]), "left")
         .join(prv, (F.col("p_pl") == f["product_line_id"]) & (F.col("p_p") == F.col("prev_period")), "left"))
    return j.select("l_orderkey", "l_linenumber", "fx_rate", "prev_fx_rate")


@query("bridge_join", ["bom", "part_attr", "funding"], """
SELECT DISTINCT b.part_number_90, a.part_number AS kp_part_number, fu.period, fu.funding
FROM bom b JOIN part_attr a ON a.item_no = b.part_number_kp
JOIN funding fu ON trim(fu.pn) = a.part_number AND substr(b.part_number_90, 11, 2) = substr(a.part_number, 11, 2)""")
def bridge_join_q(t):
    """Finished part → component item → part → funding, with a product-line check."""
    b, a = t["bom"], t["part_attr"].select("item_no", F.col("part_number").alias("kp_part_number"))
    fu = t["funding"].select(F.trim("pn").alias("pn"), "period", "funding")
    j = (b.join(a, a["item_no"] == b["part_number_kp"])
         .join(fu, (fu["pn"] == F.col("kp_part_number"))
               & (F.substring(b["part_number_90"], 11, 2) == F.substring(F.col("kp_part_number"), 11, 2))))
    return j.select("part_number_90", "kp_part_number", "period", "funding").distinct()


@query("semi_join_periods", ["quotes", "price_history"], """
WITH anchor AS (SELECT max(period) AS p FROM price_history)
SELECT item_no, group_no, po_price FROM quotes
WHERE group_no IN ((SELECT p FROM anchor),
                   (SELECT strftime(strptime(p, '%Y%m') + INTERVAL 1 MONTH, '%Y%m') FROM anchor),
                   (SELECT strftime(strptime(p, '%Y%m') + INTERVAL 2 MONTH, '%Y%m') FROM anchor))""")
def semi_join_periods_q(t):
    """Keep quotes of the anchor month and the two after it (semi-join to a 3-row set)."""
    anchor = t["price_history"].agg(F.max("period").alias("p"))
    periods = anchor.select(F.explode(F.array(F.col("p"), add_months_period("p", 1), add_months_period("p", 2)))
                            .alias("period"))
    return L.semi_join_values(t["quotes"].select("item_no", "group_no", "po_price"), "group_no", periods, "period")


@query("anti_join", ["order_snapshots"], """
SELECT s.o_orderkey, s.period, s.amount FROM order_snapshots s
WHERE s.ds = (SELECT max(ds) FROM order_snapshots)
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey % 5 = 0 AND o.o_orderkey = s.o_orderkey)""")
def anti_join_q(t):
    """Stored rows not touched by the incoming keys."""
    target = latest_snapshot(t["order_snapshots"]).select("o_orderkey", "period", "amount")
    incoming = t["orders"].where(F.col("o_orderkey") % 5 == 0).select("o_orderkey")
    return L.anti_join(target, incoming, ["o_orderkey"])


@query("attach_rate", ["fact_sales", "fx_rates"], """
WITH r AS (SELECT fx_rate FROM fx_rates WHERE product_line = 'NB' AND period = (SELECT max(period) FROM fx_rates))
SELECT f.l_orderkey, f.l_linenumber, r.fx_rate,
  CAST(CAST(f.revenue AS DECIMAL(20,8)) * CAST(r.fx_rate AS DECIMAL(17,7)) AS DECIMAL(34,15)) AS revenue_ntd
FROM fact_sales f LEFT JOIN r ON true""")
def attach_rate_q(t):
    """One FX row for the chosen month attached to every row (scalar subquery, no join)."""
    x = t["fx_rates"]
    one = x.where((F.col("product_line") == "NB") & (F.col("period") == max_of(x, "period"))).select("fx_rate")
    f = L.attach_constant(t["fact_sales"].select("l_orderkey", "l_linenumber", "revenue"), one)
    return f.select("l_orderkey", "l_linenumber", "fx_rate", M.mul("revenue", "fx_rate").alias("revenue_ntd"))


@query("map_or_keep", ["raw_text_sales"], """
WITH m AS (SELECT upper(substr(r_name, 1, 2)) AS code, max(r_name) AS name FROM region GROUP BY 1)
SELECT s.row_key, coalesce(m.name, s.region) AS region
FROM raw_text_sales s LEFT JOIN m ON upper(trim(s.region)) = m.code""")
def map_or_keep_q(t):
    """Mapped value when the code is known, else the original text."""
    m = L.dedupe_lookup(t["region"].select(F.upper(F.substring("r_name", 1, 2)).alias("code"), "r_name"),
                        ["code"], ["r_name"], normalize_keys=False)
    s = t["raw_text_sales"].select("row_key", "region", F.upper(F.trim("region")).alias("region_key"))
    return L.map_or_keep(s, "region_key", m, "code", "r_name", out="mapped").select(
        "row_key", F.coalesce(F.when(F.col("mapped") != F.col("region_key"), F.col("mapped")),
                              F.col("region")).alias("region"))


@query("two_key_lookup", ["fact_sales", "branch_freight"], """
WITH b AS (SELECT product_line, sales_team, period, max(freight) AS freight FROM branch_freight GROUP BY 1, 2, 3)
SELECT f.l_orderkey, f.l_linenumber, coalesce(b1.freight, b2.freight) AS freight
FROM fact_sales f
LEFT JOIN b b1 ON b1.product_line = f.product_line_id AND b1.sales_team = lower(f.branch) AND b1.period = f.period
LEFT JOIN b b2 ON b2.product_line = f.product_line_id AND b2.sales_team = lower(f.branch)
  AND b2.period = strftime(strptime(f.period, '%Y%m') - INTERVAL 1 MONTH, '%Y%m')""")
def two_key_lookup_q(t):
    """Freight for the row's month, else the previous month's."""
    f = t["fact_sales"].select("l_orderkey", "l_linenumber", "product_line_id", "branch", "period")
    out = L.fallback_lookup(f, t["branch_freight"], [
        {"product_line": "product_line_id", "sales_team": F.lower(F.col("branch")), "period": "period"},
        {"product_line": "product_line_id", "sales_team": F.lower(F.col("branch")),
         "period": add_months_period("period", -1)}], "freight", "freight")
    return out.select("l_orderkey", "l_linenumber", "freight")

# ---------------------------------------------------------------- aggregates


@query("group_avg", ["price_history"], """
SELECT ag_no, period, CAST(sum(equo_price) AS DOUBLE) / CAST(count(equo_price) AS DOUBLE) AS avg_equo_price
FROM price_history GROUP BY ag_no, period""")
def group_avg_q(t):
    """A1: grouped average (SQL semantics keep the NULL group)."""
    return A.group_avg(t["price_history"], ["ag_no", "period"], "equo_price", "avg_equo_price")


@query("weighted_unit", ["fact_sales"], """
SELECT product_line_id, period,
  CAST(sum(revenue) AS DOUBLE) / NULLIF(CAST(sum(all_qty) AS DOUBLE), 0) AS unit_price
FROM fact_sales GROUP BY product_line_id, period""")
def weighted_unit_q(t):
    """A2: SUM(x) / NULLIF(SUM(q), 0)."""
    return t["fact_sales"].groupBy("product_line_id", "period").agg(A.weighted_unit("revenue", "all_qty").alias("unit_price"))


@query("conditional_pivot", ["fact_sales"], """
SELECT period, CAST(sum(CASE WHEN business_type IN ('Retail') THEN revenue END) AS DECIMAL(38,2)) AS retail_revenue,
  CAST(sum(CASE WHEN business_type IN ('Channel', 'REFURBISH') THEN revenue END) AS DECIMAL(38,2)) AS channel_revenue
FROM fact_sales GROUP BY period""")
def conditional_pivot_q(t):
    """A3 / R2: category → column; two categories feed one column."""
    out = A.conditional_pivot(t["fact_sales"], ["period"], "business_type", "revenue",
                              {"retail_revenue": ["Retail"], "channel_revenue": ["Channel", "REFURBISH"]})
    return out.select("period", *[F.col(c).cast("decimal(38,2)").alias(c) for c in ("retail_revenue", "channel_revenue")])


@query("group_sum", ["bom"], """
SELECT part_number_90, CAST(sum(kp_qty) AS DECIMAL(38,2)) AS total_kp_qty FROM bom GROUP BY part_number_90""")
def group_sum_q(t):
    """A4: grouped sum."""
    out = A.group_sum(t["bom"], ["part_number_90"], "kp_qty", "total_kp_qty")
    return out.withColumn("total_kp_qty", F.col("total_kp_qty").cast("decimal(38,2)"))


@query("distinct_rows", ["fact_sales"], """
SELECT DISTINCT product_line_id, branch, period FROM fact_sales""")
def distinct_rows_q(t):
    """A5: distinct projection."""
    return t["fact_sales"].select("product_line_id", "branch", "period").distinct()


@query("global_agg", ["fact_sales"], """
SELECT max(period) AS max_period, count(*) AS n_rows FROM fact_sales""")
def global_agg_q(t):
    """Global max / count."""
    return t["fact_sales"].agg(F.max("period").alias("max_period"), F.count(F.lit(1)).alias("n_rows"))


@query("carried_key_agg", ["fact_sales", "fx_rates"], """
SELECT f.product_line_id, f.period, x.fx_rate,
  CAST(sum(f.revenue) AS DOUBLE) / NULLIF(CAST(x.fx_rate AS DOUBLE), 0) AS revenue_usd
FROM fact_sales f JOIN fx_rates x ON x.product_line = f.product_line_id AND x.period = f.period
GROUP BY f.product_line_id, f.period, x.fx_rate""")
def carried_key_agg_q(t):
    """The rate is carried in the GROUP BY so it can be used after aggregation."""
    f, x = t["fact_sales"], t["fx_rates"]
    j = f.join(x, (x["product_line"] == f["product_line_id"]) & (x["period"] == f["period"]))
    g = j.groupBy(f["product_line_id"], f["period"], x["fx_rate"]).agg(F.sum("revenue").alias("rev"))
    return g.select("product_line_id", "period", "fx_rate", M.ratio("rev", "fx_rate").alias("revenue_usd"))


@query("duplicate_keys", ["fact_sales"], """
SELECT l_orderkey, l_linenumber, l_partkey, revenue FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, revenue,
         count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM fact_sales) q WHERE n > 1""")
def duplicate_keys_q(t):
    """Every member of each duplicated (order, line) key."""
    return A.duplicate_keys(t["fact_sales"].select("l_orderkey", "l_linenumber", "l_partkey", "revenue"),
                            ["l_orderkey", "l_linenumber"])


@query("two_level_agg", ["cost_pn", "price_history"], """
WITH per AS (SELECT part_number, period, CAST(sum(item_cost_usd) AS DOUBLE) / CAST(count(item_cost_usd) AS DOUBLE) AS avg_cost
             FROM cost_pn GROUP BY part_number, period)
SELECT part_number, period, avg_cost FROM (
  SELECT *, row_number() OVER (PARTITION BY part_number ORDER BY period DESC, avg_cost DESC) AS rn
  FROM per WHERE period <= (SELECT max(period) FROM price_history)) q WHERE rn = 1""")
def two_level_agg_q(t):
    """Average per (part, period), then the latest period at or before the anchor."""
    return W.two_level_agg(t["cost_pn"], ["part_number"], "period", "item_cost_usd",
                           max_of(t["price_history"], "period"), "avg_cost")

# ---------------------------------------------------------------- windows


@query("latest_per_key", ["price_history"], """
SELECT item_no, period, equo_price, cogs_price FROM (
  SELECT *, row_number() OVER (PARTITION BY item_no ORDER BY period DESC, equo_price DESC, cogs_price DESC NULLS LAST) AS rn
  FROM price_history) q WHERE rn = 1""")
def latest_per_key_q(t):
    """ROW_NUMBER() … ORDER BY period DESC = 1, as an arg-max aggregate."""
    return W.latest_per_key(t["price_history"], ["item_no"], "period", ["equo_price", "cogs_price"])


@query("window_over_agg", ["fact_sales"], """
SELECT product_line_id, period, revenue,
  CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER (PARTITION BY product_line_id) AS DOUBLE) AS share
FROM (SELECT product_line_id, period, CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue FROM fact_sales
      GROUP BY product_line_id, period) g""")
def window_over_agg_q(t):
    """A window over an already aggregated (small) result."""
    g = t["fact_sales"].groupBy("product_line_id", "period").agg(F.sum("revenue").cast("decimal(38,2)").alias("revenue"))
    total = F.sum("revenue").over(Window.partitionBy("product_line_id"))
    return g.select("product_line_id", "period", "revenue",
                    (F.col("revenue").cast("double") / total.cast("double")).alias("share"))


@query("priority_pick", ["bom"], """
SELECT part_number_90, part_number_kp, kp_qty FROM (
  SELECT *, row_number() OVER (PARTITION BY part_number_90
    ORDER BY CASE WHEN substitute_type = 'M' THEN 0 ELSE 1 END, kp_qty DESC, part_number_kp DESC) AS rn
  FROM bom) q WHERE rn = 1""")
def priority_pick_q(t):
    """Order by a CASE rank, then quantity descending (total tie-break)."""
    rank = F.when(F.col("substitute_type") == "M", F.lit(0)).otherwise(F.lit(1))
    return W.priority_pick(t["bom"], ["part_number_90"], rank, "kp_qty", ["part_number_kp", "kp_qty"])


@query("first_in_group", ["price_history"], """
SELECT item_no, period, row_number() OVER (PARTITION BY item_no ORDER BY period NULLS LAST) = 1 AS is_first
FROM price_history""")
def first_in_group_q(t):
    """Flag each item's first period."""
    return W.first_in_group(t["price_history"].select("item_no", "period"), ["item_no"], "period")


CARRY_SQL = """cur AS (SELECT upper(product_no) AS product_line, item_no, group_no AS period,
                    CAST(sum(po_price) AS DOUBLE) / CAST(count(po_price) AS DOUBLE) AS price
             FROM quotes WHERE group_no > (SELECT max(period) FROM price_history) GROUP BY 1, 2, 3),
hist AS (SELECT product_line, item_no, period, CAST(equo_price AS DOUBLE) AS price FROM price_history),
last AS (SELECT * FROM hist WHERE period = (SELECT max(period) FROM hist)),
items AS (SELECT product_line, item_no FROM cur UNION SELECT product_line, item_no FROM hist),
periods AS (SELECT period FROM cur UNION SELECT period FROM hist),
skel AS (SELECT i.product_line, i.item_no, p.period FROM items i CROSS JOIN periods p WHERE p.period IS NOT NULL)"""


@query("carry_forward", ["quotes", "price_history"], f"""
WITH {CARRY_SQL}
SELECT s.product_line, s.item_no, s.period, coalesce(c.price, h.price, l.price) AS price
FROM skel s
LEFT JOIN cur c ON c.product_line = s.product_line AND c.item_no = s.item_no AND c.period = s.period
LEFT JOIN hist h ON h.product_line = s.product_line AND h.item_no = s.item_no AND h.period = s.period
LEFT JOIN last l ON l.product_line = s.product_line AND l.item_no = s.item_no""")
def carry_forward_q(t):
    """W5 (+J7): items × periods skeleton filled by current → stored same period → latest stored; the current quotes are
    those after the stored history's last month."""
    q = t["quotes"].where(F.col("group_no") > max_of(t["price_history"], "period"))
    cur = (q.groupBy(F.upper("product_no").alias("product_line"), "item_no", F.col("group_no").alias("period"))
           .agg(A.mean("po_price").alias("price")))
    hist = t["price_history"].select("product_line", "item_no", "period", F.col("equo_price").cast("double").alias("price"))
    items = S.key_union([cur, hist], ["product_line", "item_no"])
    skel = S.period_skeleton(items, cur.select("period").unionByName(hist.select("period")))
    return S.carry_forward(skel, cur, hist, ["product_line", "item_no"], "period", ["price"])

# ---------------------------------------------------------------- sort / limit


@query("ordered_list", ["part_attr"], """
SELECT DISTINCT model_name FROM part_attr WHERE model_name IS NOT NULL""")
def ordered_list_q(t):
    """L2: ordered distinct list."""
    return A.ordered_list(t["part_attr"], "model_name")


@query("violation_sample", ["fact_sales"], """
WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, revenue FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, revenue, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
  FROM fact_sales) q WHERE n > 1)
SELECT l_orderkey, l_linenumber, l_partkey, revenue, greatest((SELECT count(*) FROM d) - 100, 0) AS rest_count
FROM d ORDER BY l_orderkey, l_linenumber, l_partkey, revenue LIMIT 100""")
def violation_sample_q(t):
    """L3: first 100 violating rows in key order plus the count of the rest."""
    dups = A.duplicate_keys(t["fact_sales"].select("l_orderkey", "l_linenumber", "l_partkey", "revenue"),
                            ["l_orderkey", "l_linenumber"])
    sample, rest = A.violation_sample(dups, ["l_orderkey", "l_linenumber", "l_partkey", "revenue"], 100)
    return sample.withColumn("rest_count", rest)

# ---------------------------------------------------------------- set operations


@query("union_distinct", ["quotes", "part_attr"], """
SELECT 'NB' AS project_no, item_no, ag_no FROM quotes WHERE product_no = 'nb'
UNION
SELECT 'NR' AS project_no, item_no, CAST(NULL AS VARCHAR) AS ag_no FROM part_attr WHERE item_no LIKE '01%'""")
def union_distinct_q(t):
    """SQL UNION of tagged branches, typed NULL for a missing key."""
    a = t["quotes"].where(F.col("product_no") == "nb").select(F.lit("NB").alias("project_no"), "item_no", "ag_no")
    b = t["part_attr"].where(F.col("item_no").startswith("01")).select(F.lit("NR").alias("project_no"), "item_no")
    return U.union_distinct([a, b])


@query("union_all", ["fact_sales"], """
SELECT l_orderkey, l_linenumber, source, revenue FROM fact_sales WHERE source = 'ACCRAW'
UNION ALL
SELECT l_orderkey, l_linenumber, source, revenue FROM fact_sales WHERE source = 'ACIRAW'""")
def union_all_q(t):
    """UNION ALL of same-contract branches."""
    f = t["fact_sales"].select("l_orderkey", "l_linenumber", "source", "revenue")
    return U.union_all([f.where(F.col("source") == "ACCRAW"),
                        f.where(F.col("source") == "ACIRAW")])


@query("union_by_name", ["fact_sales"], """
SELECT l_orderkey, l_linenumber, revenue, all_qty FROM fact_sales WHERE product_line_id = 'NB'
UNION ALL
SELECT l_orderkey, l_linenumber, revenue, all_qty FROM fact_sales WHERE product_line_id <> 'NB'""")
def union_by_name_q(t):
    """Union by name of two frames whose columns come in different orders."""
    f = t["fact_sales"]
    a = f.where(F.col("product_line_id") == "NB").select("l_orderkey", "l_linenumber", "revenue", "all_qty")
    b = f.where(F.col("product_line_id") != "NB").select("all_qty", "revenue", "l_linenumber", "l_orderkey")
    return U.union_all([a, b])


@query("key_union", ["cost_pn", "funding", "fact_sales"], """
SELECT part_number, period FROM cost_pn UNION SELECT trim(pn), period FROM funding
UNION SELECT part_number, period FROM fact_sales""")
def key_union_q(t):
    """U4: distinct key tuples from several tables."""
    return S.key_union([t["cost_pn"], t["funding"].select(F.trim("pn").alias("part_number"), "period"),
                        t["fact_sales"]], ["part_number", "period"])


@query("period_accumulate", ["order_snapshots"], """
WITH days AS (SELECT DISTINCT ds FROM order_snapshots),
hist AS (SELECT o_orderkey, period, amount FROM order_snapshots
         WHERE ds = (SELECT max(ds) FROM days WHERE ds < (SELECT max(ds) FROM days))),
new AS (SELECT o_orderkey, period, amount FROM order_snapshots WHERE ds = (SELECT max(ds) FROM days)
        AND period = (SELECT max(period) FROM order_snapshots WHERE ds = (SELECT max(ds) FROM days)))
SELECT * FROM hist WHERE period <> (SELECT max(period) FROM new) UNION ALL SELECT * FROM new""")
def period_accumulate_q(t):
    """The snapshot before the newest, without the newest one's last period ∪ that period."""
    s = t["order_snapshots"]
    newest = max_of(s, "ds")
    hist = latest_snapshot(s.where(F.col("ds") < newest)).select("o_orderkey", "period", "amount")
    return U.period_accumulate(hist, latest_period(s).select("o_orderkey", "period", "amount"))


@query("restatement", ["order_snapshots"], """
WITH prov AS (SELECT o_orderkey, period, amount FROM order_snapshots WHERE ds = (SELECT max(ds) FROM order_snapshots)),
first AS (SELECT o_orderkey, period, amount FROM order_snapshots WHERE ds = (SELECT min(ds) FROM order_snapshots)),
rest AS (SELECT * FROM first WHERE period = (SELECT max(period) FROM first))
SELECT * FROM prov WHERE period <> coalesce((SELECT max(period) FROM rest), '') UNION ALL SELECT * FROM rest""")
def restatement_q(t):
    """The newest snapshot's periods except the restated one ∪ the restated rows: the last period of the oldest snapshot."""
    s = t["order_snapshots"]
    oldest = s.where(F.col("ds") == s.select(F.min("ds")).scalar())
    rest = latest_period(oldest, ds=None).select("o_orderkey", "period", "amount")
    return U.restatement(latest_snapshot(s).select("o_orderkey", "period", "amount"), rest)

# ---------------------------------------------------------------- reshape


@query("unpivot_matrix", ["fact_sales"], """
WITH m AS (SELECT period,
  CAST(sum(CASE WHEN product_line_id = 'NB' AND source = 'ACCRAW' THEN revenue END) AS DECIMAL(38,2)) AS nb,
  CAST(sum(CASE WHEN product_line_id = 'NR' AND source = 'ACCRAW' THEN revenue END) AS DECIMAL(38,2)) AS nr,
  CAST(sum(CASE WHEN product_line_id = 'NV' AND branch = 'ACC' THEN revenue END) AS DECIMAL(38,2)) AS nv
  FROM fact_sales GROUP BY period)
SELECT period, 'nb' AS product_line, nb AS revenue, 'fx matrix' AS label FROM m WHERE nb IS NOT NULL
UNION ALL SELECT period, 'nr', nr, 'fx matrix' FROM m WHERE nr IS NOT NULL
UNION ALL SELECT period, 'nv', nv, 'fx matrix' FROM m WHERE nv IS NOT NULL""")
def unpivot_matrix_q(t):
    """Period × product-line matrix → rows, NULL cells dropped, label added."""
    f = t["fact_sales"]
    m = f.groupBy("period").agg(
        F.sum(F.when((F.col("product_line_id") == "NB") & (F.col("source") == "ACCRAW"), F.col("revenue"))).cast("decimal(38,2)").alias("nb"),
        F.sum(F.when((F.col("product_line_id") == "NR") & (F.col("source") == "ACCRAW"), F.col("revenue"))).cast("decimal(38,2)").alias("nr"),
        F.sum(F.when((F.col("product_line_id") == "NV") & (F.col("branch") == "ACC"), F.col("revenue"))).cast("decimal(38,2)").alias("nv"))
    return A.unpivot_matrix(m, ["period"], ["nb", "nr", "nv"], "product_line", "revenue", label="fx matrix")
