"""Verified queries: ingest facts and loaders."""

from pyspark.sql import functions as F

from ledgerlake.functions import money as M
from ledgerlake.operators import lookup as L
from ledgerlake.plans import grossprofit as GP
from ledgerlake.plans import ingest as I
from ledgerlake.plans.q_gross import local_sql
from ledgerlake.plans.q_relational import CN_CASCADE_SQL, cn_cascade
from ledgerlake.plans.registry import query, shared

# ---------------------------------------------------------------- Spark side


@shared
def acc(t, monthly: bool):
    return I.acc_fact(t["acc_sheet"], t["org_map"], t["ordertype_map"], t["distribution_map"], t["fx_rates"], monthly)


@shared
def aci(t, monthly: bool):
    return (I.aci_monthly if monthly else I.aci_weekly)(t["aci_sheet"], t["country_names"])

# ---------------------------------------------------------------- SQL side


def _safe(x):
    return f"TRY_CAST(CASE WHEN trim(replace({x}, ',', '')) <> '' THEN trim(replace({x}, ',', '')) END AS DECIMAL(38,15))"


def _xd(x):
    return f"CAST(CAST({x} AS DECIMAL(38,6)) AS DOUBLE)"


def _fxdiv(a, r):
    return f"CASE WHEN {_xd(r)} <> 0 THEN {_xd(a)} / {_xd(r)} END"


def _norm_period(x):
    return f"rpad(regexp_replace({x}, '[^0-9]', '', 'g'), 6, '0')"


def _quarter(p):
    m = f"TRY_CAST(substr({p}, 5, 2) AS INTEGER)"
    return (f"CASE WHEN {m} BETWEEN 1 AND 3 THEN 'Q1' WHEN {m} BETWEEN 4 AND 6 THEN 'Q2' "
            f"WHEN {m} BETWEEN 7 AND 9 THEN 'Q3' ELSE 'Q4' END")


def acc_sql(monthly: bool, name: str) -> str:
    keep = "trim(a.is_complete) = 'Y'" if monthly else "trim(a.category) = 'FG'"
    rev = _safe("sales_net" if monthly else "sales_revenue")
    cost = f"-{_safe('sales_cost')}" if monthly else _safe("sales_cost")
    extra = "" if monthly else f""",
  -{_safe('sales_discount')} AS credit_note_rmb, {_fxdiv(f"-{_safe('sales_discount')}", 'fx_rate')} AS credit_note_hedge_rate,
  {_fxdiv(f"-{_safe('sales_discount')}", 'fx_rate_ex')} AS credit_note_fxdiff,
  {_safe('sales_net')} AS net_revenue_rmb, {_fxdiv(_safe('sales_net'), 'fx_rate')} AS net_revenue_usd_agp,
  {_fxdiv(_safe('sales_net'), 'fx_rate_ex')} AS net_revenue_fxdiff"""
    kw = " OR ".join(f"contains(upper(a.order_type), '{k}')" for k in I.ACC_ORDER_EXCLUDE)
    return f"""{name}_om AS (SELECT trim(org) AS org, max(product_type) AS product_type FROM org_map GROUP BY 1),
{name}_otm AS (SELECT trim(order_type) AS order_type, max(order_type2) AS order_type2 FROM ordertype_map GROUP BY 1),
{name}_dm AS (SELECT distribution_type, max(distribution) AS distribution FROM distribution_map GROUP BY 1),
{name}_1 AS (SELECT 'ACC' AS source, substr(a.ou, 1, 4) AS ou, a.warranty, coalesce(om.product_type, a.org) AS org,
  {_norm_period('a.period')} AS period, coalesce(otm.order_type2, a.order_type) AS order_type,
  CASE WHEN coalesce(regexp_matches(upper(a.bill_to_location), '{I.RETAIL_SUFFIX}'), false) THEN 'Retail' ELSE 'Channel' END
    AS bill_to_location,
  a.csid, a.item, a.item_description, a.quantity, trim(a.class_code) AS distribution_type, a.apply_prod_line,
  a.sales_revenue, a.sales_discount, a.sales_net, a.sales_cost
  FROM acc_sheet a LEFT JOIN {name}_om om ON trim(a.org) = om.org
  LEFT JOIN {name}_otm otm ON trim(a.order_type) = otm.order_type
  WHERE NOT coalesce({kw}, false) AND {keep}
    AND NOT coalesce(trim(a.series) IN ('NB ACCY', 'NR-ACCESSORY'), false) AND contains(a.item, '-M')),
{name}_2 AS (SELECT b.*, substr(b.period, 1, 4) AS year, substr(b.period, 5, 2) AS month, {_quarter('b.period')} AS quarter,
  dm.distribution, x.fx_rate, x.fx_rate_ex
  FROM {name}_1 b LEFT JOIN {name}_dm dm ON dm.distribution_type = b.distribution_type
  LEFT JOIN fx_rates x ON x.product_line = b.apply_prod_line AND x.period = b.period),
{name} AS (SELECT source, ou, warranty, org, period, year, month, quarter, order_type, bill_to_location, csid, item,
  item_description, quantity, distribution_type, distribution, apply_prod_line,
  {rev} AS revenue_rmb, {_fxdiv(rev, 'fx_rate')} AS revenue_usd_hedge_rate, {_fxdiv(rev, 'fx_rate_ex')} AS revenue_fxdiff,
  {cost} AS local_cogs_amount_rmb, {_fxdiv(cost, 'fx_rate')} AS local_cogs_amount,
  {_fxdiv(cost, 'fx_rate_ex')} AS local_cogs_amount_fxdiff{extra}
  FROM {name}_2 WHERE length(trim(period)) > 0)"""


def _classify_sql(st_col, sg_col, reg_col, rc_col):
    st, sg = f"upper(trim({st_col}))", f"upper(trim({sg_col}))"
    reg, rc = f"upper(trim({reg_col}))", f"upper(trim({rc_col}))"
    return f"""CASE WHEN coalesce(contains(upper({sg_col}), 'RETAIL'), false) THEN 'Direct Retail'
       WHEN coalesce(contains(upper({sg_col}), 'REFURBISH'), false) THEN 'Refurbish'
       WHEN coalesce(contains(upper({sg_col}), 'CHANNEL'), false) THEN 'Channel' ELSE {st_col} END AS business_type,
  CASE WHEN {reg} = 'SA' THEN 'LATAM' WHEN {reg} = 'NA' THEN 'ACI' ELSE {reg} END AS territory,
  CASE WHEN {reg} = 'SA' THEN 'LATAM' ELSE {reg} END AS territory2,
  CASE WHEN {st} = 'REFURBISH' THEN 'Refurbish' WHEN {st} = 'CSC' THEN 'CSC' ELSE 'Standard' END AS order_type,
  CASE WHEN {rc} = 'CA' THEN 'CA' WHEN {st} = 'CHANNEL-US' THEN 'US-CHANNEL'
       WHEN {rc} = 'US' AND {sg} = 'RETAIL' THEN 'US-Retail' ELSE trim({st_col}) END AS branch"""


def _country_sql(name, upper_keys):
    n = (lambda c: f"upper(trim({c}))") if upper_keys else (lambda c: f"trim({c})")
    return f"""{name}_cid AS (SELECT {n('country_id')} AS k, max(country_zh) AS z FROM country_names GROUP BY 1),
{name}_cnm AS (SELECT {n('country_name')} AS k, max(country_zh) AS z FROM country_names GROUP BY 1)""", n


def aci_weekly_sql(name="aci_w"):
    ctes, n = _country_sql(name, True)
    return f"""{ctes},
{name} AS (SELECT 'ACI' AS source, a.sheet, a.sales_type, a.part_no,
  {_classify_sql('a.sales_type', 'a.sales_group', 'a.region', 'a.revenue_country')},
  {_norm_period('a.period')} AS period, substr({_norm_period('a.period')}, 1, 4) AS year,
  substr({_norm_period('a.period')}, 5, 2) AS month, {_quarter(_norm_period('a.period'))} AS quarter,
  trim(a.revenue_country) AS country_id, coalesce(ci.z, cn.z) AS country_chinese, a.cust_full_name,
  {_safe('a.sales_qty_fg')} AS quantity,
  coalesce({_safe('a.revenue_amt')}, CAST(0 AS DECIMAL(38,15))) AS revenue_usd_hedge_rate,
  CAST(coalesce({_safe('a.revenue_amt')}, CAST(0 AS DECIMAL(38,15))) - coalesce({_safe('a.total_cn_amt')}, CAST(0 AS DECIMAL(38,15)))
    AS DECIMAL(38,15)) AS net_revenue_usd_agp,
  {_safe('a.cogs_amt')} AS cogs_amount, {_safe('a.csc_unit_cost')} AS csc_unit_cost,
  {_safe('a.total_csc_cost')} AS total_csc_cost
  FROM aci_sheet a LEFT JOIN {name}_cid ci ON ci.k = {n('a.revenue_country')}
  LEFT JOIN {name}_cnm cn ON cn.k = {n('a.revenue_country')}
  WHERE coalesce(trim(a.sales_type) <> 'CSC', true) AND contains(a.part_no, '-M'))"""


def aci_monthly_sql(name="aci_m"):
    ctes, n = _country_sql(name, False)
    return f"""{ctes},
{name} AS (SELECT 'ACI' AS source, a.region, a.revenue_country, a.sales_type AS type,
  {_classify_sql('a.sales_type', 'a.sales_group', 'a.region', 'a.revenue_country')},
  a.sheet AS product_line, {_norm_period('a.period')} AS period, substr({_norm_period('a.period')}, 1, 4) AS year,
  substr({_norm_period('a.period')}, 5, 2) AS month, {_quarter(_norm_period('a.period'))} AS quarter,
  a.cust_full_name AS sold_to_customer, a.part_no AS item, a.item_description,
  {_safe('a.sales_qty_fg')} AS quantity, {_safe('a.revenue_amt')} AS sales_amount,
  {_safe('a.cogs_amt')} AS material_cost_amt, a.ar_trx_type, coalesce(ci.z, cn.z) AS country_chinese
  FROM aci_sheet a LEFT JOIN {name}_cid ci ON ci.k = {n('a.revenue_country')}
  LEFT JOIN {name}_cnm cn ON cn.k = {n('a.revenue_country')}
  WHERE coalesce(a.sales_type <> 'Other', true) AND contains(a.part_no, '-M')
    AND upper(trim(a.sheet)) IN ('NB', 'NR', 'NV'))"""


_ING_VIEWS = ["acc_sheet", "aci_sheet", "org_map", "ordertype_map", "distribution_map", "country_names", "fx_rates",
              "funding", "fact_sales", "cn_rates", "cost_range", "branch_freight", "cost_pn", "finance_detail", "item_code",
              "ship_unit", "country_group", "fx_matrix", "opp_rebate", "cost_branch", "quotes"]

# ---------------------------------------------------------------- registered queries


@query("fact_acc_weekly", _ING_VIEWS, f"WITH {acc_sql(False, 'acc_w')}\nSELECT * FROM acc_w")
def fact_acc_weekly_q(t):
    """RMB-source weekly fact."""
    return acc(t, False)


@query("fact_acc_monthly", _ING_VIEWS, f"WITH {acc_sql(True, 'acc_m')}\nSELECT * FROM acc_m")
def fact_acc_monthly_q(t):
    """RMB-source monthly fact (whole-unit filter, cost negated, no credit note)."""
    return acc(t, True)


@query("fact_aci_weekly", _ING_VIEWS, f"WITH {aci_weekly_sql()}\nSELECT {', '.join(I.ACI_WEEKLY_CONTRACT)} FROM aci_w")
def fact_aci_weekly_q(t):
    """D3: USD-source weekly fact."""
    return aci(t, False)


@query("fact_aci_monthly", _ING_VIEWS, f"WITH {aci_monthly_sql()}\nSELECT {', '.join(I.ACI_MONTHLY_CONTRACT)} FROM aci_m")
def fact_aci_monthly_q(t):
    """USD-source monthly fact."""
    return aci(t, True)


_COMBINED = [c for c in GP.LOCAL_COLUMNS if c not in ("l_orderkey", "l_linenumber")]


def _amt(x):
    return f"CAST({x} AS DECIMAL(20,6))"


def _combined_sql(monthly: bool) -> str:
    """Both sheets' facts stacked, then the D10 chain over them."""
    none = "CAST(NULL AS DECIMAL(20,6))"
    acc_name, aci_name = ("acc_m", "aci_m") if monthly else ("acc_w", "aci_w")
    usd = (f"""product_line, year, quarter, month, period, sold_to_customer, order_type, business_type, NULL, NULL, NULL, territory, territory2,
    branch, trim(revenue_country), country_chinese, trim(revenue_country), NULL, NULL, NULL, item, item_description, {_amt('quantity')},
    {_amt('sales_amount')}, {_amt('material_cost_amt')}, {none}, {none}, {none}""" if monthly else
           f"""sheet, year, quarter, month, period, cust_full_name, order_type, business_type, NULL, NULL, NULL, territory, territory2,
    branch, country_id, country_chinese, country_id, NULL, NULL, NULL, part_no, NULL, {_amt('quantity')}, {_amt('revenue_usd_hedge_rate')},
    {_amt('cogs_amount')}, {_amt('revenue_usd_hedge_rate - net_revenue_usd_agp')}, {_amt('csc_unit_cost')}, {_amt('total_csc_cost')}""")
    return f"""WITH {acc_sql(monthly, acc_name)}, {aci_monthly_sql() if monthly else aci_weekly_sql()},
both_sheets AS (SELECT 'ACCRAW' AS source, apply_prod_line AS product_line_id, year, quarter, month, period, CAST(NULL AS VARCHAR) AS sold_to_customer,
    order_type, bill_to_location AS business_type, org AS product_type, distribution, distribution_type, 'ACC' AS territory, 'ACC' AS territory2,
    'ACC' AS branch, 'CN' AS country_id, '中國大陸' AS country_chinese, 'CN' AS country_code, ou, warranty, csid, item AS part_number,
    item_description AS description, {_amt(_safe('quantity'))} AS all_qty, {_amt('revenue_rmb')} AS revenue, {_amt('local_cogs_amount_rmb')} AS local_cogs,
    {none if monthly else _amt('credit_note_rmb')} AS sheet_credit_note, {none} AS sheet_csc_ratio, {none} AS sheet_csc_amt FROM {acc_name}
  UNION ALL SELECT 'ACIRAW', {usd} FROM {aci_name}),
{local_sql(monthly, 'both_sheets', _COMBINED)}
SELECT *, '{'monthly' if monthly else 'weekly'}' AS freq FROM local_data"""


def _combined(t, monthly: bool):
    sales = I.combined_sales(acc(t, monthly), aci(t, monthly), monthly)
    f = GP.local_data(sales, t["fx_rates"], t["branch_freight"], t["funding"], t["cost_range"], t["cn_rates"], monthly)
    return f.withColumn("freq", F.lit("monthly" if monthly else "weekly"))


@query("combined_fact_weekly", _ING_VIEWS, _combined_sql(False))
def combined_fact_weekly_q(t):
    """D10 weekly: both sources in one contract with fees, cost period, funding and the sheets' own credit notes."""
    return _combined(t, False)


@query("combined_fact_monthly", _ING_VIEWS, _combined_sql(True))
def combined_fact_monthly_q(t):
    """D10 monthly: credit notes by the rule cascade, net revenue = revenue less credit note; negative quantities earn no funding."""
    return _combined(t, True)


@query("shipping_fee", _ING_VIEWS, """
WITH b AS (SELECT product_line, sales_team, period, max(freight) AS freight FROM branch_freight GROUP BY 1, 2, 3),
s AS (SELECT f.l_orderkey, f.l_linenumber, f.source, x.fx_rate, x.fx_rate_ex,
  -(CAST(b.freight AS DOUBLE) * CAST(f.all_qty AS DOUBLE)) AS ship_fee_local
  FROM fact_sales f
  LEFT JOIN b ON b.product_line = f.product_line_id AND b.sales_team = lower(f.branch) AND b.period = f.period
  LEFT JOIN fx_rates x ON x.product_line = f.product_line_id AND x.period = f.period)
SELECT l_orderkey, l_linenumber, source, ship_fee_local,
  CASE WHEN source = 'ACCRAW' THEN CASE WHEN CAST(fx_rate AS DOUBLE) <> 0 THEN ship_fee_local / CAST(fx_rate AS DOUBLE) END
       ELSE ship_fee_local END AS ship_fee_usd_hedge,
  CASE WHEN source = 'ACCRAW' THEN CASE WHEN CAST(fx_rate_ex AS DOUBLE) <> 0 THEN ship_fee_local / CAST(fx_rate_ex AS DOUBLE) END
       ELSE ship_fee_local END AS ship_fee_usd_ex
FROM s""")
def shipping_fee_q(t):
    """Shipping fee = −(freight per unit × quantity); RMB source converted at both rates."""
    f = t["fact_sales"]
    f = L.star_enrich(f, [
        L.LookupSpec(t["branch_freight"], {"product_line": "product_line_id", "sales_team": F.lower(F.col("branch")),
                                           "period": "period"}, {"freight": "freight"}),
        L.LookupSpec(t["fx_rates"], {"product_line": "product_line_id", "period": "period"},
                     {"fx_rate": "fx_rate", "fx_rate_ex": "fx_rate_ex"})])
    ship = -(F.col("freight").cast("double") * F.col("all_qty").cast("double"))
    acc_ = F.col("source") == "ACCRAW"

    def conv(rate):
        r = F.col(rate).cast("double")
        return F.when(acc_, F.when(r != 0, F.col("ship_fee_local") / r)).otherwise(F.col("ship_fee_local"))

    f = f.withColumn("ship_fee_local", ship)
    return f.select("l_orderkey", "l_linenumber", "source", "ship_fee_local",
                    conv("fx_rate").alias("ship_fee_usd_hedge"), conv("fx_rate_ex").alias("ship_fee_usd_ex"))


@query("cost_period", _ING_VIEWS, """
WITH r AS (SELECT trim(pn) AS pn, trim(version) AS version, max(cost_range) AS cost_range FROM cost_range GROUP BY ALL)
SELECT l_orderkey, l_linenumber, CASE WHEN source = 'ACIRAW' OR product_line_id = 'NB' THEN coalesce(cost_range, '由新到舊')
  ELSE '由新到舊' END AS cost_period
FROM fact_sales f LEFT JOIN r ON r.pn = f.part_number AND r.version = f.period""")
def cost_period_q(t):
    """Cost period by the (part, version) range table and the lines of each source."""
    return I.cost_period(t["fact_sales"], t["cost_range"]).select("l_orderkey", "l_linenumber", "cost_period")


@query("funding", _ING_VIEWS, """
WITH fu AS (SELECT trim(pn) AS pn, period, max(funding) AS funding FROM funding GROUP BY 1, 2)
SELECT f.l_orderkey, f.l_linenumber, fu.funding AS funding_unit,
  CAST(CAST(fu.funding AS DECIMAL(38,6)) AS DOUBLE)
    * (CASE WHEN CAST(CAST(f.all_qty AS DECIMAL(38,6)) AS DOUBLE) < 0 THEN 0.0
            ELSE CAST(CAST(f.all_qty AS DECIMAL(38,6)) AS DOUBLE) END) AS funding_amount
FROM fact_sales f LEFT JOIN fu ON fu.pn = f.part_number AND fu.period = f.period""")
def funding_q(t):
    """funding = per-unit funding × quantity (monthly: 0 for negative quantity)."""
    f = t["fact_sales"]
    fu = t["funding"].select(F.trim("pn").alias("pn"), "period", "funding")
    f = L.star_enrich(f, [L.LookupSpec(fu, {"pn": "part_number", "period": "period"}, {"funding": "funding_unit"})])
    q = I.exact_double("all_qty")
    return f.select("l_orderkey", "l_linenumber", "funding_unit",
                    (I.exact_double("funding_unit") * F.when(q < 0, F.lit(0.0)).otherwise(q)).alias("funding_amount"))


@query("credit_note", _ING_VIEWS, f"""WITH {CN_CASCADE_SQL},
c AS (SELECT cascade.*, x.fx_rate, x.fx_rate_ex,
  CAST(CAST(cascade.revenue AS DECIMAL(20,8)) * CAST(cascade.cn AS DECIMAL(17,7)) AS DECIMAL(34,15)) AS cn_local
  FROM cascade LEFT JOIN fx_rates x ON x.product_line = cascade.product_line_id AND x.period = cascade.period)
SELECT l_orderkey, l_linenumber, source, cn,
  CASE WHEN source = 'ACCRAW' THEN cn_local END AS credit_note_rmb,
  CASE WHEN source = 'ACCRAW' THEN {_fxdiv('cn_local', 'fx_rate')} ELSE {_xd('cn_local')} END AS credit_note_hedge_rate,
  CASE WHEN source = 'ACCRAW' THEN {_fxdiv('cn_local', 'fx_rate_ex')} ELSE {_xd('cn_local')} END AS credit_note_fxdiff
FROM c""")
def credit_note_q(t):
    """Credit-note rate by the four-rule cascade × revenue (three currencies for
    the RMB source, two for the USD source)."""
    c = L.star_enrich(cn_cascade(t), [L.LookupSpec(t["fx_rates"], {"product_line": "product_line_id", "period": "period"},
                                                   {"fx_rate": "fx_rate", "fx_rate_ex": "fx_rate_ex"})])
    c = c.withColumn("cn_local", M.mul("revenue", "cn"))
    acc_ = F.col("source") == "ACCRAW"
    return c.select("l_orderkey", "l_linenumber", "source", "cn",
                    F.when(acc_, F.col("cn_local")).alias("credit_note_rmb"),
                    F.when(acc_, I.fx_div(F.col("cn_local"), "fx_rate")).otherwise(I.exact_double("cn_local"))
                    .alias("credit_note_hedge_rate"),
                    F.when(acc_, I.fx_div(F.col("cn_local"), "fx_rate_ex")).otherwise(I.exact_double("cn_local"))
                    .alias("credit_note_fxdiff"))


@query("net_revenue", _ING_VIEWS, f"""WITH {CN_CASCADE_SQL}
SELECT l_orderkey, l_linenumber,
  CAST(coalesce(CAST(revenue AS DECIMAL(34,15)), 0)
       - coalesce(CAST(CAST(CAST(revenue AS DECIMAL(20,8)) * CAST(cn AS DECIMAL(17,7)) AS DECIMAL(34,15)) AS DECIMAL(34,15)), 0)
    AS DECIMAL(34,15)) AS net_revenue
FROM cascade""")
def net_revenue_q(t):
    """Net revenue = revenue − credit note, NULL counted as 0."""
    c = cn_cascade(t)
    return c.select("l_orderkey", "l_linenumber",
                    M.signed_sum(plus=["revenue"], minus=[M.mul("revenue", "cn")]).alias("net_revenue"))


_GL = """CASE WHEN TRY_CAST(gl_date AS DOUBLE) IS NOT NULL
  THEN CAST(DATE '1899-12-30' + CAST(floor(TRY_CAST(gl_date AS DOUBLE)) AS INTEGER) AS DATE)
  ELSE coalesce(TRY_CAST(TRY_STRPTIME(gl_date, '%Y-%m-%d') AS DATE), TRY_CAST(TRY_STRPTIME(gl_date, '%Y/%m/%d') AS DATE)) END"""


@query("finance_keypart", _ING_VIEWS, f"""
WITH ic AS (SELECT item_code, max(category) AS category FROM item_code GROUP BY item_code)
SELECT d.order_type, d.item_no, d.item_description, d.quantity, d.net_sale_amount, d.material_cost, d.ag_no,
  CASE WHEN contains(d.item_description, 'BRA') THEN 'BR' WHEN ic.category IS NOT NULL THEN ic.category
       WHEN starts_with(d.item_description, 'DDR') OR starts_with(d.item_description, 'LPD')
         OR starts_with(d.item_description, 'GDDR') OR starts_with(d.item_description, 'LP') THEN 'DDR'
       WHEN starts_with(d.item_description, 'FLASH') THEN 'FLASH' ELSE 'SSD' END AS category,
  {_GL} AS gl_date, strftime({_GL}, '%Y%m') AS gl_yearmonth, 'NB' AS product_line,
  0 AS cogs_price, 0 AS equo_price, 0 AS bs_gap
FROM finance_detail d LEFT JOIN ic ON substr(d.item_no, 1, 2) = ic.item_code
WHERE d.ag_no_check <> '無B&S Group' AND d.material_cost <> 0
  AND d.order_type IN ('B&S-RM EX-113', 'B&S-RM EX Book-113')""")
def finance_keypart_q(t):
    """Key-part detail: conjunctive filter, category waterfall, date → month."""
    return I.finance_keypart(t["finance_detail"], t["item_code"], "NB")


@query("load_fx", _ING_VIEWS, """
SELECT period, 'nb' AS product_line, nb AS fx_rate, 'fx matrix' AS label FROM fx_matrix WHERE nb IS NOT NULL
UNION ALL SELECT period, 'nr', nr, 'fx matrix' FROM fx_matrix WHERE nr IS NOT NULL
UNION ALL SELECT period, 'nv', nv, 'fx matrix' FROM fx_matrix WHERE nv IS NOT NULL""")
def load_fx_q(t):
    """D12 FX matrix load."""
    return I.load_fx(t["fx_matrix"], "fx matrix")


@query("load_pac", _ING_VIEWS, """
SELECT part_number AS pn, period, item_cost_usd AS pac,
  upper(regexp_extract('pac_' || lower(substr(part_number, 3, 2)), '_([a-z]+)$', 1)) AS product_line FROM cost_pn""")
def load_pac_q(t):
    """D12 standard-price load: headers lower-cased, product line parsed from the
    (file) name suffix and upper-cased (S8)."""
    c = t["cost_pn"].select(F.col("part_number").alias("PN"), F.col("period").alias("Period"),
                            F.col("item_cost_usd").alias("PAC"))
    c = c.toDF(*[x.lower() for x in c.columns])
    name = F.concat(F.lit("pac_"), F.lower(F.substring("pn", 3, 2)))
    return c.withColumn("product_line", F.upper(F.regexp_extract(name, "_([a-z]+)$", 1)))


@query("load_shipunit", _ING_VIEWS, """
WITH g AS (SELECT DISTINCT geo, country_code AS country FROM country_group),
tr AS (SELECT DISTINCT territory, country_code AS country FROM country_group)
SELECT s.product_line, s.ship_way_type, s.unit_shipfee, s.unit_storage_fee, s.period, s.freq, g.country
FROM ship_unit s LEFT JOIN g ON s.geo = g.geo WHERE s.product_line = 'NB'
UNION ALL
SELECT s.product_line, s.ship_way_type, s.unit_shipfee, s.unit_storage_fee, s.period, s.freq, tr.country
FROM ship_unit s LEFT JOIN tr ON s.territory = tr.territory WHERE s.product_line IN ('NR', 'NV')""")
def load_shipunit_q(t):
    """D12 shipping-unit load: NB by geo, NR/NV by territory."""
    return I.load_shipunit(t["ship_unit"], t["country_group"])


@query("load_opp", _ING_VIEWS, """
SELECT DISTINCT sku90pn, opp_rebate, period, 'monthly' AS freq, product_line FROM opp_rebate""")
def load_opp_q(t):
    """D12 OPP rebate load (A5)."""
    return I.load_opp(t["opp_rebate"])


@query("load_default", _ING_VIEWS, """SELECT DISTINCT item_no, group_no, buying_mode FROM quotes""")
def load_default_q(t):
    """D12 default load: exact duplicate rows removed (A5)."""
    return t["quotes"].select("item_no", "group_no", "buying_mode").dropDuplicates()


@query("load_model_cost", _ING_VIEWS, """
SELECT sales_team, model_name, cpu, period,
  CAST(sum(item_cost_usd) AS DOUBLE) / CAST(count(item_cost_usd) AS DOUBLE) AS item_cost_usd
FROM cost_branch WHERE sales_team IS NOT NULL AND model_name IS NOT NULL AND cpu IS NOT NULL AND period IS NOT NULL
GROUP BY 1, 2, 3, 4""")
def load_model_cost_q(t):
    """D12 model/CPU cost load: average per key, NULL keys dropped (A1)."""
    return I.load_model_cost(t["cost_branch"])


@query("load_funding", _ING_VIEWS, """
SELECT pn, period, funding FROM funding
WHERE TRY_CAST(trim(CAST(funding AS VARCHAR)) AS DOUBLE) IS NULL OR TRY_CAST(trim(CAST(funding AS VARCHAR)) AS DOUBLE) <> 0""")
def load_funding_q(t):
    """D12 funding load: zero rows dropped, NULL kept."""
    return I.load_funding(t["funding"])
